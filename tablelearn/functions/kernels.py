"""Kernel functions on paired feature vectors (column lists)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .linalg import col_dot, sq_dist

Kernel = Callable[[Sequence[Column], Sequence[Column]], Column]


def linear() -> Kernel:
    """K(u, v) = u·v."""
    return lambda u, v: col_dot(u, v)


def polynomial(p: int = 3) -> Kernel:
    """K(u, v) = (1 + u·v)^p."""
    return lambda u, v: F.pow(F.lit(1.0) + col_dot(u, v), F.lit(float(p)))


def rbf(gamma: float) -> Kernel:
    """K(u, v) = exp(-gamma ||u - v||^2)."""
    return lambda u, v: F.exp(F.lit(-float(gamma)) * sq_dist(u, list(v)))


def get_kernel(name: str, p: int = 2, gamma: float = 1.0) -> Kernel:
    if name == "linear":
        return linear()
    if name in ("poly", "polynomial"):
        return polynomial(p)
    if name == "rbf":
        return rbf(gamma)
    raise ValueError(f"unknown kernel {name!r}")
