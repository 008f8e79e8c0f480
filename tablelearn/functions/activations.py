"""Sigmoid and (log-)softmax expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .linalg import total


def sigmoid(z: Column) -> Column:
    """1 / (1 + e^-z)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def sigmoid_gradient(z: Column) -> Column:
    s = sigmoid(z)
    return s * (F.lit(1.0) - s)


def logsumexp(scores: Sequence[Column]) -> Column:
    """Max-shifted log Σ exp(s_k) over a short list of columns."""
    m = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return m + F.log(total([F.exp(s - m) for s in scores]))


def log_softmax(scores: Sequence[Column]) -> list[Column]:
    lse = logsumexp(scores)
    return [s - lse for s in scores]


def softmax(scores: Sequence[Column]) -> list[Column]:
    return [F.exp(s) for s in log_softmax(scores)]
