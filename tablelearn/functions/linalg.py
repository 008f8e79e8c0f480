"""Vector arithmetic over lists of DOUBLE columns.

Feature vectors are lists of scalar columns, and model parameters are Python
floats that enter the plan as literals, so each expression below compiles to
straight-line generated code (no higher-order array functions).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_list(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def total(terms: Sequence[Column]) -> Column:
    terms = list(terms)
    if not terms:
        return F.lit(0.0)
    return reduce(add, terms)


def sql_double(x: float) -> str:
    """An exact DOUBLE literal for generated Spark SQL (``repr`` round-trips)."""
    x = float(x)
    if x != x or x in (float("inf"), float("-inf")):
        return f"CAST('{x}' AS DOUBLE)"
    return f"{x!r}D"


def _names(cols) -> bool:
    return all(isinstance(c, str) for c in cols)


def dot(cols: Sequence[str | Column], weights: Sequence[float], bias: float = 0.0) -> Column:
    """X·w + b as one generated sum.

    With named columns the sum is emitted as one SQL expression (one JVM call
    however many weights) — the same plan as composing Columns.
    """
    if len(cols) != len(weights):
        raise ValueError(f"width mismatch: {len(cols)} features vs {len(weights)} weights")
    if _names(cols):
        terms = [f"`{c}` * {sql_double(w)}" for c, w in zip(cols, weights)] or ["0D"]
        return F.expr(f"(({' + '.join(terms)}) + {sql_double(bias)})")
    terms = [c * F.lit(float(w)) for c, w in zip(col_list(cols), weights)]
    return total(terms) + F.lit(float(bias))


def col_dot(a: Sequence[str | Column], b: Sequence[str | Column]) -> Column:
    a, b = col_list(a), col_list(b)
    if len(a) != len(b):
        raise ValueError(f"width mismatch: {len(a)} vs {len(b)}")
    return total([x * y for x, y in zip(a, b)])


def sq_dist(cols: Sequence[str | Column], center: Sequence[float | Column]) -> Column:
    """Squared Euclidean distance from a row to a fixed point (or paired columns)."""
    if len(cols) == len(center) and _names(cols) and not any(isinstance(m, Column) for m in center):
        terms = [f"(`{c}` - {sql_double(m)}) * (`{c}` - {sql_double(m)})" for c, m in zip(cols, center)]
        return F.expr("(" + (" + ".join(terms) or "0D") + ")")
    cols = col_list(cols)
    if len(cols) != len(center):
        raise ValueError(f"width mismatch: {len(cols)} vs {len(center)}")
    terms = []
    for c, m in zip(cols, center):
        d = c - (m if isinstance(m, Column) else F.lit(float(m)))
        terms.append(d * d)
    return total(terms)


def euclidean(cols: Sequence[str | Column], other: Sequence[float | Column]) -> Column:
    """Euclidean distance."""
    return F.sqrt(sq_dist(cols, other))


def argmin_index(values: Sequence[Column]) -> Column:
    """Index of the smallest value; the lowest index wins ties."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def argmax_index(values: Sequence[Column]) -> Column:
    """Index of the largest value; the lowest index wins ties."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def pick(values: Sequence, index: Column) -> Column:
    """values[index] for a literal list (e.g. class labels); NULL for a NULL index, which
    ``element_at`` on a literal array would read as some entry."""
    return F.when(index.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in values]), index + 1))
