"""Row predicates and table bisection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def bisect_mask(df: DataFrame, feature: str, cutoff) -> Column:
    """C1 mask: numeric features go left when ``x >= cutoff``, others when ``x == cutoff``.

    NULL compares as false, so the two sides always partition the table.
    """
    dtype = df.schema[feature].dataType
    cond = F.col(feature) >= F.lit(cutoff) if isinstance(dtype, NumericType) \
        else F.col(feature) == F.lit(cutoff)
    return F.coalesce(cond, F.lit(False))


def bisect(df: DataFrame, feature: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """Both sides as filtered DataFrames.

    The sides are written as plain comparisons (``x >= c`` and
    ``x IS NULL OR x < c``; ``=`` / ``!=`` for non-numeric features) rather than
    the coalesced mask, so Parquet receives them as pushed filters; NULL goes
    right, exactly as with the mask.
    """
    dtype = df.schema[feature].dataType
    x, c = F.col(feature), F.lit(cutoff)
    if isinstance(dtype, NumericType):
        left, right = x >= c, x.isNull() | (x < c)
    else:
        left, right = x == c, x.isNull() | (x != c)
    return df.filter(left), df.filter(right)


def hinge_active(y: str | Column, score: str | Column) -> Column:
    """Rows inside the margin, y·score < 1."""
    y = F.col(y) if isinstance(y, str) else y
    s = F.col(score) if isinstance(score, str) else score
    return y * s < F.lit(1.0)
