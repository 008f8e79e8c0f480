"""A2: one data-quality aggregate that replaces per-call array checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validate_array_features(df: DataFrame, features: str, label: str | None = None) -> DataFrame:
    """Counts of rows, null vectors, NaN/inf/null entries, min/max width, null labels."""
    f = F.col(features)
    bad = F.size(F.filter(f, lambda x: x.isNull() | F.isnan(x) |
                          (F.abs(x) == F.lit(float("inf")))))
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(f.isNull()).alias("n_null_vectors"),
            F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("n_bad_values"),
            F.min(F.size(f)).cast("bigint").alias("min_width"),
            F.max(F.size(f)).cast("bigint").alias("max_width")]
    if label:
        aggs.append(F.count_if(F.col(label).isNull()).alias("n_null_labels"))
    return df.agg(*aggs)


def validate_columns(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Same checks for scalar feature columns."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    bad = None
    for c in features:
        b = (F.col(c).isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))).cast("int")
        bad = b if bad is None else bad + b
    aggs.append(F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("n_bad_values"))
    if label:
        aggs.append(F.count_if(F.col(label).isNull()).alias("n_null_labels"))
    return df.agg(*aggs)


def assert_valid(report: DataFrame) -> None:
    """Raise if the report shows any invalid entry or ragged widths."""
    r = report.first().asDict()
    problems = [k for k in ("n_null_vectors", "n_bad_values", "n_null_labels") if r.get(k)]
    if "min_width" in r and r["min_width"] != r["max_width"]:
        problems.append("ragged widths")
    if problems:
        raise ValueError(f"invalid feature table: {problems} in {r}")


def invalid_row(cols: Sequence[str], label: str | None = None):
    """Boolean column: the row has a NULL / NaN / ±inf feature (or a NULL label)."""
    bad = None
    for c in cols:
        b = F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf")))
        bad = b if bad is None else bad | b
    if label is not None:
        lb = F.col(label).isNull()
        bad = lb if bad is None else bad | lb
    return F.coalesce(bad, F.lit(True)) if bad is not None else F.lit(False)


def count_invalid(cols: Sequence[str], label: str | None = None, name: str = "_invalid"):
    """Aggregate counting invalid rows; add it to an existing ``agg`` so the
    check rides on a pass the fit makes anyway."""
    return F.count_if(invalid_row(cols, label)).alias(name)


def raise_if_invalid(n_invalid, what: str = "feature table") -> None:
    if n_invalid:
        raise ValueError(f"{what}: {n_invalid} rows have NULL, NaN or infinite values")


def assert_finite(df: DataFrame, cols: Sequence[str], label: str | None = None) -> int:
    """One aggregate pass: raise on invalid rows, return the row count."""
    r = df.agg(F.count(F.lit(1)).alias("n"), count_invalid(cols, label)).first()
    raise_if_invalid(r["_invalid"])
    return r["n"]
