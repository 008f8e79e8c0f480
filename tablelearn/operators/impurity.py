"""Entropy, information gain, variance reduction, majority class.

Counts come from ``groupBy`` (map-side combined), so a label holding most of
the rows is one partial-aggregate row per partition, never a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entropy(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """-Σ p ln p in nats per group (``by``); an empty input has no rows."""
    by = list(by)
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("c"))
    tot = counts.groupBy(*by).agg(F.sum("c").alias("n"),
                                  F.sum(F.col("c") * F.log("c")).alias("clnc"))
    # H = ln n - Σ c ln c / n
    h = F.log("n") - F.col("clnc") / F.col("n")
    if not by:
        # the ungrouped aggregate of an empty column is one NULL row: an error, not a value
        h = F.when(F.col("n").isNull(), F.raise_error(F.lit("entropy of an empty column"))).otherwise(h)
        return tot.select(F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"), h.cast("double").alias("entropy"))
    return tot.select(*by, "n", h.alias("entropy"))


def _xlnx(c: Column) -> Column:
    return F.when(c > 0, c * F.log(c)).otherwise(F.lit(0.0))


def information_gain(df: DataFrame, label: str, mask: Column) -> DataFrame:
    """H(y) - n_l/n·H(y_l) - n_r/n·H(y_r) in nats; 0 when a side is empty.

    Counts per (label, side) are pivoted to one row per label (K rows), and a
    final one-row aggregate combines them: H = ln n - Σ c ln c / n per side.
    """
    side = mask.alias("_left")
    per_label = (df.select(F.col(label), side).groupBy(label)
                 .agg(F.count_if("_left").alias("cl"), F.count_if(~F.col("_left")).alias("cr")))
    t = per_label.agg(F.sum("cl").alias("nl"), F.sum("cr").alias("nr"),
                      F.sum(_xlnx(F.col("cl").cast("double"))).alias("al"),
                      F.sum(_xlnx(F.col("cr").cast("double"))).alias("ar"),
                      F.sum(_xlnx((F.col("cl") + F.col("cr")).cast("double"))).alias("at"))
    n = F.col("nl") + F.col("nr")
    h = F.log(n) - F.col("at") / n
    hl = F.log("nl") - F.col("al") / F.col("nl")
    hr = F.log("nr") - F.col("ar") / F.col("nr")
    gain = h - F.col("nl") / n * hl - F.col("nr") / n * hr
    return t.select(F.when((F.col("nl") == 0) | (F.col("nr") == 0), F.lit(0.0))
                    .otherwise(gain).alias("information_gain"))


def variance_reduction(df: DataFrame, targets: Sequence[str], mask: Column) -> DataFrame:
    """E5: Σ_outputs [var(y) - n_l/n·var(y_l) - n_r/n·var(y_r)] (population variance).

    For two sides this is the between-side variance n_l·n_r/n²·(m_l - m_r)²,
    which needs only the side counts and means (no cancellation).
    """
    sided = df.select(*targets, mask.alias("_left"))
    agg = [F.count_if("_left").alias("nl"), F.count_if(~F.col("_left")).alias("nr")]
    for k, t in enumerate(targets):
        agg += [F.avg(F.when(F.col("_left"), F.col(t))).alias(f"ml{k}"),
                F.avg(F.when(~F.col("_left"), F.col(t))).alias(f"mr{k}")]
    t = sided.agg(*agg)
    n = (F.col("nl") + F.col("nr")).cast("double")
    w = F.col("nl") * F.col("nr") / (n * n)
    total = None
    for k in range(len(targets)):
        d = F.col(f"ml{k}") - F.col(f"mr{k}")
        term = w * d * d
        total = term if total is None else total + term
    return t.select(F.when((F.col("nl") == 0) | (F.col("nr") == 0), F.lit(0.0))
                    .otherwise(total).alias("variance_reduction"))


def majority_class(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent label per group; ties go to the smallest label.

    ``min_by(label, (-count, label))`` is an ordinary aggregate, so no window
    and no per-group sort are needed.
    """
    by = list(by)
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("c"))
    key = F.struct((-F.col("c")).alias("nc"), F.col(label).alias("v"))
    return counts.groupBy(*by).agg(F.min_by(label, key).alias("majority"),
                                   F.max("c").alias("count"))
