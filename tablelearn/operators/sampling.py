"""A3 aligned shuffle and A4 seeded sample of k distinct rows.

Both order rows by ``md5(id || '#' || seed)``: reproducible in any engine,
independent of partitioning, and uniform. Because every row carries its own
features and label, permuting "X and y together" is automatic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def perm_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"#{seed}")))


def sample_k(df: DataFrame, id_col: str, k: int, seed: int = 0) -> DataFrame:
    """A4: k distinct rows (by id) without replacement.

    ``orderBy(..).limit(k)`` plans as TakeOrderedAndProject: every partition
    keeps its own top k and only k rows per partition reach the final merge.
    """
    if k < 0:
        raise ValueError("k must be non-negative")
    return df.orderBy(perm_key(id_col, seed), F.col(id_col)).limit(k)


def aligned_shuffle(df: DataFrame, id_col: str, seed: int = 0,
                    position: str = "position") -> DataFrame:
    """A3: a reproducible permutation with 0-based global positions.

    Range-partition on the permutation key (sampling bounds, no single-task
    sort), write the sorted partitions to the checkpoint folder so partition
    ids are fixed, count rows per partition (one small row per partition), and
    add each partition's offset to the row's index within it.
    """
    key = perm_key(id_col, seed)
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.withColumn("_k", key)
               .repartitionByRange(n_parts, "_k", id_col)
               .sortWithinPartitions("_k", id_col)
               .checkpoint(eager=True))
    tagged = ordered.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id())
    # one row per partition, so a window over all of them and a broadcast stay small
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"))
               .select("_pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, (F.col("_before") + local).alias(position)))
