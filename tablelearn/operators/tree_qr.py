"""Upper triangular factor of a tall table, by a tree of small QR decompositions.

A task reduces its rows batch by batch to a p x p triangle (QR of the triangle so far on top of
the batch); triangles are stacked and reduced again, at most MERGE at a time, in two levels.
The triangle carries the table's singular values and right singular vectors and solves least
squares without forming a Gram matrix, whose condition number would be the square. One scan;
what is shuffled and collected is p x p a task, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.validate import raise_if_invalid

MERGE = 64
_SCHEMA = "n bigint, bad bigint, r array<double>"


def tree_qr(df: DataFrame, cols: Sequence[str], ones: bool = True) -> tuple[int, np.ndarray]:
    """(rows, R) of the columns, after a column of ones if ``ones``; raises on NULL, NaN or
    infinite entries. R has a non-negative diagonal."""
    cols = list(cols)
    p = len(cols) + ones
    tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def record(n: int, bad: int, r: np.ndarray) -> pa.RecordBatch:
        square = np.zeros((p, p))
        square[:len(r)] = r
        return pa.RecordBatch.from_arrays([pa.array([n]), pa.array([bad]), pa.array([square.reshape(-1)], pa.list_(pa.float64()))],
                                          ["n", "bad", "r"])

    def per_partition(batches):
        n, bad, r = 0, 0, np.zeros((0, p))
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(cols))])
            ok = np.isfinite(x).all(axis=1)
            bad += int((~ok).sum())
            x = x[ok]
            n += len(x)
            x = np.column_stack([np.ones(len(x)), x]) if ones else x
            r = np.linalg.qr(np.concatenate([r, x]), mode="r")
        if n or bad:
            yield record(n, bad, r)

    def merge(t: pa.Table) -> pa.Table:
        rs = np.concatenate([np.array(v.as_py()).reshape(p, p) for v in t.column("r")])
        total = {c: sum(t.column(c).to_pylist()) for c in ("n", "bad")}
        return pa.Table.from_batches([record(total["n"], total["bad"], np.linalg.qr(rs, mode="r"))])

    parts = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).mapInArrow(per_partition, _SCHEMA)
    if tasks > MERGE:
        shard = F.pmod(F.spark_partition_id(), F.lit(-(-tasks // MERGE)))
        parts = parts.withColumn("shard", shard).groupBy("shard").applyInArrow(merge, _SCHEMA)
    rows = parts.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(merge, _SCHEMA).collect()
    if not rows:
        return 0, np.zeros((p, p))
    raise_if_invalid(rows[0]["bad"])
    r = np.array(rows[0]["r"]).reshape(p, p)
    return rows[0]["n"], r * np.where(np.diag(r) < 0.0, -1.0, 1.0)[:, None]
