"""Append model scores computed with NumPy inside Arrow batches.

Generated expressions are the fast path for narrow models, but K classes x p
features beyond a few hundred terms exceed the JVM's 64 KB method limit and
Spark falls back to interpreted evaluation. For such wide models the K scores
are one matrix product per Arrow batch instead: still a map-only stage over
the same partitions, with the model parameters shipped in the task closure.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

MAX_GENERATED_TERMS = 160


def is_wide(n_features: int, n_outputs: int) -> bool:
    return n_features * n_outputs > MAX_GENERATED_TERMS


def null_rows(batch, cols: Sequence[str]) -> np.ndarray:
    """Rows with a NULL in any of the columns: their scores are NULL, as in the generated expressions."""
    return np.logical_or.reduce([batch.column(c).is_null().to_numpy(zero_copy_only=False) for c in cols])


def append_scores(df: DataFrame, features: Sequence[str], names: Sequence[str],
                  score_fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``df`` plus one DOUBLE column per name, ``score_fn(X) -> (rows, len(names))``."""
    import pyarrow as pa

    features, names = list(features), list(names)
    schema = StructType(list(df.schema.fields) + [StructField(n, DoubleType()) for n in names])

    def per_batch(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                 for c in features])
            s = np.asarray(score_fn(x), dtype=np.float64).reshape(b.num_rows, len(names))
            null = null_rows(b, features)
            cols = list(b.columns) + [pa.array(s[:, j], mask=null) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=list(b.schema.names) + names)

    return df.mapInArrow(per_batch, schema)


MAX_GENERATED_AGGREGATES = 256


def too_many_aggregates(n: int) -> bool:
    """More aggregate expressions than one generated aggregate should hold."""
    return n > MAX_GENERATED_AGGREGATES


def arrow_sums(df: DataFrame, columns: Sequence[str], size: int,
               batch_fn: Callable[[dict], np.ndarray]) -> np.ndarray:
    """Σ over all rows of ``batch_fn(batch) -> vector[size]``, computed per Arrow
    batch with NumPy, summed per partition, emitted as ``size`` long rows per
    partition and merged by ``groupBy(slot).sum``: a map-side-combined
    aggregate for statistics too wide for generated expressions (gradients
    of many features or classes)."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    columns = list(columns)

    def per_partition(batches):
        acc = np.zeros(size)
        for b in batches:
            if b.num_rows == 0:
                continue
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in columns}
            acc += np.asarray(batch_fn(cols), dtype=np.float64).reshape(size)
        yield pa.RecordBatch.from_pydict({"slot": np.arange(size, dtype=np.int32), "value": acc})

    rows = (df.select(*columns).mapInArrow(per_partition, "slot int, value double")
            .groupBy("slot").agg(F.sum("value").alias("value")).collect())
    out = np.zeros(size)
    for r in rows:
        out[r["slot"]] = r["value"]
    return out
