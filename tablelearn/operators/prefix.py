"""Grouped suffix sums with bounded tasks.

For every row of a table keyed by (group, value) this adds the sum over rows of the
same group whose value is >= the row's value: the statistics of the
"x >= cutoff" side of every candidate split.

While no group holds more than ``target_rows`` values, a window per group does it.
Beyond that, the table is range-partitioned and sorted by (group, value descending) once,
so that a task's share is its range however large a group is; each task adds up its own
rows, and what earlier tasks hold of a group that goes on in the next one is added as an
offset. Only a task's first group can have begun earlier, so the offsets are one row a task
(a prefix sum over the tasks' last groups, itself a window per group).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def suffix_sums(df: DataFrame, keys: Sequence[str], order_col: str, value_cols: Sequence[str],
                prefix: str = "cum_", target_rows: int = 200_000,
                max_group_rows: int | None = None) -> DataFrame:
    """``df`` plus one sum per value column. Rows are unique by (keys, order_col)."""
    keys = list(keys)
    if max_group_rows is None:
        max_group_rows = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
                          .agg(F.max("_c")).first()[0] or 0)
    if max_group_rows <= target_rows:
        w = (Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.select("*", *[F.sum(c).over(w).alias(prefix + c) for c in value_cols])
    return ranged_suffix_sums(df, keys, order_col, list(value_cols), prefix)


def ranged_suffix_sums(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str],
                       prefix: str, partitions: int | None = None) -> DataFrame:
    names = list(df.columns)
    order = [F.col(k) for k in keys] + [F.col(order_col).desc()]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    sums = [f"_in_{c}" for c in value_cols]

    def run(batches):
        from pyspark import TaskContext

        here, at, carry, first = TaskContext.get().partitionId(), None, np.zeros(len(value_cols)), True
        held = None  # the last batch, whose last row may be the task's last

        def out(b, total, is_first, end):
            flags = np.zeros(b.num_rows, bool)
            if end:
                flags[-1] = True
            return pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(total[:, j]) for j in range(len(value_cols))),
                 pa.array(np.full(b.num_rows, here, np.int64)), pa.array(is_first), pa.array(flags)],
                [*names, *sums, "_part", "_first", "_end"])

        for b in batches:
            if not b.num_rows:
                continue
            groups = list(zip(*(b.column(k).to_pylist() for k in keys)))
            fresh = np.array([groups[0] != at] + [x != y for x, y in zip(groups[1:], groups)])
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in value_cols])
            total = np.empty_like(x)
            starts = [0, *(np.nonzero(fresh[1:])[0] + 1).tolist(), len(x)]
            is_first = np.zeros(len(x), bool)
            for lo, hi in zip(starts, starts[1:]):
                if fresh[lo]:
                    first = at is None
                    carry = np.zeros(len(value_cols))
                    at = groups[lo]
                total[lo:hi] = carry + np.cumsum(x[lo:hi], axis=0)
                is_first[lo:hi] = first
                carry = total[hi - 1]
            if held is not None:
                yield out(*held, False)
            held = (b, total, is_first)
        if held is not None:
            yield out(*held, True)

    ensure_checkpoint_dir(df.sparkSession)
    extra = ", ".join(f"`{s}` double" for s in sums)
    local = ranged.sortWithinPartitions(*order).mapInArrow(
        run, f"{schema}, {extra}, _part bigint, _first boolean, _end boolean").checkpoint()
    # one row a task: what its last group has there, and a place for what its first group lacks
    tails = local.where("_end").select(*keys, "_part", F.lit(1).alias("_kind"), *sums)
    heads = local.where("_first").groupBy(*keys, "_part").agg(*[F.lit(0.0).alias(s) for s in sums]).select(
        *keys, "_part", F.lit(0).alias("_kind"), *sums)
    before = Window.partitionBy(*keys).orderBy("_part", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    offsets = heads.unionByName(tails).select(*keys, "_part", "_kind", *[
        F.coalesce(F.sum(s).over(before), F.lit(0.0)).alias(f"_off{s}") for s in sums]).where("_kind = 0").drop("_kind")
    joined = local.join(offsets, [*keys, "_part"], "left")
    return joined.select(*names, *[(F.col(s) + F.coalesce(F.col(f"_off{s}"), F.lit(0.0))).alias(prefix + c)
                                   for s, c in zip(sums, value_cols)])
