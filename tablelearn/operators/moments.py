"""Moments and sufficient statistics.

Everything here is one aggregate pass. Spark computes the partial aggregate
inside every scan task and shuffles one row per partition (per group), so a
hot class that holds a third of the table costs nothing extra: skew is
absorbed by the map-side combine.

Two physical forms of the Gram matrix:
* p <= SCALAR_MAX_P: one ``agg`` of generated ``sum(x_i * x_j)`` (whole-stage
  codegen, no Python);
* larger p: ``mapInArrow`` computes X^T X per Arrow batch with NumPy, emits
  p(p+1)/2 partial rows per partition, and ``groupBy(i, j).sum`` merges them.

Covariances of wide tables are one scan too: a task keeps (n, mean, co-moments about that
mean) per group and merges batches into it pairwise (Chan, Golub and LeVeque 1983), so means
far from zero cost no digits; each task emits one block a group, and blocks are merged by
``groupBy(group, shard).applyInArrow`` in two levels, so no task holds more than
MERGE_BLOCKS blocks however many tasks there are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALAR_MAX_P = 12
MAX_GROUPS = 10_000  # model tables are collected; the group count must stay bounded


def _inline(structs: list[Column]) -> Column:
    return F.inline(F.array(*structs))


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def gram_table(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """E1 as a long table ``([by,] i, j, value)`` with value = Σ x_i x_j, i <= j.

    i and j are 0-based feature positions.
    """
    p = len(cols)
    keys = [by] if by else []
    if p <= SCALAR_MAX_P:
        aggs = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"g_{i}_{j}") for i, j in _pairs(p)]
        wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
        structs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                            F.col(f"g_{i}_{j}").alias("value")) for i, j in _pairs(p)]
        return wide.select(*keys, _inline(structs))
    return _arrow_gram(df, cols, by)


def _arrow_gram(df: DataFrame, cols: Sequence[str], by: str | None,
                centre: dict | None = None) -> DataFrame:
    """Per-partition X^T X in NumPy; ``centre`` maps group -> mean subtracted first."""
    import pyarrow as pa

    p = len(cols)
    iu, ju = np.triu_indices(p)
    key_field = [(by, df.schema[by].dataType.simpleString())] if by else []
    schema = ", ".join([f"{k} {t}" for k, t in key_field] + ["i int", "j int", "value double"])

    def per_partition(batches):
        acc: dict = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                 for c in cols])
            if by:
                keys = batch.column(by).to_numpy(zero_copy_only=False)
                for k in np.unique(keys):
                    xs = x[keys == k]
                    if centre is not None:
                        xs = xs - centre[k]
                    acc[k] = acc.get(k, 0) + xs.T @ xs
            else:
                if centre is not None:
                    x = x - centre[None]
                acc[None] = acc.get(None, 0) + x.T @ x
        for k, g in acc.items():
            data = {"i": pa.array(iu, pa.int32()), "j": pa.array(ju, pa.int32()),
                    "value": pa.array(g[iu, ju], pa.float64())}
            if by:
                data = {by: pa.array([k] * len(iu))} | data
            yield pa.RecordBatch.from_pydict(data)

    partial = df.select(*([by] if by else []), *cols).mapInArrow(per_partition, schema)
    keys = [by] if by else []
    return partial.groupBy(*keys, "i", "j").agg(F.sum("value").alias("value"))


def covariance_table(df: DataFrame, cols: Sequence[str], by: str | None = None,
                     ddof: int = 1, centered: bool = False) -> DataFrame:
    """Covariance as ``([by,] i, j, value)`` for i <= j.

    ``covar_samp`` / ``covar_pop`` merge partial (n, mean, co-moment) states,
    which avoids the cancellation of Σxx^T - n·μμ^T. ``centered=True`` means
    the caller's data are already centred: the result is XᵀX / (n - ddof).
    """
    fn = F.covar_samp if ddof == 1 else F.covar_pop
    p = len(cols)
    keys = [by] if by else []
    if centered:
        # row counts per group are model-sized: they enter as literals, no join
        rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).limit(MAX_GROUPS + 1).collect()
        if len(rows) > MAX_GROUPS:
            raise ValueError(f"covariance groups: more than the bound of {MAX_GROUPS}")
        counts = {(r[by] if by else None): r["_n"] for r in rows}
        g = gram_table(df, cols, by)
        if by:
            denom = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(float(n - ddof)))])[F.col(by)]
            return g.select(by, "i", "j", F.when(denom > 0, F.col("value") / denom).alias("value"))
        left = counts.get(None, 0) - ddof
        return g.select("i", "j", (F.col("value") / F.lit(float(left) if left > 0 else None)).cast("double").alias("value"))
    if p > SCALAR_MAX_P:
        return _centred_arrow_cov(df, cols, by, ddof)
    aggs = [fn(cols[i], cols[j]).alias(f"c_{i}_{j}") for i, j in _pairs(p)]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    structs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                        F.col(f"c_{i}_{j}").alias("value")) for i, j in _pairs(p)]
    return wide.select(*keys, _inline(structs))


#: Partial blocks that one merging task holds.
MERGE_BLOCKS = 64
BLOCK_SCHEMA = "n bigint, bad bigint, mean array<double>, co array<double>"


def merge_blocks(a: tuple, b: tuple) -> tuple:
    """(n, mean, co-moments) of two row sets together."""
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return a if a[0] else b
    delta = b[1] - a[1]
    return n, a[1] + delta * (b[0] / n), a[2] + b[2] + np.outer(delta, delta) * (a[0] * b[0] / n)


def co_moments(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """One row per group, one scan: ([by,] n, bad rows, mean, p x p co-moments about the mean).
    Rows with a NULL, NaN or infinite entry (or a NULL group) count as bad and nowhere else."""
    import pyarrow as pa

    cols, p = list(cols), len(cols)
    key_type = df.schema[by].dataType.simpleString() if by else "int"
    group = F.col(by) if by else F.lit(0)
    rows = df.select(group.alias("g"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def record(parts: dict, bad: dict, arrow_key) -> pa.RecordBatch:
        keys = list(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, arrow_key), pa.array([parts[k][0] for k in keys], pa.int64()),
             pa.array([bad.get(k, 0) for k in keys], pa.int64()),
             pa.array([parts[k][1] for k in keys], pa.list_(pa.float64())),
             pa.array([parts[k][2].reshape(-1) for k in keys], pa.list_(pa.float64()))], ["g", "n", "bad", "mean", "co"])

    empty = (0, np.zeros(p), np.zeros((p, p)))

    def per_partition(batches):
        parts: dict = {}
        bad: dict = {}
        arrow_key = None
        for b in batches:
            arrow_key = b.schema.field("g").type
            if not b.num_rows:
                continue
            x = np.column_stack([b.column(f"x{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(p)])
            ok = np.isfinite(x).all(axis=1)
            codes = b.column("g").dictionary_encode()
            at = codes.indices.to_numpy(zero_copy_only=False) if not codes.null_count else np.array(
                [-1 if v is None else v for v in codes.indices.to_pylist()])
            for c, key in enumerate([*codes.dictionary.to_pylist(), None]):
                mine = at == (c if key is not None else -1)
                if not mine.any():
                    continue
                good = mine & ok & (key is not None)
                parts.setdefault(key, empty)
                bad[key] = bad.get(key, 0) + int(mine.sum() - good.sum())
                if good.any():
                    mean = x[good].mean(axis=0)
                    d = x[good] - mean
                    parts[key] = merge_blocks(parts[key], (int(good.sum()), mean, d.T @ d))
        if parts:
            yield record(parts, bad, arrow_key)

    def merge(t: pa.Table) -> pa.Table:
        block, bad = empty, 0
        for n, b, mean, co in zip(*(t.column(c).to_pylist() for c in ("n", "bad", "mean", "co"))):
            block, bad = merge_blocks(block, (n, np.array(mean), np.array(co).reshape(p, p))), bad + b
        key = t.column("g")[0].as_py()
        return pa.Table.from_batches([record({key: block}, {key: bad}, t.schema.field("g").type)])

    schema = f"g {key_type}, {BLOCK_SCHEMA}"
    parts = rows.mapInArrow(per_partition, schema)
    shard = F.pmod(F.spark_partition_id(), F.lit(-(-tasks // MERGE_BLOCKS))).alias("shard")
    first = parts.select("*", shard).groupBy("g", "shard").applyInArrow(merge, schema) if tasks > MERGE_BLOCKS else parts
    out = first.groupBy("g").applyInArrow(merge, schema)
    return out.withColumnRenamed("g", by) if by else out.drop("g")


def _co_long(blocks: DataFrame, p: int, by: str | None) -> DataFrame:
    """([by,] n, i, j, value) of co-moment blocks, i <= j."""
    import pyarrow as pa

    iu, ju = np.triu_indices(p)
    keys = [by] if by else []
    schema = ", ".join([f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in keys] + ["n bigint, i int, j int, value double"])

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                at = pa.array(np.full(len(iu), r))
                co = np.array(b.column("co")[r].as_py()).reshape(p, p)[iu, ju]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k).take(at) for k in keys], b.column("n").take(at), pa.array(iu.astype(np.int32)),
                     pa.array(ju.astype(np.int32)), pa.array(co)], [*keys, "n", "i", "j", "value"])

    return blocks.select(*keys, "n", "co").mapInArrow(run, schema)


def _centred_arrow_cov(df, cols, by, ddof):
    """The covariance table of a wide input, from one scan."""
    d = F.col("n") - ddof
    keys = [by] if by else []
    long = _co_long(co_moments(df, cols, by).where("n > 0"), len(cols), by)
    # a group without degrees of freedom has an undefined (NULL) covariance at every width
    return long.select(*keys, "i", "j", F.when(d > 0, F.col("value") / d).alias("value"))


def covariance_matrix(df: DataFrame, cols: Sequence[str], ddof: int = 1) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, covariance) collected for a driver-side eigen / solve; O(p²).

    Narrow: one aggregate of ``count``, ``avg`` and ``covar_samp``. Wide: the
    means pass, then the centred Arrow Gram (two scans, no join).
    """
    p = len(cols)
    cov = np.zeros((p, p))
    if p <= SCALAR_MAX_P:
        fn = F.covar_samp if ddof == 1 else F.covar_pop
        from ..sources.validate import count_invalid, raise_if_invalid

        row = df.agg(F.count(F.lit(1)).alias("n"), count_invalid(cols),
                     *[F.avg(c).alias(f"m{k}") for k, c in enumerate(cols)],
                     *[fn(cols[i], cols[j]).alias(f"c_{i}_{j}") for i, j in _pairs(p)]).first()
        raise_if_invalid(row["_invalid"])
        for i, j in _pairs(p):
            cov[i, j] = cov[j, i] = row[f"c_{i}_{j}"] if row[f"c_{i}_{j}"] is not None else np.nan
        return row["n"], np.array([row[f"m{k}"] for k in range(p)], dtype=float), cov
    from ..sources.validate import raise_if_invalid

    row = co_moments(df, cols).first()
    if row is None:
        return 0, np.full(p, np.nan), np.full((p, p), np.nan)
    raise_if_invalid(row["bad"])
    if row["n"] - ddof <= 0:
        return row["n"], np.array(row["mean"]), np.full((p, p), np.nan)
    return row["n"], np.array(row["mean"]), np.array(row["co"]).reshape(p, p) / (row["n"] - ddof)


def moment_matrices(df: DataFrame, cols: Sequence[str], y: str | None = None) -> dict:
    """Collect n, Σx, XᵀX, Xᵀy, Σy, Σy² for a closed-form solve on the driver.

    The collected size is O(p²), independent of the row count.
    """
    from ..sources.validate import count_invalid, raise_if_invalid

    p = len(cols)
    aggs = [F.count(F.lit(1)).alias("n"), count_invalid(cols, y)]
    aggs += [F.sum(c).alias(f"s_{k}") for k, c in enumerate(cols)]
    if y is not None:
        aggs += [F.sum(F.col(c) * F.col(y)).alias(f"xy_{k}") for k, c in enumerate(cols)]
        aggs += [F.sum(y).alias("sy"), F.sum(F.col(y) * F.col(y)).alias("syy")]
    if p <= SCALAR_MAX_P:
        aggs += [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"g_{i}_{j}") for i, j in _pairs(p)]
        row = df.agg(*aggs).first()
        g = np.zeros((p, p))
        for i, j in _pairs(p):
            g[i, j] = g[j, i] = row[f"g_{i}_{j}"] or 0.0
    else:
        row = df.agg(*aggs).first()
        g = np.zeros((p, p))
        for r in _arrow_gram(df, cols, None).collect():
            g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["value"]
    raise_if_invalid(row["_invalid"])
    out = {"n": row["n"], "sx": np.array([row[f"s_{k}"] or 0.0 for k in range(p)]), "xtx": g}
    if y is not None:
        out["xty"] = np.array([row[f"xy_{k}"] or 0.0 for k in range(p)])
        out["sy"] = row["sy"] or 0.0
        out["syy"] = row["syy"] or 0.0
    return out


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Counts per class: ``(label, n)``."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_priors(df: DataFrame, label: str) -> DataFrame:
    """prior = n_class / n. The window runs over the K-row count table only."""
    from pyspark.sql import Window

    counts = class_counts(df, label)
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy()))
                         .alias("prior"))


def class_gaussian_params(df: DataFrame, cols: Sequence[str], label: str,
                          var_smoothing: float = 1e-9) -> DataFrame:
    """Per class n, mean and population variance (+ smoothing) of each feature."""
    from ..sources.validate import count_invalid

    aggs = [F.count(F.lit(1)).alias("n"), count_invalid(cols, label)]
    for k, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"theta_{k}"),
                 (F.var_pop(c) + F.lit(var_smoothing)).alias(f"var_{k}")]
    return df.groupBy(label).agg(*aggs)


def class_means(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Per class (or cluster) mean of each feature."""
    from ..sources.validate import count_invalid

    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), count_invalid(cols, label),
                                 *[F.avg(c).alias(f"mean_{k}") for k, c in enumerate(cols)])


def pooled_covariance_table(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Σ_k prior_k · Cov_k with Cov_k the n_k-1 sample covariance, in one scan.

    A class with one row has an undefined covariance: the pooled value raises at
    evaluation (``raise_error``), so no extra job is spent on the check.
    """
    p = len(cols)
    long = _co_long(co_moments(df, cols, label), p, label)
    n, d = F.col("n"), F.col("n") - 1
    pooled = long.groupBy("i", "j").agg(
        (F.sum(n * F.when(d > 0, F.col("value") / d)) / F.sum(n)).alias("value"), F.count_if(d < 1).alias("_undefined"))
    return pooled.select("i", "j", F.when(F.col("_undefined") > 0, F.raise_error(F.lit(
        "a class has fewer than two rows: its covariance is undefined"))).otherwise(F.col("value"))
        .cast("double").alias("value"))
