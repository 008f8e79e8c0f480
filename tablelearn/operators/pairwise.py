"""Distances, kernels, nearest centroid and exact k-nearest neighbours.

* Row-vs-small-set operators (landmarks, centroids, support vectors) take the
  small side as literals (its size is a model parameter, checked), so they
  are projections: no join, no shuffle.
* Row-vs-row neighbours (D7) never materialise pairs as rows: the train table
  is partitioned by pivots, queries visit only blocks that their bound cannot
  exclude (:mod:`.metric_search`), each visit emits only its k best, and a final
  ``row_number() <= k`` keeps the global top k (planned with a partial
  ``WindowGroupLimit`` before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions.linalg import argmin_index, euclidean, sq_dist
from .metric_search import NeighborSearch

MAX_LITERAL_POINTS = 100_000  # rows x dims entered into the plan as literals


def _check_points(points: np.ndarray) -> np.ndarray:
    pts = np.asarray(points, dtype=float)
    if pts.ndim != 2:
        raise ValueError("points must be a 2-D array")
    if pts.size > MAX_LITERAL_POINTS:
        raise ValueError(f"{pts.shape} points exceed the literal bound {MAX_LITERAL_POINTS}")
    return pts


def paired_distance(a: Sequence[str | Column], b: Sequence[str | Column]) -> Column:
    """Euclidean distance between two aligned column vectors of one row."""
    return euclidean(a, list(b) if not isinstance(b, list) else b)


def to_points(df: DataFrame, cols: Sequence[str], what: str = "points") -> np.ndarray:
    """Collect a small point set (landmarks, centroids); bounded."""
    rows = df.select(*cols).limit(MAX_LITERAL_POINTS // max(1, len(cols)) + 1).collect()
    return _check_points(np.array([[r[c] for c in cols] for r in rows], dtype=float).reshape(-1, len(cols)))


def point_values(cols: Sequence[str | Column], points: np.ndarray, fn: str = "distance",
                 degree: int = 3, gamma: float = 1.0) -> list[Column]:
    """One value per point: distance, linear / polynomial / RBF kernel."""
    pts = _check_points(points)
    lit_rows = [[F.lit(float(v)) for v in row] for row in pts]
    if fn == "distance":
        return [F.sqrt(sq_dist(cols, row)) for row in lit_rows]
    if fn == "sqdistance":
        return [sq_dist(cols, row) for row in lit_rows]
    kern = K.get_kernel({"linear": "linear", "polynomial": "poly", "rbf": "rbf"}[fn],
                        p=degree, gamma=gamma)
    return [kern(list(cols), row) for row in lit_rows]


# above this many (dims x points) terms, generated expressions outgrow the JVM's
# 64 KB method limit; the Arrow form computes the same values with NumPy.
from ..functions.arrow_scores import MAX_GENERATED_TERMS, null_rows  # noqa: E402


def _np_point_values(x: np.ndarray, pts: np.ndarray, fn: str, degree: int, gamma: float) -> np.ndarray:
    if fn in ("distance", "sqdistance", "rbf"):
        d2 = np.empty((x.shape[0], pts.shape[0]))
        for j in range(pts.shape[0]):
            diff = x - pts[j]
            d2[:, j] = np.einsum("ij,ij->i", diff, diff)
        if fn == "distance":
            return np.sqrt(d2)
        if fn == "rbf":
            return np.exp(-gamma * d2)
        return d2
    dots = x @ pts.T
    if fn == "linear":
        return dots
    if fn == "polynomial":
        return (1.0 + dots) ** degree
    raise ValueError(f"unknown function {fn!r}")


def _arrow_point_values(df: DataFrame, key: str, cols: Sequence[str], pts: np.ndarray, fn: str,
                        out: str, point_col: str, degree: int = 3, gamma: float = 1.0,
                        mode: str = "long") -> DataFrame:
    import pyarrow as pa

    key_type = df.schema[key].dataType.simpleString()
    if mode == "long":
        schema = f"{key} {key_type}, {point_col} bigint, {out} double"
    else:
        schema = f"{key} {key_type}, {out} int"

    def per_batch(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                 for c in cols])
            vals = _np_point_values(x, pts, fn, degree, gamma)
            null = null_rows(b, cols)
            keys = b.column(key)
            if mode == "long":
                m = pts.shape[0]
                idx = np.repeat(np.arange(b.num_rows), m)
                yield pa.RecordBatch.from_pydict({
                    key: keys.take(pa.array(idx)),
                    point_col: pa.array(np.tile(np.arange(m, dtype=np.int64), b.num_rows)),
                    out: pa.array(vals.reshape(-1), mask=np.repeat(null, m))})
            else:
                # first index of the minimum = lowest index wins ties
                yield pa.RecordBatch.from_pydict({
                    key: keys, out: pa.array(np.argmin(vals, axis=1).astype(np.int32), mask=null)})

    return df.select(key, *cols).mapInArrow(per_batch, schema)


def wide_point_values(df: DataFrame, keep: Sequence[str], cols: Sequence[str], points: np.ndarray,
                      fn: str = "distance", prefix: str = "k", degree: int = 3,
                      gamma: float = 1.0) -> DataFrame:
    """``keep`` columns plus one value column per point (``k0..k{m-1}``), map-only.

    Used for kernel features: expressions for narrow inputs, Arrow for wide.
    """
    import pyarrow as pa

    pts = _check_points(points)
    m = pts.shape[0]
    names = [f"{prefix}{j}" for j in range(m)]
    if len(cols) * m <= MAX_GENERATED_TERMS:
        vals = point_values(cols, pts, fn, degree=degree, gamma=gamma)
        return df.select(*keep, *[v.alias(n) for v, n in zip(vals, names)])
    keep = list(keep)
    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep]
                       + [f"{n} double" for n in names])

    def per_batch(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                 for c in cols])
            vals = _np_point_values(x, pts, fn, degree, gamma)
            data = {c: b.column(c) for c in keep}
            null = null_rows(b, cols)
            data.update({n: pa.array(vals[:, j], mask=null) for j, n in enumerate(names)})
            yield pa.RecordBatch.from_pydict(data)

    return df.select(*dict.fromkeys(keep + list(cols))).mapInArrow(per_batch, schema)


def nearest_point_frame(df: DataFrame, key: str, cols: Sequence[str], points: np.ndarray,
                        out: str = "nearest") -> DataFrame:
    """D6 as ``(key, index)``: expression form for narrow inputs, Arrow for wide."""
    pts = _check_points(points)
    if len(cols) * pts.shape[0] <= MAX_GENERATED_TERMS:
        return df.select(key, nearest_point(cols, pts).alias(out))
    return _arrow_point_values(df, key, cols, pts, "sqdistance", out, "", mode="argmin")


def long_point_values(df: DataFrame, key: str, cols: Sequence[str], points: np.ndarray,
                      fn: str = "distance", out: str = "value", point_col: str = "point",
                      **kw) -> DataFrame:
    """(key, point, value) for every row and point: n x m rows, a projection + inline.

    Wide inputs go through Arrow batches (NumPy), still a map-only stage.
    """
    pts = _check_points(points)
    if len(cols) * pts.shape[0] > MAX_GENERATED_TERMS:
        return _arrow_point_values(df, key, cols, pts, fn, out, point_col, **kw)
    vals = point_values(cols, points, fn, **kw)
    structs = [F.struct(F.lit(i).cast("bigint").alias(point_col), v.alias(out))
               for i, v in enumerate(vals)]
    return df.select(key, F.inline(F.array(*structs)))


def nearest_point(cols: Sequence[str | Column], points: np.ndarray) -> Column:
    """Index of the closest point; the lowest index wins ties."""
    return argmin_index(point_values(cols, points, "sqdistance"))


# --------------------------------------------------------------------- D7
def knn_pairs(queries: DataFrame, train: DataFrame, qid: str, tid: str, features: str, k: int,
              exclude_self: bool = False, block_rows: int | None = None,
              carry: str | None = None) -> DataFrame:
    """Exact k nearest train rows for every query row (see :mod:`.metric_search`).

    ``features`` is an ARRAY<DOUBLE> column on both sides. Returns
    ``(qid, rank, neighbor, distance[, carry])``, ranks 1..k ordered by
    (distance, neighbor id). ``carry`` (e.g. the train label) travels with the
    train rows so that consumers need no join back to the train table.
    """
    if k < 1:
        raise ValueError("k must be positive")
    search = NeighborSearch(train, tid, features, carry, block_rows)
    return search.search(queries, qid, features, k, exclude_self)


def knn_vote(pairs: DataFrame, qid: str, label: str) -> DataFrame:
    """Majority label among the neighbours; ties go to the smallest label.

    ``pairs`` carries the neighbour label (``knn_pairs(..., carry=label)``),
    so the vote is two small aggregates keyed by the query id; a popular
    neighbour ("hub") cannot skew a join because there is none.
    """
    votes = pairs.groupBy(qid, label).agg(F.count(F.lit(1)).alias("_c"))
    key = F.struct((-F.col("_c")).alias("nc"), F.col(label).alias("v"))
    return votes.groupBy(qid).agg(F.min_by(label, key).alias("prediction"))
