"""Exact pruned neighbour search against NumPy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.operators.metric_search import NeighborSearch
from tablelearn.operators.pairwise import knn_pairs
from tablelearn.plans.neighbors import KNNClassifier


def frame(spark, x, ids=None, labels=None):
    ids = range(len(x)) if ids is None else ids
    labels = [0] * len(x) if labels is None else labels
    rows = [(int(i), [float(v) for v in r], int(l)) for i, r, l in zip(ids, x, labels)]
    return spark.createDataFrame(rows, "id bigint, f array<double>, label int").repartition(4)


def brute(q, t, k, same):
    d = np.sqrt(((q[:, None] - t[None]) ** 2).sum(-1))
    out = []
    for i in range(len(q)):
        ids = [j for j in range(len(t)) if not (same and i == j)]
        out += [(i, r + 1, j) for r, j in enumerate(sorted(ids, key=lambda j: (d[i, j], j))[:k])]
    return out


def clusters(rng, n, dims, centres=12, spread=0.05, shift=0.0):
    c = rng.normal(size=(centres, dims)) * 4 + shift
    return c[rng.integers(centres, size=n)] + rng.normal(size=(n, dims)) * spread


@pytest.mark.parametrize("name", ["clusters", "uniform", "far", "copies", "grid"])
@pytest.mark.parametrize("same", [True, False])
def test_equals_brute_force(spark, name, same):
    rng = np.random.default_rng(3)
    t = {"clusters": lambda: clusters(rng, 500, 5), "uniform": lambda: rng.normal(size=(400, 16)),
         "far": lambda: clusters(rng, 400, 3, shift=1e6),
         "copies": lambda: np.concatenate([np.ones((200, 4)), clusters(rng, 200, 4)]),
         "grid": lambda: rng.integers(0, 3, size=(400, 3)).astype(float)}[name]()
    q = t if same else (t[::3] + rng.normal(size=t[::3].shape) * 0.01 if name != "grid" else t[::3])
    out = knn_pairs(frame(spark, q), frame(spark, t), "id", "id", "f", 4, exclude_self=same, block_rows=32)
    got = sorted((r.id, r.rank, r.neighbor) for r in out.collect())
    assert got == sorted(brute(q, t, 4, same))


def test_prunes_clustered_data(spark):
    rng = np.random.default_rng(5)
    x = clusters(rng, 2000, 8, centres=40)
    df = frame(spark, x)
    search = NeighborSearch(df, "id", "f", block_rows=64)
    q = df.selectExpr("id AS q", "f AS qv")
    first = search._routes(q, 3, True, home=True)
    found = search._search(first, 3, True, {})
    shipped = first.count() + search.open_routes(q, first, found, 3, True).count()
    assert len(search.cells.rows) >= 20
    assert shipped < 0.2 * len(x) * len(search.cells.rows)
    assert shipped < 6 * len(x)


def test_few_rows_and_string_ids(spark):
    t = spark.createDataFrame([("b", [0.0]), ("a", [0.0]), ("c", [5.0])], "id string, f array<double>")
    out = knn_pairs(t, t, "id", "id", "f", 5, exclude_self=True, block_rows=1)
    assert sorted((r.id, r.rank, r.neighbor) for r in out.collect()) == [
        ("a", 1, "b"), ("a", 2, "c"), ("b", 1, "a"), ("b", 2, "c"), ("c", 1, "a"), ("c", 2, "b")]
    assert knn_pairs(t, t.limit(0), "id", "id", "f", 2).count() == 0
    assert knn_pairs(t.limit(0), t, "id", "id", "f", 2).count() == 0
    with pytest.raises(Exception, match="widths"):
        knn_pairs(t, spark.createDataFrame([("x", [1.0, 2.0])], t.schema), "id", "id", "f", 1).collect()


def test_hot_block_of_queries(spark):
    x = np.concatenate([np.zeros((300, 3)), np.arange(90).reshape(30, 3)])
    out = KNNClassifier(n_neighbors=3, block_rows=16).fit(frame(spark, x, labels=np.arange(330) % 2), "id", "f", "label")
    got = sorted((r.id, r.rank, r.neighbor) for r in out.kneighbors(frame(spark, x), "id", exclude_self=True).collect())
    assert got == sorted(brute(x, x, 3, True))


def test_routed_queries_leave_in_bounded_batches(spark):
    """Every query visits every block here: the vectors of one batch must not grow with the blocks."""
    import pyarrow as pa

    from tablelearn.operators import metric_search as M

    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id bigint, v array<double>").repartition(4)
    found = M.NeighborSearch(df, "id", "v", block_rows=20)
    blocks = len(found.cells.rows)
    assert blocks > 50

    class Queries:
        schema = df.select(F.col("id").alias("q")).schema

        def mapInArrow(self, fn, schema):
            return fn

    route = found._routes(Queries(), 3, False, home=False)
    batch = pa.RecordBatch.from_pydict({"q": pa.array(range(2000)), "qv": pa.array(x.tolist()), "tau": pa.array([1e9] * 2000),
                                        "home": pa.array(found.cells.assign(x)[2])})
    sizes = [b.num_rows for b in route([batch])]
    assert max(sizes) * 64 <= 1_000_000
    assert 50 * 2000 < sum(sizes) <= blocks * 2000
