"""Trees without a depth limit: brute force, large and small nodes, table of subtrees, ranged sums."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.operators.prefix import ranged_suffix_sums
from tablelearn.plans.boosting import GradientBoostingClassifier
from tablelearn.plans.trees import DecisionTreeClassifier, DecisionTreeRegressor


def brute(rows, ys, gain, leaf, node=1):
    """Nested recursion over plain lists; returns heap id -> (feature, cutoff) or leaf value."""
    best = None
    for f in range(len(rows[0])):
        for v in sorted({r[f] for r in rows}):
            l = [y for r, y in zip(rows, ys) if r[f] >= v]
            r_ = [y for r, y in zip(rows, ys) if r[f] < v]
            if not r_:
                continue
            g = round(gain(ys, l, r_), 12)
            if best is None or g > best[0]:
                best = (g, f, v)
    if len(rows) < 2 or best is None or best[0] <= 1e-7:
        return {node: leaf(ys)}
    _, f, v = best
    out = {node: (f, v)}
    for child, side in ((2 * node, [r[f] >= v for r in rows]), (2 * node + 1, [r[f] < v for r in rows])):
        out |= brute([r for r, s in zip(rows, side) if s], [y for y, s in zip(ys, side) if s], gain, leaf, child)
    return out


def entropy(ys):
    return -sum(ys.count(c) / len(ys) * math.log(ys.count(c) / len(ys)) for c in set(ys))


def info(ys, l, r):
    return entropy(ys) - len(l) / len(ys) * entropy(l) - len(r) / len(ys) * entropy(r)


def variance(ys, l, r):
    d = sum(l) / len(l) - sum(r) / len(r)
    return len(l) * len(r) / len(ys) ** 2 * d * d


def majority(ys):
    return min(set(ys), key=lambda c: (-ys.count(c), c))


def plain(nodes):
    return {i: n["value"] if "value" in n else (n["feature"], n["cutoff"]) for i, n in nodes.items()}


def table(spark, rows, ys, kind):
    cols = ", ".join(f"x{j} double" for j in range(len(rows[0])))
    return spark.createDataFrame([(i, *map(float, r), y) for i, (r, y) in enumerate(zip(rows, ys))],
                                 f"id bigint, {cols}, y {kind}").repartition(5), [f"x{j}" for j in range(len(rows[0]))]


SIZES = [dict(), dict(small_rows=12), dict(small_rows=12, target_window_rows=15), dict(small_rows=1, target_window_rows=15)]


@pytest.mark.parametrize("kw", SIZES)
def test_classifier_grows_to_the_end(spark, kw):
    rng = random.Random(1)
    rows = [[rng.randint(0, 6), rng.random(), rng.randint(0, 2), rng.random()] for _ in range(90)]
    ys = [rng.choice([2, 5, 9]) if rng.random() < .4 else 2 + 3 * (r[0] > 3) for r in rows]
    df, feats = table(spark, rows, ys, "int")
    model = DecisionTreeClassifier(**kw).fit(df, feats, "y")
    assert plain(model.tree.nodes) == brute(rows, ys, info, majority)
    got = {r.id: r.prediction for r in model.transform(df).collect()}
    assert got == dict(enumerate(ys)) and model.transform(df).schema["prediction"].dataType.simpleString() == "int"


@pytest.mark.parametrize("kw", SIZES)
def test_regressor_grows_to_the_end(spark, kw):
    rng = random.Random(2)
    rows = [[rng.randint(0, 9), rng.randint(0, 3)] for _ in range(120)]
    ys = [round(r[0] ** 2 + 3 * r[1] + rng.random(), 3) for r in rows]
    df, feats = table(spark, rows, ys, "double")
    model = DecisionTreeRegressor(**kw).fit(df, feats, "y")
    means = {}
    for r, y in zip(rows, ys):
        means.setdefault(tuple(r), []).append(y)
    for r in model.transform(df).collect():
        v = means[tuple(rows[r.id])]
        assert r.prediction == pytest.approx(sum(v) / len(v))
    want = brute(rows, ys, variance, lambda y: sum(y) / len(y))
    assert len(model.tree.nodes) == len(want)


def test_table_of_subtrees_scores_alike(spark):
    rng = random.Random(3)
    rows = [[rng.random(), rng.random(), rng.randint(0, 4)] for _ in range(150)]
    ys = [rng.choice("abc") for _ in rows]
    df, feats = table(spark, rows, ys, "string")
    whole = DecisionTreeClassifier(small_rows=20).fit(df, feats, "y")
    kept = DecisionTreeClassifier(small_rows=20, max_driver_nodes=3).fit(df, feats, "y")
    assert kept.tree.subtrees is not None and kept.tree.subtrees.count() > 3 and len(kept.tree.nodes) < len(whole.tree.nodes)
    new = df.withColumn("x0", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("x0") + 0.01))
    a = sorted((r.id, r.prediction) for r in whole.transform(new).collect() if r.prediction)
    assert a == sorted((r.id, r.prediction) for r in kept.transform(new).collect() if r.prediction) and len(a) == 135
    b = {r.id: r.leaf for r in whole.tree.route(df, path=True).collect()}
    assert b == {r.id: r.leaf for r in kept.tree.route(df, path=True).collect()}


def test_deeper_than_a_bigint(spark):
    rows, ys = [[i] for i in range(90)], [4.0 ** i for i in range(90)]
    df, feats = table(spark, rows, ys, "double")
    model = DecisionTreeRegressor().fit(df, feats, "y")
    assert model.tree.depth > 70
    assert {r.id: r.prediction for r in model.transform(df).collect()} == dict(enumerate(ys))
    paths = {r.id: r.leaf for r in model.tree.route(df, path=True).collect()}
    assert len(set(paths.values())) == 90 and max(map(len, paths.values())) == model.tree.depth
    with pytest.raises(ValueError, match="path=True"):
        model.tree.route(df)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_ranged_sums(spark, partitions):
    rng = random.Random(partitions)
    data = [(g, v, rng.randint(1, 9) * 1.0) for g in range(4) for v in range((1, 30, 200, 3)[g])]
    df = spark.createDataFrame(data, "g int, v int, w double").repartition(6)
    got = {(r.g, r.v): r.cum_w for r in ranged_suffix_sums(df, ["g"], "v", ["w"], "cum_", partitions).collect()}
    assert got == {(g, v): sum(w for h, u, w in data if h == g and u >= v) for g, v, _ in data}
    assert ranged_suffix_sums(df.limit(0), ["g"], "v", ["w"], "cum_", partitions).count() == 0


def test_boosting_large_and_small_nodes_agree(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 3))
    ys = (x[:, 0] + x[:, 1] > 0).astype(int) + (x[:, 2] > 1)
    df, feats = table(spark, x.tolist(), [int(y) for y in ys], "int")
    a = GradientBoostingClassifier(n_estimators=3, learning_rate=0.3).fit(df, feats, "y")
    b = GradientBoostingClassifier(n_estimators=3, learning_rate=0.3, small_rows=10).fit(df, feats, "y")
    assert [sorted(t.nodes) for t in a.trees] == [sorted(t.nodes) for t in b.trees]
    for t, u in zip(a.trees, b.trees):
        for i in t.nodes:
            if "value" in t.nodes[i]:
                assert t.nodes[i]["value"] == pytest.approx(u.nodes[i]["value"])
            else:
                assert t.nodes[i] == u.nodes[i]


def test_two_hundred_rounds_and_probabilities(spark):
    """The default size: rounds without row state, logits written now and then, probabilities of
    all classes in one pass."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(80, 2))
    ys = [int(v) for v in (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)]
    df, feats = table(spark, x.tolist(), ys, "int")
    m = GradientBoostingClassifier(n_estimators=200, learning_rate=0.05, state_every=80).fit(df, feats, "y")
    assert len(m.trees) == 200
    got = {r.id: [r.probability_0, r.probability_1, r.probability_2] for r in m.predict_proba(df).collect()}
    z = np.zeros((80, 3))
    for t in m.trees:
        for i in range(80):
            node = 1
            while "value" not in t.nodes[node]:
                node = 2 * node + (x[i, t.nodes[node]["feature"]] < t.nodes[node]["cutoff"])
            z[i] -= 0.05 * np.array(t.nodes[node]["value"])
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert all(got[i] == pytest.approx(p[i], abs=1e-9) for i in range(80))
    assert np.mean([np.argmax(got[i]) == ys[i] for i in range(80)]) == 1.0
    once = GradientBoostingClassifier(n_estimators=12, learning_rate=0.05, state_every=5).fit(df, feats, "y")
    assert [t.nodes for t in once.trees] == [t.nodes for t in m.trees[:12]] or all(
        sorted(a.nodes) == sorted(b.nodes) for a, b in zip(once.trees, m.trees))
    bad = df.withColumn("y", F.when(F.col("id") > 0, F.col("y")))
    with pytest.raises(ValueError, match="NULL"):
        GradientBoostingClassifier(n_estimators=1).fit(bad, feats, "y")


def test_equal_feature_rows_are_added_up_first(spark):
    """3 x 4 different feature rows: the tree is one small node, however many rows stand behind it."""
    from tablelearn.plans import trees

    df = spark.range(40_000).select((F.col("id") % 3).cast("double").alias("a"), (F.col("id") % 4).cast("double").alias("b"))
    df = df.withColumn("y", F.col("a") * 10 + F.col("b"))
    levels, real = [], trees.TreeGrower._level
    try:
        trees.TreeGrower._level = lambda self, *a: levels.append(1) or real(self, *a)
        m = trees.DecisionTreeRegressor(small_rows=1000).fit(df, ["a", "b"], "y")
    finally:
        trees.TreeGrower._level = real
    assert not levels
    assert m.transform(df).where("abs(prediction - y) > 1e-9").count() == 0


@pytest.mark.parametrize("ranges", [65_536, 300])
def test_large_nodes_send_arrays_not_rows(spark, ranges):
    """The level search groups one row a (feature, range) and task, not one a row and feature."""
    from tablelearn.plans import trees

    rng = np.random.default_rng(9)
    x, y = rng.normal(size=(3000, 5)), rng.integers(0, 3, 3000)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, e double, y int")
    kw = dict(max_depth=3, small_rows=100, target_window_rows=ranges)
    m = trees.DecisionTreeClassifier(**kw).fit(df, list("abcde"), "y")
    whole = trees.DecisionTreeClassifier(max_depth=3, small_rows=10_000).fit(df, list("abcde"), "y")
    pick = lambda t: {i: (n.get("feature"), n.get("cutoff"), n.get("value")) for i, n in t.tree.nodes.items()}
    assert pick(m) == pick(whole)
    g = trees.TreeGrower(trees.Entropy("y", [0, 1, 2]), target_window_rows=ranges)
    g._rows = 3000
    assert sum(len(e) for e in g._edges(df, list("abcde"))) == (0 if ranges > 3000 else 5 * 9)
