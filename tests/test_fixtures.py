"""Micro fixtures from FIXTURES.md §1 (corrected expected values)."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.functions import kernels
from tablelearn.operators import features, impurity, moments, split
from tablelearn.operators.metrics import logistic_loss
from tablelearn.plans.bayes import LinearDiscriminantAnalysis
from tablelearn.plans.boosting import GradientBoostingClassifier
from tablelearn.plans.trees import DecisionTreeRegressor


def test_entropy(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 2, 2, 2]], "y int")
    got = impurity.entropy(df, "y").first()["entropy"]
    assert got == pytest.approx(0.6730116670092565, abs=1e-12)


def test_entropy_pure(spark):
    df = spark.createDataFrame([(1,)] * 4, "y int")
    assert impurity.entropy(df, "y").first()["entropy"] == pytest.approx(0.0, abs=1e-15)


def test_information_gain(spark):
    df = spark.createDataFrame([("l", 1), ("l", 1), ("r", 0), ("r", 0), ("r", 1)], "side string, y int")
    g = impurity.information_gain(df, "y", F.col("side") == "l").first()[0]
    assert g == pytest.approx(0.29110316603236885, abs=1e-12)


def test_information_gain_empty_side(spark):
    df = spark.createDataFrame([("l", 1), ("l", 0)], "side string, y int")
    assert impurity.information_gain(df, "y", F.col("side") == "l").first()[0] == 0.0


def test_variance_reduction_1d(spark):
    df = spark.createDataFrame([("l", 1.0), ("l", 2.0), ("l", 3.0), ("r", 4.0), ("r", 5.0)],
                               "side string, y double")
    v = impurity.variance_reduction(df, ["y"], F.col("side") == "l").first()[0]
    assert v == pytest.approx(1.5, abs=1e-12)


def test_variance_reduction_2d(spark):
    df = spark.createDataFrame([("l", 1.0, 2.0), ("l", 3.0, 4.0), ("r", 5.0, 6.0)],
                               "side string, y1 double, y2 double")
    v = impurity.variance_reduction(df, ["y1", "y2"], F.col("side") == "l").first()[0]
    assert v == pytest.approx(4.0, abs=1e-12)


def test_majority(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 1, 1, 0]], "y int")
    assert impurity.majority_class(df, "y").first()["majority"] == 1


def test_majority_tie(spark):
    df = spark.createDataFrame([(v,) for v in [0, 0, 1, 1]], "y int")
    assert impurity.majority_class(df, "y").first()["majority"] == 0


def test_covariance(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0), (3, 5.0, 6.0)], "id int, x1 double, x2 double")
    vals = [r["value"] for r in moments.covariance_table(df, ["x1", "x2"]).collect()]
    assert vals == pytest.approx([4.0, 4.0, 4.0])


def test_covariance_wide_matches_scalar(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 14)) + 100.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"x{i} double" for i in range(14)))
    got = {(r["i"], r["j"]): r["value"] for r in moments.covariance_table(df, [f"x{i}" for i in range(14)]).collect()}
    ref = np.cov(x, rowvar=False)
    for (i, j), v in got.items():
        assert v == pytest.approx(ref[i, j], abs=1e-9)


def test_bisect_numeric(spark):
    df = spark.createDataFrame([(1, 1, 2), (2, 3, 4), (3, 5, 6)], "id int, x1 int, x2 int")
    left, right = split.bisect(df, "x1", 3)
    assert sorted(r.id for r in left.collect()) == [2, 3]
    assert [r.id for r in right.collect()] == [1]


def test_bisect_string(spark):
    df = spark.createDataFrame([(1, "apple", "red"), (2, "banana", "yellow"), (3, "apple", "green")],
                               "id int, fruit string, colour string")
    left, right = split.bisect(df, "fruit", "apple")
    assert sorted(r.id for r in left.collect()) == [1, 3]
    assert [r.id for r in right.collect()] == [2]


def test_bisect_null_goes_right(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, x int")
    left, right = split.bisect(df, "x", 3)
    assert [r.id for r in left.collect()] == [2] and [r.id for r in right.collect()] == [1]


def test_one_hot(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0, 2, 1, 3])], "id int, x int")
    rows = features.one_hot(df, "x").orderBy("id").collect()
    assert [[r[f"oh_{k}"] for k in range(4)] for r in rows] == np.eye(4, dtype=int)[[0, 2, 1, 3]].tolist()


def test_one_hot_k(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, 2, 3])], "id int, x int")
    out = features.one_hot(df, "x", n=5)
    assert len([c for c in out.columns if c.startswith("oh_")]) == 5


def test_one_hot_out_of_range(spark):
    df = spark.createDataFrame([(0, 7)], "id int, x int")
    with pytest.raises(Exception):
        features.one_hot(df, "x", n=3).collect()


def test_polynomial_d2(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "id int, x1 double, x2 double")
    rows = df.select("id", *features.polynomial_features(["x1", "x2"], 2)).orderBy("id").collect()
    assert [list(r)[1:] for r in rows] == [[1, 1, 2, 1, 2, 4], [1, 3, 4, 9, 12, 16]]


@pytest.mark.parametrize("kern,expected", [(kernels.linear(), 11.0), (kernels.polynomial(2), 144.0),
                                           (kernels.rbf(0.5), 0.01831563888873418)])
def test_kernels(spark, kern, expected):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "u1 double, u2 double, v1 double, v2 double")
    got = df.select(kern([F.col("u1"), F.col("u2")], [F.col("v1"), F.col("v2")])).first()[0]
    assert got == pytest.approx(expected, rel=1e-12)


def test_leaf_mean(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0), (0.0, 3.0)], "x double, y double")
    m = DecisionTreeRegressor(max_depth=2).fit(df, ["x"], "y")
    assert m.tree.nodes[1]["value"] == pytest.approx(2.0)
    df2 = spark.createDataFrame([(0.0, 1.0, 2.0), (0.0, 3.0, 4.0), (0.0, 5.0, 6.0)], "x double, y1 double, y2 double")
    m2 = DecisionTreeRegressor(max_depth=2).fit(df2, ["x"], ["y1", "y2"])
    assert m2.tree.nodes[1]["value"] == pytest.approx([3.0, 4.0])


def test_logistic_loss(spark):
    ys, zs = [0, 1, 1, 0], [0.1, 0.9, 0.8, 0.3]
    df = spark.createDataFrame(list(zip(ys, zs)), "y int, z double")
    r = logistic_loss(df, "y", "z").first()
    p = 1 / (1 + np.exp(-np.array(zs)))
    y = np.array(ys)
    assert r["loss"] == pytest.approx(np.mean(-(y * np.log(p) + (1 - y) * np.log(1 - p))), rel=1e-12)
    assert r["gradient"] == pytest.approx(np.mean(p - y), rel=1e-12)
    assert r["hessian"] == pytest.approx(np.mean(p * (1 - p)), rel=1e-12)


def test_boost_smoke(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 0), (2, 3.0, 4.0, 1), (3, 5.0, 6.0, 0), (4, 7.0, 8.0, 1)],
                               "id int, x1 double, x2 double, y int")
    losses = []
    for n in (1, 3, 6):
        m = GradientBoostingClassifier(n_estimators=n, learning_rate=0.3, max_depth=2).fit(df, ["x1", "x2"], "y")
        losses.append(m.log_loss(df, "y"))
    assert losses[0] >= losses[1] >= losses[2]


def test_lda_single_row_class_raises(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 0), (2, 3.0, 4.0, 1), (3, 5.0, 6.0, 0)],
                               "id int, x1 double, x2 double, y int")
    with pytest.raises(ValueError, match="at least two rows"):
        LinearDiscriminantAnalysis().fit(df, ["x1", "x2"], "y")


def test_priors_checked(spark):
    from tablelearn.plans.bayes import GaussianNB

    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (0.1, 0), (1.1, 1)], "x double, y int")
    with pytest.raises(ValueError):
        GaussianNB(priors=[0.5, 0.6]).fit(df, ["x"], "y")
    with pytest.raises(ValueError):
        GaussianNB(priors=[1.0]).fit(df, ["x"], "y")


def test_label_gap(spark):
    """Classes 0 and 2 only: no phantom class 1 in the model."""
    from tablelearn.plans.bayes import GaussianNB

    df = spark.createDataFrame([(0.0, 0), (0.2, 0), (5.0, 2), (5.2, 2)], "x double, y int")
    m = GaussianNB().fit(df, ["x"], "y")
    assert m.classes == [0, 2]
    preds = {r.x: r.prediction for r in m.transform(df).collect()}
    assert preds[0.0] == 0 and preds[5.2] == 2


def test_empty_input_raises(spark):
    from tablelearn.plans.bayes import GaussianNB

    df = spark.createDataFrame([], "x double, y int")
    with pytest.raises(ValueError):
        GaussianNB().fit(df, ["x"], "y")


@pytest.mark.parametrize("fit", ["ols", "nb", "lda", "kmeans", "tree", "pca", "logit", "svm"])
def test_nan_or_null_feature_rejected(spark, fit):
    from tablelearn.plans.bayes import GaussianNB
    from tablelearn.plans.cluster import KMeans
    from tablelearn.plans.decompose import PCA
    from tablelearn.plans.linear import LinearRegression, LogisticRegression
    from tablelearn.plans.svm import LinearSVM
    from tablelearn.plans.trees import DecisionTreeClassifier

    rows = [(1, 0.0, 1.0, 1), (2, 1.0, float("nan"), -1), (3, 2.0, 0.5, 1), (4, None, 0.1, -1),
            (5, 0.3, 0.2, 1), (6, 0.7, 0.9, -1)]
    df = spark.createDataFrame(rows, "id int, x1 double, x2 double, y int")
    fits = {
        "ols": lambda: LinearRegression().fit(df, ["x1", "x2"], "y"),
        "nb": lambda: GaussianNB().fit(df, ["x1", "x2"], "y"),
        "lda": lambda: LinearDiscriminantAnalysis().fit(df, ["x1", "x2"], "y"),
        "kmeans": lambda: KMeans(2, max_iter=2).fit(df, ["x1", "x2"], "id"),
        "tree": lambda: DecisionTreeClassifier(max_depth=2).fit(df, ["x1", "x2"], "y"),
        "pca": lambda: PCA(2).fit(df, ["x1", "x2"]),
        "logit": lambda: LogisticRegression(max_iter=2).fit(df, ["x1", "x2"], "y"),
        "svm": lambda: LinearSVM(max_iter=2).fit(df, ["x1", "x2"], "y"),
    }
    with pytest.raises(ValueError, match="NULL, NaN or infinite"):
        fits[fit]()


def test_covariance_centered_flag(spark):
    df = spark.createDataFrame([(1, -2.0, 1.0), (2, 0.0, 0.0), (3, 2.0, -1.0)], "id int, x1 double, x2 double")
    vals = {(r["i"], r["j"]): r["value"] for r in moments.covariance_table(df, ["x1", "x2"], centered=True).collect()}
    assert vals == {(0, 0): 4.0, (0, 1): -2.0, (1, 1): 1.0}
    # uncentred data: the flag skips centring, as documented
    df2 = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0), (3, 5.0, 6.0)], "id int, x1 double, x2 double")
    raw = {(r["i"], r["j"]): r["value"] for r in moments.covariance_table(df2, ["x1", "x2"], centered=True).collect()}
    assert raw[(0, 0)] == pytest.approx((1 + 9 + 25) / 2)


def test_entropy_empty_raises(spark):
    df = spark.createDataFrame([], "y int")
    with pytest.raises(Exception, match="empty column"):
        impurity.entropy(df, "y").collect()


def test_gmm_and_wide_kmeans_reject_nan(spark):
    from tablelearn.operators import pairwise as pw
    from tablelearn.plans.cluster import GaussianMixture, KMeans

    rows = [(1, 0.0, 1.0), (2, 1.0, float("nan")), (3, 2.0, 0.5), (4, 0.3, 0.2), (5, 0.7, 0.9)]
    df = spark.createDataFrame(rows, "id int, x1 double, x2 double")
    with pytest.raises(ValueError, match="NULL, NaN or infinite"):
        GaussianMixture(2, max_iter=2, init_means=[[0.0, 0.0], [1.0, 1.0]]).fit(df, ["x1", "x2"], "id")
    saved = pw.MAX_GENERATED_TERMS
    pw.MAX_GENERATED_TERMS = 0
    try:
        with pytest.raises(ValueError, match="NULL, NaN or infinite"):
            KMeans(2, max_iter=2, init=[[0.0, 0.0], [1.0, 1.0]]).fit(df, ["x1", "x2"], "id")
    finally:
        pw.MAX_GENERATED_TERMS = saved
