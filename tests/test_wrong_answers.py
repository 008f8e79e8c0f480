"""Inputs that once gave wrong or incomplete answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.plans.boosting import GradientBoostingClassifier
from tablelearn.plans.cluster import GaussianMixture
from tablelearn.plans.linear import LinearRegression
from tablelearn.plans.neighbors import KNNClassifier
from tablelearn.plans.svm import OneVsRestSVM
from tablelearn.plans.trees import NewtonGain


@pytest.mark.parametrize("mu", [0.0, 1e6, 1.7e9])
def test_slope_far_from_zero(spark, mu):
    df = spark.range(200).select((F.col("id") % 17 + mu).cast("double").alias("x")).withColumn("y", 2 * (F.col("x") - mu) + 1)
    m = LinearRegression().fit(df, ["x"], "y")
    assert abs(m.weights[0] - 2) < 1e-6 and m.training_mse() < 1e-9
    assert abs(m.intercept + m.weights[0] * (mu + 3) - 7) < 1e-5


def test_knn_rejects_nan_and_keeps_types(spark):
    rows = [(f"r{i}", [float(i), 0.0], 0.4 if i < 3 else 0.6) for i in range(6)]
    df = spark.createDataFrame(rows, "id string, v array<double>, lab double")
    knn = KNNClassifier(n_neighbors=2, block_rows=3).fit(df, "id", "v", "lab")
    got = {r.id: r.prediction for r in knn.predict(df, exclude_self=True).collect()}
    assert got["r0"] == 0.4 and got["r5"] == 0.6 and len(got) == 6
    bad = df.union(spark.createDataFrame([("x", [float("nan"), 0.0], 0.4)], df.schema))
    with pytest.raises(ValueError):
        knn.predict(bad)
    with pytest.raises(ValueError):
        KNNClassifier(2).fit(bad, "id", "v", "lab").predict(df)


def test_mixture_far_apart(spark):
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(0, 1, 200), rng.normal(1e8, 1, 200)]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id bigint, x double")
    m = GaussianMixture(2, max_iter=5, init_means=np.array([[0.0], [1e8]])).fit(df, ["x"], "id")
    want = [x[:200].var(), x[200:].var()]
    assert np.allclose(m.covariances_.ravel(), want, rtol=1e-4)


def test_newton_gain_without_curvature(spark):
    sql = NewtonGain(["g"], ["h"]).gain(["tg", "th"], ["lg", "lh"], ["rg", "rh"])
    row = spark.sql("select 1D tg, 2D th, 1D lg, 0D lh, 0D rg, 2D rh").selectExpr(f"{sql} as v").first()
    assert row.v == -0.25


def test_one_vs_rest_rejects_nulls(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (3.0, None)], "x double, y int")
    with pytest.raises(ValueError):
        OneVsRestSVM().fit(df, ["x"], "y")


@pytest.mark.parametrize("limit", [0, 10_000])
def test_null_nan_and_ties_at_every_width(spark, monkeypatch, limit):
    from tablelearn.functions import arrow_scores
    from tablelearn.operators import pairwise
    from tablelearn.plans.bayes import GaussianNB

    monkeypatch.setattr(arrow_scores, "MAX_GENERATED_TERMS", limit)
    monkeypatch.setattr(pairwise, "MAX_GENERATED_TERMS", limit)
    df = spark.createDataFrame([(0, 1.0, 0.0), (1, None, 0.0), (2, 0.0, 0.0), (3, float("nan"), 0.0)],
                               "id bigint, x1 double, x2 double")
    points = np.array([[-1.0, 0.0], [1.0, 0.0]])
    near = {r.id: r.nearest for r in pairwise.nearest_point_frame(df, "id", ["x1", "x2"], points).collect()}
    assert near == {0: 1, 1: None, 2: 0, 3: 0}
    far = {(r.id, r.point): r.value for r in pairwise.long_point_values(df, "id", ["x1", "x2"], points).collect()}
    assert len(far) == 8 and far[0, 0] == 2.0 and far[1, 0] is None and np.isnan(far[3, 1])
    wide = {r.id: r.k1 for r in pairwise.wide_point_values(df, ["id"], ["x1", "x2"], points).collect()}
    assert wide[0] == 0.0 and wide[1] is None and wide[2] == 1.0
    train = spark.createDataFrame([(-1.0, 0.0, 0), (-2.0, 1.0, 0), (1.0, 0.0, 1), (2.0, 1.0, 1)],
                                  "x1 double, x2 double, y int")
    nb = GaussianNB().fit(train, ["x1", "x2"], "y")
    got = {r.id: r.prediction for r in nb.transform(df.where("id < 3")).collect()}
    assert got == {0: 1, 1: None, 2: 0}


@pytest.mark.parametrize("width", [2, 14])
def test_one_row_group_has_undefined_covariance(spark, width):
    from tablelearn.operators import moments

    cols = [f"c{i}" for i in range(width)]
    rows = [(g, *[float(r * (i + 1)) for i in range(width)]) for r, g in enumerate([0, 0, 0, 1])]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"{c} double" for c in cols))
    got = moments.covariance_table(df, cols, by="g").where("i = 0 and j = 1").collect()
    assert {r.g: r.value for r in got} == {0: 2.0, 1: None}


def test_boosting_scores_at_its_default_size(spark):
    rows = [(i, float(i % 10) + (i % 3) * 0.1, float(i % 7), i % 10) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, a double, b double, lab int")
    m = GradientBoostingClassifier(n_estimators=2, learning_rate=0.01).fit(df, ["a", "b"], "lab")
    few = {r.id: (r.x, r.p) for r in df.select("id", m.predict_col().alias("x"), m.logit_cols()[3].alias("p")).collect()}
    short = {r.id: (r.prediction, r._logit3) for r in m.with_logits(m.transform(df)).collect()}
    assert all(short[i][0] == few[i][0] and abs(short[i][1] - few[i][1]) < 1e-12 for i in few)
    m.trees = m.trees * 100  # 200 rounds, 10 classes
    null = spark.createDataFrame([(999, None, 1.0, 0)], df.schema)
    got = {r.id: r for r in m.with_logits(m.transform(df.union(null))).collect()}
    assert all(got[i].prediction == few[i][0] and abs(got[i]._logit3 - 100 * few[i][1]) < 1e-9 for i in few)
    assert got[999].prediction is None and got[999]._logit0 is None
