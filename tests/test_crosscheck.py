"""Cross-checks against pyspark.ml at loose tolerance."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablelearn.plans.common import xs
from tablelearn.sources.tables import document_xy, embedding_view, lineitem_xy

from .conftest import SF01


def _assemble(df, cols):
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df)


def test_ols_matches_ml_normal_solver(spark):
    from pyspark.ml.regression import LinearRegression as MLLinearRegression

    from tablelearn.plans.linear import LinearRegression

    li = lineitem_xy(spark, SF01, standardized=True)
    ours = LinearRegression().fit(li, ["x1", "x2", "x3"], "y").coef_
    ml = MLLinearRegression(solver="normal", regParam=0.0, standardization=False, labelCol="y").fit(
        _assemble(li, ["x1", "x2", "x3"]))
    np.testing.assert_allclose(ours[1:], ml.coefficients.toArray(), atol=1e-9)
    assert ours[0] == pytest.approx(ml.intercept, abs=1e-9)


def test_pca_variance_matches_ml(spark):
    from pyspark.ml.feature import PCA as MLPCA

    from tablelearn.plans.decompose import PCA

    df = embedding_view(spark, SF01, 6)
    ours = PCA(n_components=3).fit(df, xs(6))
    ml = MLPCA(k=3, inputCol="features").fit(_assemble(df, xs(6)))
    np.testing.assert_allclose(ours.explained_variance_ratio_[:3], ml.explainedVariance.toArray(), atol=1e-9)
    np.testing.assert_allclose(np.abs(ours.components_), np.abs(ml.pc.toArray().T), atol=1e-7)


def test_logistic_regression_reaches_ml_optimum(spark):
    from pyspark.ml.classification import LogisticRegression as MLLogisticRegression

    from tablelearn.plans.linear import LogisticRegression

    docs = document_xy(spark, SF01, "quality")
    ours = LogisticRegression(learning_rate=0.005, max_iter=400, tol=1e-9).fit(docs, ["x1"], "y").coef_
    ml = MLLogisticRegression(regParam=0.0, standardization=False, labelCol="y", tol=1e-10, maxIter=200).fit(
        _assemble(docs.withColumn("y", F.col("y").cast("double")), ["x1"]))
    assert ours[0] == pytest.approx(ml.intercept, abs=1e-4)
    assert ours[1] == pytest.approx(ml.coefficients[0], abs=1e-4)


def test_naive_bayes_means_match_ml(spark):
    from pyspark.ml.classification import NaiveBayes

    from tablelearn.plans.bayes import GaussianNB

    df = embedding_view(spark, SF01, 4)
    ours = GaussianNB().fit(df, xs(4), "label")
    ml = NaiveBayes(modelType="gaussian", labelCol="label").fit(
        _assemble(df.withColumn("label", F.col("label").cast("double")), xs(4)))
    np.testing.assert_allclose(ours.theta, ml.theta.toArray(), atol=1e-12)
    np.testing.assert_allclose(np.log(ours.class_prior), ml.pi.toArray(), atol=1e-12)
