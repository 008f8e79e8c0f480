"""Boundary cases from FIXTURES.md §1 (the list closing the table)."""

import numpy as np
import pytest

from tablelearn.operators import pairwise
from tablelearn.plans.bayes import GaussianNB, LinearDiscriminantAnalysis
from tablelearn.plans.cluster import GaussianMixture, KMeans
from tablelearn.plans.trees import DecisionTreeClassifier, DecisionTreeRegressor


def test_single_class_labels(spark):
    df = spark.createDataFrame([(1, 0.1, 3), (2, 0.5, 3), (3, 0.9, 3)], "id int, x double, y int")
    nb = GaussianNB().fit(df, ["x"], "y")
    out = nb.transform(df).collect()
    assert {r.prediction for r in out} == {3} and all(r.probability == pytest.approx(1.0) for r in out)
    tree = DecisionTreeClassifier(max_depth=3).fit(df, ["x"], "y").tree
    assert tree.nodes == {1: {"value": 3}}


def test_no_acceptable_split_makes_a_leaf(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 1.0, 1), (3, 1.0, 0)], "id int, x double, y int")
    tree = DecisionTreeClassifier(max_depth=3).fit(df, ["x"], "y").tree
    assert tree.nodes == {1: {"value": 0}}  # constant feature: majority leaf, ties to the smallest
    reg = DecisionTreeRegressor(max_depth=3).fit(
        spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "x double, y double"), ["x"], "y").tree
    assert reg.nodes == {1: {"value": 2.0}}  # constant target: no positive gain


def test_equal_distances_break_ties_by_id(spark):
    train = spark.createDataFrame([(10, [1.0, 0.0], 1), (11, [-1.0, 0.0], 2), (12, [0.0, 1.0], 3)],
                                  "id bigint, f array<double>, label int")
    query = spark.createDataFrame([(0, [0.0, 0.0])], "qid bigint, f array<double>")
    pairs = pairwise.knn_pairs(query, train, "qid", "id", "f", 2, carry="label").collect()
    assert [(r["rank"], r.neighbor) for r in sorted(pairs, key=lambda r: r["rank"])] == [(1, 10), (2, 11)]
    vote = pairwise.knn_vote(pairwise.knn_pairs(query, train, "qid", "id", "f", 3, carry="label"),
                             "qid", "label").first()
    assert vote.prediction == 1  # three-way tie -> smallest label


def test_empty_cluster_keeps_its_centroid(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([0.0, 0.1, 0.2, 5.0, 5.1])], "id int, x double")
    init = np.array([[0.1], [5.0], [100.0]])
    km = KMeans(3, max_iter=5, tol=0.0, init=init).fit(df, ["x"], "id")
    assert km.centroids_[2, 0] == 100.0
    assert km.centroids_[0, 0] == pytest.approx(0.1) and km.centroids_[1, 0] == pytest.approx(5.05)


def test_singular_covariance(spark):
    # x2 = 2·x1: the pooled covariance is singular; the pseudo-inverse still scores
    rows = [(i, float(i % 7), 2.0 * (i % 7), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x1 double, x2 double, y int")
    lda = LinearDiscriminantAnalysis().fit(df, ["x1", "x2"], "y")
    assert lda.transform(df).count() == 40
    assert np.isfinite(lda.coef).all()
    gmm = GaussianMixture(2, max_iter=3, tol=0.0, init_means=[[1.0, 2.0], [5.0, 10.0]]).fit(df, ["x1", "x2"], "id")
    assert np.isfinite(gmm.means_).all() and np.isclose(gmm.weights_.sum(), 1.0)
    assert all(np.linalg.eigvalsh(c).min() > 0 for c in gmm.covariances_)  # reg_covar keeps them definite
