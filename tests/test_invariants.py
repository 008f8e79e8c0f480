"""Invariants for fits SQL cannot express directly."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.operators import pairwise, sampling
from tablelearn.operators.prefix import suffix_sums
from tablelearn.plans.cluster import GaussianMixture, KMeans
from tablelearn.plans.common import xs
from tablelearn.plans.decompose import PCA
from tablelearn.plans.trees import DecisionTreeClassifier
from tablelearn.sources.tables import embedding_array_view, embedding_view

from .conftest import SF001, SF01


def test_kmeans_inertia_non_increasing(spark):
    df = embedding_view(spark, SF01, 4)
    inertias = []
    for it in (1, 2, 4, 8):
        m = KMeans(5, max_iter=it, tol=0.0, seed=7).fit(df, xs(4), "vec_id")
        inertias.append(m.inertia(df))
    assert all(a >= b - 1e-12 for a, b in zip(inertias, inertias[1:]))


def test_kmeans_wide_path_matches_narrow(spark):
    df = embedding_view(spark, SF001, 4)
    narrow = KMeans(3, max_iter=5, tol=0.0, seed=3).fit(df, xs(4), "vec_id").centroids_
    from tablelearn.operators import pairwise as pw
    saved = pw.MAX_GENERATED_TERMS
    pw.MAX_GENERATED_TERMS = 0
    try:
        wide = KMeans(3, max_iter=5, tol=0.0, seed=3).fit(df, xs(4), "vec_id").centroids_
    finally:
        pw.MAX_GENERATED_TERMS = saved
    np.testing.assert_allclose(narrow, wide, atol=1e-12)


def test_gmm_log_likelihood_non_decreasing(spark):
    df = embedding_view(spark, SF01, 2)
    m = GaussianMixture(3, max_iter=8, tol=0.0, seed=5).fit(df, xs(2), "vec_id")
    ll = m.log_likelihood_
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(ll, ll[1:]))
    assert np.isclose(m.weights_.sum(), 1.0)


def test_pca_orthonormal_and_reconstruction(spark):
    df = embedding_view(spark, SF001, 3)
    m = PCA(n_components=3).fit(df, xs(3))
    v = m.components_
    np.testing.assert_allclose(v @ v.T, np.eye(3), atol=1e-10)
    z = m.transform(df)
    rec = z.select(*xs(3), *m.reconstruct_cols(["z1", "z2", "z3"])).collect()
    for r in rec:
        for i in range(3):
            assert r[f"r{i + 1}"] == pytest.approx(r[f"x{i + 1}"], abs=1e-10)


def test_pca_bad_components(spark):
    df = embedding_view(spark, SF001, 2)
    with pytest.raises(ValueError):
        PCA(n_components=3).fit(df, xs(2))


def test_nb_probabilities_sum_to_one(spark):
    from tablelearn.plans.bayes import GaussianNB

    df = embedding_view(spark, SF001, 4)
    m = GaussianNB().fit(df, xs(4), "label")
    total = sum(m.probability_columns())
    vals = [r[0] for r in df.select(total).collect()]
    assert np.allclose(vals, 1.0)


def test_tree_leaves_partition_rows(spark):
    df = embedding_view(spark, SF001, 4)
    m = DecisionTreeClassifier(max_depth=3).fit(df, xs(4), "label")
    leaves = df.select(m.tree.leaf_id_col().alias("leaf")).groupBy("leaf").count().collect()
    assert sum(r["count"] for r in leaves) == df.count()
    assert all(m.tree.is_leaf(r["leaf"]) for r in leaves)


def test_suffix_sums_two_level_equals_single_window(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), float(v), float(w)) for g, v, w in
            zip(rng.integers(0, 3, 400), rng.normal(size=400).round(2), rng.random(400))]
    df = spark.createDataFrame(rows, "g int, v double, w double").groupBy("g", "v").agg(F.sum("w").alias("w"))
    single = {(r.g, r.v): r.cum_w for r in suffix_sums(df, ["g"], "v", ["w"]).collect()}
    split = {(r.g, r.v): r.cum_w for r in suffix_sums(df, ["g"], "v", ["w"], target_rows=20).collect()}
    assert single.keys() == split.keys()
    for k in single:
        assert split[k] == pytest.approx(single[k], rel=1e-12)


def test_aligned_shuffle_is_permutation(spark):
    df = spark.read.parquet(f"{SF001}/customer.parquet").select("c_custkey")
    out = sampling.aligned_shuffle(df.repartition(4), "c_custkey", seed=9).collect()
    pos = sorted(r.position for r in out)
    assert pos == list(range(df.count()))


def test_knn_blocks_match_single_block(spark):
    emb = embedding_array_view(spark, SF001)
    one = pairwise.knn_pairs(emb, emb, "vec_id", "vec_id", "features", 4, exclude_self=True)
    many = pairwise.knn_pairs(emb, emb, "vec_id", "vec_id", "features", 4, exclude_self=True, block_rows=60)
    a = sorted((r.vec_id, r.rank, r.neighbor) for r in one.collect())
    b = sorted((r.vec_id, r.rank, r.neighbor) for r in many.collect())
    assert a == b


def test_tree_two_level_windows_match(spark):
    df = embedding_view(spark, SF001, 3)
    a = DecisionTreeClassifier(max_depth=3).fit(df, xs(3), "label").tree.nodes
    b = DecisionTreeClassifier(max_depth=3, target_window_rows=25).fit(df, xs(3), "label").tree.nodes
    assert a == b


def test_validate_flags_ragged(spark):
    from tablelearn.sources.validate import assert_valid, validate_array_features

    df = spark.createDataFrame([([1.0, 2.0], 0), ([1.0], 1), ([float("nan"), 1.0], None)],
                               "f array<double>, y int")
    r = validate_array_features(df, "f", "y").first()
    assert (r.n_bad_values, r.min_width, r.max_width, r.n_null_labels) == (1, 1, 2, 1)
    with pytest.raises(ValueError):
        assert_valid(validate_array_features(df, "f", "y"))


def test_stream_scoring(spark, tmp_path):
    from tablelearn.plans.bayes import GaussianNB
    from tablelearn.streaming.scoring import read_parquet_stream, score_stream, write_scored

    static = embedding_view(spark, SF001, 4)
    model = GaussianNB().fit(static, xs(4), "label")
    schema = spark.read.parquet(f"{SF001}/embeddings.parquet").schema
    stream = read_parquet_stream(spark, SF001, schema, glob="embeddings.parquet")
    feats = stream.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i + 1}") for i in range(4)],
                          "label")
    scored = score_stream(feats, lambda d: model.transform(d))
    out = str(tmp_path / "scored")
    q = write_scored(scored, out, f"nb_stream_{tmp_path.name}")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == static.count()
    expect = {r.vec_id: r.prediction for r in model.transform(static).collect()}
    assert all(expect[r.vec_id] == r.prediction for r in got.collect())


def test_knn_classifier_matches_brute_force(spark):
    from tablelearn.plans.neighbors import KNNClassifier

    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = emb.collect()
    train = emb.filter(F.col("vec_id") % 3 != 0)
    test = emb.filter(F.col("vec_id") % 3 == 0)
    model = KNNClassifier(n_neighbors=5, block_rows=100).fit(train, "vec_id", "embedding", "label")
    got = {r.vec_id: r.prediction for r in model.predict(test).collect()}
    tr = [(r.vec_id, np.array(r.embedding, dtype=float), r.label) for r in rows if r.vec_id % 3 != 0]
    for r in rows:
        if r.vec_id % 3:
            continue
        x = np.array(r.embedding, dtype=float)
        d = sorted((float(np.sqrt(((x - v) ** 2).sum())), i, lab) for i, v, lab in tr)[:5]
        votes = {}
        for _, _, lab in d:
            votes[lab] = votes.get(lab, 0) + 1
        best = min(votes, key=lambda lab: (-votes[lab], lab))
        assert got[r.vec_id] == best


@pytest.mark.parametrize("kind", ["nb", "lda", "gmm"])
def test_arrow_scoring_matches_expressions(spark, kind):
    from tablelearn.functions import arrow_scores
    from tablelearn.plans.bayes import GaussianNB, LinearDiscriminantAnalysis

    df = embedding_view(spark, SF001, 3)
    if kind == "gmm":
        model = GaussianMixture(2, max_iter=3, tol=0.0, seed=2).fit(df, xs(3), "vec_id")
        run = lambda: {r.vec_id: (r.component, r.log_likelihood) for r in model.transform(df).collect()}
    else:
        model = (GaussianNB() if kind == "nb" else LinearDiscriminantAnalysis()).fit(df, xs(3), "label")
        run = lambda: {r.vec_id: (r.prediction, r.probability) for r in model.transform(df).collect()}
    expr = run()
    saved = arrow_scores.MAX_GENERATED_TERMS
    arrow_scores.MAX_GENERATED_TERMS = 0
    try:
        arrow = run()
    finally:
        arrow_scores.MAX_GENERATED_TERMS = saved
    assert expr.keys() == arrow.keys()
    for k in expr:
        assert expr[k][0] == arrow[k][0]
        assert expr[k][1] == pytest.approx(arrow[k][1], rel=1e-9)


@pytest.mark.parametrize("kind", ["logit", "svm", "pegasos", "ovr"])
def test_arrow_gradients_match_sql(spark, kind):
    from tablelearn.functions import arrow_scores
    from tablelearn.plans.linear import LogisticRegression
    from tablelearn.plans.svm import LinearSVM, OneVsRestSVM, PegasosSVM

    df = embedding_view(spark, SF001, 3).withColumn("yb", (F.col("label") < 5).cast("int")).withColumn(
        "ypm", F.when(F.col("label") < 5, 1).otherwise(-1))
    make = {
        "logit": lambda: LogisticRegression(learning_rate=0.05, max_iter=4, tol=0.0).fit(df, xs(3), "yb").coef_,
        "svm": lambda: LinearSVM(learning_rate=0.1, max_iter=4, tol=0.0).fit(df, xs(3), "ypm").coef_,
        "pegasos": lambda: PegasosSVM(C=1.0, max_iter=4, tol=0.0).fit(df, xs(3), "ypm").coef_,
        "ovr": lambda: OneVsRestSVM(learning_rate=0.1, max_iter=3, tol=0.0).fit(df, xs(3), "label").coef_,
    }[kind]
    sql = make()
    saved = arrow_scores.MAX_GENERATED_AGGREGATES
    arrow_scores.MAX_GENERATED_AGGREGATES = 0
    try:
        arrow = make()
    finally:
        arrow_scores.MAX_GENERATED_AGGREGATES = saved
    np.testing.assert_allclose(arrow, sql, rtol=1e-9, atol=1e-12)


def test_stopping_rules(spark):
    """H1-H5: every loop stops early once its criterion is met."""
    from tablelearn.plans.linear import LinearRegression, LogisticRegression
    from tablelearn.plans.svm import LinearSVM, PegasosSVM
    from tablelearn.sources.tables import document_xy, lineitem_xy

    li = lineitem_xy(spark, SF001, standardized=True)
    gd = LinearRegression(closed_form=False, learning_rate=0.5, max_iter=5000, tol=1e-8).fit(li, ["x1", "x2"], "y")
    assert gd.n_iter_ < 5000  # H1 on the collected Gram
    docs = document_xy(spark, SF001, "quality")
    logit = LogisticRegression(learning_rate=0.1, max_iter=2000, tol=1e-4).fit(docs, ["x1"], "y")
    assert logit.n_iter_ < 2000  # H1
    km = KMeans(3, max_iter=100, tol=0.0, seed=1).fit(embedding_view(spark, SF001, 2), xs(2), "vec_id")
    assert km.n_iter_ < 100  # H2: exact fixed point reached
    gmm = GaussianMixture(2, max_iter=100, tol=1e-2, seed=1).fit(embedding_view(spark, SF001, 2), xs(2), "vec_id")
    assert gmm.n_iter_ < 100  # H3
    toxic = document_xy(spark, SF001, "toxic")
    svm = LinearSVM(learning_rate=0.1, max_iter=500, tol=1e-3).fit(toxic, ["x1"], "y")
    assert svm.n_iter_ < 500  # H4
    peg = PegasosSVM(C=1.0, max_iter=500, tol=0.5).fit(toxic, ["x1"], "y")
    assert peg.n_iter_ < 500  # H5


def test_ridge_gradient_descent_reaches_closed_form(spark):
    from tablelearn.plans.linear import Ridge
    from tablelearn.sources.tables import lineitem_xy

    li = lineitem_xy(spark, SF001, standardized=True)
    closed = Ridge(alpha=0.1).fit(li, ["x1", "x2", "x3"], "y").coef_
    gd = Ridge(alpha=0.1, closed_form=False, learning_rate=0.5, max_iter=20000, tol=1e-13).fit(
        li, ["x1", "x2", "x3"], "y").coef_
    np.testing.assert_allclose(gd, closed, atol=1e-8)


def test_binned_tree_routes_raw_values_consistently(spark):
    """Histogram mode: cutoffs are bin edges; training assignment on snapped
    values equals routing of raw values, and many bins reproduce the exact tree."""
    df = embedding_view(spark, SF001, 3)
    exact = DecisionTreeClassifier(max_depth=3).fit(df, xs(3), "label")
    fine = DecisionTreeClassifier(max_depth=3, max_bins=10_000).fit(df, xs(3), "label")
    a = {r.vec_id: r.p for r in df.select("vec_id", exact.predict_col().alias("p")).collect()}
    b = {r.vec_id: r.p for r in df.select("vec_id", fine.predict_col().alias("p")).collect()}
    agree = sum(a[k] == b[k] for k in a) / len(a)
    assert agree > 0.95
    coarse = DecisionTreeClassifier(max_depth=3, max_bins=8).fit(df, xs(3), "label")
    leaves = df.select(coarse.tree.leaf_id_col().alias("leaf")).groupBy("leaf").count().collect()
    assert sum(r["count"] for r in leaves) == df.count()
    cut = {nd["cutoff"] for nd in coarse.tree.nodes.values() if "cutoff" in nd}
    assert len(cut) >= 1


def test_array_routing_matches_nested_case(spark):
    df = embedding_view(spark, SF001, 4)
    tree = DecisionTreeClassifier(max_depth=4).fit(df, xs(4), "label").tree
    case = {r.vec_id: r.leaf for r in df.select("vec_id", tree.leaf_id_col().alias("leaf")).collect()}
    walked = {r.vec_id: r.leaf for r in tree.route(df).collect()}
    assert case == walked


def test_pca_arrow_projection_matches_expressions(spark):
    from tablelearn.functions import arrow_scores

    df = embedding_view(spark, SF001, 4)
    m = PCA(n_components=3).fit(df, xs(4))
    expr = {r.vec_id: (r.z1, r.z2, r.z3) for r in m.transform(df).collect()}
    saved = arrow_scores.MAX_GENERATED_TERMS
    arrow_scores.MAX_GENERATED_TERMS = 0
    try:
        arrow = {r.vec_id: (r.z1, r.z2, r.z3) for r in m.transform(df).collect()}
    finally:
        arrow_scores.MAX_GENERATED_TERMS = saved
    for k in expr:
        np.testing.assert_allclose(arrow[k], expr[k], rtol=1e-9, atol=1e-12)
