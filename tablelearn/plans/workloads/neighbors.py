"""D1-D8 pairwise operators, G8 KNN with E13 vote and F4 accuracy, E14 mixture likelihood."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ...functions.activations import logsumexp
from ...functions.arrow_scores import append_scores
from ...functions.linalg import argmax_index, pick
from ...operators import metrics, moments, pairwise, sampling
from ...sources.tables import embedding_array_view
from ..base import collect_bounded
from ..cluster import GaussianMixture
from ..common import WIDE, rnd, sql_inverse, sql_rnd
from ..registry import query
from .aggregates import EMB_LONG_SQL, wide_features

SEED = 42
M = 8  # landmarks
K_NN = 3

LANDMARK_SQL = f"""
    lm AS (SELECT (row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id) - 1)::BIGINT AS point,
                  embedding::DOUBLE[] AS le
           FROM embeddings ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id LIMIT {M})"""


def landmarks(spark, sf_dir, df, cols):
    """A4 sample of M rows, collected as the literal point set (M x p, bounded)."""
    sample = sampling.sample_k(df, "vec_id", M, SEED)
    return pairwise.to_points(sample, cols)


def _landmark_query(fn: str, **kw):
    def run(spark, sf_dir):
        df, cols = wide_features(spark, sf_dir)
        pts = landmarks(spark, sf_dir, df, cols)
        out = pairwise.long_point_values(df, "vec_id", cols, pts, fn=fn, **kw)
        return out.select("vec_id", "point", rnd("value").alias("value"))
    return run


def _landmark_sql(expr: str) -> str:
    return f"""
    WITH {LANDMARK_SQL}
    SELECT e.vec_id, lm.point, {sql_rnd(expr)} AS value
    FROM embeddings e CROSS JOIN lm"""


query("d2_landmark_distance", _landmark_sql("list_distance(e.embedding::DOUBLE[], lm.le)"))(
    _landmark_query("distance"))
query("d3_linear_kernel", _landmark_sql("list_inner_product(e.embedding::DOUBLE[], lm.le)"))(
    _landmark_query("linear"))
query("d4_polynomial_kernel", _landmark_sql("pow(1 + list_inner_product(e.embedding::DOUBLE[], lm.le), 3)"))(
    _landmark_query("polynomial", degree=3))
query("d5_rbf_kernel", _landmark_sql(
    "exp(-0.5 * list_sum(list_transform(list_zip(e.embedding::DOUBLE[], lm.le), lambda t: (t[1] - t[2]) ^ 2)))"))(
    _landmark_query("rbf", gamma=0.5))


@query("d1_paired_distance", f"""
    WITH {EMB_LONG_SQL},
    c AS (SELECT label, i, avg(x) AS m FROM ev GROUP BY label, i)
    SELECT ev.vec_id, {sql_rnd('sqrt(sum((ev.x - c.m) ^ 2))')} AS distance
    FROM ev JOIN c USING (label, i) GROUP BY ev.vec_id""")
def d1_paired_distance(spark, sf_dir):
    """Distance of each row to its own class centroid: an equi-join on label."""
    df, cols = wide_features(spark, sf_dir)
    cents = moments.class_means(df, cols, "label")
    collect_bounded(cents.select("label"), "centroids")  # K bounded -> safe to broadcast
    joined = df.join(F.broadcast(cents), "label")
    return joined.select("vec_id", rnd(pairwise.paired_distance(
        cols, [F.col(f"mean_{k}") for k in range(len(cols))])).alias("distance"))


@query("d6_nearest_centroid", f"""
    WITH {EMB_LONG_SQL},
    c AS (SELECT label AS cls, i, avg(x) AS m FROM ev GROUP BY label, i),
    d AS (SELECT ev.vec_id, c.cls, sum((ev.x - c.m) ^ 2) AS d FROM ev JOIN c USING (i)
          GROUP BY ev.vec_id, c.cls),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cls) AS rn FROM d)
    SELECT vec_id, cls AS nearest FROM r WHERE rn = 1""")
def d6_nearest_centroid(spark, sf_dir):
    df, cols = wide_features(spark, sf_dir)
    rows = sorted(collect_bounded(moments.class_means(df, cols, "label"), "centroids"),
                  key=lambda r: r["label"])
    pts = np.array([[r[f"mean_{k}"] for k in range(len(cols))] for r in rows])
    labels = [r["label"] for r in rows]
    idx = pairwise.nearest_point_frame(df, "vec_id", cols, pts, out="_idx")
    return idx.select("vec_id", pick(labels, F.col("_idx")).alias("nearest"))


KNN_PAIRS_SQL = f"""
    pairs AS (SELECT a.vec_id, b.vec_id AS neighbor, b.label AS nlabel,
                     list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
              FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbor) AS rank
                           FROM pairs) WHERE rank <= {K_NN})"""


def _knn(spark, sf_dir):
    emb = embedding_array_view(spark, sf_dir)
    pairs = pairwise.knn_pairs(emb, emb, "vec_id", "vec_id", "features", K_NN, exclude_self=True,
                               carry="label")
    return emb, pairs


@query("d7_knn_topk", f"""
    WITH {KNN_PAIRS_SQL}
    SELECT vec_id, rank::BIGINT AS rank, neighbor, {sql_rnd('d')} AS distance FROM top""")
def d7_knn_topk(spark, sf_dir):
    _, pairs = _knn(spark, sf_dir)
    return pairs.select("vec_id", "rank", "neighbor", rnd("distance").alias("distance"))  # label dropped


KNN_PRED_SQL = f"""
    WITH {KNN_PAIRS_SQL},
    votes AS (SELECT vec_id, nlabel, count(*) AS c FROM top GROUP BY vec_id, nlabel),
    pred AS (SELECT vec_id, nlabel AS prediction FROM (
               SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, nlabel) AS rn FROM votes)
             WHERE rn = 1),
    scored AS (SELECT e.vec_id, e.label, p.prediction FROM embeddings e JOIN pred p USING (vec_id))"""


@query("g8_knn_classifier", KNN_PRED_SQL + " SELECT * FROM scored")
def g8_knn_classifier(spark, sf_dir):
    emb, pairs = _knn(spark, sf_dir)
    pred = pairwise.knn_vote(pairs, "vec_id", "label")
    return emb.select("vec_id", "label").join(pred, "vec_id")


@query("e13_knn_vote", KNN_PRED_SQL + " SELECT vec_id, prediction FROM scored")
def e13_knn_vote(spark, sf_dir):
    """Majority label of the k neighbours (ties to the smallest label)."""
    emb, pairs = _knn(spark, sf_dir)
    return pairwise.knn_vote(pairs, "vec_id", "label")


@query("f4_accuracy", KNN_PRED_SQL + f"""
    SELECT {sql_rnd('avg((label = prediction)::DOUBLE)')} AS accuracy, count(*) AS n FROM scored""")
def f4_accuracy(spark, sf_dir):
    scored = g8_knn_classifier(spark, sf_dir)
    return metrics.accuracy(scored, "label", "prediction").select(
        rnd("accuracy").alias("accuracy"), "n")


# ---------------------------------------------------------- D8 / E14
#: Added to the diagonal of a class covariance: a class has fewer rows than dims.
RIDGE = 0.01
GAUSS_SQL = f"""
    {EMB_LONG_SQL},
    pri AS (SELECT label AS grp, count(*) / sum(count(*)) OVER () AS w FROM embeddings GROUP BY label),
    mu AS (SELECT label AS grp, i, avg(x) AS m FROM ev GROUP BY label, i),
    cov AS (SELECT a.label AS grp, a.i::INTEGER AS i, b.i::INTEGER AS j,
                   covar_samp(a.x, b.x) + CASE WHEN a.i = b.i THEN {RIDGE} ELSE 0 END AS v
            FROM ev a JOIN ev b ON a.vec_id = b.vec_id GROUP BY a.label, a.i, b.i),
    {', '.join(sql_inverse('inv', 'cov', WIDE))},
    dev AS (SELECT ev.vec_id, mu.grp, ev.i, ev.x - mu.m AS d FROM ev JOIN mu USING (i)),
    quad AS (SELECT a.vec_id, a.grp, sum(a.d * q.d) AS q FROM dev a JOIN (
                 SELECT b.vec_id, b.grp, inv.i, sum(inv.v * b.d) AS d FROM dev b JOIN inv ON inv.grp = b.grp AND inv.j = b.i
                 GROUP BY b.vec_id, b.grp, inv.i) q ON q.vec_id = a.vec_id AND q.grp = a.grp AND q.i = a.i
             GROUP BY a.vec_id, a.grp),
    dens AS (SELECT vec_id, quad.grp AS component, w, -0.5 * ({WIDE} * ln(2 * pi()) + logdet + q) AS ld
             FROM quad JOIN inv_det USING (grp) JOIN pri USING (grp))"""


def _components(spark, sf_dir):
    """Each class as a Gaussian over whole vectors: log prior and log density a row, from one
    scan for the parameters and one map-only pass."""
    df, cols = wide_features(spark, sf_dir)
    p = len(cols)
    blocks = sorted(collect_bounded(moments.co_moments(df, cols, "label"), "components"), key=lambda r: r["label"])
    n = sum(r["n"] for r in blocks)
    mixture = GaussianMixture(len(blocks))
    mixture.features = cols
    mixture.weights_ = np.array([r["n"] / n for r in blocks])
    mixture.means_ = np.array([r["mean"] for r in blocks])
    mixture.covariances_ = np.stack([np.array(r["co"]).reshape(p, p) / (r["n"] - 1) + RIDGE * np.eye(p) for r in blocks])
    names = [f"_j{j}" for j in range(len(blocks))]
    scored = append_scores(df, cols, names, mixture.np_joint_log_likelihood)
    return scored, names, [r["label"] for r in blocks], np.log(mixture.weights_)


@query("d8_gaussian_density", f"""
    WITH RECURSIVE {GAUSS_SQL}
    SELECT vec_id, component, {sql_rnd('ld')} AS log_density FROM dens""")
def d8_gaussian_density(spark, sf_dir):
    scored, names, labels, logw = _components(spark, sf_dir)
    structs = [F.struct(F.lit(k).alias("component"), (F.col(c) - F.lit(float(w))).alias("ld"))
               for k, c, w in zip(labels, names, logw)]
    out = scored.select("vec_id", F.inline(F.array(*structs)))
    return out.select("vec_id", "component", rnd("ld").alias("log_density"))


LL_SQL = """
    j AS (SELECT vec_id, component, ln(w) + ld AS s FROM dens),
    m AS (SELECT vec_id, max(s) AS mx FROM j GROUP BY vec_id),
    ll AS (SELECT j.vec_id, any_value(m.mx) + ln(sum(exp(j.s - m.mx))) AS ll FROM j JOIN m USING (vec_id)
           GROUP BY j.vec_id)"""


@query("e14_mixture_likelihood", f"""
    WITH RECURSIVE {GAUSS_SQL}, {LL_SQL},
    best AS (SELECT vec_id, component FROM (
               SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, component) AS rn FROM j)
             WHERE rn = 1)
    SELECT ll.vec_id, {sql_rnd('ll.ll')} AS log_likelihood, best.component AS best_component
    FROM ll JOIN best USING (vec_id)""")
def e14_mixture_likelihood(spark, sf_dir):
    scored, names, labels, _ = _components(spark, sf_dir)
    joint = [F.col(c) for c in names]
    return scored.select("vec_id", rnd(logsumexp(joint)).alias("log_likelihood"),
                         pick(labels, argmax_index(joint)).alias("best_component"))


@query("e14_total_log_likelihood", f"""
    WITH RECURSIVE {GAUSS_SQL}, {LL_SQL}
    SELECT count(*) AS n, {sql_rnd('sum(ll)', 4)} AS total_log_likelihood FROM ll""")
def e14_total_log_likelihood(spark, sf_dir):
    """E14 reduction: Σ_rows log Σ_k π_k N(x; μ_k, Σ_k), one aggregate over the scored rows."""
    scored, names, _, _ = _components(spark, sf_dir)
    ll = scored.select(logsumexp([F.col(c) for c in names]).alias("ll"))
    return ll.agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("ll"), 4).alias("total_log_likelihood"))
