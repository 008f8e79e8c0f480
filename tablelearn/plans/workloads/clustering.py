"""G17 k-means with E11 centroid update, G19 GMM with E12 M-step and E14."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.tables import embedding_view
from ..cluster import GaussianMixture, KMeans
from ..common import rnd, sql_emb, sql_rnd, xs
from ..registry import query
from .aggregates import EMB_LONG_SQL, wide_features

SEED = 42
GM = dict(k=2, tol=1e-3, max_iter=100)


def _seed_sql(p: int, k: int, name: str) -> str:
    cols = ", ".join(f"x{i + 1}" for i in range(p))
    return f"""{name} AS (SELECT (row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id) - 1)::BIGINT
                       AS cid, {cols}
                FROM emb ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id LIMIT {k})"""


def _kmeans_sql(k: int, tail: str) -> str:
    """Lloyd steps over whole vectors until no centroid cell moves by more than 1e-8, as the
    query does: a step of the recursion holds the centroids."""
    near = """(SELECT vec_id, cid FROM (
        SELECT e.vec_id, c.cid, row_number() OVER (PARTITION BY e.vec_id
          ORDER BY list_sum(list_transform(list_zip(e.v, c.cv), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.cid) AS rn
        FROM e CROSS JOIN {c} c) WHERE rn = 1)"""
    return f"""WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), {EMB_LONG_SQL},
    lloyd AS (
        SELECT 0 AS step, (row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id) - 1)::BIGINT AS cid,
               embedding::DOUBLE[] AS cv, false AS done
        FROM embeddings WHERE vec_id IN (
            SELECT vec_id FROM embeddings ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id LIMIT {k})
        UNION ALL
        SELECT step + 1, cid, new, max(list_max(list_transform(list_zip(new, cv), lambda z: abs(z[1] - z[2])))) OVER () <= 1e-8
        FROM (SELECT c.step, c.cid, c.cv, coalesce(n.cv, c.cv) AS new
              FROM lloyd c LEFT JOIN (
                  SELECT cid, list(m ORDER BY i) AS cv FROM (
                      SELECT a.cid, ev.i, avg(ev.x) AS m FROM {near.format(c='lloyd')} a JOIN ev USING (vec_id) GROUP BY a.cid, ev.i)
                  GROUP BY cid) n USING (cid)
              WHERE NOT c.done AND c.step < 100)),
    cfin AS (SELECT cid, cv FROM lloyd WHERE step = (SELECT max(step) FROM lloyd)),
    afin AS (SELECT * FROM {near.format(c='cfin')})
    """ + tail.format(a="afin", c="cfin")


def _kmeans(spark, sf_dir, k):
    df, cols = wide_features(spark, sf_dir)
    return df, KMeans(k, max_iter=100, tol=1e-8, seed=SEED).fit(df, cols, "vec_id")


@query("g17_kmeans", _kmeans_sql(5, "SELECT vec_id, cid AS cluster FROM {a}"))
def g17_kmeans(spark, sf_dir):
    """k-means over whole vectors until the centroids stand still."""
    df, model = _kmeans(spark, sf_dir, 5)
    return model.predict(df, "vec_id", out="cluster").select("vec_id", F.col("cluster").cast("bigint").alias("cluster"))


@query("e11_centroid_update", _kmeans_sql(5, f"""
    SELECT cid AS cluster, i::BIGINT AS i, {sql_rnd('x')} AS centroid FROM (
      SELECT cid, unnest(generate_series(0, len(cv) - 1)) AS i, unnest(cv) AS x FROM {{c}})"""))
def e11_centroid_update(spark, sf_dir):
    _, model = _kmeans(spark, sf_dir, 5)
    rows = [(j, i, float(x)) for j, c in enumerate(model.centroids_) for i, x in enumerate(c)]
    out = spark.createDataFrame(rows, "cluster bigint, i bigint, centroid double")
    return out.select("cluster", "i", rnd("centroid").alias("centroid"))


@query("g17_kmeans_wide", _kmeans_sql(10, "SELECT vec_id, cid AS cluster FROM {a}"))
def g17_kmeans_wide(spark, sf_dir):
    """Ten clusters over whole vectors (Arrow partial sums)."""
    df, model = _kmeans(spark, sf_dir, 10)
    return model.predict(df, "vec_id").select("vec_id", F.col("cluster").cast("bigint").alias("cluster"))


def _gmm_sql(tail: str) -> str:
    """EM on two dims until the weights move by less than the tolerance, as the query does; a
    step of the recursion holds the parameters."""
    k = GM["k"]
    score = """ln(c.w) - 0.5 * (2 * ln(2 * pi()) + ln(c.a * c.d - c.b * c.b)
                + (c.d * (e.x1 - c.m1) ^ 2 - 2 * c.b * (e.x1 - c.m1) * (e.x2 - c.m2) + c.a * (e.x2 - c.m2) ^ 2)
                  / (c.a * c.d - c.b * c.b))"""
    resp = """(SELECT *, exp(s - mx - ln(sum(exp(s - mx)) OVER (PARTITION BY vec_id))) AS r FROM (
                SELECT *, max(s) OVER (PARTITION BY vec_id) AS mx FROM (
                    SELECT e.vec_id, e.x1, e.x2, c.comp, {score} AS s FROM emb e CROSS JOIN {c} c {w})))"""
    return f"""WITH RECURSIVE {sql_emb(2)}, {_seed_sql(2, k, 'seed')},
    em AS (
        SELECT 0 AS step, cid AS comp, 1.0::DOUBLE / {k} AS w, x1 AS m1, x2 AS m2, 1.0::DOUBLE AS a, 0.0::DOUBLE AS b, 1.0::DOUBLE AS d,
               false AS done FROM seed
        UNION ALL
        SELECT step + 1, comp, nk / n, m1, m2, a, b, d, sum(abs(nk / n - old)) OVER () < {GM['tol']} FROM (
            SELECT c.step, c.comp, c.w AS old, q.nk, sum(q.nk) OVER () AS n, q.m1, q.m2,
                   q.s11 / q.nk - q.m1 * q.m1 + 1e-6 AS a, q.s12 / q.nk - q.m1 * q.m2 AS b, q.s22 / q.nk - q.m2 * q.m2 + 1e-6 AS d
            FROM em c JOIN (
                SELECT comp, sum(r) AS nk, sum(r * x1) / sum(r) AS m1, sum(r * x2) / sum(r) AS m2, sum(r * x1 * x1) AS s11,
                       sum(r * x1 * x2) AS s12, sum(r * x2 * x2) AS s22
                FROM {resp.format(score=score, c='em', w='')} GROUP BY comp) q USING (comp)
            WHERE NOT c.done AND c.step < {GM['max_iter']})),
    fin AS (SELECT * FROM em WHERE step = (SELECT max(step) FROM em)),
    last AS (SELECT * FROM {resp.format(score=score, c='fin', w='')})
    """ + tail.format(r="last", p="fin")


def _gmm(spark, sf_dir):
    df = embedding_view(spark, sf_dir, 2)
    model = GaussianMixture(GM["k"], max_iter=GM["max_iter"], tol=GM["tol"], init_params="random", seed=SEED)
    return df, model.fit(df, xs(2), "vec_id")


@query("g19_gmm", _gmm_sql(f"""
    SELECT vec_id, comp::INTEGER AS component, {sql_rnd('r')} AS probability FROM (
      SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, comp) AS rn FROM {{r}})
    WHERE rn = 1"""))
def g19_gmm(spark, sf_dir):
    """Two dims, whose 2 x 2 covariances SQL can invert in every step, to the stopping rule."""
    df, model = _gmm(spark, sf_dir)
    out = model.transform(df)
    resp = F.greatest(*[F.col(f"resp_{j}") for j in range(GM["k"])])
    return out.select("vec_id", "component", rnd(resp).alias("probability"))


@query("g19_gmm_wide")
def g19_gmm_wide(spark, sf_dir):
    """Whole vectors: k-means starts, three restarts side by side, the likeliest one to its
    stopping rule. SQL cannot invert 64 x 64 covariances in every step: rows only, compared
    with NumPy in the tests."""
    df, cols = wide_features(spark, sf_dir)
    model = GaussianMixture(3, n_init=3, reg_covar=1e-3, seed=SEED).fit(df, cols, "vec_id")
    out = model.transform(df)
    return out.select("vec_id", "component", rnd("log_likelihood", 4).alias("log_likelihood"))


@query("e12_gmm_mstep", f"""
    WITH {EMB_LONG_SQL},
    seed AS (SELECT (row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id) - 1)::BIGINT AS comp, vec_id AS sid
             FROM embeddings ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id LIMIT {GM['k']}),
    mu AS (SELECT comp, i, x AS m FROM seed JOIN ev ON ev.vec_id = sid),
    d AS (SELECT vec_id, comp, -0.5 * sum((x - m) ^ 2) AS s FROM ev JOIN mu USING (i) GROUP BY vec_id, comp),
    r AS (SELECT vec_id, comp, exp(s - mx) / sum(exp(s - mx)) OVER (PARTITION BY vec_id) AS r
          FROM (SELECT *, max(s) OVER (PARTITION BY vec_id) AS mx FROM d)),
    w AS (SELECT comp, sum(r) AS nk, sum(r) / (SELECT count(*) FROM embeddings) AS weight FROM r GROUP BY comp),
    m AS (SELECT comp, i, sum(r * x) / any_value(nk) AS mean FROM r JOIN ev USING (vec_id) JOIN w USING (comp) GROUP BY comp, i)
    SELECT a.comp AS component, a.i::BIGINT AS i, b.i::BIGINT AS j, {sql_rnd('any_value(w.weight)')} AS weight,
           {sql_rnd('any_value(a.mean)')} AS mean,
           {sql_rnd('sum(r.r * (ea.x - a.mean) * (eb.x - b.mean)) / any_value(w.nk) + CASE WHEN a.i = b.i THEN 1e-6 ELSE 0 END')} AS cov
    FROM r JOIN ev ea ON ea.vec_id = r.vec_id JOIN ev eb ON eb.vec_id = r.vec_id AND ea.i <= eb.i
    JOIN m a ON a.comp = r.comp AND a.i = ea.i JOIN m b ON b.comp = r.comp AND b.i = eb.i JOIN w ON w.comp = r.comp
    GROUP BY a.comp, a.i, b.i""")
def e12_gmm_mstep(spark, sf_dir):
    """One E-step from seeded rows with unit covariances and its M-step, over whole vectors:
    weight, mean of feature i, covariance of i and j a component."""
    df, cols = wide_features(spark, sf_dir)
    m = GaussianMixture(GM["k"], max_iter=1, init_params="random", seed=SEED).fit(df, cols, "vec_id")
    p = len(cols)
    rows = [(c, i, j, float(m.weights_[c]), float(m.means_[c, i]), float(m.covariances_[c, i, j]))
            for c in range(GM["k"]) for i in range(p) for j in range(i, p)]
    out = spark.createDataFrame(rows, "component bigint, i bigint, j bigint, weight double, mean double, cov double")
    return out.select("component", "i", "j", *[rnd(n).alias(n) for n in ("weight", "mean", "cov")])
