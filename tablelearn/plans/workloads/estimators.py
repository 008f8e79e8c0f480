"""G5 naive Bayes, G6 LDA."""

from __future__ import annotations

from ...sources.tables import embedding_view
from ..bayes import GaussianNB, LinearDiscriminantAnalysis
from ..common import WIDE, rnd, sql_emb, sql_inverse, sql_rnd, xs
from ..registry import query
from .aggregates import EMB_LONG_SQL


def softmax_pick_sql(scores_cte: str) -> str:
    """From (vec_id, label, cls, s): argmax class (lowest on ties) and its probability."""
    return f"""
    ranked AS (
      SELECT vec_id, label, cls, s,
             row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cls) AS rn,
             max(s) OVER (PARTITION BY vec_id) AS smax
      FROM {scores_cte}),
    norm AS (SELECT vec_id, sum(exp(s - smax)) AS z FROM ranked GROUP BY vec_id)
    SELECT r.vec_id, r.label, r.cls AS prediction, {sql_rnd('1.0 / n.z')} AS probability
    FROM ranked r JOIN norm n USING (vec_id) WHERE r.rn = 1"""


def _nb_sql(p: int = WIDE) -> str:
    stats = ", ".join(f"avg(x{i}) AS t{i}, var_pop(x{i}) + 1e-9 AS v{i}" for i in range(1, p + 1))
    ll = " + ".join(f"ln(2 * pi() * v{i}) + (x{i} - t{i}) ^ 2 / v{i}" for i in range(1, p + 1))
    return f"""
    WITH {sql_emb(p)},
    stats AS (SELECT label AS cls, count(*) AS n, {stats} FROM emb GROUP BY label),
    pri AS (SELECT *, n / sum(n) OVER () AS prior FROM stats),
    scores AS (SELECT e.vec_id, e.label, p.cls, ln(p.prior) - 0.5 * ({ll}) AS s
               FROM emb e CROSS JOIN pri p),
    {softmax_pick_sql('scores')}"""


@query("g5_gaussian_nb", _nb_sql())
def g5_gaussian_nb(spark, sf_dir):
    df = embedding_view(spark, sf_dir, WIDE)
    model = GaussianNB().fit(df, xs(WIDE), "label")
    return model.transform(df).select("vec_id", "label", "prediction",
                                      rnd("probability").alias("probability"))


LDA_SQL = f"""
    WITH RECURSIVE {EMB_LONG_SQL},
    pri AS (SELECT label AS cls, count(*) AS n, count(*) / sum(count(*)) OVER () AS prior FROM embeddings GROUP BY label),
    per AS (SELECT a.label AS cls, a.i, b.i AS j, covar_samp(a.x, b.x) AS c
            FROM ev a JOIN ev b ON a.vec_id = b.vec_id GROUP BY a.label, a.i, b.i),
    pooled AS (SELECT 0 AS grp, i::INTEGER AS i, j::INTEGER AS j, sum(prior * c) AS v FROM per JOIN pri USING (cls) GROUP BY i, j),
    {', '.join(sql_inverse('inv', 'pooled', WIDE))},
    mu AS (SELECT label AS cls, i, avg(x) AS m FROM ev GROUP BY label, i),
    coef AS (SELECT mu.cls, inv.i, sum(inv.v * mu.m) AS w FROM inv JOIN mu ON mu.i = inv.j GROUP BY mu.cls, inv.i),
    bias AS (SELECT c.cls, -0.5 * sum(c.w * mu.m) + ln(any_value(p.prior)) AS b
             FROM coef c JOIN mu ON mu.cls = c.cls AND mu.i = c.i JOIN pri p ON p.cls = c.cls GROUP BY c.cls),
    scores AS (SELECT ev.vec_id, any_value(ev.label) AS label, c.cls, sum(ev.x * c.w) + any_value(b.b) AS s
               FROM ev JOIN coef c USING (i) JOIN bias b ON b.cls = c.cls GROUP BY ev.vec_id, c.cls),
    {softmax_pick_sql('scores')}"""


@query("g6_lda", LDA_SQL)
def g6_lda(spark, sf_dir):
    """Whole vectors; one scan fits, one scores."""
    df = embedding_view(spark, sf_dir, WIDE)
    model = LinearDiscriminantAnalysis().fit(df, xs(WIDE), "label")
    return model.transform(df).select("vec_id", "label", "prediction",
                                      rnd("probability").alias("probability"))


@query("a5_model_roundtrip", _nb_sql())
def a5_model_roundtrip(spark, sf_dir):
    """Fit naive Bayes, write the model table to the shared checkpoint folder,
    read it back and score with the loaded parameters."""
    import uuid

    from ...session import scratch_path
    from ..base import ModelTable

    df = embedding_view(spark, sf_dir, WIDE)
    fitted = GaussianNB().fit(df, xs(WIDE), "label")
    path = scratch_path(spark, f"models/gaussian_nb-{uuid.uuid4().hex}")
    fitted.model_table().save(spark, path)
    loaded = ModelTable.load(spark, path)
    model = GaussianNB.from_table(loaded)
    return model.transform(df).select("vec_id", "label", "prediction",
                                      rnd("probability").alias("probability"))
