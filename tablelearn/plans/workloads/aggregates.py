"""Moments, covariance and per-class statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import moments
from ...sources.tables import embedding_view, read_table
from ..common import WIDE, rnd, sql_emb, sql_rnd, xs
from ..registry import query

EMB_LONG_SQL = """ev AS (SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS i,
                              unnest(embedding)::DOUBLE AS x FROM embeddings)"""


def wide_features(spark, sf_dir):
    """All 64 embedding dims as DOUBLE columns (exercises the Arrow Gram path)."""
    return embedding_view(spark, sf_dir, WIDE), xs(WIDE)


@query("e1_gram", f"""
    WITH {EMB_LONG_SQL}
    SELECT a.i::BIGINT AS i, b.i::BIGINT AS j, {sql_rnd('sum(a.x * b.x)')} AS value
    FROM ev a JOIN ev b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def e1_gram(spark, sf_dir):
    df, cols = wide_features(spark, sf_dir)
    g = moments.gram_table(df, cols)
    return g.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                    rnd("value").alias("value"))


@query("e1_gram_by_class", f"""
    WITH {EMB_LONG_SQL}
    SELECT a.label, a.i::BIGINT AS i, b.i::BIGINT AS j, {sql_rnd('sum(a.x * b.x)')} AS value
    FROM ev a JOIN ev b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.label, a.i, b.i""")
def e1_gram_by_class(spark, sf_dir):
    df, cols = wide_features(spark, sf_dir)
    g = moments.gram_table(df, cols, by="label")
    return g.select("label", F.col("i").cast("bigint").alias("i"),
                    F.col("j").cast("bigint").alias("j"), rnd("value").alias("value"))


LI_COLS = ["l_quantity", "l_discount", "l_tax"]


@query("e2_covariance", f"""
    WITH li AS (SELECT l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem),
    c AS (SELECT {', '.join(f'covar_samp(x{i}, x{j}) AS c{i}{j}' for i in range(3) for j in range(i, 3))} FROM li)
    {' UNION ALL '.join(f'SELECT {i}::BIGINT AS i, {j}::BIGINT AS j, {sql_rnd(f"c{i}{j}")} AS value FROM c'
                        for i in range(3) for j in range(i, 3))}""")
def e2_covariance(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    c = moments.covariance_table(li, LI_COLS)
    return c.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                    rnd("value").alias("value"))


@query("e2_covariance_wide", f"""
    WITH {EMB_LONG_SQL}
    SELECT a.i::BIGINT AS i, b.i::BIGINT AS j, {sql_rnd('covar_samp(a.x, b.x)', 8)} AS value
    FROM ev a JOIN ev b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def e2_covariance_wide(spark, sf_dir):
    df, cols = wide_features(spark, sf_dir)
    c = moments.covariance_table(df, cols)
    return c.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                    rnd("value", 8).alias("value"))


@query("e7_class_priors", f"""
    SELECT label, count(*) AS n, {sql_rnd('count(*) / sum(count(*)) OVER ()')} AS prior
    FROM embeddings GROUP BY label""")
def e7_class_priors(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    pr = moments.class_priors(emb, "label")
    return pr.select("label", "n", rnd("prior").alias("prior"))


@query("e8_gaussian_params", f"""
    WITH {EMB_LONG_SQL}
    SELECT label, i::BIGINT AS i, {sql_rnd('avg(x)')} AS theta,
           {sql_rnd('var_pop(x) + 1e-9', 9)} AS var
    FROM ev GROUP BY label, i""")
def e8_gaussian_params(spark, sf_dir):
    df, cols = wide_features(spark, sf_dir)
    s = moments.class_gaussian_params(df, cols, "label")
    rows = [F.struct(F.lit(i).cast("bigint").alias("i"), rnd(f"theta_{i}").alias("theta"),
                     rnd(f"var_{i}", 9).alias("var")) for i in range(WIDE)]
    return s.select("label", F.inline(F.array(*rows)))


@query("e9_class_means", f"""
    WITH {sql_emb(WIDE)}
    SELECT label, count(*) AS n, {', '.join(f"{sql_rnd(f'avg(x{i + 1})')} AS mean_{i}" for i in range(WIDE))}
    FROM emb GROUP BY label""")
def e9_class_means(spark, sf_dir):
    df, cols = wide_features(spark, sf_dir)
    m = moments.class_means(df, cols, "label")
    return m.select("label", "n", *[rnd(f"mean_{i}").alias(f"mean_{i}") for i in range(WIDE)])


@query("e10_pooled_covariance", f"""
    WITH {EMB_LONG_SQL},
    pri AS (SELECT label, count(*) / sum(count(*)) OVER () AS prior FROM embeddings GROUP BY label),
    per AS (SELECT a.label, a.i, b.i AS j, covar_samp(a.x, b.x) AS c
            FROM ev a JOIN ev b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.label, a.i, b.i)
    SELECT i::BIGINT AS i, j::BIGINT AS j, {sql_rnd('sum(prior * c)', 8)} AS value
    FROM per JOIN pri USING (label) GROUP BY i, j""")
def e10_pooled_covariance(spark, sf_dir):
    df, cols = wide_features(spark, sf_dir)
    c = moments.pooled_covariance_table(df, cols, "label")
    return c.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                    rnd("value", 8).alias("value"))
