"""A2-A4 sources/sampling, B1-B3/B5-B7/B9 transforms, C1 bisection, E3-E6 impurity."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...functions.activations import sigmoid, sigmoid_gradient
from ...operators import features, impurity, sampling, split
from ...sources.tables import embedding_view, read_table, standardize
from ...sources.validate import validate_array_features
from ..common import WIDE, rnd, sql_emb, sql_rnd, xs
from ..registry import query

SEED = 42


@query("a1_feature_view", f"""
    WITH {sql_emb(WIDE)}
    SELECT vec_id, label, {', '.join(f"{sql_rnd(x, 8)} AS {x}" for x in xs(WIDE))} FROM emb""")
def a1_feature_view(spark, sf_dir):
    """A1: read the table and assemble DOUBLE feature columns (pruned scan)."""
    df = embedding_view(spark, sf_dir, WIDE)
    return df.select("vec_id", "label", *[rnd(x, 8).alias(x) for x in xs(WIDE)])


@query("c2_class_rows", f"""
    WITH {sql_emb(WIDE)}
    SELECT label, count(*) AS n, {', '.join(f"{sql_rnd(f'sum({x})')} AS sum_{x}" for x in xs(WIDE))}
    FROM emb GROUP BY label""")
def c2_class_rows(spark, sf_dir):
    """The rows of each class, as one grouped pass (never K filters)."""
    df = embedding_view(spark, sf_dir, WIDE)
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                   *[rnd(F.sum(x)).alias(f"sum_{x}") for x in xs(WIDE)])


@query("a2_validate", """
    SELECT count(*) AS n_rows, count_if(embedding IS NULL)::BIGINT AS n_null_vectors,
           coalesce(sum(len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x)))), 0)::BIGINT
             AS n_bad_values,
           min(len(embedding))::BIGINT AS min_width, max(len(embedding))::BIGINT AS max_width,
           count_if(label IS NULL)::BIGINT AS n_null_labels
    FROM embeddings""")
def a2_validate(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    return validate_array_features(emb, "embedding", "label")


@query("a3_aligned_shuffle", f"""
    SELECT c_custkey, c_nationkey,
           (row_number() OVER (ORDER BY md5(c_custkey::VARCHAR || '#{SEED}'), c_custkey) - 1)::BIGINT
             AS position
    FROM customer""")
def a3_aligned_shuffle(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return sampling.aligned_shuffle(cust, "c_custkey", SEED)


@query("a4_sample_k", f"""
    SELECT vec_id, label FROM embeddings
    ORDER BY md5(vec_id::VARCHAR || '#{SEED}'), vec_id LIMIT 5""")
def a4_sample_k(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return sampling.sample_k(emb, "vec_id", 5, SEED)


@query("b1_add_intercept", """
    SELECT l_orderkey, l_linenumber, 1.0::DOUBLE AS x0, l_quantity AS x1, l_discount AS x2
    FROM lineitem""")
def b1_add_intercept(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    cols = features.add_intercept([F.col("l_quantity").alias("x1"), F.col("l_discount").alias("x2")])
    return li.select("l_orderkey", "l_linenumber", *cols)


@query("b2_one_hot", """
    WITH coded AS (
      SELECT l_orderkey, l_linenumber,
             (dense_rank() OVER (ORDER BY l_returnflag) - 1)::BIGINT AS code FROM lineitem)
    SELECT l_orderkey, l_linenumber, code, (code = 0)::INTEGER AS oh_0,
           (code = 1)::INTEGER AS oh_1, (code = 2)::INTEGER AS oh_2 FROM coded""")
def b2_one_hot(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    coded = features.dictionary_encode(li, "l_returnflag", "code")
    coded = coded.select("l_orderkey", "l_linenumber", F.col("code").cast("bigint").alias("code"))
    return features.one_hot(coded, "code")


@query("b3_polynomial", f"""
    SELECT p_partkey, 1.0::DOUBLE AS f0, p_size::DOUBLE AS f1, {sql_rnd('p_retailprice')} AS f2,
           (p_size * p_size)::DOUBLE AS f3, {sql_rnd('p_size * p_retailprice')} AS f4,
           {sql_rnd('p_retailprice * p_retailprice')} AS f5
    FROM part""")
def b3_polynomial(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    cols = features.polynomial_features(
        [F.col("p_size").cast("double"), F.col("p_retailprice")], degree=2)
    out = part.select("p_partkey", *cols)
    return out.select("p_partkey", *[rnd(f"f{i}").alias(f"f{i}") for i in range(6)])


@query("b5_sigmoid", f"""
    WITH st AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders),
    z AS (SELECT o_orderkey, (o_totalprice - m) / s AS z FROM orders, st)
    SELECT o_orderkey, {sql_rnd('1 / (1 + exp(-z))')} AS p,
           {sql_rnd('(1 / (1 + exp(-z))) * (1 - 1 / (1 + exp(-z)))')} AS dp FROM z""")
def b5_sigmoid(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    z = standardize(orders, ["o_totalprice"], "_z")
    return z.select("o_orderkey", rnd(sigmoid(F.col("o_totalprice_z"))).alias("p"),
                    rnd(sigmoid_gradient(F.col("o_totalprice_z"))).alias("dp"))


@query("b6_softmax", f"""
    WITH t AS (SELECT c_nationkey, c_mktsegment, sum(c_acctbal) AS t FROM customer
               GROUP BY c_nationkey, c_mktsegment),
    s AS (SELECT *, (t - avg(t) OVER ()) / stddev_pop(t) OVER () AS s FROM t),
    m AS (SELECT *, max(s) OVER (PARTITION BY c_nationkey) AS mx FROM s),
    l AS (SELECT *, s - mx - ln(sum(exp(s - mx)) OVER (PARTITION BY c_nationkey)) AS lp FROM m)
    SELECT c_nationkey, c_mktsegment, {sql_rnd('lp')} AS log_prob, {sql_rnd('exp(lp)')} AS prob FROM l""")
def b6_softmax(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer")
    totals = cust.groupBy("c_nationkey", "c_mktsegment").agg(F.sum("c_acctbal").alias("t"))
    scored = standardize(totals, ["t"], "_s")
    w = Window.partitionBy("c_nationkey")
    mx = F.max("t_s").over(w)
    lp = F.col("t_s") - F.col("_mx") - F.log(F.sum(F.exp(F.col("t_s") - F.col("_mx"))).over(w))
    out = scored.withColumn("_mx", mx).withColumn("lp", lp)
    return out.select("c_nationkey", "c_mktsegment", rnd("lp").alias("log_prob"),
                      rnd(F.exp("lp")).alias("prob"))


@query("b7_argmax", """
    SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS argmax
    FROM embeddings""")
def b7_argmax(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    e = F.col("embedding")
    return emb.select("vec_id", (F.array_position(e, F.array_max(e)) - 1).cast("bigint").alias("argmax"))


@query("b9_one_vs_rest", """
    WITH cls AS (SELECT DISTINCT label AS ovr_class FROM embeddings)
    SELECT e.vec_id, c.ovr_class, CASE WHEN e.label = c.ovr_class THEN 1 ELSE -1 END AS y_ovr
    FROM embeddings e CROSS JOIN cls c""")
def b9_one_vs_rest(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    classes = features.dictionary(emb, "label")
    return features.one_vs_rest(emb, "label", classes).select("vec_id", "ovr_class", "y_ovr")


@query("c1_bisect_numeric", """
    SELECT l_orderkey, l_linenumber, coalesce(l_quantity >= 25, false) AS is_left FROM lineitem""")
def c1_bisect_numeric(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     split.bisect_mask(li, "l_quantity", 25).alias("is_left"))


@query("c1_bisect_string", """
    SELECT side, count(*) AS n, round(sum(l_quantity), 2) + 0.0 AS quantity FROM (
      SELECT coalesce(l_returnflag = 'R', false) AS side, l_quantity FROM lineitem)
    GROUP BY side""")
def c1_bisect_string(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    left, right = split.bisect(li, "l_returnflag", "R")

    def summary(d, side):
        return d.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n"),
                     rnd(F.sum("l_quantity"), 2).alias("quantity"))
    return summary(left, True).unionByName(summary(right, False))


def _entropy_sql(groupby: str) -> str:
    return f"""
    WITH c AS (SELECT {groupby}, l_returnflag, count(*) AS c FROM lineitem GROUP BY {groupby}, l_returnflag),
    p AS (SELECT *, c / sum(c) OVER (PARTITION BY {groupby}) AS p, sum(c) OVER (PARTITION BY {groupby}) AS n FROM c)
    SELECT {groupby}, any_value(n)::BIGINT AS n, {sql_rnd('-sum(p * ln(p))')} AS entropy FROM p GROUP BY {groupby}"""


@query("e3_entropy", _entropy_sql("l_linestatus"))
def e3_entropy(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    e = impurity.entropy(li, "l_returnflag", by=["l_linestatus"])
    return e.select("l_linestatus", "n", rnd("entropy").alias("entropy"))


@query("e4_information_gain", f"""
    WITH s AS (SELECT l_returnflag AS y, coalesce(l_quantity >= 25, false) AS side FROM lineitem),
    h AS (SELECT side, count(*) AS n, -sum(c / n0 * ln(c / n0)) AS h FROM (
            SELECT side, y, count(*) AS c, sum(count(*)) OVER (PARTITION BY side) AS n0
            FROM s GROUP BY side, y) GROUP BY side),
    hs AS (SELECT side, sum(c) AS n, -sum(c / n0 * ln(c / n0)) AS h FROM (
            SELECT side, y, count(*) AS c, sum(count(*)) OVER (PARTITION BY side) AS n0
            FROM s GROUP BY side, y) GROUP BY side),
    ht AS (SELECT -sum(c / n0 * ln(c / n0)) AS h, any_value(n0) AS n FROM (
            SELECT y, count(*) AS c, sum(count(*)) OVER () AS n0 FROM s GROUP BY y))
    SELECT {sql_rnd('ht.h - sum(hs.n / ht.n * hs.h)')} AS information_gain
    FROM hs CROSS JOIN ht GROUP BY ht.h""")
def e4_information_gain(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    g = impurity.information_gain(li, "l_returnflag", split.bisect_mask(li, "l_quantity", 25))
    return g.select(rnd("information_gain").alias("information_gain"))


@query("e5_variance_reduction", f"""
    WITH s AS (SELECT l_extendedprice AS y1, l_tax AS y2, coalesce(l_quantity >= 25, false) AS side
               FROM lineitem),
    t AS (SELECT count(*) AS n, var_pop(y1) AS v1, var_pop(y2) AS v2 FROM s),
    ps AS (SELECT side, count(*) AS n, var_pop(y1) AS v1, var_pop(y2) AS v2 FROM s GROUP BY side)
    SELECT {sql_rnd('(t.v1 + t.v2) - sum(ps.n / t.n * (ps.v1 + ps.v2))', 3)} AS variance_reduction
    FROM ps CROSS JOIN t GROUP BY t.v1, t.v2""")
def e5_variance_reduction(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    v = impurity.variance_reduction(li, ["l_extendedprice", "l_tax"],
                                    split.bisect_mask(li, "l_quantity", 25))
    return v.select(rnd("variance_reduction", 3).alias("variance_reduction"))


@query("e6_majority_class", """
    WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS c FROM customer
               GROUP BY c_nationkey, c_mktsegment),
    r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c DESC, c_mktsegment) AS rn
          FROM c)
    SELECT c_nationkey, c_mktsegment AS majority, c AS count FROM r WHERE rn = 1""")
def e6_majority_class(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer")
    return impurity.majority_class(cust, "c_mktsegment", by=["c_nationkey"])
