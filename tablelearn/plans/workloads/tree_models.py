"""G9 classification tree, G10 regression tree, B12 routing, G11/G12 boosting.

The oracles grow the same trees in SQL: candidate cutoffs are the distinct
values and the argmax is a window. G9, G10 and B12 are recursive SQL, a level a
step, until no split is left; the depth-2 trees of boosting are unrolled.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.tables import read_table
from ..boosting import GradientBoostingClassifier
from ..common import WIDE, rnd, sql_emb, sql_rnd, xs
from ..registry import query
from ..trees import DecisionTreeClassifier, DecisionTreeRegressor
from .aggregates import wide_features

DEPTH = 2
MIN_SPLIT = 2
MIN_IMPURITY = 1e-7


def _xlnx(c: str) -> str:
    return f"(CASE WHEN {c} > 0 THEN {c} * ln({c}) ELSE 0 END)"


def tree_sql(rows: str, feats: list[str], stats: list[str], gain, count_expr, depth: int = DEPTH,
             prefix: str = "") -> list[str]:
    """CTEs growing a tree over ``rows(rid, feats.., s0..)``; the last CTE is
    {prefix}nd{depth}(rid, node). ``prefix`` keeps several trees apart in one query."""
    m = len(stats)
    p = len(feats)
    s_sum = ", ".join(f"sum(s{j}) AS s{j}" for j in range(m))
    ctes = [f"{prefix}nd0 AS (SELECT rid, 1::BIGINT AS node FROM {rows})"]
    pick = "CASE b.f " + " ".join(f"WHEN {k} THEN r.{f}" for k, f in enumerate(feats)) + " END"
    for lv in range(depth):
        lo = 2 ** lv
        t = [f"t.t{j}" for j in range(m)]
        lcols = [f"lf.l{j}" for j in range(m)]
        r = [f"({a} - {b})" for a, b in zip(t, lcols)]
        ctes += [
            f"{prefix}lv{lv} AS (SELECT r.*, n.node FROM {rows} r JOIN {prefix}nd{lv} n USING (rid) WHERE n.node >= {lo})",
            f"{prefix}lg{lv} AS (SELECT node, unnest(range({p})) AS f, unnest([{', '.join(feats)}])::DOUBLE AS v, "
            f"{', '.join(f's{j}' for j in range(m))} FROM {prefix}lv{lv})",
            f"{prefix}st{lv} AS (SELECT node, f, v, {s_sum} FROM {prefix}lg{lv} GROUP BY node, f, v)",
            f"{prefix}tt{lv} AS (SELECT node, {', '.join(f'sum(s{j}) AS t{j}' for j in range(m))} FROM {prefix}lv{lv} GROUP BY node)",
            f"{prefix}el{lv} AS (SELECT node FROM {prefix}tt{lv} t WHERE {count_expr(t)} >= {MIN_SPLIT})",
            f"{prefix}lf{lv} AS (SELECT node, f, v, "
            f"{', '.join(f'sum(s{j}) OVER (PARTITION BY node, f ORDER BY v DESC) AS l{j}' for j in range(m))} "
            f"FROM {prefix}st{lv} WHERE node IN (SELECT node FROM {prefix}el{lv}))",
            f"{prefix}gn{lv} AS (SELECT lf.node, lf.f, lf.v, round({gain(t, lcols, r)}, 12) AS g "
            f"FROM {prefix}lf{lv} lf JOIN {prefix}tt{lv} t USING (node) WHERE {count_expr(r)} > 0.5)",
            f"{prefix}bs{lv} AS (SELECT node, f, v, g FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY node ORDER BY g DESC, f, v) AS rn FROM {prefix}gn{lv}) WHERE rn = 1 AND g > {MIN_IMPURITY})",
            f"{prefix}nd{lv + 1} AS (SELECT n.rid, CASE WHEN b.node IS NULL THEN n.node ELSE 2 * n.node + "
            f"CASE WHEN {pick} >= b.v THEN 0 ELSE 1 END END AS node "
            f"FROM {prefix}nd{lv} n JOIN {rows} r USING (rid) LEFT JOIN {prefix}bs{lv} b ON b.node = n.node)",
        ]
    return ctes


def _entropy_sql(k: int):
    def h(cs):
        n = " + ".join(cs)
        return f"(ln({n}) - ({' + '.join(_xlnx(c) for c in cs)}) / ({n}))", f"({n})"

    def gain(t, l, r):
        ht, nt = h(t)
        hl, nl = h(l)
        hr, nr = h(r)
        return f"{ht} - {nl} / {nt} * {hl} - {nr} / {nt} * {hr}"

    def count(cs):
        return "(" + " + ".join(cs) + ")"
    return gain, count


CLASS_ROWS = "cls AS (SELECT DISTINCT label FROM embeddings)"


def full_tree_sql(rows: str, feats: list[str], m: int, gain, count_expr, max_depth: int = 0) -> list[str]:
    """CTEs growing a tree (0: without a depth limit) over ``rows(rid, feats.., s0..)``: one step of
    the recursion is one level; rows of a node without an acceptable split drop out. The last
    CTE is leaves(rid, path), the path in the letters L (``>=``) and R."""
    s_sum = ", ".join(f"sum(r.s{j}) AS s{j}" for j in range(m))
    cum = ", ".join(f"sum(s{j}) OVER (PARTITION BY path, f ORDER BY v DESC) AS l{j}" for j in range(m))
    tot = ", ".join(f"sum(s{j}) OVER (PARTITION BY path, f) AS t{j}" for j in range(m))
    t, l = [f"t{j}" for j in range(m)], [f"l{j}" for j in range(m)]
    r = [f"({x} - {y})" for x, y in zip(t, l)]
    return [
        f"long AS (SELECT rid, unnest(range({len(feats)})) AS f, unnest([{', '.join(feats)}])::DOUBLE AS v FROM {rows})",
        f"""lvl AS (
        SELECT rid, ''::VARCHAR AS path FROM {rows}
        UNION ALL
        SELECT c.rid, c.path || CASE WHEN x.v >= b.v THEN 'L' ELSE 'R' END
        FROM lvl c JOIN (
            SELECT path, f, v FROM (
                SELECT path, f, v, g, row_number() OVER (PARTITION BY path ORDER BY g DESC, f, v) AS rn FROM (
                    SELECT path, f, v, round({gain(t, l, r)}, 12) AS g FROM (
                        SELECT path, f, v, {cum}, {tot} FROM (
                            SELECT k.path, x.f, x.v, {s_sum} FROM lvl k JOIN {rows} r USING (rid) JOIN long x USING (rid){f' WHERE length(k.path) < {max_depth}' if max_depth else ''}
                            GROUP BY k.path, x.f, x.v))
                    WHERE {count_expr(r)} > 0.5 AND {count_expr(t)} >= {MIN_SPLIT}))
            WHERE rn = 1 AND g > {MIN_IMPURITY}) b ON b.path = c.path
        JOIN long x ON x.rid = c.rid AND x.f = b.f)""",
        "leaves AS (SELECT rid, arg_max(path, length(path)) AS path FROM lvl GROUP BY rid)"]


def _classifier_sql(tail: str) -> str:
    k = 10
    feats = xs(WIDE)
    # class indicator statistics in label order; the class list is read from the table
    rows = (f"rows AS (SELECT vec_id AS rid, {', '.join(feats)}, label, "
            + ", ".join(f"(label = (SELECT label FROM (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i "
                        f"FROM cls) WHERE i = {j}))::DOUBLE AS s{j}" for j in range(k)) + " FROM emb)")
    gain, count = _entropy_sql(k)
    ctes = [sql_emb(WIDE), CLASS_ROWS, rows] + full_tree_sql("rows", feats, k, gain, count)
    ctes.append("""leaf AS (SELECT path, label AS value FROM (
        SELECT n.path, r.label, row_number() OVER (PARTITION BY n.path ORDER BY count(*) DESC, r.label) AS rn
        FROM leaves n JOIN rows r USING (rid) GROUP BY n.path, r.label) WHERE rn = 1)""")
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + tail


def _classifier(spark, sf_dir):
    df, feats = wide_features(spark, sf_dir)
    return df, DecisionTreeClassifier(min_samples_split=MIN_SPLIT, min_impurity=MIN_IMPURITY).fit(df, feats, "label")


@query("g9_decision_tree", _classifier_sql("""
    SELECT r.rid AS vec_id, r.label, l.value AS prediction FROM rows r JOIN leaves n USING (rid)
    JOIN leaf l USING (path)"""))
def g9_decision_tree(spark, sf_dir):
    """Whole vectors, grown until no split is left."""
    df, model = _classifier(spark, sf_dir)
    return model.transform(df).select("vec_id", "label", "prediction")


@query("b12_route_tree", _classifier_sql("""
    SELECT rid AS vec_id, path AS leaf FROM leaves"""))
def b12_route_tree(spark, sf_dir):
    """Every row's path through the tree of ``g9_decision_tree``."""
    df, model = _classifier(spark, sf_dir)
    return model.tree.route(df, path=True).select("vec_id", "leaf")


def _variance_sql():
    def gain(t, l, r):
        return (f"{l[0]} * {r[0]} / (({l[0]} + {r[0]}) * ({l[0]} + {r[0]})) * "
                f"({l[1]} / {l[0]} - {r[1]} / {r[0]}) * ({l[1]} / {l[0]} - {r[1]} / {r[0]})")

    def count(cs):
        return cs[0]
    return gain, count


#: Means of whole cents lie exactly between two roundings now and then; both engines step past.
HALF = 1e-8


def _regressor_sql(tail: str) -> str:
    feats = ["x1", "x2", "x3"]
    rows = ("rows AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rid, l_orderkey, "
            "l_linenumber, l_quantity AS x1, l_discount AS x2, l_tax AS x3, l_extendedprice AS y, 1.0::DOUBLE AS s0, "
            "l_extendedprice AS s1 FROM lineitem)")
    gain, count = _variance_sql()
    ctes = [rows] + full_tree_sql("rows", feats, 2, gain, count)
    ctes.append("leaf AS (SELECT n.path, avg(r.y) AS value FROM leaves n JOIN rows r USING (rid) GROUP BY n.path)")
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + tail


@query("g10_regression_tree", _regressor_sql(f"""
    SELECT r.l_orderkey, r.l_linenumber, {sql_rnd(f'l.value + {HALF}')} AS prediction
    FROM rows r JOIN leaves n USING (rid) JOIN leaf l USING (path)"""))
def g10_regression_tree(spark, sf_dir):
    """Quantity, discount and tax, grown until no split is left."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x1"), F.col("l_discount").alias("x2"),
        F.col("l_tax").alias("x3"), F.col("l_extendedprice").alias("y"))
    model = DecisionTreeRegressor(min_samples_split=MIN_SPLIT, min_impurity=MIN_IMPURITY).fit(li, ["x1", "x2", "x3"], "y")
    return model.transform(li).select("l_orderkey", "l_linenumber", rnd(F.col("prediction") + HALF).alias("prediction"))


#: Nodes beyond SEARCH_SMALL rows are searched by jobs, those with more values than SEARCH_RANGE by ranged prefix sums.
SEARCH_DEPTH, SEARCH_SMALL, SEARCH_RANGE = 3, 500, 1_000


def _search_sql() -> str:
    feats = ["x1", "x2"]
    rows = ("rows AS (SELECT o_orderkey AS rid, o_custkey::DOUBLE AS x1, epoch(o_orderdate) / 86400 AS x2, o_totalprice AS y, "
            "1.0::DOUBLE AS s0, o_totalprice AS s1 FROM orders)")
    gain, count = _variance_sql()
    ctes = [rows] + full_tree_sql("rows", feats, 2, gain, count, SEARCH_DEPTH)
    ctes.append("leaf AS (SELECT n.path, avg(r.y) AS value FROM leaves n JOIN rows r USING (rid) GROUP BY n.path)")
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"""
    SELECT n.rid AS o_orderkey, n.path AS leaf, {sql_rnd('l.value', 4)} AS prediction FROM leaves n JOIN leaf l USING (path)"""


@query("g10_ranged_split_search", _search_sql())
def g10_ranged_split_search(spark, sf_dir):
    """Total price by customer and day: features of many values, whose split search is one
    range-partitioned sort by (node, feature, value) a level."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("x1"),
        (F.unix_timestamp("o_orderdate") / 86400).alias("x2"), F.col("o_totalprice").alias("y"))
    model = DecisionTreeRegressor(max_depth=SEARCH_DEPTH, min_samples_split=MIN_SPLIT, min_impurity=MIN_IMPURITY,
                                  small_rows=SEARCH_SMALL, target_window_rows=SEARCH_RANGE).fit(orders, ["x1", "x2"], "y")
    routed = model.tree.route(orders.select("o_orderkey", "x1", "x2"), path=True)
    return model.transform(routed).select("o_orderkey", "leaf", rnd("prediction", 4).alias("prediction"))


# ------------------------------------------------------------------ G11 / G12
BOOST_LR = 0.1


def _newton_sql(k: int):
    def gain(t, l, r):
        terms = [f"{l[j]} * {l[j]} / {l[k + j]} + {r[j]} * {r[j]} / {r[k + j]} - {t[j]} * {t[j]} / {t[k + j]}"
                 for j in range(k)]
        return "0.5 * (" + " + ".join(terms) + ")"

    def count(cs):
        return cs[2 * k]
    return gain, count


def _boost_sql(tail: str) -> str:
    k = 10
    feats = xs(WIDE)
    ranked = "(SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM cls)"
    ind = [f"(label = (SELECT label FROM {ranked} WHERE i = {j}))::DOUBLE" for j in range(k)]
    # z = 0 -> p = 1/K for every class: G = 1/K - y, H = (1/K)(1 - 1/K)
    stats = ([f"{1.0 / k} - {ind[j]} AS s{j}" for j in range(k)]
             + [f"{(1.0 / k) * (1.0 - 1.0 / k)} AS s{k + j}" for j in range(k)] + [f"1.0::DOUBLE AS s{2 * k}"])
    rows = f"rows AS (SELECT vec_id AS rid, {', '.join(feats)}, label, {', '.join(stats)} FROM emb)"
    gain, count = _newton_sql(k)
    ctes = [sql_emb(WIDE), CLASS_ROWS, rows] + tree_sql("rows", feats, [f"s{j}" for j in range(2 * k + 1)],
                                                     gain, count)
    zs = ", ".join(f"-{BOOST_LR} * sum(r.s{j}) / sum(r.s{k + j}) AS z{j}" for j in range(k))
    ctes.append(f"leaf AS (SELECT n.node, {zs} FROM nd{DEPTH} n JOIN rows r USING (rid) GROUP BY n.node)")
    ctes.append("zl AS (SELECT n.rid, l.node, unnest(range(" + str(k) + ")) AS j, unnest(["
                + ", ".join(f"l.z{j}" for j in range(k)) + "]) AS z FROM nd" + str(DEPTH)
                + " n JOIN leaf l USING (node))")
    return "WITH " + ",\n".join(ctes) + "\n" + tail.format(ranked=ranked)


@query("g12_boosting_one_round", _boost_sql("""
    SELECT zl.rid AS vec_id, c.label AS prediction FROM (
      SELECT *, row_number() OVER (PARTITION BY rid ORDER BY round(z, 10) DESC, j) AS rn FROM zl) zl
    JOIN {ranked} c ON c.i = zl.j WHERE zl.rn = 1"""))
def g12_boosting_one_round(spark, sf_dir):
    df, feats = wide_features(spark, sf_dir)
    model = GradientBoostingClassifier(n_estimators=1, learning_rate=BOOST_LR, max_depth=DEPTH).fit(
        df, feats, "label")
    return model.transform(df).select("vec_id", "prediction")


@query("g11_boosted_tree_leaves", _boost_sql("""
    SELECT node AS leaf, j::BIGINT AS output, round(z, 8) + 0.0 AS value
    FROM (SELECT DISTINCT node, j, z FROM zl)"""))
def g11_boosted_tree_leaves(spark, sf_dir):
    """The single Newton tree of round one: per leaf, the -lr·G/H vector."""
    df, feats = wide_features(spark, sf_dir)
    model = GradientBoostingClassifier(n_estimators=1, learning_rate=BOOST_LR, max_depth=DEPTH).fit(
        df, feats, "label")
    tree = model.trees[0]
    rows = [(i, j, float(-BOOST_LR * v)) for i, nd in tree.nodes.items() if "value" in nd
            for j, v in enumerate(nd["value"])]
    used = {r["leaf"] for r in df.select(tree.leaf_id_col().alias("leaf")).distinct().collect()}
    out = spark.createDataFrame([r for r in rows if r[0] in used], "leaf bigint, output bigint, value double")
    return out.select("leaf", "output", rnd("value", 8).alias("value"))


BOOST_ROUNDS = 20


def _boost_rounds_sql(rounds: int = BOOST_ROUNDS) -> str:
    """All rounds unrolled: softmax of the logits, gradient / hessian
    statistics, a depth-2 Newton tree (the same generator as above, one CTE
    prefix per round) and the logit update; prediction = argmax of the rounded
    logits, lowest class on ties."""
    k = 10
    feats = xs(WIDE)
    ranked = "(SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM cls)"
    ind = [f"(label = (SELECT label FROM {ranked} WHERE i = {j}))::DOUBLE" for j in range(k)]
    zs = [f"z{j}" for j in range(k)]
    gain, count = _newton_sql(k)
    ctes = [sql_emb(WIDE), CLASS_ROWS,
            f"zr0 AS (SELECT vec_id AS rid, {', '.join(feats)}, label, {', '.join(f'0.0::DOUBLE AS {z}' for z in zs)} FROM emb)"]
    for r in range(rounds):
        mx = f"greatest({', '.join(zs)})"
        ctes.append(f"ls{r} AS (SELECT *, {mx} + ln({' + '.join(f'exp({z} - {mx})' for z in zs)}) AS lse FROM zr{r})")
        ps = [f"exp(z{j} - lse)" for j in range(k)]
        stats = ([f"{ps[j]} - {ind[j]} AS s{j}" for j in range(k)]
                 + [f"{ps[j]} * (1 - {ps[j]}) AS s{k + j}" for j in range(k)] + [f"1.0::DOUBLE AS s{2 * k}"])
        ctes.append(f"rw{r} AS (SELECT rid, {', '.join(feats)}, label, {', '.join(stats)} FROM ls{r})")
        ctes += tree_sql(f"rw{r}", feats, [f"s{j}" for j in range(2 * k + 1)], gain, count, prefix=f"r{r}_")
        leaf = ", ".join(f"sum(w.s{j}) / sum(w.s{k + j}) AS g{j}" for j in range(k))
        ctes.append(f"lv{r} AS (SELECT n.node, {leaf} FROM r{r}_nd{DEPTH} n JOIN rw{r} w USING (rid) GROUP BY n.node)")
        upd = ", ".join(f"z.z{j} - {BOOST_LR} * l.g{j} AS z{j}" for j in range(k))
        ctes.append(f"zr{r + 1} AS (SELECT z.rid, {', '.join('z.' + f for f in feats)}, z.label, {upd} FROM zr{r} z "
                    f"JOIN r{r}_nd{DEPTH} n USING (rid) JOIN lv{r} l USING (node))")
    last = f"zr{rounds}"
    ctes.append(f"zl AS (SELECT rid, label, unnest(range({k})) AS j, unnest([{', '.join(zs)}]) AS z FROM {last})")
    return "WITH " + ",\n".join(ctes) + f"""
    SELECT zl.rid AS vec_id, zl.label, c.label AS prediction FROM (
      SELECT *, row_number() OVER (PARTITION BY rid ORDER BY round(z, 10) DESC, j) AS rn FROM zl) zl
    JOIN {ranked} c ON c.i = zl.j WHERE zl.rn = 1"""


@query("g12_boosting", _boost_rounds_sql())
def g12_boosting(spark, sf_dir):
    """20 rounds on whole vectors, every round a depth-2 Newton tree."""
    df, feats = wide_features(spark, sf_dir)
    model = GradientBoostingClassifier(n_estimators=BOOST_ROUNDS, learning_rate=BOOST_LR, max_depth=DEPTH).fit(
        df, feats, "label")
    return model.transform(df).select("vec_id", "label", "prediction")
