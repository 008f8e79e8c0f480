"""G1-G4 regression family, F1/F5/F6 metrics, G7 logistic regression with F2,
G18 PCA with B8/B10/B11/E15."""

from __future__ import annotations


import numpy as np
from pyspark.sql import functions as F

from ...functions.linalg import total
from ...operators import metrics
from ...operators.moments import covariance_matrix
from ...sources.tables import LANGS, document_xy, embedding_view, lineitem_xy
from ..common import WIDE, rnd, sql_emb, sql_rnd, xs
from ..decompose import PCA
from ..linear import ElasticNet, Lasso, LinearRegression, LogisticRegression, Ridge
from ..registry import query
from .aggregates import EMB_LONG_SQL

# Standardised lineitem view: y = extendedprice ~ x1 = quantity, x2 = discount, x3 = tax.
LI_FEATURES = ["x1", "x2", "x3"]
_K = range(1, 4)
_PAIRS = [(i, j) for i in _K for j in _K if i <= j]
LI_SQL = f"""
    raw AS (SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_discount AS x2, l_tax AS x3,
                   l_extendedprice AS y FROM lineitem),
    st AS (SELECT {', '.join(f'avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}' for i in _K)},
                  avg(y) AS my, stddev_pop(y) AS sy FROM raw),
    z AS (SELECT l_orderkey, l_linenumber, {', '.join(f'(x{i} - m{i}) / s{i} AS x{i}' for i in _K)},
                 (y - my) / sy AS y FROM raw, st),
    mom AS (SELECT avg(y) AS ay, {', '.join(f'avg(x{i}) AS a{i}, avg(x{i} * y) AS v{i}, covar_pop(x{i}, y) AS c{i}y' for i in _K)},
                   {', '.join(f'avg(x{i} * x{j}) AS g{i}{j}, covar_pop(x{i}, x{j}) AS c{i}{j}' for i, j in _PAIRS)} FROM z)"""


def li_z(spark, sf_dir):
    df = lineitem_xy(spark, sf_dir, standardized=True)
    return df.select("l_orderkey", "l_linenumber", *LI_FEATURES, "y")


def coef_frame(spark, coef):
    return spark.createDataFrame([(k, float(v)) for k, v in enumerate(coef)],
                                 "term bigint, coef double").select("term", rnd("coef").alias("coef"))


def _terms_sql(names: list[str], table: str) -> str:
    return " UNION ALL ".join(f"SELECT {k}::BIGINT AS term, {sql_rnd(n)} AS coef FROM {table}"
                              for k, n in enumerate(names))


def _closed_form_ctes(alpha: float) -> str:
    """Normal equations of three centred features by Cramer's rule."""
    def det(col: int) -> str:
        a = {(i, j): f"c{i}{j}" for i, j in _PAIRS}
        m = [[f"({a[min(i, j), max(i, j)]}{f' + {alpha}' if i == j else ''})" if j != col else f"c{i}y"
              for j in _K] for i in _K]
        return " + ".join(f"{m[0][k]} * ({m[1][(k + 1) % 3]} * {m[2][(k + 2) % 3]}"
                          f" - {m[1][(k + 2) % 3]} * {m[2][(k + 1) % 3]})" for k in range(3))

    return f"""
    WITH {LI_SQL},
    sol AS (SELECT {', '.join(f'({det(i)}) / ({det(0)}) AS w{i}' for i in _K)}, a1, a2, a3, ay FROM mom),
    coef AS (SELECT ay - a1 * w1 - a2 * w2 - a3 * w3 AS w0, w1, w2, w3 FROM sol)"""


def _closed_form_sql(alpha: float) -> str:
    return f"{_closed_form_ctes(alpha)} {_terms_sql(['w0', 'w1', 'w2', 'w3'], 'coef')}"


@query("g1_ols", _closed_form_sql(0.0))
def g1_ols(spark, sf_dir):
    model = LinearRegression().fit(li_z(spark, sf_dir), LI_FEATURES, "y")
    return coef_frame(spark, model.coef_)


@query("g2_ridge", _closed_form_sql(0.1))
def g2_ridge(spark, sf_dir):
    model = Ridge(alpha=0.1).fit(li_z(spark, sf_dir), LI_FEATURES, "y")
    return coef_frame(spark, model.coef_)


ALPHAS = (0.1, 0.01, 0.002, 0.0005)
EN_RATIO = 3.0


def _cd_ctes(l2: float, l1: float) -> str:
    """Cyclic coordinate descent with soft thresholding on the centred moments, one sweep a step
    of the recursion, until a sweep changes nothing: paths(alpha, w0, w1, w2, w3)."""
    def c(i: int, j: int) -> str:
        return f"c{min(i, j)}{max(i, j)}"

    def update(i: int, now: dict) -> str:
        rest = " ".join(f"- {c(i, j)} * ({now[j]})" for j in _K if j != i)
        corr = f"(c{i}y {rest})"
        return (f"sign({corr}) * greatest(abs({corr}) - alpha * {l1}, 0) / ({c(i, i)} + alpha * {l2})")

    return f"""
    WITH RECURSIVE {LI_SQL},
    cd AS (
        SELECT unnest([{', '.join(map(str, ALPHAS))}])::DOUBLE AS alpha, 0 AS step, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2,
               0.0::DOUBLE AS w3, 1.0::DOUBLE AS moved
        UNION ALL
        SELECT alpha, step + 1, n1, n2, n3, abs(n1 - w1) + abs(n2 - w2) + abs(n3 - w3) FROM (
            SELECT *, {update(3, {1: 'n1', 2: 'n2'})} AS n3 FROM (
                SELECT *, {update(2, {1: 'n1', 3: 'w3'})} AS n2 FROM (
                    SELECT *, {update(1, {2: 'w2', 3: 'w3'})} AS n1 FROM cd CROSS JOIN mom WHERE moved > 1e-15 AND step < 1000))))
    ,
    paths AS (SELECT alpha, ay - a1 * w1 - a2 * w2 - a3 * w3 AS w0, w1, w2, w3 FROM (
        SELECT *, row_number() OVER (PARTITION BY alpha ORDER BY step DESC) AS rn FROM cd) CROSS JOIN mom WHERE rn = 1)"""


def _path_sql(l2: float, l1: float) -> str:
    return _cd_ctes(l2, l1) + " UNION ALL ".join(
        f" SELECT alpha, {k}::BIGINT AS term, {sql_rnd(f'w{k}')} AS coef, {'false' if k == 0 else f'w{k} = 0'} AS zero FROM paths"
        for k in range(4))


def _path_frame(spark, sf_dir, model):
    """Coefficients along ALPHAS, all from one pass over the table."""
    model = model.fit(li_z(spark, sf_dir), LI_FEATURES, "y")
    rows = [(a, k, float(c), bool(k and c == 0)) for a in ALPHAS for k, c in enumerate(model.refit(a).coef_)]
    return spark.createDataFrame(rows, "alpha double, term bigint, coef double, zero boolean").select(
        "alpha", "term", rnd("coef").alias("coef"), "zero")


@query("g3_lasso", _path_sql(0.0, 1.0))
def g3_lasso(spark, sf_dir):
    return _path_frame(spark, sf_dir, Lasso(alpha=ALPHAS[0]))


@query("g4_elastic_net", _path_sql(0.75, 0.25))
def g4_elastic_net(spark, sf_dir):
    return _path_frame(spark, sf_dir, ElasticNet(alpha=ALPHAS[0], ratio=EN_RATIO))


@query("g2_ridge_gd", _closed_form_sql(0.1))
def g2_ridge_gd(spark, sf_dir):
    """Gradient descent to its fixed point, the closed form's solution."""
    model = Ridge(alpha=0.1, closed_form=False, learning_rate=0.5, tol=1e-13).fit(li_z(spark, sf_dir), LI_FEATURES, "y")
    return coef_frame(spark, model.coef_)


NORM_ALPHA = 0.001


def _norm_sql() -> str:
    """w = (C + alpha/|w|)^-1 c by fixed-point steps on the norm, Cramer's rule a step."""
    def det(col: int) -> str:
        m = [[f"(c{min(i, j)}{max(i, j)}{' + shift' if i == j else ''})" if j != col else f"c{i}y" for j in _K] for i in _K]
        return " + ".join(f"{m[0][k]} * ({m[1][(k + 1) % 3]} * {m[2][(k + 2) % 3]}"
                          f" - {m[1][(k + 2) % 3]} * {m[2][(k + 1) % 3]})" for k in range(3))

    return f"""
    WITH RECURSIVE {LI_SQL},
    fp AS (
        SELECT 0 AS step, sqrt(c1y * c1y + c2y * c2y + c3y * c3y) AS t, 1.0::DOUBLE AS moved FROM mom
        UNION ALL
        SELECT step + 1, new, abs(new - t) FROM (
            SELECT step, t, sqrt(w1 * w1 + w2 * w2 + w3 * w3) AS new FROM (
                SELECT step, t, {', '.join(f'({det(i)}) / ({det(0)}) AS w{i}' for i in _K)} FROM (
                    SELECT *, {NORM_ALPHA} / t AS shift FROM fp CROSS JOIN mom WHERE moved > 1e-16 AND t > 1e-300 AND step < 5000)))),
    sol AS (SELECT {', '.join(f'CASE WHEN big THEN ({det(i)}) / ({det(0)}) ELSE 0 END AS w{i}' for i in _K)}, a1, a2, a3, ay FROM (
        SELECT mom.*, {NORM_ALPHA} / greatest(t, 1e-300) AS shift, sqrt(c1y * c1y + c2y * c2y + c3y * c3y) > {NORM_ALPHA} AS big
        FROM (SELECT t FROM fp ORDER BY step DESC LIMIT 1) CROSS JOIN mom)),
    coef AS (SELECT ay - a1 * w1 - a2 * w2 - a3 * w3 AS w0, w1, w2, w3 FROM sol)
    {_terms_sql(['w0', 'w1', 'w2', 'w3'], 'coef')}"""


@query("g2_ridge_norm", _norm_sql())
def g2_ridge_norm(spark, sf_dir):
    """The unsquared norm as penalty."""
    model = Ridge(alpha=NORM_ALPHA, squared=False).fit(li_z(spark, sf_dir), LI_FEATURES, "y")
    return coef_frame(spark, model.coef_)


@query("b4_linear_score", _closed_form_ctes(0.0) + f"""
    SELECT z.l_orderkey, z.l_linenumber, {sql_rnd('c.w0 + c.w1 * z.x1 + c.w2 * z.x2 + c.w3 * z.x3')} AS prediction
    FROM z CROSS JOIN coef c""")
def b4_linear_score(spark, sf_dir):
    df = li_z(spark, sf_dir)
    model = LinearRegression().fit(df, LI_FEATURES, "y")
    return df.select("l_orderkey", "l_linenumber", rnd(model.predict_col()).alias("prediction"))


def _fitted_metrics_sql() -> str:
    base = _closed_form_ctes(0.0)
    return f"""{base},
    res AS (SELECT z.y, c.w0 + c.w1 * z.x1 + c.w2 * z.x2 + c.w3 * z.x3 AS yhat FROM z CROSS JOIN coef c)
    SELECT {sql_rnd('avg((y - yhat) ^ 2)')} AS mse,
           {sql_rnd('1 - sum((y - yhat) ^ 2) / sum((y - (SELECT avg(y) FROM z)) ^ 2)')} AS r2
    FROM res"""


@query("f1_f5_regression_metrics", _fitted_metrics_sql())
def f1_f5_regression_metrics(spark, sf_dir):
    df = li_z(spark, sf_dir)
    model = LinearRegression().fit(df, LI_FEATURES, "y")
    scored = df.select("y", model.predict_col().alias("yhat"))
    m = metrics.regression_metrics(scored, "y", "yhat")
    return m.select(rnd("mse").alias("mse"), rnd("r2").alias("r2"))


OBJECTIVE_ALPHA = 0.002
#: l1, half squared l2, unsquared l2 parts of each penalty
PENALTIES = {"l1": (0.1, 0.0, 0.0), "l2": (0.0, 0.0, 0.1), "l2_squared": (0.0, 0.1, 0.0), "elastic_net": (0.025, 0.075, 0.0)}


def _objective_sql() -> str:
    value = {k: f"{l1} * (abs(w1) + abs(w2) + abs(w3)) + {l2} * 0.5 * (w1 * w1 + w2 * w2 + w3 * w3)"
                f" + {norm} * sqrt(w1 * w1 + w2 * w2 + w3 * w3)" for k, (l1, l2, norm) in PENALTIES.items()}
    rows = " UNION ALL ".join(
        f"SELECT '{k}' AS penalty_kind, {sql_rnd('r.mse')} AS mse, {sql_rnd(v, 9)} AS penalty, {sql_rnd(f'0.5 * r.mse + {v}')} AS objective"
        f" FROM res r CROSS JOIN lasso" for k, v in value.items())
    return f"""{_cd_ctes(0.0, 1.0)},
    lasso AS (SELECT * FROM paths WHERE alpha = {OBJECTIVE_ALPHA}),
    res AS (SELECT avg((z.y - (c.w0 + c.w1 * z.x1 + c.w2 * z.x2 + c.w3 * z.x3)) ^ 2) AS mse FROM z CROSS JOIN lasso c)
    {rows}"""


@query("f6_penalized_objective", _objective_sql())
def f6_penalized_objective(spark, sf_dir):
    """L1, L2 (unsquared and squared) and elastic net of a lasso model, in one pass."""
    df = li_z(spark, sf_dir)
    model = Lasso(alpha=OBJECTIVE_ALPHA).fit(df, LI_FEATURES, "y")
    scored = df.select("y", model.predict_col().alias("yhat"))
    return metrics.penalized_objectives(scored, "y", "yhat", model.weights, PENALTIES).select(
        "penalty_kind", rnd("mse").alias("mse"), rnd("penalty", 9).alias("penalty"), rnd("objective").alias("objective"))


# ------------------------------------------------------------------ G7 / F2
DOC_FEATURES = [f"x{i + 1}" for i in range(1 + len(LANGS))]
DOC_SQL = f"""
    dj AS (SELECT d.doc_id, d.n_chars::DOUBLE AS x, l.quality AS y,
                  {', '.join(f"coalesce(d.lang = '{c}', false)::INTEGER::DOUBLE AS x{i + 2}" for i, c in enumerate(LANGS))}
           FROM documents d JOIN labels l USING (doc_id)),
    ds AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM dj),
    dz AS (SELECT doc_id, (x - m) / s AS x1, {', '.join(DOC_FEATURES[1:])}, y::DOUBLE AS y FROM dj, ds)"""
NEWTON_STEPS = 12


def sql_solve(n: int, rhs: str, table: str, out: str) -> list[str]:
    """CTEs solving the symmetric system h{i}_{j} w = {rhs}{i} of ``table`` by elimination; the
    last one is {out}(w0, w1, ...)."""
    m = {(i, j): f"h{min(i, j)}_{max(i, j)}" for i in range(n) for j in range(n)}
    cols = ", ".join([f"{m[i, j]} AS e{i}_{j}" for i in range(n) for j in range(n)] + [f"{rhs}{i} AS e{i}_{n}" for i in range(n)])
    ctes = [f"{out}_0 AS (SELECT {cols} FROM {table})"]
    for k in range(n):  # positive definite: no pivoting
        cells = [f"e{i}_{j} - e{i}_{k} / e{k}_{k} * e{k}_{j} AS e{i}_{j}" if i != k else f"e{i}_{j}"
                 for i in range(n) for j in range(n + 1)]
        ctes.append(f"{out}_{k + 1} AS (SELECT {', '.join(cells)} FROM {out}_{k})")
    ctes.append(f"{out} AS (SELECT {', '.join(f'e{i}_{n} / e{i}_{i} AS w{i}' for i in range(n))} FROM {out}_{n})")
    return ctes


def _logit_sql(tail: str) -> str:
    """Newton's method with C = 1 (small tables separate a language), the intercept free,
    unrolled well past convergence."""
    p = len(DOC_FEATURES) + 1
    x = ["1"] + [f"dz.{c}" for c in DOC_FEATURES]
    ctes = ["v0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(p)) + ")"]
    for t in range(NEWTON_STEPS):
        z = " + ".join(f"v.w{i} * {x[i]}" for i in range(p))
        ctes.append(f"p{t} AS (SELECT dz.*, 1 / (1 + exp(-({z}))) AS p FROM dz CROSS JOIN v{t} v)")
        xs_ = ["1"] + DOC_FEATURES
        sums = [f"sum((y - p) * {xs_[i]}){f' - any_value(v.w{i})' if i else ''} AS g{i}" for i in range(p)]
        sums += [f"sum(p * (1 - p) * {xs_[i]} * {xs_[j]}){' + 1' if i == j and i else ''} AS h{i}_{j}"
                 for i in range(p) for j in range(i, p)]
        ctes.append(f"m{t} AS (SELECT {', '.join(sums)} FROM p{t} CROSS JOIN v{t} v)")
        ctes += sql_solve(p, "g", f"m{t}", f"d{t}")
        ctes.append(f"v{t + 1} AS (SELECT {', '.join(f'v.w{i} + d.w{i} AS w{i}' for i in range(p))} FROM v{t} v CROSS JOIN d{t} d)")
    z = " + ".join(f"v.w{i} * {x[i]}" for i in range(p))
    ctes.append(f"sc AS (SELECT dz.doc_id, dz.y, {z} AS z FROM dz CROSS JOIN v{NEWTON_STEPS} v)")
    return f"WITH {DOC_SQL}, {', '.join(ctes)} {tail}"


def _logit_fit(spark, sf_dir):
    df = document_xy(spark, sf_dir, "quality")
    return df, LogisticRegression(penalty="l2", C=1.0).fit(df, DOC_FEATURES, "y")


@query("g7_logistic_regression", _logit_sql(f"""
    SELECT doc_id, y::INTEGER AS y, {sql_rnd('1 / (1 + exp(-z))')} AS probability FROM sc"""))
def g7_logistic_regression(spark, sf_dir):
    df, model = _logit_fit(spark, sf_dir)
    return df.select("doc_id", "y", rnd(model.predict_proba_col()).alias("probability"))


_F2_SQL = ("ln(1 + exp(-abs(z))) + greatest(z, 0) - y * z", "1 / (1 + exp(-z)) - y",
           "(1 / (1 + exp(-z))) * (1 - 1 / (1 + exp(-z)))")


@query("f2_logistic_loss", _logit_sql(f"""
    SELECT {sql_rnd(f'avg({_F2_SQL[0]})')} AS loss, {sql_rnd(f'avg({_F2_SQL[1]})')} AS gradient,
           {sql_rnd(f'avg({_F2_SQL[2]})')} AS hessian FROM sc"""))
def f2_logistic_loss(spark, sf_dir):
    df, model = _logit_fit(spark, sf_dir)
    scored = df.select("y", model.decision_col().alias("z"))
    m = metrics.logistic_loss(scored, "y", "z")
    return m.select(rnd("loss").alias("loss"), rnd("gradient").alias("gradient"),
                    rnd("hessian").alias("hessian"))


@query("f2_logistic_loss_rows", _logit_sql(f"""
    SELECT doc_id, {sql_rnd(_F2_SQL[0])} AS loss, {sql_rnd(_F2_SQL[1])} AS gradient, {sql_rnd(_F2_SQL[2])} AS hessian FROM sc"""))
def f2_logistic_loss_rows(spark, sf_dir):
    """Per document: a projection of the scored table."""
    df, model = _logit_fit(spark, sf_dir)
    scored = df.select("doc_id", "y", model.decision_col().alias("z"))
    loss, gradient, hessian = metrics.logistic_terms("y", "z")
    return scored.select("doc_id", rnd(loss).alias("loss"), rnd(gradient).alias("gradient"), rnd(hessian).alias("hessian"))


# ------------------------------------------------------------------ G18 PCA
# SQL has no eigen-decomposition, but it can state what one over all 64 components must give
# back: the covariance itself, the spectrum's moments, and quadratic forms of every row.
COV_SQL = f"""{EMB_LONG_SQL},
    c AS (SELECT a.i::BIGINT AS i, b.i::BIGINT AS j, covar_samp(a.x, b.x) AS v
          FROM ev a JOIN ev b ON a.vec_id = b.vec_id GROUP BY a.i, b.i),
    dv AS (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY i) AS d FROM ev)"""


def _pca(spark, sf_dir, k=None):
    df = embedding_view(spark, sf_dir, WIDE)
    return df, PCA(n_components=k).fit(df, xs(WIDE))


@query("g18_pca_components", f"""
    WITH {COV_SQL} SELECT i, j, {sql_rnd('v', 9)} AS value FROM c WHERE i <= j""")
def g18_pca_components(spark, sf_dir):
    """All components put together: sum of lambda_k v_ki v_kj is the covariance of i and j."""
    _, model = _pca(spark, sf_dir)
    whole = (model.components_.T * model.explained_variance_) @ model.components_
    rows = [(i, j, float(whole[i, j])) for i in range(WIDE) for j in range(i, WIDE)]
    return spark.createDataFrame(rows, "i bigint, j bigint, value double").select("i", "j", rnd("value", 9).alias("value"))


@query("e15_explained_variance", f"""
    WITH {COV_SQL},
    c2 AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM c a JOIN c b ON a.j = b.i GROUP BY a.i, b.j),
    tr AS (SELECT 1::BIGINT AS moment, sum(v) AS t FROM c WHERE i = j
           UNION ALL SELECT 2, sum(v) FROM c2 WHERE i = j
           UNION ALL SELECT 3, sum(a.v * b.v) FROM c2 a JOIN c b ON a.i = b.j AND a.j = b.i
           UNION ALL SELECT 4, sum(a.v * b.v) FROM c2 a JOIN c2 b ON a.i = b.j AND a.j = b.i)
    SELECT moment, {sql_rnd('t', 12)} AS total, {sql_rnd('t / (SELECT t FROM tr WHERE moment = 1) ^ moment', 9)} AS ratio FROM tr""")
def e15_explained_variance(spark, sf_dir):
    """Moments of the explained variances and of their ratios over all components: the traces
    of the covariance's powers."""
    _, model = _pca(spark, sf_dir)
    rows = [(m, float((model.explained_variance_ ** m).sum()), float((model.explained_variance_ratio_ ** m).sum()))
            for m in range(1, 5)]
    return spark.createDataFrame(rows, "moment bigint, total double, ratio double").select(
        "moment", rnd("total", 12).alias("total"), rnd("ratio", 9).alias("ratio"))


@query("b8_center", f"""
    WITH {sql_emb(WIDE)}, m AS (SELECT {', '.join(f'avg({x}) AS m_{x}' for x in xs(WIDE))} FROM emb)
    SELECT vec_id, {', '.join(f"{sql_rnd(f'{x} - m_{x}')} AS c{x[1:]}" for x in xs(WIDE))} FROM emb CROSS JOIN m""")
def b8_center(spark, sf_dir):
    df = embedding_view(spark, sf_dir, WIDE)
    model = PCA(n_components=1).fit(df, xs(WIDE))
    return df.select("vec_id", *[rnd(c).alias(f"c{i + 1}") for i, c in enumerate(model.center_cols())])


@query("b10_pca_project", f"""
    WITH {COV_SQL},
    q AS (SELECT a.vec_id, sum(a.d * s.d) AS q FROM dv a JOIN (
              SELECT b.vec_id, c.i, sum(c.v * b.d) AS d FROM dv b JOIN c ON c.j = b.i GROUP BY b.vec_id, c.i) s
              ON s.vec_id = a.vec_id AND s.i = a.i GROUP BY a.vec_id)
    SELECT vec_id, {sql_rnd('any_value(l)')} AS length, {sql_rnd('any_value(q)', 9)} AS spread
    FROM (SELECT vec_id, sum(d * d) AS l FROM dv GROUP BY vec_id) JOIN q USING (vec_id) GROUP BY vec_id""")
def b10_pca_project(spark, sf_dir):
    """All 64 scores of every row: their squares add up to the row's squared length, and
    weighted by the explained variances to its quadratic form in the covariance."""
    df, model = _pca(spark, sf_dir)
    z = model.transform(df.select("vec_id", *xs(WIDE)))
    square = [F.col(f"z{k + 1}") * F.col(f"z{k + 1}") for k in range(WIDE)]
    weighted = [s * F.lit(float(v)) for s, v in zip(square, model.explained_variance_)]
    return z.select("vec_id", rnd(total(square)).alias("length"), rnd(total(weighted), 9).alias("spread"))


@query("b11_pca_reconstruct", f"""
    WITH {sql_emb(WIDE)} SELECT vec_id, {', '.join(f"{sql_rnd(x)} AS r{x[1:]}" for x in xs(WIDE))} FROM emb""")
def b11_pca_reconstruct(spark, sf_dir):
    """From all components a row comes back as it was."""
    df, model = _pca(spark, sf_dir)
    z = model.transform(df.select("vec_id", *xs(WIDE)))
    rec = model.reconstruct(z, [f"z{k + 1}" for k in range(WIDE)])
    return rec.select("vec_id", *[rnd(f"r{j + 1}").alias(f"r{j + 1}") for j in range(WIDE)])


@query("g18_pca_wide", f"""
    WITH {COV_SQL} SELECT 8::BIGINT AS kept, (SELECT count(*) FROM embeddings) AS n, true AS uncorrelated,
           {sql_rnd('sum(v)', 9)} AS total FROM c WHERE i = j""")
def g18_pca_wide(spark, sf_dir):
    """Eight components over whole vectors, measured on the scored rows: the scores are
    uncorrelated, their variances are the explained ones, and what is left of the rows has the
    rest of the total variance."""
    df, model = _pca(spark, sf_dir, 8)
    names = [f"z{k + 1}" for k in range(8)]
    n, _, cov = covariance_matrix(model.transform(df.select(*xs(WIDE))).select(*names), names)
    held = bool(np.allclose(cov, np.diag(model.explained_variance_[:8]), atol=1e-12))
    left = model.residuals(df.select(*xs(WIDE)))
    whole = float(np.trace(cov)) + left.agg(F.sum("residual")).first()[0] / (n - 1)
    return spark.createDataFrame([(8, int(n), held, whole)], "kept bigint, n bigint, uncorrelated boolean, total double").select(
        "kept", "n", "uncorrelated", rnd("total", 9).alias("total"))
