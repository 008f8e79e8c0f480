"""G13 hinge-loss SVM (full-batch subgradient), G14 Pegasos, G15 pyspark.ml
LinearSVC / one-vs-rest, G16 kernel SVM on landmarks.

Row-sequential SGD is not parallel, so G13 is re-aimed as full-batch: each
iteration is one aggregate of the hinge subgradient over all rows, with the
weights as literals. Kernel training on the full n x n Gram matrix is
re-aimed as a linear SVM on kernel features against m landmark rows (a
Nyström-style approximation, m fixed by the caller); scoring against a
support-vector table is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrow_scores import arrow_sums, too_many_aggregates
from ..functions.linalg import dot, sql_double


def _sql_value(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, (int, np.integer)):
        return str(int(v))
    return sql_double(v)
from ..operators.split import hinge_active
from ..sources.validate import assert_finite, count_invalid, raise_if_invalid


class LinearSVM:
    """Minimise ½‖w‖² + C·mean(max(0, 1 - y(w·x + b))) by full-batch subgradient.

    Labels must be ±1 (recode with B9). ``penalize_bias`` keeps the bias inside
    the regulariser, as the per-row update it replaces did. Stops when the
    relative change of the objective is below ``tol`` (checked every step).
    """

    def __init__(self, C: float = 1.0, fit_intercept: bool = True, learning_rate: float = 1e-3,
                 max_iter: int = 1000, tol: float = 1e-3, penalize_bias: bool = True):
        self.C, self.fit_intercept, self.lr = C, fit_intercept, learning_rate
        self.max_iter, self.tol, self.penalize_bias = max_iter, tol, penalize_bias

    def _score(self, w: np.ndarray) -> Column:
        if self.fit_intercept:
            return dot(self.features, w[1:], float(w[0]))
        return dot(self.features, w)

    def _pass(self, data: DataFrame, w: np.ndarray, validate: bool = False):
        """One aggregate: hinge loss and Σ y·x over margin violators.

        With ``validate`` the same aggregate counts invalid rows and labels
        other than ±1 (the first iteration's check rides on its scan)."""
        if too_many_aggregates(len(self.features) + 2):
            if validate:
                self._validate(data)
            return self._arrow_pass(data, w)
        s = self._score(w)
        act = hinge_active(F.col("_y"), s)
        yx = [F.col("_y")] if self.fit_intercept else []
        yx += [F.col("_y") * F.col(c) for c in self.features]
        aggs = [F.avg(F.greatest(F.lit(0.0), F.lit(1.0) - F.col("_y") * s)).alias("hinge"),
                F.count(F.lit(1)).alias("n")]
        aggs += [F.sum(F.when(act, e).otherwise(F.lit(0.0))).alias(f"g{k}") for k, e in enumerate(yx)]
        if validate:
            aggs += [count_invalid(self.features, "_y"),
                     F.count_if(~F.col("_y").isin(-1.0, 1.0)).alias("_badlab")]
        row = data.agg(*aggs).first()
        if validate:
            self._raise_bad(row)
        g = np.array([row[f"g{k}"] or 0.0 for k in range(len(yx))])
        return row["hinge"], row["n"], g

    @staticmethod
    def _raise_bad(row) -> None:
        raise_if_invalid(row["_invalid"])
        if row["_badlab"]:
            raise ValueError("labels must be -1 or +1")

    def _validate(self, data: DataFrame) -> None:
        self._raise_bad(data.agg(count_invalid(self.features, "_y"),
                                 F.count_if(~F.col("_y").isin(-1.0, 1.0)).alias("_badlab")).first())

    def _arrow_pass(self, data: DataFrame, w: np.ndarray):
        feats, icpt = self.features, self.fit_intercept

        def batch(cols):
            x = np.column_stack([cols[c].astype(np.float64) for c in feats])
            if icpt:
                x = np.column_stack([np.ones(len(x)), x])
            y = cols["_y"].astype(np.float64)
            margin = y * (x @ w)
            act = margin < 1.0
            return np.concatenate([[np.maximum(0.0, 1.0 - margin).sum(), len(y)], x[act].T @ y[act]])
        v = arrow_sums(data, feats + ["_y"], 2 + len(w), batch)
        n = int(v[1])
        return (v[0] / n if n else 0.0), n, v[2:]

    def _reg_mask(self, p: int) -> np.ndarray:
        m = np.ones(p)
        if self.fit_intercept and not self.penalize_bias:
            m[0] = 0.0
        return m

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "LinearSVM":
        self.features = list(features)
        p = len(self.features) + (1 if self.fit_intercept else 0)
        data = df.select(*self.features, F.col(label).cast("double").alias("_y")).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            w = np.zeros(p)
            mask = self._reg_mask(p)
            old = None
            self.n_iter_, self.objective_ = 0, []
            for it in range(self.max_iter):
                hinge, n, g = self._pass(data, w, validate=it == 0)
                obj = 0.5 * float((mask * w) @ w) + self.C * hinge
                self.objective_.append(obj)
                if old is not None and old != 0 and abs(old - obj) / abs(old) < self.tol:
                    break
                old = obj
                grad = mask * w - self.C * g / n
                w = w - self.lr * grad
                self.n_iter_ += 1
        finally:
            data.unpersist()
        self.coef_ = w
        return self

    def decision_col(self) -> Column:
        return self._score(self.coef_)

    def predict_col(self) -> Column:
        """sign of the decision value (0 maps to +1)."""
        return F.when(self.decision_col() >= 0, F.lit(1)).otherwise(F.lit(-1))


class PegasosSVM(LinearSVM):
    """G14 (linear): primal Pegasos, full batch (Shalev-Shwartz et al. 2007).

    η_t = 1/(λ t); w ← (1 - η_t λ) w + η_t/n · Σ_{y·s<1} y·x; λ = 1/(C·n)
    unless given. The bias is appended as a constant feature (regularised).
    Stops when ‖w_t - w_{t-1}‖² < tol.
    """

    def __init__(self, C: float = 100.0, lam: float | None = None, fit_intercept: bool = True,
                 max_iter: int = 100, tol: float = 1e-3):
        super().__init__(C=C, fit_intercept=fit_intercept, max_iter=max_iter, tol=tol)
        self.lam = lam

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "PegasosSVM":
        self.features = list(features)
        p = len(self.features) + (1 if self.fit_intercept else 0)
        data = df.select(*self.features, F.col(label).cast("double").alias("_y")).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            w = np.zeros(p)
            self.n_iter_ = 0
            lam = self.lam
            for t in range(1, self.max_iter + 1):
                _, n, g = self._pass(data, w, validate=t == 1)
                if lam is None:
                    lam = 1.0 / (self.C * n)
                eta = 1.0 / (lam * t)
                new = (1.0 - eta * lam) * w + eta * g / n
                self.n_iter_ = t
                done = float(((new - w) ** 2).sum()) < self.tol
                w = new
                if done:
                    break
        finally:
            data.unpersist()
        self.lam_ = lam
        self.coef_ = w
        return self


def ml_linear_svc(df: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
                  max_iter: int = 100, multiclass: bool = False):
    """The soft-margin primal via pyspark.ml (regParam = 1/(C·n), no standardisation).

    Binary labels must be 0/1; ``multiclass`` wraps it in OneVsRest. Returns the
    fitted pyspark.ml model and the assembled frame to score.
    """
    from pyspark.ml.classification import LinearSVC, OneVsRest
    from pyspark.ml.feature import VectorAssembler

    n = df.count()
    assembled = VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)
    svc = LinearSVC(featuresCol="_features", labelCol=label, regParam=1.0 / (C * n),
                    maxIter=max_iter, standardization=False)
    est = OneVsRest(classifier=svc, featuresCol="_features", labelCol=label) if multiclass else svc
    model = est.fit(assembled.withColumn(label, F.col(label).cast("double")))
    return model, assembled


class KernelSVM:
    """Kernel SVM decision f(x) = Σ_i α_i y_i K(s_i, x) + b.

    Training: kernel features φ(x) = [K(x, l_1) … K(x, l_m)] against m
    landmark rows (bounded, literal), then the full-batch linear SVM (G13) on
    φ. Scoring with explicit support vectors is exact.
    """

    def __init__(self, kernel: str = "rbf", gamma: float = 1.0, degree: int = 2, **svm_kw):
        self.kernel, self.gamma, self.degree = kernel, gamma, degree
        self.svm_kw = svm_kw

    def kernel_features(self, df: DataFrame, cols: Sequence[str], landmarks: np.ndarray,
                        keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
        """φ(x) as columns k0..k{m-1} next to ``keep`` (map-only, no shuffle)."""
        from ..operators import pairwise

        fn = {"rbf": "rbf", "linear": "linear", "poly": "polynomial", "polynomial": "polynomial"}[self.kernel]
        out = pairwise.wide_point_values(df, keep, cols, landmarks, fn=fn, degree=self.degree,
                                         gamma=self.gamma)
        return out, [f"k{j}" for j in range(landmarks.shape[0])]

    def fit(self, df: DataFrame, key: str, cols: Sequence[str], label: str,
            landmarks: np.ndarray) -> "KernelSVM":
        self.landmarks, self.cols = np.asarray(landmarks, dtype=float), list(cols)
        feats, names = self.kernel_features(df, cols, self.landmarks, keep=[key, label])
        self.svm = LinearSVM(**self.svm_kw).fit(feats, names, label)
        self.feature_names = names
        return self

    def decision(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        feats, _ = self.kernel_features(df, self.cols, self.landmarks, keep=keep)
        return feats.select(*keep, self.svm.decision_col().alias("decision"))


def support_vector_scores(df: DataFrame, keep: Sequence[str], cols: Sequence[str],
                          support: np.ndarray, alpha_y: Sequence[float], bias: float,
                          kernel: str = "rbf", gamma: float = 1.0, degree: int = 2) -> DataFrame:
    """Exact kernel decision Σ α_i y_i K(s_i, x) + b against a literal support set (map-only)."""
    from ..operators import pairwise

    fn = {"rbf": "rbf", "linear": "linear", "poly": "polynomial", "polynomial": "polynomial"}[kernel]
    k = pairwise.wide_point_values(df, keep, cols, support, fn=fn, degree=degree, gamma=gamma)
    return k.select(*keep, dot([f"k{j}" for j in range(len(alpha_y))], alpha_y, bias).alias("decision"))


class OneVsRestSVM:
    """G15 one-vs-rest (B9) with all K binary hinge problems in one pass.

    Every iteration is a single aggregate computing, for each class k, the
    subgradient Σ_{y_k·s_k<1} y_k·[1, x] with y_k = +1 for rows of class k
    and -1 otherwise; then each hyperplane takes the G13 step. Prediction is
    the argmax of the K decision values (lowest class on ties).
    """

    def __init__(self, C: float = 1.0, learning_rate: float = 1e-3, max_iter: int = 1000,
                 tol: float = 1e-3):
        self.C, self.lr, self.max_iter, self.tol = C, learning_rate, max_iter, tol

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "OneVsRestSVM":
        from ..operators.features import dictionary

        self.features = list(features)
        assert_finite(df, self.features, label)  # a NULL label would be a negative of every class
        self.classes = dictionary(df, label)
        k, p = len(self.classes), len(self.features) + 1
        data = df.select(*self.features, F.col(label).alias("_lab")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            w = np.zeros((k, p))
            old = None
            self.n_iter_ = 0
            wide = too_many_aggregates(k * (p + 1))
            for _ in range(self.max_iter):
                if wide:
                    n, hinge, g = self._arrow_pass(data, w)
                    obj = float(sum(0.5 * w[c] @ w[c] + self.C * hinge[c] for c in range(k)))
                    if old is not None and old != 0 and abs(old - obj) / abs(old) < self.tol:
                        break
                    old = obj
                    w = w - self.lr * (w - self.C * g / n)
                    self.n_iter_ += 1
                    continue
                # all K problems in one aggregate, generated as SQL expressions
                aggs = [F.count(F.lit(1)).alias("n")]
                for c, cls in enumerate(self.classes):
                    y = f"(CASE WHEN `_lab` = {_sql_value(cls)} THEN 1D ELSE -1D END)"
                    terms = [f"`{f}` * {sql_double(w[c, j + 1])}" for j, f in enumerate(self.features)]
                    s_ = f"({sql_double(w[c, 0])} + {' + '.join(terms)})"
                    act = f"{y} * {s_} < 1D"
                    aggs.append(F.expr(f"avg(greatest(0D, 1D - {y} * {s_}))").alias(f"h{c}"))
                    aggs.append(F.expr(f"sum(CASE WHEN {act} THEN {y} ELSE 0D END)").alias(f"g{c}_0"))
                    aggs += [F.expr(f"sum(CASE WHEN {act} THEN {y} * `{f}` ELSE 0D END)").alias(f"g{c}_{j + 1}")
                             for j, f in enumerate(self.features)]
                row = data.agg(*aggs).first()
                n = row["n"]
                g = np.array([[row[f"g{c}_{j}"] or 0.0 for j in range(p)] for c in range(k)])
                obj = float(sum(0.5 * w[c] @ w[c] + self.C * row[f"h{c}"] for c in range(k)))
                if old is not None and old != 0 and abs(old - obj) / abs(old) < self.tol:
                    break
                old = obj
                w = w - self.lr * (w - self.C * g / n)
                self.n_iter_ += 1
        finally:
            data.unpersist()
        self.coef_ = w
        return self

    def _arrow_pass(self, data: DataFrame, w: np.ndarray):
        """(n, mean hinge per class, K x (p+1) subgradient sums) in one Arrow pass."""
        feats, classes = self.features, list(self.classes)
        k, p1 = w.shape

        def batch(cols):
            x = np.column_stack([np.ones(len(cols["_lab"]))] + [cols[c].astype(np.float64) for c in feats])
            lab = cols["_lab"]
            y = np.where(lab[:, None] == np.array(classes, dtype=object)[None, :], 1.0, -1.0)
            margin = y * (x @ w.T)
            act = (margin < 1.0) * y
            return np.concatenate([[len(lab)], np.maximum(0.0, 1.0 - margin).sum(axis=0),
                                   (act.T @ x).reshape(-1)])
        v = arrow_sums(data, feats + ["_lab"], 1 + k + k * p1, batch)
        n = v[0]
        return n, v[1:1 + k] / n, v[1 + k:].reshape(k, p1)

    def decision_cols(self) -> list[Column]:
        return [dot(self.features, self.coef_[c, 1:], float(self.coef_[c, 0]))
                for c in range(len(self.classes))]

    def predict_col(self) -> Column:
        from ..functions.linalg import argmax_index, pick

        return pick(self.classes, argmax_index(self.decision_cols()))
