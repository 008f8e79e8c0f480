"""G1-G4 linear regression family and G7 logistic regression.

Least squares comes from the triangle of a tree QR (one scan, the condition number not
squared). Penalised squared loss runs on the sufficient statistics of one aggregate pass (E1),
centred on the means of the columns: after it, every iteration is p-dimensional driver
arithmetic and never touches the table again. Squared L2 is solved in closed form,
L1 and elastic net by coordinate descent with soft thresholding (exact zeros, stopped by the
violation of the optimality conditions), the unsquared L2 norm by a one-dimensional root.

Logistic regression has no finite sufficient statistic: each Newton step is one distributed
aggregate of loss, gradient and the p x p weighted Hessian, whose weights enter the plan as
literals (constant plan size, no growing lineage).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.validate import assert_finite, count_invalid, raise_if_invalid
from ..functions.activations import sigmoid
from ..operators.metrics import logistic_loss_col
from ..functions.arrow_scores import arrow_sums, too_many_aggregates
from ..functions.linalg import dot
from ..operators.moments import moment_matrices
from ..operators.tree_qr import tree_qr


class _Penalty:
    """alpha x (l2_share x half the squared norm + l1_share x L1 norm + norm_share x the
    unsquared L2 norm); the intercept (index 0) is never penalised by default."""

    def __init__(self, alpha: float = 0.0, l2_share: float = 0.0, l1_share: float = 0.0, norm_share: float = 0.0):
        self.alpha, self.l2_share, self.l1_share, self.norm_share = alpha, l2_share, l1_share, norm_share

    def value(self, w: np.ndarray) -> float:
        return self.alpha * (self.l2_share * 0.5 * float(w @ w) + self.l1_share * float(np.abs(w).sum())
                             + self.norm_share * float(np.sqrt(w @ w)))

    def gradient(self, w: np.ndarray) -> np.ndarray:
        norm = float(np.sqrt(w @ w))
        return self.alpha * (self.l2_share * w + self.l1_share * np.sign(w) + (self.norm_share * w / norm if norm else 0.0))


def coordinate_descent(a: np.ndarray, b: np.ndarray, l1: np.ndarray, l2: np.ndarray, w: np.ndarray, max_iter: int,
                       tol: float) -> tuple[np.ndarray, int, float]:
    """argmin of w'aw/2 - b'w + sum l1|w| + sum l2 w^2/2 by cyclic soft thresholding; stops when
    no coordinate violates its optimality condition by more than ``tol``. Returns the
    coefficients, the sweeps made and the largest violation left."""
    w = w.copy()
    for sweep in range(max_iter + 1):
        slope = a @ w - b + l2 * w
        off = np.where(w == 0.0, np.maximum(np.abs(slope) - l1, 0.0), np.abs(slope + l1 * np.sign(w)))
        violation = float(off.max()) if len(off) else 0.0
        if violation <= tol or sweep == max_iter:
            return w, sweep, violation
        for j in range(len(w)):
            c = b[j] - a[j] @ w + a[j, j] * w[j]
            scale = a[j, j] + l2[j]
            w[j] = np.sign(c) * max(abs(c) - l1[j], 0.0) / scale if scale > 0.0 else 0.0


def norm_penalised(a: np.ndarray, b: np.ndarray, alpha: float) -> np.ndarray:
    """argmin of w'aw/2 - b'w + alpha |w|: zero if |b| <= alpha, else the w = (a + alpha/t)^-1 b
    whose norm is t, by bisection on t."""
    if np.sqrt(b @ b) <= alpha:
        return np.zeros(len(b))
    if alpha == 0.0:
        return np.linalg.lstsq(a, b, rcond=None)[0]
    values, vectors = np.linalg.eigh(a)
    values, c = np.maximum(values, 0.0), vectors.T @ b

    def at(t: float) -> np.ndarray:
        return c * t / (values * t + alpha)

    lo, hi = 0.0, 1.0
    while np.sqrt(at(hi) @ at(hi)) > hi:
        lo, hi = hi, 2.0 * hi
        if hi > 1e300:
            break
    for _ in range(200):
        t = 0.5 * (lo + hi)
        lo, hi = (t, hi) if np.sqrt(at(t) @ at(t)) > t else (lo, t)
    return vectors @ at(hi)


def elastic_net_shares(ratio: float) -> tuple[float, float]:
    """``ratio`` is the L2:L1 weight: 0 → pure L1, inf → pure L2."""
    if ratio < 0:
        raise ValueError("ratio must be non-negative")
    if ratio == 0:
        return 0.0, 1.0
    if ratio == float("inf"):
        return 1.0, 0.0
    return ratio / (ratio + 1.0), 1.0 / (ratio + 1.0)


class LinearModel:
    """Squared-loss linear model fitted from the moments of ``[1, x]``.

    Objective: (1/2n)|Xw - y|^2 + alpha (l2_share |w|^2/2 + l1_share |w|_1 + norm_share |w|).
    With an unpenalised intercept all solvers work on centred moments. ``closed_form=False``
    with no L1 or norm part runs gradient descent on them.
    """

    def __init__(self, fit_intercept: bool = True, closed_form: bool = True, alpha: float = 0.0,
                 l2_share: float = 0.0, l1_share: float = 0.0, norm_share: float = 0.0, learning_rate: float = 1e-3,
                 max_iter: int = 1000, tol: float = 1e-8, penalize_intercept: bool = False,
                 init: Sequence[float] | None = None):
        self.fit_intercept = fit_intercept
        self.closed_form = closed_form
        self.penalty = _Penalty(alpha, l2_share, l1_share, norm_share)
        self.learning_rate, self.max_iter, self.tol = learning_rate, max_iter, tol
        self.penalize_intercept = penalize_intercept
        self.init = init

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "LinearModel":
        self.features = list(features)
        pen = self.penalty
        if self.closed_form and not (pen.alpha and (pen.l1_share or pen.l2_share or pen.norm_share)):
            return self._least_squares(df, label)
        centre = self.fit_intercept and not self.penalize_intercept
        shift = self._means(df, label) if centre else None
        if centre:  # raw moments of far-from-zero columns lose every digit of the slope
            df = df.select(*[(F.col(c) - F.lit(s)).alias(c) for c, s in zip([*self.features, label], shift)])
        m = moment_matrices(df, self.features, label)
        n = m["n"]
        if n == 0:
            raise ValueError("cannot fit on an empty table")
        p = len(self.features)
        if self.fit_intercept:
            g = np.empty((p + 1, p + 1))
            g[0, 0], g[0, 1:], g[1:, 0], g[1:, 1:] = n, m["sx"], m["sx"], m["xtx"]
            xty = np.concatenate([[m["sy"]], m["xty"]])
        else:
            g, xty = m["xtx"], m["xty"]
        self.n_, self.gram_, self.xty_, self.syy_, self._shift = n, g, xty, m["syy"], shift
        mask = np.ones(len(xty))
        if centre:
            mask[0] = 0.0
        self.mask_ = mask
        return self._solve()

    def _least_squares(self, df: DataFrame, label: str) -> "LinearModel":
        """No penalty: from the triangle of a tree QR, one scan, as NumPy's lstsq on all rows
        (the least solution if columns are collinear)."""
        n, r = tree_qr(df, [*self.features, label], ones=self.fit_intercept)
        if n == 0:
            raise ValueError("cannot fit on an empty table")
        a, b = r[:, :-1], r[:, -1]
        self.n_, self.gram_, self.xty_, self.syy_, self._shift = n, a.T @ a, a.T @ b, float(b @ b), None
        self.mask_, self.n_iter_, self.violation_ = np.ones(a.shape[1]), 0, 0.0
        if self.fit_intercept and not self.penalize_intercept:
            self.mask_[0] = 0.0
        tol = max(n, a.shape[1]) * np.finfo(float).eps
        w, _, rank, _ = np.linalg.lstsq(a, b, rcond=tol)
        if self.fit_intercept and 1 < a.shape[1] and rank < a.shape[1]:
            # the least solution leaves out directions that the longest column's rounding hides; below
            # its first row the triangle is that of the centred columns, which may tell them apart
            # (slopes of columns far from zero). Taken if it leaves less than half of the rest.
            size = np.linalg.norm(a[:, 1:], axis=0)
            scaled = a[1:, 1:] / np.where(size > 0, size, 1.0)
            if np.linalg.svd(scaled, compute_uv=False)[-1] > tol:
                slopes = np.linalg.lstsq(scaled, b[1:], rcond=tol)[0] / size
                centred = np.r_[(b[0] - a[0, 1:] @ slopes) / a[0, 0], slopes]
                if 2 * np.sum((a @ centred - b) ** 2) < np.sum((a @ w - b) ** 2):
                    w = centred
        self._w = self.coef_ = w
        self._residual = float(np.sum((a @ self._w - b) ** 2))
        return self

    def refit(self, alpha: float) -> "LinearModel":
        """The model of another ``alpha`` from the same moments, starting at this one's
        coefficients: a regularisation path costs one pass over the table."""
        import copy

        other = copy.copy(self)
        other.penalty = _Penalty(alpha, self.penalty.l2_share, self.penalty.l1_share, self.penalty.norm_share)
        other.init = self._w
        return other._solve()

    def _solve(self) -> "LinearModel":
        a, b, mask, pen = self.gram_ / self.n_, self.xty_ / self.n_, self.mask_, self.penalty
        start = np.zeros(len(b)) if self.init is None else np.asarray(self.init, dtype=float)
        self.n_iter_, self.violation_ = 0, 0.0
        if pen.norm_share:
            if pen.l1_share or pen.l2_share:
                raise ValueError("the unsquared norm stands alone")
            w = self._norm(a, b, pen.alpha * pen.norm_share)
        elif pen.l1_share:
            w, self.n_iter_, self.violation_ = coordinate_descent(
                a, b, pen.alpha * pen.l1_share * mask, pen.alpha * pen.l2_share * mask, start, self.max_iter, self.tol)
        elif self.closed_form:
            w = np.linalg.lstsq(a + pen.alpha * pen.l2_share * np.diag(mask), b, rcond=None)[0]
        else:
            w = start
            for _ in range(self.max_iter):
                new = w - self.learning_rate * (a @ w - b + mask * pen.gradient(w))
                self.n_iter_ += 1
                done = np.linalg.norm(new - w) < self.tol
                w = new
                if done:
                    break
        self._w = w  # in the coordinates of gram_
        if self._shift is not None:
            w = w.copy()
            w[0] += self._shift[-1] - w[1:] @ self._shift[:-1]
        self.coef_ = w
        return self

    def _norm(self, a: np.ndarray, b: np.ndarray, alpha: float) -> np.ndarray:
        if self.mask_.all():
            return norm_penalised(a, b, alpha)
        # the centred intercept is independent of the slopes
        return np.concatenate([[b[0]], norm_penalised(a[1:, 1:], b[1:], alpha)])

    def _means(self, df: DataFrame, label: str) -> np.ndarray:
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate([*self.features, label])]).first()
        return np.array([0.0 if v is None else float(v) for v in row])

    @property
    def intercept(self) -> float:
        return float(self.coef_[0]) if self.fit_intercept else 0.0

    @property
    def weights(self) -> np.ndarray:
        return self.coef_[1:] if self.fit_intercept else self.coef_

    def predict_col(self) -> Column:
        """x·w + b."""
        return dot(self.features, self.weights, self.intercept)

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        return df.withColumn(prediction, self.predict_col())

    def training_mse(self) -> float:
        """F1 on the training table from the collected moments (no extra pass)."""
        w = self._w
        if getattr(self, "_residual", None) is not None:
            return self._residual / self.n_
        return float((w @ self.gram_ @ w - 2 * w @ self.xty_ + self.syy_) / self.n_)

    def objective(self) -> float:
        """½·MSE + penalty, the quantity gradient descent minimises."""
        return 0.5 * self.training_mse() + self.penalty.value(self.mask_ * self.coef_)


def LinearRegression(**kw) -> LinearModel:  # noqa: N802 - estimator factory
    """G1: ordinary least squares (closed form by default)."""
    return LinearModel(**kw)


def Ridge(alpha: float = 0.1, squared: bool = True, **kw) -> LinearModel:  # noqa: N802
    """Half the squared L2 norm, in closed form (Gram + alpha I) unless closed_form=False;
    ``squared=False`` penalises the norm itself."""
    return LinearModel(alpha=alpha, l2_share=1.0 if squared else 0.0, norm_share=0.0 if squared else 1.0, **kw)


def Lasso(alpha: float = 0.1, **kw) -> LinearModel:  # noqa: N802
    """L1 penalty by coordinate descent on the Gram."""
    kw.setdefault("tol", 1e-12)
    return LinearModel(alpha=alpha, l1_share=1.0, **kw)


def ElasticNet(alpha: float = 0.1, ratio: float = 1.0, **kw) -> LinearModel:  # noqa: N802
    """Ratio is the L2:L1 weight, shares [ratio, 1] / (ratio + 1)."""
    l2, l1 = elastic_net_shares(ratio)
    kw.setdefault("tol", 1e-12)
    return LinearModel(alpha=alpha, l2_share=l2, l1_share=l1, **kw)


class LogisticRegression:
    """Maximise the log-likelihood, minus |w|^2 / (2C) when ``penalty='l2'`` (intercept free).

    ``solver="newton"``: iteratively reweighted least squares. One pass yields loss, gradient
    and Hessian; a step that does not lower the loss is halved. Stops when the Newton
    decrement is below ``tol`` squared, in loss per row, so duplicating all rows changes
    nothing. On separable classes the loss has no minimum: it stops at ``max_iter`` or when
    the loss is zero, and ``converged_`` is false.

    ``solver="gradient"``: ascent on the mean gradient with ``learning_rate``, stopped when
    the step is shorter than ``tol``.
    """

    def __init__(self, fit_intercept: bool = True, C: float = 1.0, penalty: str | None = None,
                 learning_rate: float = 1e-3, max_iter: int = 100, tol: float = 1e-8,
                 init: Sequence[float] | None = None, solver: str = "newton"):
        if solver not in ("newton", "gradient"):
            raise ValueError("solver must be 'newton' or 'gradient'")
        self.fit_intercept, self.C, self.penalty, self.solver = fit_intercept, C, penalty, solver
        self.learning_rate, self.max_iter, self.tol = learning_rate, max_iter, tol
        self.init = init

    def _score(self, w: np.ndarray) -> Column:
        if self.fit_intercept:
            return dot(self.features, w[1:], float(w[0]))
        return dot(self.features, w)

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "LogisticRegression":
        self.features = list(features)
        p = len(self.features) + (1 if self.fit_intercept else 0)
        data = df.select(*self.features, F.col(label).cast("double").alias("_y")).persist()
        lam = np.full(p, 1.0 / self.C if self.penalty == "l2" else 0.0)
        if self.fit_intercept:
            lam[0] = 0.0
        w = np.zeros(p) if self.init is None else np.asarray(self.init, dtype=float).copy()
        try:
            self.coef_ = (self._newton if self.solver == "newton" else self._ascend)(data, w, lam)
        finally:
            data.unpersist()
        return self

    def _newton(self, data: DataFrame, w: np.ndarray, lam: np.ndarray) -> np.ndarray:
        def at(w: np.ndarray, validate: bool = False):
            n, loss, grad, hess = self._pass(data, w, validate)
            return n, loss + 0.5 * float(lam @ (w * w)), grad - lam * w, hess + np.diag(lam)

        self.n_iter_, self.converged_, self.loss_ = 1, False, []
        n, loss, grad, hess = at(w, True)
        if n == 0:
            raise ValueError("cannot fit on an empty table")
        self.loss_.append(loss)
        while self.n_iter_ < self.max_iter:
            step = np.linalg.lstsq(hess, grad, rcond=1e-14)[0]
            if float(grad @ step) / n < self.tol * self.tol:
                self.converged_ = True
                break
            size = 1.0
            while True:
                _, new_loss, new_grad, new_hess = at(w + size * step)
                self.n_iter_ += 1
                lower = new_loss <= loss + 1e-12 * abs(loss)  # but for rounding, at the optimum
                if lower or self.n_iter_ >= self.max_iter:
                    break
                size *= 0.5
            stalled = new_loss >= loss - 1e-15 * abs(loss)
            if lower:
                w, grad, hess = w + size * step, new_grad, new_hess
                loss = new_loss
                self.loss_.append(loss)
            if stalled:
                self.converged_ = True
                break
            if loss / n < 1e-12:  # the classes are separated
                break
        return w

    def _ascend(self, data: DataFrame, w: np.ndarray, lam: np.ndarray) -> np.ndarray:
        self.n_iter_, self.converged_ = 0, False
        for it in range(self.max_iter):
            n, _, grad, _ = self._pass(data, w, it == 0, hessian=False)
            new = w + self.learning_rate * (grad - lam * w) / max(n, 1)
            self.n_iter_ += 1
            self.converged_ = bool(np.linalg.norm(new - w) < self.tol)
            w = new
            if self.converged_:
                break
        return w

    def _pass(self, data: DataFrame, w: np.ndarray, validate: bool = False, hessian: bool = True):
        """One aggregate: rows, loss, gradient of the likelihood and Hessian of the loss. The
        first one also counts invalid rows (no extra scan)."""
        p = len(w)
        pairs = [(i, j) for i in range(p) for j in range(i, p)] if hessian else []
        if too_many_aggregates(2 + p + len(pairs)):
            if validate:
                assert_finite(data, self.features, "_y")
            return self._arrow_pass(data, w, hessian)
        z = self._score(w)
        prob = sigmoid(F.col("_z"))
        x = ([F.lit(1.0)] if self.fit_intercept else []) + [F.col(c) for c in self.features]
        staged = data.withColumn("_z", z).withColumns({"_r": F.col("_y") - prob, "_h": prob * (F.lit(1.0) - prob)})
        aggs = [F.count(F.lit(1)).alias("n"), F.sum(logistic_loss_col("_y", "_z")).alias("loss")]
        aggs += [F.sum(F.col("_r") * x[i]).alias(f"g{i}") for i in range(p)]
        aggs += [F.sum(F.col("_h") * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in pairs]
        if validate:
            aggs.append(count_invalid(self.features, "_y"))
        row = staged.agg(*aggs).first()
        if validate:
            raise_if_invalid(row["_invalid"])
        hess = np.zeros((p, p))
        for i, j in pairs:
            hess[i, j] = hess[j, i] = row[f"h{i}_{j}"] or 0.0
        return row["n"], row["loss"] or 0.0, np.array([row[f"g{i}"] or 0.0 for i in range(p)]), hess

    def _arrow_pass(self, data: DataFrame, w: np.ndarray, hessian: bool):
        feats, icpt, p = self.features, self.fit_intercept, len(w)

        def batch(cols):
            x = np.column_stack([cols[c].astype(np.float64) for c in feats])
            if icpt:
                x = np.column_stack([np.ones(len(x)), x])
            y, z = cols["_y"].astype(np.float64), x @ w
            e = np.exp(-np.abs(z))
            prob = np.where(z >= 0, 1.0 / (1.0 + e), e / (1.0 + e))
            loss = (np.log1p(e) + np.maximum(z, 0.0) - y * z).sum()
            hess = ((x * (prob * (1.0 - prob))[:, None]).T @ x).reshape(-1) if hessian else np.zeros(0)
            return np.concatenate([[len(y), loss], x.T @ (y - prob), hess])

        v = arrow_sums(data, feats + ["_y"], 2 + p + (p * p if hessian else 0), batch)
        return int(v[0]), float(v[1]), v[2:2 + p], v[2 + p:].reshape(p, p) if hessian else np.zeros((p, p))

    def decision_col(self) -> Column:
        return self._score(self.coef_)

    def predict_proba_col(self) -> Column:
        """The reference's ``predict`` returns this probability."""
        return sigmoid(self.decision_col())
