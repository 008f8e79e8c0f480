"""G5 Gaussian naive Bayes and G6 linear discriminant analysis.

Fit = one grouped aggregate per class (E7 + E8 / E9 + E10); the K x p model is
collected (bounded by the class count) and scoring is a pure projection with
the parameters as literals: no join, no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.activations import log_softmax
from ..functions.arrow_scores import append_scores, is_wide
from ..functions.linalg import argmax_index, dot, pick, total
from ..operators import moments
from ..sources.validate import raise_if_invalid
from .base import ModelTable, collect_bounded


def _check_priors(priors, k: int) -> np.ndarray:
    pr = np.asarray(priors, dtype=float)
    if pr.shape != (k,):
        raise ValueError(f"priors must have length {k}, got {pr.shape}")
    if not math.isclose(pr.sum(), 1.0, rel_tol=0, abs_tol=1e-9):
        raise ValueError(f"priors must sum to 1, got {pr.sum()}")
    if (pr < 0).any():
        raise ValueError("priors must be non-negative")
    return pr


def _plain(classes: list) -> list:
    """Class labels as JSON holds them: integers, strings, floats."""
    return [c.item() if isinstance(c, np.generic) else c for c in classes]


class _ClassScorer:
    classes: list
    features: list[str]

    def joint_log_likelihood(self) -> list[Column]:
        raise NotImplementedError

    def transform(self, df: DataFrame, prediction: str = "prediction",
                  probability: str | None = "probability") -> DataFrame:
        """Append the predicted class (lowest class wins ties) and its probability."""
        # class scores are projected once; argmax and softmax then read columns
        k = len(self.classes)
        names = [f"_jll{j}" for j in range(k)]
        if is_wide(len(self.features), k):
            scored = append_scores(df, self.features, names, self.np_joint_log_likelihood)
        else:
            scored = df.select("*", *[c.alias(n) for c, n in zip(self.joint_log_likelihood(), names)])
        jll = [F.col(n) for n in names]
        out = scored.withColumn(prediction, pick(self.classes, argmax_index(jll)))
        if probability:
            # the top class has probability 1 / Σ exp(s_j - max s)
            mx = F.greatest(*jll) if k > 1 else jll[0]
            out = out.withColumn(probability, F.lit(1.0) / total([F.exp(c - mx) for c in jll]))
        return out.drop(*names)

    def probability_columns(self, prefix: str = "p_") -> list[Column]:
        return [F.exp(c).alias(f"{prefix}{k}") for k, c in zip(self.classes,
                                                              log_softmax(self.joint_log_likelihood()))]


class GaussianNB(_ClassScorer):
    """Log prior + Σ_i log N(x_i; θ_ki, σ²_ki); variance floor var_smoothing."""

    def __init__(self, priors: Sequence[float] | None = None, var_smoothing: float = 1e-9):
        self.priors = priors
        self.var_smoothing = var_smoothing

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "GaussianNB":
        self.features = list(features)
        stats = moments.class_gaussian_params(df, self.features, label, self.var_smoothing)
        rows = collect_bounded(stats, "naive Bayes classes")
        raise_if_invalid(sum(r["_invalid"] for r in rows))
        rows = sorted(rows, key=lambda r: r[label])
        if not rows:
            raise ValueError("cannot fit on an empty table")
        p = len(self.features)
        self.classes = [r[label] for r in rows]
        counts = np.array([r["n"] for r in rows], dtype=float)
        self.theta = np.array([[r[f"theta_{i}"] for i in range(p)] for r in rows])
        self.var = np.array([[r[f"var_{i}"] for i in range(p)] for r in rows])
        self.class_prior = (counts / counts.sum() if self.priors is None
                            else _check_priors(self.priors, len(rows)))
        return self

    def np_joint_log_likelihood(self, x: np.ndarray) -> np.ndarray:
        const = np.log(self.class_prior) - 0.5 * np.log(2.0 * math.pi * self.var).sum(axis=1)
        out = np.empty((x.shape[0], len(self.classes)))
        for k in range(len(self.classes)):
            d = x - self.theta[k]
            out[:, k] = const[k] - 0.5 * (d * d / self.var[k]).sum(axis=1)
        return out

    def joint_log_likelihood(self) -> list[Column]:
        out = []
        for k in range(len(self.classes)):
            const = math.log(self.class_prior[k]) - 0.5 * float(
                np.sum(np.log(2.0 * math.pi * self.var[k])))
            terms = []
            for i, c in enumerate(self.features):
                d = F.col(c) - F.lit(float(self.theta[k, i]))
                terms.append(d * d * F.lit(-0.5 / float(self.var[k, i])))
            out.append(total(terms) + F.lit(const))
        return out

    def model_table(self) -> ModelTable:
        return ModelTable("gaussian_nb", {"theta": self.theta, "var": self.var,
                                          "prior": self.class_prior},
                          {"features": self.features, "classes": _plain(self.classes)})

    @classmethod
    def from_table(cls, table: ModelTable) -> "GaussianNB":
        model = cls()
        model.features, model.classes = table.meta["features"], table.meta["classes"]
        model.theta, model.var, model.class_prior = (table.params[k] for k in ("theta", "var", "prior"))
        return model


class LinearDiscriminantAnalysis(_ClassScorer):
    """Shared-covariance Gaussian classes.

    coef_k = Σ⁻¹ μ_k, intercept_k = -½ μ_kᵀ Σ⁻¹ μ_k + ln π_k, with Σ the
    prior-weighted sum of per-class (n_k - 1) covariances. ``tol`` is the
    relative singular-value cutoff of the pseudo-inverse.
    """

    def __init__(self, priors: Sequence[float] | None = None, tol: float = 1e-4):
        self.priors = priors
        self.tol = tol

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "LinearDiscriminantAnalysis":
        self.features = list(features)
        p = len(self.features)
        blocks = collect_bounded(moments.co_moments(df, self.features, label), "LDA classes")  # the only scan
        raise_if_invalid(sum(r["bad"] for r in blocks))
        means = sorted(blocks, key=lambda r: r[label])
        if not means:
            raise ValueError("cannot fit on an empty table")
        self.classes = [r[label] for r in means]
        counts = np.array([r["n"] for r in means], dtype=float)
        if (counts < 2).any():
            raise ValueError("every class needs at least two rows for its covariance")
        mu = np.array([r["mean"] for r in means])
        cov = sum(r["n"] / counts.sum() * np.array(r["co"]).reshape(p, p) / (r["n"] - 1) for r in means)
        self.class_prior = (counts / counts.sum() if self.priors is None
                            else _check_priors(self.priors, len(means)))
        inv = np.linalg.pinv(cov, rcond=self.tol)
        self.means, self.covariance = mu, cov
        self.coef = mu @ inv
        self.intercept = -0.5 * np.einsum("kp,kp->k", mu @ inv, mu) + np.log(self.class_prior)
        return self

    def joint_log_likelihood(self) -> list[Column]:
        return [dot(self.features, self.coef[k], float(self.intercept[k]))
                for k in range(len(self.classes))]

    decision_function = joint_log_likelihood

    def np_joint_log_likelihood(self, x: np.ndarray) -> np.ndarray:
        return x @ self.coef.T + self.intercept

    def model_table(self) -> ModelTable:
        return ModelTable("lda", {"coef": self.coef, "intercept": self.intercept},
                          {"features": self.features, "classes": _plain(self.classes)})

    @classmethod
    def from_table(cls, table: ModelTable) -> "LinearDiscriminantAnalysis":
        model = cls()
        model.features, model.classes = table.meta["features"], table.meta["classes"]
        model.coef, model.intercept = table.params["coef"], table.params["intercept"]
        return model
