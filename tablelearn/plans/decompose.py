"""G18 PCA (with B8 centring, B10 projection, B11 reconstruction, E15 variance).

Fit = one tree QR of the rows beside a column of ones, which leaves the triangle of the
centred rows in its lower right; its SVD on the driver gives components and variances without
forming a covariance, whose condition number would be squared. Components are flipped so
that the largest-magnitude loading of each is positive. Transform centres
(unlike the reference's ``transform``, which forgot to) and is a projection
with the components as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrow_scores import append_scores, is_wide
from ..functions.linalg import dot
from ..operators.tree_qr import tree_qr


class PCA:
    def __init__(self, n_components: int | None = 2):
        self.n_components = n_components

    def fit(self, df: DataFrame, features: Sequence[str]) -> "PCA":
        self.features = list(features)
        p = len(self.features)
        k = p if self.n_components is None else self.n_components
        if not 0 < k <= p:
            raise ValueError(f"n_components={k} must be between 1 and {p}")
        n, r = tree_qr(df, self.features)
        if n < 2:
            raise ValueError("PCA needs at least two rows")
        if k > n:
            raise ValueError(f"n_components={k} exceeds the row count {n}")
        self.mean_ = r[0, 1:] / r[0, 0]
        _, sizes, vecs = np.linalg.svd(r[1:, 1:])
        vals = sizes ** 2 / (n - 1)
        signs = np.sign(vecs[np.arange(p), np.argmax(np.abs(vecs), axis=1)])
        signs[signs == 0] = 1.0
        vecs = vecs * signs[:, None]
        self.explained_variance_ = vals
        total = vals.sum()
        self.explained_variance_ratio_ = vals / total if total > 0 else np.zeros(p)
        self.components_ = vecs[:k]
        self.covariance_ = r[1:, 1:].T @ r[1:, 1:] / (n - 1)
        return self

    def fit_transform(self, df: DataFrame, features: Sequence[str], prefix: str = "z") -> DataFrame:
        return self.fit(df, features).transform(df, prefix)

    def inverse_transform(self, df: DataFrame, zcols: Sequence[str], prefix: str = "r") -> DataFrame:
        return self.reconstruct(df, zcols, prefix)

    def center_cols(self) -> list[Column]:
        """X - mean."""
        return [F.col(c) - F.lit(float(m)) for c, m in zip(self.features, self.mean_)]

    def project_cols(self, prefix: str = "z") -> list[Column]:
        """(x - mean)·Vᵀ."""
        centred = self.center_cols()
        return [dot(centred, v).alias(f"{prefix}{i + 1}") for i, v in enumerate(self.components_)]

    def transform(self, df: DataFrame, prefix: str = "z") -> DataFrame:
        """B10 as columns z1..zk: generated dot products while small, one NumPy
        matrix product per Arrow batch for wide inputs (many features x components)."""
        k = len(self.components_)
        if is_wide(len(self.features), k):
            mean, comps = self.mean_, self.components_
            return append_scores(df, self.features, [f"{prefix}{i + 1}" for i in range(k)],
                                 lambda x: (x - mean) @ comps.T)
        return df.select("*", *self.project_cols(prefix))

    def reconstruct(self, df: DataFrame, zcols: Sequence[str], prefix: str = "r") -> DataFrame:
        """B11 at any width: ``df`` plus the columns r1..rp."""
        if len(zcols) != len(self.components_):
            raise ValueError("need one score column per component")
        p, mean, comps = len(self.features), self.mean_, self.components_
        if is_wide(len(zcols), p):
            return append_scores(df, list(zcols), [f"{prefix}{j + 1}" for j in range(p)], lambda z: z @ comps + mean)
        return df.select("*", *self.reconstruct_cols(zcols, prefix))

    def residuals(self, df: DataFrame, out: str = "residual") -> DataFrame:
        """``df`` plus the squared distance of every row to the components' subspace."""
        mean, comps = self.mean_, self.components_

        def left(x: np.ndarray) -> np.ndarray:
            d = x - mean
            return ((d - (d @ comps.T) @ comps) ** 2).sum(axis=1, keepdims=True)

        return append_scores(df, self.features, [out], left)

    def reconstruct_cols(self, zcols: Sequence[str], prefix: str = "r") -> list[Column]:
        """Z·V + mean."""
        if len(zcols) != len(self.components_):
            raise ValueError("need one score column per component")
        return [dot(zcols, self.components_[:, j], float(self.mean_[j])).alias(f"{prefix}{j + 1}")
                for j in range(len(self.features))]
