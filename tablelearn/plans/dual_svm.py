"""The soft-margin SVM solved in its dual, with a duality-gap certificate.

    min |w|^2/2 + C sum max(0, 1 - y (w.x + b))   over w and a free b
    max sum a - |sum a y x|^2/2                   over 0 <= a <= C with sum a y = 0

The dual variables are row state. A round is one job: every task walks its rows block by
block (an Arrow batch, a few sweeps each) by exact coordinate steps against the shared w and
its own changes, and the changes of all tasks are added with the step length that maximises
the dual along them. The dual is quadratic along that line, so the length is closed form, and
a round can never lower the dual however many tasks disagree (safe aggregation); convex
combinations stay in the box.

The equality constraint is the multiplier of the free bias: rows see a constant feature of
squared size rho, and each round moves b by rho x (sum a y) (the method of multipliers). For
the certificate the variables of the heavier class are scaled down until sum a y = 0, which
gives a feasible dual point from sums that the round collects anyway; the primal value of the
previous w, at the best of some values of b around the current one, comes from the same pass.
Features are centred, which a free bias absorbs. Multiclass trains all one-vs-rest problems in
the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.linalg import argmax_index, dot, pick
from ..operators.features import dictionary
from ..session import ensure_checkpoint_dir
from ..sources.validate import assert_finite


#: Squared size of the constant feature, as a share of the rows' mean squared size.
BIAS_SHARE = 0.02
#: Values of the bias tried for the primal bound in a pass.
BIAS_TRIALS = 33


def _rows(b: pa.RecordBatch, name: str, k: int) -> np.ndarray:
    return b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def sweep(x: np.ndarray, y: np.ndarray, a: np.ndarray, w: np.ndarray, s: np.ndarray, b: np.ndarray, c: float, rho: float,
          sweeps: int, order: np.ndarray) -> None:
    """Exact coordinate steps over a block, all problems side by side; changes a, w and s."""
    size = np.einsum("ij,ij->i", x, x) + rho
    for _ in range(sweeps):
        for i in order:
            if size[i] <= 0.0:
                continue
            slope = 1.0 - y[i] * (w @ x[i] + rho * s + b)
            step = np.clip(a[i] + slope / size[i], 0.0, c) - a[i]
            if step.any():
                a[i] += step
                signed = step * y[i]
                w += signed[:, None] * x[i]
                s += signed


class DualSVM:
    """Soft-margin SVM, binary or one-vs-rest. Stops when the relative duality gap of every
    problem is at most ``tol``, or after ``max_iter`` rounds (``gap_`` tells)."""

    def __init__(self, C: float = 1.0, tol: float = 1e-3, max_iter: int = 300, sweeps: int = 3, checkpoint_interval: int = 10,
                 seed: int = 0):
        self.C, self.tol, self.max_iter, self.sweeps, self.seed = C, tol, max_iter, sweeps, seed
        self.checkpoint_interval = checkpoint_interval

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "DualSVM":
        ensure_checkpoint_dir(df.sparkSession)
        self.features = feats = list(features)
        n = assert_finite(df, feats, label)
        if not n:
            raise ValueError("cannot fit on an empty table")
        self.classes = dictionary(df, label)
        if len(self.classes) < 2:
            raise ValueError("need at least two classes")
        pos = [self.classes[1]] if len(self.classes) == 2 else self.classes
        k, p, c = len(pos), len(feats), float(self.C)
        ys = F.array(*[F.when(F.col(label) == F.lit(v), 1.0).otherwise(-1.0) for v in pos])
        zeros = F.array_repeat(F.lit(0.0), k)
        stats = df.agg(*[F.avg(f) for f in feats], *[F.var_pop(f) for f in feats]).first()
        centre = np.array(stats[:p], float)
        rho = BIAS_SHARE * float(sum(stats[p:])) or 1.0
        rows = df.select(F.array(*[F.col(f).cast("double") - F.lit(float(m)) for f, m in zip(feats, centre)]).alias("x"),
                         ys.alias("y"), zeros.alias("a"), zeros.alias("d")).persist(StorageLevel.MEMORY_AND_DISK)
        # sums a by sign, sums a y x by sign: all that the certificate needs
        sa, wa = np.zeros((2, k)), np.zeros((2, k, p))
        b, gamma = np.zeros(k), np.zeros(k)
        self.primal_, self.dual_ = np.full(k, np.inf), np.full(k, -np.inf)
        self.coef_, self.intercept_ = np.zeros((k, p)), np.zeros(k)
        self.n_iter_, self.history_ = 0, []
        try:
            for t in range(self.max_iter + 1):
                w, s = wa.sum(axis=0), sa[0] - sa[1]
                last = t == self.max_iter
                step = self._round(rows, w, s, b, gamma, rho, c, k, p, t)
                if self.checkpoint_interval and t % self.checkpoint_interval == self.checkpoint_interval - 1:
                    step = step.checkpoint(eager=True)
                else:
                    step = step.persist(StorageLevel.MEMORY_AND_DISK)
                shifts = 2.0 / np.sqrt(t + 1.0) * np.linspace(-1.0, 1.0, BIAS_TRIALS)
                hinge, dsa, dwa = self._sums(step, w, b, shifts, k, p)
                rows.unpersist()
                rows = step
                at = hinge.argmin(axis=0)
                self._certify(w, b + shifts[at], hinge[at, np.arange(k)], sa, wa, c)
                self.history_.append(float(self.gap_.max()))
                if last or (self.gap_ <= self.tol).all():
                    break
                # the best common step along the changes: the augmented dual is quadratic in it
                dw, ds = dwa.sum(axis=0), dsa[0] - dsa[1]
                rise = dsa.sum(axis=0) - (w * dw).sum(axis=1) - (rho * s + b) * ds
                bend = (dw * dw).sum(axis=1) + rho * ds * ds
                gamma = np.where(bend > 0.0, np.clip(rise / np.where(bend > 0.0, bend, 1.0), 0.0, 1.0), 1.0)
                sa, wa = sa + gamma * dsa, wa + gamma[None, :, None] * dwa
                b = b + rho * (sa[0] - sa[1])
                self.n_iter_ = t + 1
        finally:
            rows.unpersist()
        self.n_, self.k_ = n, k
        self.intercept_ = self.intercept_ - self.coef_ @ centre
        return self

    def _round(self, rows: DataFrame, w, s, b, gamma, rho, c, k, p, t) -> DataFrame:
        """Rows with the variables of the last round put together and this round's changes."""
        sweeps, seed = self.sweeps, self.seed

        def run(batches):
            from pyspark import TaskContext

            rng = np.random.default_rng((seed, t, TaskContext.get().partitionId()))
            mine_w, mine_s = w.copy(), s.copy()
            for batch in batches:
                x, y = _rows(batch, "x", p), _rows(batch, "y", k)
                a = np.clip(_rows(batch, "a", k) + gamma * _rows(batch, "d", k), 0.0, c)
                new = a.copy()
                sweep(x, y, new, mine_w, mine_s, b, c, rho, sweeps, rng.permutation(len(x)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("x"), batch.column("y"), pa.array(list(a), pa.list_(pa.float64())),
                     pa.array(list(new - a), pa.list_(pa.float64()))], ["x", "y", "a", "d"])

        return rows.mapInArrow(run, "x array<double>, y array<double>, a array<double>, d array<double>")

    @staticmethod
    def _sums(rows: DataFrame, w, b, shifts, k, p):
        """The hinge sums at w and each shifted b, and the changes' sums by sign, in one pass."""
        def run(batches):
            hinge, sa, wa = np.zeros((len(shifts), k)), np.zeros((2, k)), np.zeros((2, k, p))
            for batch in batches:
                x, y, d = _rows(batch, "x", p), _rows(batch, "y", k), _rows(batch, "d", k)
                score = x @ w.T + b
                for g, shift in enumerate(shifts):
                    hinge[g] += np.maximum(0.0, 1.0 - y * (score + shift)).sum(axis=0)
                for side, sign in enumerate((1.0, -1.0)):
                    part = np.where(y == sign, d, 0.0)
                    sa[side] += part.sum(axis=0)
                    wa[side] += sign * part.T @ x
            values = np.concatenate([hinge.reshape(-1), sa.reshape(-1), wa.reshape(-1)])
            yield pa.RecordBatch.from_pydict({"slot": np.arange(len(values), dtype=np.int32), "value": values})

        m = len(shifts) * k
        out = np.zeros(m + 2 * k + 2 * k * p)
        for r in rows.mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("v")).collect():
            out[r["slot"]] = r["v"]
        return out[:m].reshape(-1, k), out[m:m + 2 * k].reshape(2, k), out[m + 2 * k:].reshape(2, k, p)

    def _certify(self, w, b, hinge, sa, wa, c) -> None:
        primal = 0.5 * (w * w).sum(axis=1) + c * hinge
        better = primal < self.primal_
        self.coef_ = np.where(better[:, None], w, self.coef_)
        self.intercept_ = np.where(better, b, self.intercept_)
        self.primal_ = np.minimum(primal, self.primal_)
        # scale the heavier side until the sides are equal
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(sa > 0.0, np.minimum(1.0, sa[::-1] / sa), 0.0)
        feasible = (scale[:, :, None] * wa).sum(axis=0)
        self.dual_ = np.maximum(self.dual_, (scale * sa).sum(axis=0) - 0.5 * (feasible * feasible).sum(axis=1))
        self.gap_ = (self.primal_ - self.dual_) / np.maximum(np.abs(self.primal_), 1e-12)

    # ------------------------------------------------------------------ scoring
    def decision_cols(self) -> list[Column]:
        """One score a class (two classes: the second one's), a projection."""
        return [dot(self.features, self.coef_[j], float(self.intercept_[j])) for j in range(self.k_)]

    def predict_col(self) -> Column:
        cols = self.decision_cols()
        if self.k_ == 1:
            return F.when(cols[0] >= 0.0, F.lit(self.classes[1])).otherwise(F.lit(self.classes[0]))
        return pick(self.classes, argmax_index(cols))
