"""Evaluation and loss aggregates over scored rows.

Each metric is a single aggregate (partial per partition, one row shuffled);
inputs are column names of an already-scored table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """F1 MSE and F5 R² in one pass: R² = 1 - SSE / (n·var_pop(y))."""
    err = _c(y) - _c(yhat)
    agg = df.agg(F.avg(err * err).alias("mse"), F.sum(err * err).alias("sse"),
                 F.var_pop(_c(y)).alias("vy"), F.count(F.lit(1)).alias("n"))
    return agg.select("mse", (F.lit(1.0) - F.col("sse") / (F.col("vy") * F.col("n"))).alias("r2"))


def mean_squared_error(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """F1."""
    err = _c(y) - _c(yhat)
    return df.agg(F.avg(err * err).alias("mse"))


def logistic_loss_col(y: str | Column, z: str | Column) -> Column:
    """Per-row log-loss on a logit, stable form: log(1+e^-|z|) + max(z,0) - y·z."""
    z = _c(z)
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - _c(y) * z


def logistic_terms(y: str | Column, z: str | Column) -> tuple[Column, Column, Column]:
    """F2 per row: loss, gradient p - y and hessian p(1 - p) on a logit."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))
    return logistic_loss_col(y, z), p - _c(y), p * (F.lit(1.0) - p)


def logistic_loss(df: DataFrame, y: str, z: str) -> DataFrame:
    """mean loss, gradient (p - y) and hessian p(1 - p) over logits."""
    loss, gradient, hessian = logistic_terms(y, z)
    return df.agg(F.avg(loss).alias("loss"), F.avg(gradient).alias("gradient"), F.avg(hessian).alias("hessian"))


def hinge_objective(df: DataFrame, y: str, score: str, weights: Sequence[float],
                    C: float = 1.0) -> DataFrame:
    """½‖w‖² + C·mean(max(0, 1 - y·score)) (mean, as the fitted code divides by n)."""
    w = np.asarray(weights, dtype=float)
    reg = 0.5 * float(w @ w)
    hinge = F.avg(F.greatest(F.lit(0.0), F.lit(1.0) - _c(y) * _c(score)))
    return df.agg(hinge.alias("hinge")).select(
        "hinge", (F.lit(reg) + F.lit(float(C)) * F.col("hinge")).alias("objective"))


def accuracy(df: DataFrame, y: str, prediction: str, digits: int | None = None) -> DataFrame:
    """share of rows whose prediction equals the label."""
    acc = F.avg((_c(y) == _c(prediction)).cast("double"))
    if digits is not None:
        acc = F.round(acc, digits)
    return df.agg(acc.alias("accuracy"), F.count(F.lit(1)).alias("n"))


def penalized_objective(df: DataFrame, y: str, yhat: str, weights: Sequence[float],
                        l1: float = 0.0, l2: float = 0.0, norm: float = 0.0) -> DataFrame:
    """half the MSE + l1 x L1 norm + l2 x half the squared L2 norm + norm x the L2 norm
    itself, for a fitted coefficient vector."""
    return penalized_objectives(df, y, yhat, weights, {"": (l1, l2, norm)}).drop("penalty_kind")


def penalized_objectives(df: DataFrame, y: str, yhat: str, weights: Sequence[float],
                         penalties: dict[str, tuple[float, float, float]]) -> DataFrame:
    """F6 for several named penalties (l1, l2, norm) in one pass: penalty_kind, mse, penalty,
    objective."""
    w = np.asarray(weights, dtype=float)
    values = {k: l1 * float(np.abs(w).sum()) + l2 * 0.5 * float(w @ w) + norm * float(np.sqrt(w @ w))
              for k, (l1, l2, norm) in penalties.items()}
    err = _c(y) - _c(yhat)
    rows = F.inline(F.array(*[F.struct(F.lit(k).alias("penalty_kind"), F.lit(v).alias("penalty"))
                              for k, v in values.items()]))
    out = df.agg(F.avg(err * err).alias("mse")).select("mse", rows)
    return out.select("penalty_kind", "mse", "penalty", (F.lit(0.5) * F.col("mse") + F.col("penalty")).alias("objective"))
