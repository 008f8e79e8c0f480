"""Multivariate Gaussian log-density as a generated expression.

The covariance is factored once on the driver (inverse and log-determinant);
each row then costs p² multiply-adds of literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .linalg import col_list, total


def gaussian_logpdf(cols: Sequence[str | Column], mean: Sequence[float], cov: np.ndarray,
                    ridge: float = 0.0) -> Column:
    x = col_list(cols)
    p = len(x)
    cov = np.asarray(cov, dtype=float) + ridge * np.eye(p)
    sign, logdet = np.linalg.slogdet(cov)
    if sign <= 0:
        raise ValueError("covariance is not positive definite")
    prec = np.linalg.inv(cov)
    d = [xi - F.lit(float(m)) for xi, m in zip(x, mean)]
    quad = []
    for i in range(p):
        quad.append(d[i] * d[i] * F.lit(float(prec[i, i])))
        for j in range(i + 1, p):
            quad.append(d[i] * d[j] * F.lit(float(2.0 * prec[i, j])))
    const = -0.5 * (p * math.log(2.0 * math.pi) + logdet)
    return F.lit(const) - F.lit(0.5) * total(quad)
