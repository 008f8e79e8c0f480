"""Shared model plumbing: small model tables, collection bounds, persistence (A5)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_CLASSES = 10_000
#: Numbers that a model table may hold.
MAX_MODEL_CELLS = 10_000_000


def collect_bounded(df: DataFrame, what: str, limit: int = MAX_CLASSES) -> list:
    """Collect a table whose row count is bounded by the model (classes, clusters).

    ``limit + 1`` rows are fetched so an unexpectedly large table fails fast
    instead of flooding the driver.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; refusing to collect")
    return rows


@dataclass
class ModelTable:
    """A fitted model as named parameter arrays plus metadata (names, classes of any JSON type).

    ``to_frame`` gives the long table ``(param, index, value)``; ``save`` /
    ``load`` write it as Parquet so fitted models outlive the session.
    """

    kind: str
    params: dict[str, np.ndarray]
    meta: dict = field(default_factory=dict)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        for name, arr in self.params.items():
            a = np.asarray(arr, dtype=float)
            for idx in np.ndindex(a.shape):
                rows.append((name, list(map(int, idx)), float(a[idx])))
        return spark.createDataFrame(rows, "param string, index array<int>, value double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_frame(spark).withColumn(
            "meta", F.lit(json.dumps({"kind": self.kind, **self.meta,
                                      "shapes": {k: list(np.shape(v))
                                                 for k, v in self.params.items()}}))).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ModelTable":
        rows = collect_bounded(spark.read.parquet(path), "model table", MAX_MODEL_CELLS)
        if not rows:
            raise ValueError(f"empty model table at {path}")
        meta = json.loads(rows[0]["meta"])
        shapes = meta.pop("shapes")
        kind = meta.pop("kind")
        params = {k: np.zeros(tuple(s)) for k, s in shapes.items()}
        for r in rows:
            params[r["param"]][tuple(r["index"])] = r["value"]
        return cls(kind, params, meta)
