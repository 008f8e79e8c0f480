"""Exact k-nearest-neighbour classifier (lazy learner).

``fit`` keeps the training table (the model *is* the data); ``predict`` runs
the exact pruned top-k search (D7) and the label vote (E13) as Spark jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import pairwise


class KNNClassifier:
    def __init__(self, n_neighbors: int = 3, block_rows: int | None = None):
        if n_neighbors < 1:
            raise ValueError("n_neighbors must be positive")
        self.k, self.block_rows = n_neighbors, block_rows

    def fit(self, train: DataFrame, id_col: str, features: Sequence[str] | str, label: str) -> "KNNClassifier":
        self.id_col, self.label = id_col, label
        self.features = features
        self.train = self._vectors(train, id_col, features).withColumn(label, F.col(label))
        return self

    @staticmethod
    def _vectors(df: DataFrame, id_col: str, features) -> DataFrame:
        if isinstance(features, str):
            vec = F.col(features).cast("array<double>")
        else:
            vec = F.array(*[F.col(c).cast("double") for c in features])
        return df.select("*", vec.alias("_features"))

    def kneighbors(self, test: DataFrame, id_col: str | None = None, exclude_self: bool = False) -> DataFrame:
        """(query id, rank, neighbor, distance, neighbor label) for the k nearest rows."""
        qid = id_col or self.id_col
        q = self._vectors(test, qid, self.features)
        train = self.train.select(F.col(self.id_col).alias("_tid"), "_features", self.label)
        return pairwise.knn_pairs(q, train, qid, "_tid", "_features", self.k, exclude_self=exclude_self,
                                  block_rows=self.block_rows, carry=self.label)

    def predict(self, test: DataFrame, id_col: str | None = None, exclude_self: bool = False) -> DataFrame:
        """(query id, prediction): majority label of the k neighbours, ties to the smallest."""
        qid = id_col or self.id_col
        return pairwise.knn_vote(self.kneighbors(test, qid, exclude_self), qid, self.label)
