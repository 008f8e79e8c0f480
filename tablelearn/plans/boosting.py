"""G11 second-order boosted tree and G12 multiclass boosting.

Each round: softmax of the current logits z gives p; gradient G = p - y and
hessian H = p(1 - p) per class are columns; one vector-leaf tree is grown on
(G, H) with the Newton gain (lambda = 0, Chen & Guestrin 2016), and
z <- z - lr G_leaf / H_leaf.

Rows carry no state between rounds. The table of features and labels is persisted once; a
round walks every row down the trees grown so far (arrays, map-only) to its logits, gradients
and hessians, so a lost executor costs its partitions of that table and nothing of earlier
rounds, and no lineage grows. From ``state_every`` trees on, the logits reached so far are
written to the checkpoint folder once each ``state_every`` rounds, and rounds walk only the
trees since: the work of a round stays bounded at any number of rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.activations import log_softmax
from ..functions.arrow_scores import append_scores
from ..functions.linalg import argmax_index, pick
from ..session import ensure_checkpoint_dir
from .trees import NewtonGain, TreeGrower, TreeModel, _features


def boosted_tree(df: DataFrame, features: Sequence[str], grads: Sequence[str], hess: Sequence[str],
                 max_depth: int = 2, min_samples_split: int = 2, min_impurity: float = 1e-7,
                 **kw) -> TreeModel:
    """One tree on gradient/hessian columns; leaves are G/H vectors."""
    return TreeGrower(NewtonGain(grads, hess), max_depth=max_depth, min_samples_split=min_samples_split,
                      min_impurity=min_impurity, **kw).fit(df, features)


TIE_DIGITS = 10


class GradientBoostingClassifier:
    def __init__(self, n_estimators: int = 200, learning_rate: float = 1e-3, max_depth: float | None = 2,
                 min_samples_split: int = 2, min_impurity: float = 1e-7, state_every: int = 50,
                 max_bins: int | None = None, small_rows: int | None = None):
        self.max_bins, self.small_rows = max_bins, small_rows
        self.n_estimators, self.lr, self.max_depth = n_estimators, learning_rate, max_depth
        self.min_split, self.min_impurity = min_samples_split, min_impurity
        self.state_every = state_every

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "GradientBoostingClassifier":
        from ..operators.features import dictionary

        self.features = list(features)
        self.classes = dictionary(df, label)
        k = len(self.classes)
        ensure_checkpoint_dir(df.sparkSession)
        which = F.array_position(F.array(*[F.lit(c) for c in self.classes]), F.col(label)) - 1
        data = df.select(*[F.col(c).cast("double").alias(c) for c in self.features],
                         F.when(F.col(label).isNotNull(), which).cast("int").alias("_y"),
                         F.array_repeat(F.lit(0.0), k).alias("_z")).persist(StorageLevel.MEMORY_AND_DISK)
        self.trees: list[TreeModel] = []
        edges: dict = {}  # the features stay as they are from round to round
        since = 0  # trees that the rows' logits do not hold yet
        try:
            for _ in range(self.n_estimators):
                names = [f"_g{j}" for j in range(k)], [f"_h{j}" for j in range(k)]
                gh = self._gradients(data, self.trees[len(self.trees) - since:], *names)
                tree = boosted_tree(gh, self.features, *names, self.max_depth, self.min_split, self.min_impurity,
                                    max_bins=self.max_bins, small_rows=self.small_rows, edges=edges)
                self.trees.append(tree)
                since += 1
                if since == self.state_every and len(self.trees) < self.n_estimators:
                    new = self._advance(data, self.trees[-since:]).checkpoint(eager=True)
                    data.unpersist()
                    data, since = new, 0
        finally:
            data.unpersist()
        return self

    def _tables(self, trees: list[TreeModel]) -> list[tuple]:
        k = len(self.classes)
        return [(a := t.arrays(), np.array([t.nodes[i].get("value", [0.0] * k) for i in a.ids])) for t in trees]

    def _logits(self, trees: list[TreeModel]):
        """x, z -> the logits after some more trees."""
        tables, lr = self._tables(trees), self.lr

        def add(x: np.ndarray, z: np.ndarray) -> np.ndarray:
            z = z.copy()
            for tree, values in tables:
                z -= lr * values[tree.walk(x)]
            return z
        return add

    def _advance(self, data: DataFrame, trees: list[TreeModel]) -> DataFrame:
        add, features, k = self._logits(trees), self.features, len(self.classes)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields)

        def run(batches):
            for b in batches:
                z = add(_features(b, features), b.column("_z").flatten().to_numpy().reshape(-1, k))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(list(z), pa.list_(pa.float64()))], b.schema.names)

        return data.mapInArrow(run, schema)

    def _gradients(self, data: DataFrame, trees: list[TreeModel], grads: list[str], hess: list[str]) -> DataFrame:
        """The features with gradient and hessian of every class at the present logits."""
        add, features, k = self._logits(trees), self.features, len(self.classes)
        schema = ", ".join([f"`{c}` double" for c in [*features, *grads, *hess]])

        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                z = add(_features(b, features), b.column("_z").flatten().to_numpy().reshape(-1, k))
                e = np.exp(z - z.max(axis=1, keepdims=True))
                p = e / e.sum(axis=1, keepdims=True)
                y = np.array([-1 if v is None else v for v in b.column("_y").to_pylist()])
                g = p - (y[:, None] == np.arange(k))
                g[y < 0] = np.nan  # counted as invalid by the tree's own first aggregate
                h = p * (1.0 - p)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in features), *(pa.array(m[:, j]) for m in (g, h) for j in range(k))],
                    [*features, *grads, *hess])

        return data.mapInArrow(run, schema)

    def with_logits(self, df: DataFrame, prefix: str = "_logit") -> DataFrame:
        """``df`` plus one logit column per class (``{prefix}0`` ...), for any number of
        trees: every tree is routed once per Arrow batch, map-only. A NULL feature gives
        NULL logits, at every number of trees."""
        k, add = len(self.classes), self._logits(self.trees)

        def score(x: np.ndarray) -> np.ndarray:
            return add(x, np.zeros((len(x), k)))

        return append_scores(df, self.features, [f"{prefix}{j}" for j in range(k)], score)

    def transform(self, df: DataFrame, out: str = "prediction", tie_digits: int = TIE_DIGITS) -> DataFrame:
        """``df`` plus the predicted class, with the tie rule of ``predict_col``."""
        names = [f"_logit{j}" for j in range(len(self.classes))]
        best = argmax_index([F.round(F.col(c), tie_digits) for c in names])
        known = F.when(F.col(names[0]).isNotNull(), best)
        return self.with_logits(df).withColumn(out, pick(self.classes, known)).drop(*names)

    def logit_cols(self, n_trees: int | None = None) -> list[Column]:
        """The logits as expressions, for few small trees; ``with_logits`` takes any number."""
        trees = self.trees if n_trees is None else self.trees[:n_trees]
        out = []
        for j in range(len(self.classes)):
            z = F.lit(0.0)
            for t in trees:
                z = z - F.lit(self.lr) * t.value_col(j)
            out.append(z)
        return out

    def predict_col(self, tie_digits: int = TIE_DIGITS) -> Column:
        """Softmax is monotone, so the class is the argmax of the logits.

        Logits are compared after rounding: classes with equal gradient sums
        get mathematically equal logits, and the lowest class must win such a
        tie rather than the last bit of a floating-point sum.
        """
        return pick(self.classes, argmax_index([F.round(z, tie_digits) for z in self.logit_cols()]))

    def predict_proba(self, df: DataFrame, prefix: str = "probability_") -> DataFrame:
        """``df`` plus every class's probability (``{prefix}0`` ...), for any number of trees:
        all trees are walked and the softmax taken once per Arrow batch, map-only."""
        k, add = len(self.classes), self._logits(self.trees)

        def score(x: np.ndarray) -> np.ndarray:
            z = add(x, np.zeros((len(x), k)))
            e = np.exp(z - z.max(axis=1, keepdims=True))
            return e / e.sum(axis=1, keepdims=True)

        return append_scores(df, self.features, [f"{prefix}{j}" for j in range(k)], score)

    def log_loss(self, df: DataFrame, label: str) -> float:
        """Mean cross-entropy of the fitted ensemble on ``df``."""
        df = self.with_logits(df.select(*dict.fromkeys([*self.features, label])))
        logp = log_softmax([F.col(f"_logit{j}") for j in range(len(self.classes))])
        ce = F.lit(0.0)
        for j, c in enumerate(self.classes):
            ce = ce - F.when(F.col(label) == F.lit(c), logp[j]).otherwise(F.lit(0.0))
        return df.agg(F.avg(ce)).first()[0]
