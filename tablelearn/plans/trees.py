"""Exact decision trees of any depth, and boosting.

A node is split on the feature/cutoff with the largest impurity gain, over
every distinct value of every feature, ``x >= cutoff`` going left (first
maximum in feature, then cutoff order). The frontier of open nodes has two
kinds of members:

* *Large* nodes (more than ``small_rows`` rows) share one pass a level: each feature's values
  are cut into ranges of about ``target_window_rows`` rows (edges from a sample; they decide
  where work is done, not what is found), and tasks send each (feature, range) its values and
  additive statistics as arrays, equal values of a node added up (a dominant value is one row a
  task). One task sorts a range; suffix sums over the ranges' totals
  (:mod:`..operators.prefix`) say what lies to its left, node totals the rest, so every
  distinct value's gain is exact. ``max_by`` per node picks the split with its left statistics,
  so children's totals are known without another pass. Rows move to children
  through a broadcast of the level's splits (one row a large node).
* *Small* nodes are finished whole, to any depth, inside one grouped task that
  holds their at most ``small_rows`` rows and returns the subtree as arrays.

Rows with equal features always travel together: where the table has at most half as many
different feature rows as rows, their statistics are added up first.

So the number of jobs grows with the logarithm of the table over ``small_rows``
and not with the depth of the tree. Scoring walks all rows of an Arrow batch
down the arrays together: one map-only pass at any depth. Trees beyond
``MAX_DRIVER_NODES`` stay a table of subtrees and are scored by a co-grouped
join on the small node a row falls into. Node ids are heap ids: children of i
are 2i (left) and 2i+1 (right). Gains are compared after rounding to 12
decimals so floating-point noise cannot pick between equal splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrow_scores import null_rows
from ..operators.prefix import suffix_sums
from ..sources.validate import count_invalid, raise_if_invalid
from ..session import ensure_checkpoint_dir

MAX_BROADCAST_NODES = 1_000_000
#: Nodes held by the driver and sent to every task; larger trees stay a table.
MAX_DRIVER_NODES = 1_000_000
#: Nodes of a tree that may become one CASE expression.
MAX_CASE_NODES = 255
#: rows x (features + statistics) of the task that finishes a small node
SMALL_CELLS = 4_000_000
#: rows x features x statistics compared at once
SPLIT_CELLS = 1_000_000
#: rows of the sample that sets the ranges of the features' values
EDGE_ROWS = 20_000
GAIN_DIGITS = 12


def sql_double(x: float) -> str:
    """An exact DOUBLE literal for generated Spark SQL (repr round-trips)."""
    x = float(x)
    if x != x or x in (float("inf"), float("-inf")):
        return f"CAST('{x}' AS DOUBLE)"
    return f"{x!r}D"


def _q(name: str) -> str:
    return f"`{name}`"


def _xlnx(c: str) -> str:
    return f"(CASE WHEN {c} > 0 THEN {c} * ln({c}) ELSE 0D END)"


def _sum(terms: Sequence[str]) -> str:
    return "(" + " + ".join(terms) + ")"


class Criterion:
    """Additive per-row statistics, a split gain over (total, left, right)
    statistics, and a leaf value from the total statistics.

    Gains are generated as one Spark SQL expression over statistic columns
    (a single ``F.expr`` call instead of hundreds of Column constructions).
    """

    n_stats: int

    def row_stats(self) -> list[Column]:
        raise NotImplementedError

    def gain(self, t: list[str], l: list[str], r: list[str]) -> str:
        raise NotImplementedError

    def gains(self, t: np.ndarray, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        """``gain`` over arrays whose last axis holds the statistics."""
        raise NotImplementedError

    def count(self, t):
        """The rows behind statistics (list of SQL names or array, last axis)."""
        raise NotImplementedError

    def leaf(self, t: np.ndarray):
        raise NotImplementedError


class Entropy(Criterion):
    """Information gain in nats from class counts; leaf = majority (smallest label on ties)."""

    def __init__(self, label: str, classes: Sequence):
        self.label, self.classes = label, list(classes)
        self.n_stats = len(self.classes)

    def row_stats(self):
        return [(F.col(self.label) == F.lit(c)).cast("double") for c in self.classes]

    @staticmethod
    def _h(cs: list[str]) -> tuple[str, str]:
        n = _sum(cs)
        return n, f"(ln({n}) - {_sum([_xlnx(c) for c in cs])} / {n})"

    def gain(self, t, l, r):
        nt, ht = self._h(t)
        nl, hl = self._h(l)
        nr, hr = self._h(r)
        return f"{ht} - {nl} / {nt} * {hl} - {nr} / {nt} * {hr}"

    @staticmethod
    def _hs(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = c.sum(axis=-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return n, np.log(n) - np.where(c > 0, c * np.log(c), 0.0).sum(axis=-1) / n

    def gains(self, t, l, r):
        (nt, ht), (nl, hl), (nr, hr) = self._hs(t), self._hs(l), self._hs(r)
        return ht - nl / nt * hl - nr / nt * hr

    def count(self, t):
        return t.sum(axis=-1) if isinstance(t, np.ndarray) else _sum(t)

    def leaf(self, t):
        return self.classes[int(np.argmax(t))]


class VarianceReduction(Criterion):
    """Variance reduction (population variance, summed over targets); leaf = mean."""

    def __init__(self, targets: Sequence[str]):
        self.targets = list(targets)
        self.n_stats = 1 + len(self.targets)

    def row_stats(self):
        return [F.lit(1.0)] + [F.col(t).cast("double") for t in self.targets]

    def gain(self, t, l, r):
        nl, nr = l[0], r[0]
        w = f"{nl} * {nr} / (({nl} + {nr}) * ({nl} + {nr}))"
        terms = []
        for k in range(1, self.n_stats):
            d = f"({l[k]} / {nl} - {r[k]} / {nr})"
            terms.append(f"{w} * {d} * {d}")
        return _sum(terms)

    def gains(self, t, l, r):
        nl, nr = l[..., 0], r[..., 0]
        d = l[..., 1:] / nl[..., None] - r[..., 1:] / nr[..., None]
        return (nl * nr / ((nl + nr) * (nl + nr))) * (d * d).sum(axis=-1)

    def count(self, t):
        return t[..., 0] if isinstance(t, np.ndarray) else t[0]

    def leaf(self, t):
        vals = [float(t[k] / t[0]) for k in range(1, self.n_stats)]
        return vals[0] if len(vals) == 1 else vals


class NewtonGain(Criterion):
    """Second-order gain ½Σ_k[G_L²/H_L + G_R²/H_R - G²/H] (λ = 0); leaf = G/H per output."""

    def __init__(self, grads: Sequence[str], hess: Sequence[str]):
        self.grads, self.hess = list(grads), list(hess)
        self.k = len(self.grads)
        self.n_stats = 2 * self.k + 1  # the last statistic counts rows

    def row_stats(self):
        return [F.col(c) for c in self.grads] + [F.col(c) for c in self.hess] + [F.lit(1.0)]

    def gain(self, t, l, r):
        terms = []
        for j in range(self.k):
            g, h = j, self.k + j
            # a side without curvature (saturated probabilities) adds nothing, as its leaf is 0
            side = [f"(CASE WHEN {x[h]} = 0D THEN 0D ELSE {x[g]} * {x[g]} / {x[h]} END)" for x in (l, r, t)]
            terms.append(f"{side[0]} + {side[1]} - {side[2]}")
        return f"0.5D * {_sum(terms)}"

    def gains(self, t, l, r):
        def side(x):
            g, h = x[..., :self.k], x[..., self.k:2 * self.k]
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(h == 0.0, 0.0, g * g / h)
        return 0.5 * (side(l) + side(r) - side(t)).sum(axis=-1)

    def count(self, t):
        return t[..., -1] if isinstance(t, np.ndarray) else t[-1]

    def leaf(self, t):
        return [float(t[j] / t[self.k + j]) if t[self.k + j] != 0 else 0.0 for j in range(self.k)]


@dataclass
class NodeArrays:
    """A tree as arrays, the root first; a leaf is its own child, so all rows of a batch can
    take steps until none moves. ``leaf`` numbers the leaves in the order of the nodes."""

    feature: np.ndarray
    cutoff: np.ndarray
    left: np.ndarray
    right: np.ndarray
    ids: list  # heap ids

    def walk(self, x: np.ndarray) -> np.ndarray:
        """The leaf (an index into the arrays) of every row; NaN is the largest value, as in
        Spark's comparisons."""
        at = np.zeros(len(x), np.int64)
        moving = np.arange(len(x)) if self.left[0] or self.right[0] else np.zeros(0, np.int64)
        while len(moving):
            here = at[moving]
            v = x[moving, self.feature[here]]
            nxt = np.where((v >= self.cutoff[here]) | np.isnan(v), self.left[here], self.right[here])
            at[moving] = nxt
            moving = moving[self.left[nxt] != nxt]
        return at


def node_arrays(nodes: dict[int, dict]) -> NodeArrays:
    ids = sorted(nodes)
    at = {i: q for q, i in enumerate(ids)}
    feature, cutoff = np.zeros(len(ids), np.int32), np.zeros(len(ids))
    left, right = np.arange(len(ids)), np.arange(len(ids))
    for i, q in at.items():
        if "cutoff" in nodes[i]:
            feature[q], cutoff[q] = nodes[i]["feature"], nodes[i]["cutoff"]
            left[q], right[q] = at[2 * i], at[2 * i + 1]
    return NodeArrays(feature, cutoff, left, right, ids)


@dataclass
class TreeModel:
    """``nodes``: heap id -> {feature, cutoff}, {value}, or {subtree} for a small node whose
    subtree is a row of the table ``subtrees`` (trees beyond MAX_DRIVER_NODES only)."""

    features: list[str]
    nodes: dict[int, dict] = field(default_factory=dict)
    subtrees: DataFrame | None = None

    def is_leaf(self, i: int) -> bool:
        return "value" in self.nodes[i]

    @property
    def depth(self) -> int:
        return max(int(i).bit_length() for i in self.nodes) - 1

    def arrays(self) -> NodeArrays:
        return node_arrays(self.nodes)

    # ------------------------------------------------------ one CASE expression
    def _route_sql(self, i: int, leaf_sql) -> str:
        nd = self.nodes[i]
        if "value" in nd:
            return leaf_sql(i, nd["value"])
        x = _q(self.features[nd["feature"]])
        return (f"CASE WHEN {x} >= {sql_double(nd['cutoff'])} THEN {self._route_sql(2 * i, leaf_sql)} "
                f"ELSE {self._route_sql(2 * i + 1, leaf_sql)} END")

    def _case(self, leaf_sql) -> Column:
        if len(self.nodes) > MAX_CASE_NODES or self.subtrees is not None:
            raise ValueError(f"a tree of {len(self.nodes)} nodes is no expression: use transform() or route()")
        return F.expr(self._route_sql(1, leaf_sql))

    def leaf_id_col(self) -> Column:
        """The heap id of the leaf each row falls into, for trees small enough for a
        nested CASE; ``route`` takes any tree."""
        return self._case(lambda i, v: f"{int(i)}L")

    def value_col(self, index: int | None = None) -> Column:
        """Leaf value (or its ``index``-th component for vector leaves) of a small tree."""
        def leaf(i, v):
            v = v if index is None else v[index]
            if isinstance(v, (bool, np.bool_)):
                return "true" if v else "false"
            if isinstance(v, (int, np.integer)):
                return f"{int(v)}"
            if isinstance(v, str):
                return "'" + v.replace("'", "''") + "'"
            return sql_double(v)
        return self._case(leaf)

    # ------------------------------------------------------ any size, map-only
    def route(self, df: DataFrame, out: str = "leaf", path: bool = False) -> DataFrame:
        """``df`` plus the heap id of every row's leaf (bigint; trees deeper than 62
        levels have no such id), or its path from the root in the letters L and R (string)."""
        if not path and self.subtrees is None and self.depth > 62:
            raise ValueError("heap ids of this tree exceed a bigint: ask for path=True")

        def name(i: int):
            return bin(i)[3:].replace("0", "L").replace("1", "R") if path else i

        return self._walk(df, out, "string" if path else "bigint", lambda i, value: name(i))

    def transform(self, df: DataFrame, out: str = "prediction", index: int | None = None,
                  data_type: str = "double") -> DataFrame:
        """``df`` plus every row's leaf value (or its ``index``-th component); a NULL feature
        gives a NULL."""
        return self._walk(df, out, data_type, lambda i, value: value if index is None else value[index])

    def _walk(self, df: DataFrame, out: str, data_type: str, leaf_value) -> DataFrame:
        features, names = self.features, list(df.columns)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        if self.subtrees is not None:
            return self._walk_table(df, out, data_type, leaf_value, schema)
        tree = self.arrays()
        leaves = [leaf_value(i, self.nodes[i].get("value")) if "value" in self.nodes[i] else None for i in tree.ids]
        values = pa.array(leaves, pa.string()) if data_type == "string" else pa.array(leaves)

        def per_batch(batches):
            for b in batches:
                if b.num_rows:
                    at = pa.array(tree.walk(_features(b, features)), mask=null_rows(b, features))
                    yield pa.RecordBatch.from_arrays([*b.columns, values.take(at)], [*names, out])

        return df.mapInArrow(per_batch, f"{schema}, `{out}` {data_type}")

    def _walk_table(self, df, out, data_type, leaf_value, schema: str, salts: int = 16) -> DataFrame:
        """Rows go to the small node they fall into and meet its subtree there; a node's rows
        are dealt over ``salts`` tasks."""
        features, names = self.features, list(df.columns)
        top = self.arrays()
        direct = {i: leaf_value(i, nd["value"]) for i, nd in self.nodes.items() if "value" in nd}
        ids = pa.array([str(i) for i in top.ids])

        def per_batch(batches):
            for b in batches:
                if b.num_rows:
                    at = pa.array(top.walk(_features(b, features)), mask=null_rows(b, features))
                    yield pa.RecordBatch.from_arrays([*b.columns, ids.take(at)], [*names, "_node"])

        arrow = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "int": pa.int32()}[data_type]

        def finish(rows: pa.Table, sub: pa.Table) -> pa.Table:
            node = rows.column("_node")[0].as_py() if rows.num_rows else None
            if node is None or not sub.num_rows:
                value = None if node is None else direct.get(int(node))
                found = pa.array([value] * rows.num_rows, arrow)
            else:
                r = {c: sub.column(c)[0].as_py() for c in ("feature", "cutoff", "left", "right", "value", "id")}
                tree = NodeArrays(*(np.array(r[c]) for c in ("feature", "cutoff", "left", "right")), r["id"])
                found = pa.array([leaf_value(int(i), v) for i, v in zip(r["id"], r["value"])], arrow).take(
                    pa.array(tree.walk(_features(rows, features))))
            return rows.select(names).append_column(out, found)

        salt = F.pmod(F.xxhash64(*[F.col(_q(c)) for c in features]), F.lit(salts))
        rows = df.mapInArrow(per_batch, f"{schema}, _node string").withColumn("_salt", salt)
        subs = self.subtrees.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        return rows.groupBy("_node", "_salt").cogroup(subs.groupBy("_node", "_salt")).applyInArrow(
            finish, f"{schema}, `{out}` {data_type}")

    def leaf_value_table(self, spark, index: int | None = None) -> DataFrame:
        """(leaf, value) for joining routed rows to leaf values."""
        rows = []
        for i, nd in self.nodes.items():
            if "value" in nd:
                v = nd["value"] if index is None else nd["value"][index]
                rows.append((int(i), float(v)))
        return spark.createDataFrame(rows, "leaf bigint, value double")

    def table(self) -> list[tuple]:
        """Node table rows: (node, feature, cutoff, is_leaf, value as text)."""
        out = []
        for i in sorted(self.nodes):
            nd = self.nodes[i]
            out.append((i, nd.get("feature"), nd.get("cutoff"), "value" in nd,
                        None if "value" not in nd else str(nd["value"])))
        return out


def _features(batch, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) if isinstance(
        batch, pa.RecordBatch) else batch.column(c).to_numpy().astype(np.float64) for c in features])


def grow_small(x: np.ndarray, s: np.ndarray, crit: Criterion, depth_left: float, min_split: int,
               min_impurity: float) -> tuple[list, list, list, list, list]:
    """The whole subtree over rows ``x`` with statistics ``s``: (feature, cutoff, left, right,
    totals) of its nodes, the root first; a leaf is its own child."""
    by = np.lexsort((*s.T[::-1], *x.T[::-1]))  # sums do not depend on the order of arrival
    x, s = x[by], s[by]
    feature, cutoff, left, right, totals = [], [], [], [], []

    def node(rows: np.ndarray) -> int:
        feature.append(0)
        cutoff.append(0.0)
        left.append(len(left))
        right.append(len(right))
        totals.append(s[rows].sum(axis=0))
        return len(feature) - 1

    stack = [(node(np.arange(len(x))), np.arange(len(x)), depth_left)]
    while stack:
        at, rows, depth = stack.pop()
        if depth < 1 or crit.count(totals[at]) < min_split:
            continue
        best = _best_split(x[rows], s[rows], totals[at], crit)
        if best is None or not best[0] > min_impurity:
            continue
        _, f, v = best
        feature[at], cutoff[at] = f, v
        goes_left = x[rows, f] >= v
        for side, mask in ((left, goes_left), (right, ~goes_left)):
            side[at] = node(rows[mask])
            stack.append((side[at], rows[mask], depth - 1))
    return feature, cutoff, left, right, totals


def _best_split(x: np.ndarray, s: np.ndarray, t: np.ndarray, crit: Criterion) -> tuple[float, int, float] | None:
    """(gain, feature, cutoff): the largest rounded gain, then the first feature, then the
    least cutoff."""
    n, p = x.shape
    step, best = max(1, SPLIT_CELLS // max(1, n * s.shape[1])), None
    for lo in range(0, p, step):
        part = x[:, lo:lo + step]
        order = np.argsort(-part, axis=0, kind="stable")
        v = np.take_along_axis(part, order, axis=0)
        ends = v[:-1] != v[1:]  # the last row of a value, with rows to its right
        if not ends.any():
            continue
        l = np.cumsum(s[order], axis=0)[:-1]
        gain = np.where(ends, np.round(crit.gains(t, l, t - l), GAIN_DIGITS), -np.inf)
        top = gain.max()
        if best is None or top > best[0]:
            f = int((gain == top).any(axis=0).argmax())
            i = int(np.nonzero(gain[:, f] == top)[0][-1])
            best = (float(top), lo + f, float(v[i, f]))
    return best


class TreeGrower:
    def __init__(self, criterion: Criterion, max_depth: float | None = None, min_samples_split: int = 2,
                 min_impurity: float = 1e-7, checkpoint_interval: int = 4,
                 target_window_rows: int = 65_536, max_bins: int | None = None, small_rows: int | None = None,
                 max_driver_nodes: int = MAX_DRIVER_NODES, edges: dict | None = None):
        #: features -> edges of their ranges; trees over the same rows may share it
        self.edges = {} if edges is None else edges
        self.crit = criterion
        self.max_depth = float("inf") if max_depth is None else max_depth
        self.min_split, self.min_impurity = min_samples_split, min_impurity
        self.checkpoint_interval, self.target_rows = checkpoint_interval, target_window_rows
        self.max_bins, self.small_rows, self.max_driver_nodes = max_bins, small_rows, max_driver_nodes

    def _binned(self, df: DataFrame, feats: list[str]) -> DataFrame:
        """Optional histogram mode: snap every value to the lower edge of its
        approximate-quantile bin (one ``percentile_approx`` aggregate, edges
        collected: features x bins). Candidate cutoffs become the edges, so the
        per-level statistics table is bounded by nodes x features x bins; since
        an edge e satisfies ``edge(x) >= e`` exactly when ``x >= e``, the learned
        cutoffs route raw values identically. ``max_bins=None`` keeps the exact
        search over every distinct value."""
        from pyspark.ml.feature import Bucketizer

        qs = [i / self.max_bins for i in range(self.max_bins)]
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), qs, max(10_000, 10 * self.max_bins))
                       .alias(f"_q{k}") for k, c in enumerate(feats)]).first()
        out = df
        for k, c in enumerate(feats):
            edges = sorted(set(float(e) for e in (row[f"_q{k}"] or []) if e is not None))
            if not edges:
                continue
            splits = [float("-inf")] + edges + [float("inf")]
            out = Bucketizer(splits=splits, inputCol=c, outputCol=f"_b{k}", handleInvalid="keep").transform(out)
            # bucket 0 holds values below the first edge (only possible with approximate
            # quantiles): they keep the first edge as their representative
            lower = F.array(*[F.lit(e) for e in [edges[0]] + edges])
            out = out.withColumn(c, F.element_at(lower, F.col(f"_b{k}").cast("int") + 1)).drop(f"_b{k}")
        return out

    def fit(self, df: DataFrame, features: Sequence[str]) -> TreeModel:
        feats = list(features)
        stat_names = [f"_s{j}" for j in range(self.crit.n_stats)]
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        small = self.small_rows or max(1000, min(200_000, SMALL_CELLS // (len(feats) + self.crit.n_stats)))
        data = df.select(*[F.col(c).cast("double").alias(c) for c in feats],
                         *[c.cast("double").alias(n) for c, n in zip(self.crit.row_stats(), stat_names)],
                         F.lit("1").alias("_node"))
        if self.max_bins:
            data = self._binned(data, feats)
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
        model = TreeModel(feats)
        stale: list[DataFrame] = []
        try:
            # root totals: one aggregate (it also materialises the persisted rows);
            # every later node's totals come from its parent's winning split
            root = data.agg(*[F.sum(s).alias(s) for s in stat_names],
                            count_invalid(feats + stat_names), F.count(F.lit(1)).alias("_rows"),
                            F.approx_count_distinct(F.xxhash64(*feats)).alias("_kinds")).first()
            raise_if_invalid(root["_invalid"])
            if root[stat_names[0]] is None:
                raise ValueError("cannot grow a tree on an empty table")
            self._rows = root["_rows"]
            if self._rows > 1000 and 2 * root["_kinds"] <= self._rows:
                merged = data.groupBy(*feats).agg(*[F.sum(s).alias(s) for s in stat_names]).select(
                    *feats, *stat_names, F.lit("1").alias("_node")).persist(StorageLevel.MEMORY_AND_DISK)
                self._rows = merged.count()
                data.unpersist()
                data = merged
            frontier = {1: np.array([root[s] for s in stat_names], dtype=float)}
            unfinished: list[int] = []  # small nodes, at any depth
            level = 0
            while frontier:
                large = {}
                for i, t in frontier.items():
                    n = float(self.crit.count(t))
                    if level >= self.max_depth or n < self.min_split:
                        model.nodes[i] = {"value": self.crit.leaf(t)}
                    elif min(n, self._rows) <= small:
                        unfinished.append(i)
                    else:
                        large[i] = t
                best = self._level(data, feats, stat_names, large) if large else {}
                for old in stale:
                    old.unpersist()
                stale, splits, frontier = [], {}, {}
                for i, t in large.items():
                    b = best.get(i)
                    if b is not None and b[2] > self.min_impurity:
                        model.nodes[i] = {"feature": b[0], "cutoff": b[1]}
                        splits[i] = b
                        frontier[2 * i], frontier[2 * i + 1] = b[3], t - b[3]
                    else:
                        model.nodes[i] = {"value": self.crit.leaf(t)}
                level += 1
                if not splits or level >= self.max_depth:
                    continue  # children at the last level are leaves: their totals are known
                _few(splits)
                table = spark.createDataFrame([(str(i), int(b[0]), float(b[1]), str(2 * i), str(2 * i + 1))
                                               for i, b in splits.items()],
                                              "_node string, _sf int, _sc double, _l string, _r string")
                arr = F.array(*[F.col(c) for c in feats])
                side = F.when(F.element_at(arr, F.col("_sf") + 1) >= F.col("_sc"), F.col("_l")).otherwise(F.col("_r"))
                moved = data.join(F.broadcast(table), "_node", "left").select(
                    *feats, *stat_names, F.coalesce(side, F.col("_node")).alias("_node"))
                if self.checkpoint_interval and level % self.checkpoint_interval == 0:
                    moved = moved.checkpoint(eager=True)
                else:
                    # materialised by the next job; the old copy is released only after
                    # that, so nothing is recomputed
                    moved = moved.persist(StorageLevel.MEMORY_AND_DISK)
                stale.append(data)
                data = moved
            if unfinished:
                self._finish(model, data, feats, stat_names, unfinished)
        finally:
            for old in stale:
                old.unpersist()
            data.unpersist()
        return model

    # ------------------------------------------------------------ small nodes
    def _finish(self, model: TreeModel, data: DataFrame, feats: list[str], stat_names: list[str],
                unfinished: list[int]) -> None:
        """Grow every small node to its end inside one task of a grouped job."""
        crit, min_split, min_impurity, max_depth = self.crit, self.min_split, self.min_impurity, self.max_depth
        if unfinished != [1]:
            _few(unfinished)
            table = data.sparkSession.createDataFrame([(str(i),) for i in unfinished], "_node string")
            data = data.join(F.broadcast(table), "_node", "left_semi")

        def grow(rows: pa.Table) -> pa.Table:
            top = int(rows.column("_node")[0].as_py())
            x = np.column_stack([rows.column(c).to_numpy() for c in feats])
            s = np.column_stack([rows.column(c).to_numpy() for c in stat_names])
            feature, cutoff, left, right, totals = grow_small(
                x, s, crit, max_depth - (top.bit_length() - 1), min_split, min_impurity)
            ids = [top] * len(feature)
            for q in range(len(feature)):  # parents come before their children
                if left[q] != q:
                    ids[left[q]], ids[right[q]] = 2 * ids[q], 2 * ids[q] + 1
            return pa.table({
                "_node": [str(top)], "feature": pa.array([feature], pa.list_(pa.int32())),
                "cutoff": pa.array([cutoff], pa.list_(pa.float64())), "left": pa.array([left], pa.list_(pa.int32())),
                "right": pa.array([right], pa.list_(pa.int32())),
                "totals": pa.array([[t.tolist() for t in totals]], pa.list_(pa.list_(pa.float64()))),
                "id": pa.array([[str(i) for i in ids]], pa.list_(pa.string()))})

        grown = data.groupBy("_node").applyInArrow(
            grow, "_node string, feature array<int>, cutoff array<double>, left array<int>, right array<int>, "
                  "totals array<array<double>>, id array<string>").checkpoint()
        if (grown.agg(F.sum(F.size("feature")).alias("n")).first()["n"] or 0) > self.max_driver_nodes:
            self._keep_table(model, grown, unfinished)
            return
        for r in grown.collect():
            for q, i in enumerate(map(int, r["id"])):
                model.nodes[i] = ({"feature": r["feature"][q], "cutoff": r["cutoff"][q]} if r["left"][q] != q
                                  else {"value": crit.leaf(np.array(r["totals"][q]))})

    def _keep_table(self, model: TreeModel, grown: DataFrame, unfinished: list[int]) -> None:
        crit = self.crit
        for i in unfinished:
            model.nodes[i] = {"subtree": True}
        sample = crit.leaf(np.ones(crit.n_stats))
        kind = ("array<double>" if isinstance(sample, list) else "string" if isinstance(sample, str)
                else "bigint" if isinstance(sample, (int, np.integer)) else "double")

        def values(batches):
            for b in batches:
                vs = [[crit.leaf(np.array(t)) for t in ts] for ts in b.column("totals").to_pylist()]
                names = ["_node", "feature", "cutoff", "left", "right", "id"]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(vs)], [*names, "value"])

        model.subtrees = grown.mapInArrow(
            values, "_node string, feature array<int>, cutoff array<double>, left array<int>, right array<int>, "
                    f"id array<string>, value array<{kind}>").checkpoint()

    # ------------------------------------------------------------ large nodes
    def _edges(self, data: DataFrame, feats: list[str]) -> list[np.ndarray]:
        """Per feature, the least value of each range but the first."""
        ranges, key = -(-self._rows // self.target_rows), (*feats, self.target_rows, self._rows)
        if ranges > 1 and key not in self.edges:
            part = data.select(*feats)
            if self._rows > EDGE_ROWS:
                part = part.sample(EDGE_ROWS / self._rows, seed=7)
            x = _features(part.toArrow(), feats)
            at = np.arange(1, ranges) / ranges
            self.edges[key] = [np.unique(np.quantile(x[:, k], at, method="nearest")) if len(x) else np.zeros(0)
                               for k in range(len(feats))]
        return self.edges[key] if ranges > 1 else [np.zeros(0)] * len(feats)

    def _level(self, data: DataFrame, feats: list[str], stat_names: list[str], large: dict) -> dict:
        """node -> (feature, cutoff, gain, left statistics) of its best split."""
        _few(large)
        crit, m, held = self.crit, len(stat_names), self.target_rows
        names = pa.array([str(i) for i in large])
        totals = np.array(list(large.values()), dtype=float)
        edges = self._edges(data, feats)

        def chunks(batches):
            """(node number, features, statistics) of the rows in large nodes."""
            have, kept = 0, []
            for b in batches:
                node = pc.index_in(b.column("_node"), value_set=names)
                inside = node.is_valid()
                b, node = b.filter(inside), node.filter(inside)
                if b.num_rows:
                    kept.append((node.to_numpy(zero_copy_only=False).astype(np.int32), _features(b, feats), _features(b, stat_names)))
                    have += b.num_rows
                if have * (len(feats) + m) >= SMALL_CELLS:
                    yield tuple(np.concatenate(z) for z in zip(*kept))
                    have, kept = 0, []
            if kept:
                yield tuple(np.concatenate(z) for z in zip(*kept))

        def deal(batches):
            for node, x, s in chunks(batches):
                for f in range(len(feats)):
                    n, v, a = _add_equal(node, x[:, f], s)
                    at = np.searchsorted(edges[f], v, side="right")
                    for r in np.unique(at):
                        here = at == r
                        yield pa.RecordBatch.from_pydict({
                            "_f": pa.array([f], pa.int32()), "_b": pa.array([r], pa.int32()),
                            "node": [n[here].tobytes()], "v": [v[here].tobytes()], "s": [a[here].tobytes()]})

        def best(parts: pa.Table, before: dict) -> pa.Table:
            found = []
            if parts.num_rows:
                f = parts.column("_f")[0].as_py()
                node, v, s = (np.frombuffer(b"".join(parts.column(c).to_pylist()), t) for c, t in (
                    ("node", np.int32), ("v", np.float64), ("s", np.float64)))
                node, v, s = _add_equal(node, v, s.reshape(-1, m))
                starts = np.nonzero(np.r_[True, node[1:] != node[:-1]])[0]
                for lo, hi in zip(starts, [*starts[1:], len(node)]):
                    i = int(node[lo])
                    t, carry, top = totals[i], before.get(i, np.zeros(m)), None
                    step = max(1, SPLIT_CELLS // m)
                    for a in range(lo, hi, step):
                        l = carry + np.cumsum(s[a:min(a + step, hi)], axis=0)
                        carry = l[-1]
                        ok = np.nonzero(crit.count(t) - crit.count(l) > 0.5)[0]
                        if not len(ok):
                            continue
                        gain = np.round(crit.gains(t, l[ok], t - l[ok]), GAIN_DIGITS)
                        q = len(gain) - 1 - int(np.argmax(gain[::-1]))  # the least of equal cutoffs
                        if top is None or gain[q] >= top[3]:
                            top = (names[i].as_py(), f, float(v[a + ok[q]]), float(gain[q]), l[ok[q]].tolist())
                    if top is not None:
                        found.append(top)
            cols = list(zip(*found)) if found else [[]] * 5
            return pa.table({c: pa.array(list(z), t) for c, z, t in zip(
                ("_node", "_f", "_v", "_g", "l"), cols, (pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64())))})

        out = "_node string, _f int, _v double, _g double, l array<double>"
        dealt = data.mapInArrow(deal, "_f int, _b int, node binary, v binary, s binary")
        if any(len(e) for e in edges):
            def sums(batches):
                """The totals of each (node, feature, range) in a chunk."""
                for node, x, s in chunks(batches):
                    for f in range(len(feats)):
                        at = node.astype(np.int64) * (len(edges[f]) + 1) + np.searchsorted(edges[f], x[:, f], side="right")
                        which, at = np.unique(at, return_inverse=True)
                        n, r = np.divmod(which, len(edges[f]) + 1)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(n.astype(np.int32)), pa.array(np.full(len(n), f, np.int32)), pa.array(r.astype(np.int32)),
                             *(pa.array(np.bincount(at, s[:, j], len(n))) for j in range(m))], ["_n", "_f", "_b", *stat_names])

            ranges = data.mapInArrow(sums, "_n int, _f int, _b int, " + ", ".join(f"{c} double" for c in stat_names))
            ranges = ranges.groupBy("_n", "_f", "_b").agg(*[F.sum(c).alias(c) for c in stat_names])
            after = suffix_sums(ranges, ["_n", "_f"], "_b", stat_names, prefix="_l", target_rows=held,
                                max_group_rows=1 + max(len(e) for e in edges))
            after = after.select("_f", "_b", "_n", F.array(*[F.col(f"_l{c}") - F.col(c) for c in stat_names]).alias("l"))

            def task(parts: pa.Table, before: pa.Table) -> pa.Table:
                return best(parts, {n: np.array(l) for n, l in zip(before.column("_n").to_pylist(), before.column("l").to_pylist())})

            scored = dealt.groupBy("_f", "_b").cogroup(after.groupBy("_f", "_b")).applyInArrow(task, out)
        else:
            scored = dealt.groupBy("_f", "_b").applyInArrow(lambda parts: best(parts, {}), out)
        key = F.struct(F.col("_g"), (-F.col("_f")).alias("nf"), (-F.col("_v")).alias("nv"))
        picked = scored.groupBy("_node").agg(F.max_by(F.struct("_f", "_v", "_g", "l"), key).alias("b"))
        return {int(r["_node"]): (r["b"]["_f"], r["b"]["_v"], r["b"]["_g"], np.array(r["b"]["l"], dtype=float))
                for r in picked.collect()}


def _add_equal(node: np.ndarray, v: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by node and descending value, the statistics of equal ones added up."""
    by = np.lexsort((-v, node))
    node, v, s = node[by], v[by], s[by]
    new = np.r_[True, (node[1:] != node[:-1]) | (v[1:] != v[:-1])] if len(v) else np.zeros(0, bool)
    if new.all():
        return node, v, s
    at = np.nonzero(new)[0]
    return node[at], v[at], np.add.reduceat(s, at, axis=0)


def _few(nodes) -> None:
    if len(nodes) > MAX_BROADCAST_NODES:
        raise ValueError("too many open nodes to broadcast: raise small_rows")


class DecisionTreeClassifier:
    """Exact information-gain tree of any depth; leaves hold the majority class."""

    def __init__(self, max_depth: float | None = None, min_samples_split: int = 2, min_impurity: float = 1e-7,
                 **grower_kw):
        self.kw = dict(max_depth=max_depth, min_samples_split=min_samples_split,
                       min_impurity=min_impurity, **grower_kw)

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "DecisionTreeClassifier":
        from ..operators.features import dictionary

        self.classes = dictionary(df, label)
        self.tree = TreeGrower(Entropy(label, self.classes), **self.kw).fit(df, features)
        self.label_type = df.schema[label].dataType.simpleString()
        return self

    def predict_col(self) -> Column:
        """The class as an expression (small trees); ``transform`` takes any tree."""
        return self.tree.value_col()

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        whole = self.label_type in ("int", "bigint", "smallint", "tinyint")
        scored = self.tree.transform(df, out, data_type="bigint" if whole else self.label_type)
        return scored.withColumn(out, F.col(_q(out)).cast(self.label_type))


class DecisionTreeRegressor:
    """Exact variance-reduction tree of any depth; leaves hold the mean target."""

    def __init__(self, max_depth: float | None = None, min_samples_split: int = 2, min_impurity: float = 1e-7,
                 **grower_kw):
        self.kw = dict(max_depth=max_depth, min_samples_split=min_samples_split,
                       min_impurity=min_impurity, **grower_kw)

    def fit(self, df: DataFrame, features: Sequence[str], targets: Sequence[str] | str) -> "DecisionTreeRegressor":
        targets = [targets] if isinstance(targets, str) else list(targets)
        self.tree = TreeGrower(VarianceReduction(targets), **self.kw).fit(df, features)
        return self

    def predict_col(self, index: int | None = None) -> Column:
        """The mean as an expression (small trees); ``transform`` takes any tree."""
        return self.tree.value_col(index)

    def transform(self, df: DataFrame, out: str = "prediction", index: int | None = None) -> DataFrame:
        return self.tree.transform(df, out, index)
