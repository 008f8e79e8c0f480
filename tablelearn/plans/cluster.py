"""G17 k-means and G19 Gaussian mixtures (EM).

Both are driver loops over one persisted feature table. Each iteration is one
distributed aggregate whose inputs (centroids, component parameters) enter
the plan as literals or task closures, so the plan stays the same size and
the lineage never grows: an iteration re-reads the persisted rows, and a lost
executor only recomputes its partitions from the scan.

* k-means, narrow input: assignment is a generated argmin expression and the
  update is ``groupBy(cluster).agg(avg)`` (JVM only, map-side combined).
* k-means, wide input, and EM: NumPy inside Arrow batches computes the
  assignment/responsibilities and per-partition partial sums, emitted as long
  ``(component, slot, value)`` rows and merged with ``groupBy().sum()``.
* k-means with many clusters: every row keeps its cluster and bounds on its distances as
  state, so that rows which cannot have changed cluster compute none (Hamerly 2010).
* k-means|| seeding (Bahmani et al. 2012): a few rounds that each draw about 2k rows by their
  squared distance, weighted by the rows nearest to them and thinned to k on the driver.
* EM restarts run side by side: one pass per iteration serves all that have not stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.validate import assert_finite, count_invalid, raise_if_invalid
from ..functions.activations import log_softmax, logsumexp
from ..functions.arrow_scores import append_scores, is_wide
from ..functions.gaussian import gaussian_logpdf
from ..functions.linalg import argmax_index
from ..operators import pairwise, sampling


def _initial_rows(df: DataFrame, id_col: str, cols: Sequence[str], k: int, seed: int) -> np.ndarray:
    pts = pairwise.to_points(sampling.sample_k(df, id_col, k, seed), cols)
    if pts.shape[0] < k:
        raise ValueError(f"need at least {k} rows to initialise {k} clusters")
    return pts


def _partial_sums_schema() -> str:
    return "comp int, slot int, value double"


#: From so many clusters on, distance bounds are worth their state.
BOUNDS_FROM = 64
#: Seeds that k-means|| may draw in a round.
MAX_SEEDS = 100_000


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(points)))
    for j in range(len(points)):
        d = x - points[j]
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def _nearest(rows: DataFrame, points: np.ndarray) -> DataFrame:
    """``rows`` (id, x) with the nearest point c and its squared distance d2."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            d = _distances(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), points)
            c = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("x"), pa.array(c.astype(np.int32)), pa.array(d[np.arange(len(c)), c] ** 2)],
                ["id", "x", "c", "d2"])

    return rows.mapInArrow(run, "id string, x array<double>, c int, d2 double")


class KMeans:
    """Lloyd's algorithm from ``init``: ``"random"`` (k seeded distinct rows, A4), ``"k-means||"``
    or a k x p array.

    Stops after ``max_iter`` updates or when no centroid coordinate moves by
    more than ``tol`` (``tol=0``: only at an exact fixed point). An empty
    cluster keeps its previous centroid. With ``bounds`` (default: from
    BOUNDS_FROM clusters on) rows carry distance bounds; ``distance_evals_``
    counts the distances computed, n x k an iteration without them.
    """

    def __init__(self, n_clusters: int = 2, max_iter: int = 100, tol: float = 1e-8,
                 seed: int = 0, init: str | np.ndarray | None = None, bounds: bool | None = None,
                 seed_rounds: int = 5, checkpoint_interval: int = 10):
        self.k, self.max_iter, self.tol, self.seed, self.init = n_clusters, max_iter, tol, seed, init
        self.bounds = n_clusters >= BOUNDS_FROM if bounds is None else bounds
        self.seed_rounds, self.checkpoint_interval = seed_rounds, checkpoint_interval

    def fit(self, df: DataFrame, features: Sequence[str], id_col: str) -> "KMeans":
        self.features = list(features)
        p = len(self.features)
        data = df.select(id_col, *self.features).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.init is None or isinstance(self.init, str):
                seeder = {"random": _initial_rows, "k-means||": self._parallel_seeds}[self.init or "random"]
                cent = seeder(data, id_col, self.features, self.k, self.seed)
            else:
                cent = np.asarray(self.init, dtype=float)
            if cent.shape != (self.k, p):
                raise ValueError(f"initial centroids must be {self.k} x {p}")
            self.n_iter_, self.distance_evals_ = 0, 0
            cent = self._bounded_lloyd(data, cent) if self.bounds else self._lloyd(data, cent)
        finally:
            data.unpersist()
        self.centroids_ = cent
        return self

    def _lloyd(self, data: DataFrame, cent: np.ndarray) -> np.ndarray:
        for it in range(self.max_iter):
            # the first update also counts invalid rows (no extra scan)
            sums, counts = self._update_stats(data, cent, validate=it == 0)
            self.distance_evals_ += int(counts.sum()) * self.k
            cent, moved = self._step(cent, sums, counts)
            if moved.max(initial=0.0) <= self.tol:
                break
        return cent

    def _step(self, cent: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The new centroids and how far each coordinate moved at most."""
        new = cent.copy()
        nz = counts > 0
        new[nz] = sums[nz] / counts[nz, None]
        self.n_iter_ += 1
        return new, np.abs(new - cent)

    def _bounded_lloyd(self, data: DataFrame, cent: np.ndarray) -> np.ndarray:
        """Lloyd with row state (cluster, upper bound on its distance, lower bound on the
        second nearest): a row computes distances only if the bounds allow another cluster."""
        import pyarrow as pa

        ensure_checkpoint_dir(data.sparkSession)
        assert_finite(data, self.features)
        k, p = cent.shape
        state = data.select(F.array(*[F.col(c).cast("double") for c in self.features]).alias("x"), F.lit(-1).alias("c"),
                            F.lit(0.0).alias("u"), F.lit(0.0).alias("l"), F.lit(0).cast("bigint").alias("evals"))
        drift = np.zeros(k)
        for it in range(self.max_iter):
            gaps = _distances(cent, cent)
            np.fill_diagonal(gaps, np.inf)
            half = gaps.min(axis=1) / 2.0

            def assign(batches, cent=cent, drift=drift, half=half):
                for b in batches:
                    x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
                    c, u, l = (b.column(n).to_numpy().copy() for n in ("c", "u", "l"))
                    fresh = c < 0
                    own = np.maximum(c, 0)
                    # a little slack keeps the bounds safe from rounding
                    u = u + drift[own] + 1e-12
                    l = l - drift.max(initial=0.0) - 1e-12
                    ask = np.nonzero(fresh | (u >= np.maximum(half[own], l)))[0]
                    evals = np.zeros(len(x), np.int64)
                    # first the distance to the own centroid alone, then all of them
                    tight = ask[~fresh[ask]]
                    diff = x[tight] - cent[own[tight]]
                    u[tight] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                    evals[tight] += 1
                    ask = ask[fresh[ask] | (u[ask] * (1 + 1e-12) >= np.maximum(half[own[ask]], l[ask]))]
                    d = _distances(x[ask], cent)
                    best = d.argmin(axis=1)
                    c[ask], u[ask] = best, d[np.arange(len(ask)), best]
                    d[np.arange(len(ask)), best] = np.inf
                    l[ask] = d.min(axis=1) if k > 1 else np.inf
                    evals[ask] += k
                    yield pa.RecordBatch.from_arrays(
                        [b.column("x"), pa.array(c.astype(np.int32)), pa.array(u), pa.array(l), pa.array(evals)],
                        ["x", "c", "u", "l", "evals"])

            new_state = state.mapInArrow(assign, "x array<double>, c int, u double, l double, evals bigint")
            if (it + 1) % self.checkpoint_interval == 0:
                new_state = new_state.checkpoint(eager=True)
            else:
                new_state = new_state.persist(StorageLevel.MEMORY_AND_DISK)
            sums, counts, evals = self._state_sums(new_state, k, p)
            state.unpersist()
            state = new_state
            self.distance_evals_ += evals
            new, moved = self._step(cent, sums, counts)
            drift = np.sqrt(((new - cent) ** 2).sum(axis=1))
            cent = new
            if moved.max(initial=0.0) <= self.tol:
                break
        state.unpersist()
        return cent

    @staticmethod
    def _state_sums(state: DataFrame, k: int, p: int) -> tuple[np.ndarray, np.ndarray, int]:
        import pyarrow as pa

        def run(batches):
            out, evals = np.zeros((k, p + 1)), 0
            for b in batches:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
                c = b.column("c").to_numpy()
                np.add.at(out[:, 1:], c, x)
                out[:, 0] += np.bincount(c, minlength=k)
                evals += int(b.column("evals").to_numpy().sum())
            values = np.append(out.reshape(-1), evals)
            yield pa.RecordBatch.from_pydict({"slot": np.arange(len(values), dtype=np.int64), "value": values})

        v = np.zeros(k * (p + 1) + 1)
        for r in state.mapInArrow(run, "slot bigint, value double").groupBy("slot").agg(F.sum("value").alias("v")).collect():
            v[r["slot"]] = r["v"]
        out = v[:-1].reshape(k, p + 1)
        return out[:, 1:], out[:, 0], int(v[-1])

    def _parallel_seeds(self, data: DataFrame, id_col: str, cols: Sequence[str], k: int, seed: int) -> np.ndarray:
        """k-means||: rows enter by chance 2k d^2 / (sum of d^2), drawn from a hash of their id."""
        points = _initial_rows(data, id_col, cols, 1, seed)
        vector = F.array(*[F.col(c).cast("double") for c in cols]).alias("x")
        rows = data.select(F.col(id_col).cast("string").alias("id"), vector)
        for r in range(self.seed_rounds):
            total = _nearest(rows, points).agg(F.sum("d2").alias("s")).first()["s"]
            if not total:
                break
            chance = F.pmod(F.xxhash64(F.concat("id", F.lit(f"#{seed}#{r}"))), F.lit(1 << 40)) / F.lit(float(1 << 40))
            drawn = _nearest(rows, points).where(chance < F.col("d2") * F.lit(2.0 * k / total)).select("x")
            found = drawn.limit(MAX_SEEDS + 1).collect()  # 2k are expected
            if len(found) > MAX_SEEDS:
                raise ValueError("too many seeds: fewer clusters, please")
            points = np.unique(np.concatenate([points, *[np.array([f["x"]]) for f in found]]), axis=0)
        if len(points) < k:
            return _initial_rows(data, id_col, cols, k, seed)
        near = _nearest(rows, points).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()
        weight = np.zeros(len(points))
        for r in near:
            weight[r["c"]] = r["n"]
        rng = np.random.default_rng(seed)
        chosen = [int(weight.argmax())]  # weighted k-means++ over the candidates
        d2 = _distances(points, points[chosen])[:, 0] ** 2
        while len(chosen) < k:
            odds = weight * d2
            if odds.sum() == 0.0:
                odds = np.where(np.isin(np.arange(len(points)), chosen), 0.0, 1.0)
            chosen.append(int(rng.choice(len(points), p=odds / odds.sum())))
            d2 = np.minimum(d2, _distances(points, points[chosen[-1:]])[:, 0] ** 2)
        return points[chosen]

    def _update_stats(self, data: DataFrame, cent: np.ndarray, validate: bool = False):
        k, p = cent.shape
        if p * k <= pairwise.MAX_GENERATED_TERMS:
            assigned = data.withColumn("_c", pairwise.nearest_point(self.features, cent))
            extra = [count_invalid(self.features)] if validate else []
            rows = assigned.groupBy("_c").agg(F.count(F.lit(1)).alias("n"), *extra,
                                              *[F.sum(c).alias(f"s{j}") for j, c in enumerate(self.features)]).collect()
            if validate:
                raise_if_invalid(sum(r["_invalid"] for r in rows))
            sums, counts = np.zeros((k, p)), np.zeros(k)
            for r in rows:
                counts[r["_c"]] = r["n"]
                sums[r["_c"]] = [r[f"s{j}"] for j in range(p)]
            return sums, counts
        return self._arrow_stats(data, cent, validate)

    def _arrow_stats(self, data: DataFrame, cent: np.ndarray, validate: bool = False):
        import pyarrow as pa

        k, p = cent.shape
        cols = self.features

        def per_partition(batches):
            sums, counts = np.zeros((k, p)), np.zeros(k)
            bad = 0
            for b in batches:
                if b.num_rows == 0:
                    continue
                x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                     for c in cols])
                bad += int((~np.isfinite(x)).any(axis=1).sum())
                d2 = np.stack([np.einsum("ij,ij->i", x - cent[j], x - cent[j]) for j in range(k)], axis=1)
                lab = np.argmin(d2, axis=1)
                np.add.at(sums, lab, x)
                counts += np.bincount(lab, minlength=k)
            comp = np.append(np.repeat(np.arange(k), p + 1), -1).astype(np.int32)
            slot = np.append(np.tile(np.arange(p + 1), k), 0).astype(np.int32)
            vals = np.append(np.concatenate([counts[:, None], sums], axis=1).reshape(-1), bad)
            yield pa.RecordBatch.from_pydict({"comp": comp, "slot": slot, "value": vals})

        rows = (data.select(*cols).mapInArrow(per_partition, _partial_sums_schema())
                .groupBy("comp", "slot").agg(F.sum("value").alias("value")).collect())
        sums, counts = np.zeros((k, p)), np.zeros(k)
        if validate:
            raise_if_invalid(int(sum(r["value"] for r in rows if r["comp"] == -1)))
        for r in rows:
            if r["comp"] == -1:
                continue
            if r["slot"] == 0:
                counts[r["comp"]] = r["value"]
            else:
                sums[r["comp"], r["slot"] - 1] = r["value"]
        return sums, counts

    def predict(self, df: DataFrame, key: str, out: str = "cluster") -> DataFrame:
        """D6 with the fitted centroids."""
        return pairwise.nearest_point_frame(df, key, self.features, self.centroids_, out=out)

    def fit_predict(self, df: DataFrame, features: Sequence[str], id_col: str,
                    out: str = "cluster") -> DataFrame:
        return self.fit(df, features, id_col).predict(df, id_col, out)

    def inertia(self, df: DataFrame) -> float:
        """Σ squared distance to the nearest centroid (one aggregate)."""
        d = pairwise.point_values(self.features, self.centroids_, "sqdistance")
        return df.agg(F.sum(F.least(*d) if len(d) > 1 else d[0])).first()[0]


class GaussianMixture:
    """EM with full covariances, in log space.

    Starts: ``init_means``, or a k-means fit (``init_params="kmeans"``), or k seeded rows
    (``"random"``, A4), each restart from a seed of its own; identity covariances, equal
    weights. Each iteration is one Arrow pass for all ``n_init`` restarts that have not
    stopped: E-step responsibilities and the M-step sums of r, r x and r x x' of each;
    covariances get ``reg_covar`` I. A restart stops when its weights move by less than
    ``tol`` in all; the one with the best likelihood of its last E-step wins.
    """

    def __init__(self, n_components: int = 1, max_iter: int = 100, tol: float = 1e-3,
                 reg_covar: float = 1e-6, init_params: str = "kmeans", seed: int = 0,
                 init_means: np.ndarray | None = None, n_init: int = 1):
        if init_params not in ("kmeans", "random"):
            raise ValueError("init_params must be 'kmeans' or 'random'")
        if n_init < 1:
            raise ValueError("n_init must be positive")
        self.k, self.max_iter, self.tol, self.reg = n_components, max_iter, tol, reg_covar
        self.init_params, self.seed, self.init_means, self.n_init = init_params, seed, init_means, n_init

    def fit(self, df: DataFrame, features: Sequence[str], id_col: str) -> "GaussianMixture":
        self.features = list(features)
        p, k = len(self.features), self.k
        data = df.select(id_col, *self.features).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            runs = []
            for r in range(1 if self.init_means is not None else self.n_init):
                runs.append({"means": self._start(data, id_col, self.seed + r), "covs": np.stack([np.eye(p)] * k),
                             "weights": np.full(k, 1.0 / k), "n_iter": 0, "ll": [], "done": False})
            for it in range(self.max_iter):
                live = [r for r in runs if not r["done"]]
                sums = self._em_sums(data, [(r["weights"], r["means"], r["covs"]) for r in live])
                if it == 0:
                    raise_if_invalid(int(sums[0][-1]))  # checked on the first E-step's scan
                for r, s in zip(live, sums):
                    self._m_step(r, *s[:5])
                if all(r["done"] for r in runs):
                    break
        finally:
            data.unpersist()
        best = max(runs, key=lambda r: r["ll"][-1] if r["ll"] else -np.inf)
        self.weights_, self.means_, self.covariances_ = best["weights"], best["means"], best["covs"]
        self.n_iter_, self.log_likelihood_ = best["n_iter"], best["ll"]
        self.restarts_ = [(r["n_iter"], r["ll"][-1] if r["ll"] else None) for r in runs]
        return self

    def _start(self, data: DataFrame, id_col: str, seed: int) -> np.ndarray:
        if self.init_means is not None:
            return np.asarray(self.init_means, dtype=float)
        if self.init_params == "kmeans":
            return KMeans(self.k, seed=seed).fit(data, self.features, id_col).centroids_
        return _initial_rows(data, id_col, self.features, self.k, seed)

    def _m_step(self, run: dict, n, sr, srx, srxx, ll) -> None:
        p = len(self.features)
        old, run["weights"] = run["weights"], sr / n
        safe = np.where(sr > 0, sr, 1.0)
        # the sums are taken about each component's current mean
        delta = np.where(sr[:, None] > 0, srx / safe[:, None], 0.0)
        run["means"] = run["means"] + delta
        second = srxx / safe[:, None, None]
        covs = np.where((sr > 0)[:, None, None], second - np.einsum("ki,kj->kij", delta, delta), run["covs"])
        run["covs"] = covs + self.reg * np.eye(p)[None]
        run["ll"].append(ll)
        run["n_iter"] += 1
        run["done"] = bool(np.abs(run["weights"] - old).sum() < self.tol)

    def _em_sums(self, data: DataFrame, runs: list[tuple]) -> list[tuple]:
        """(n, sum r, sum r d, sum r d d', likelihood, invalid rows) of each parameter set."""
        import pyarrow as pa

        k, p = runs[0][1].shape
        cols = self.features
        sets = []
        for weights, means, covs in runs:
            # factor every covariance once per iteration on the driver
            prec = np.linalg.inv(covs)
            sign, logdet = np.linalg.slogdet(covs)
            if (sign <= 0).any():
                raise ValueError("a component's covariance is not positive definite; raise reg_covar")
            with np.errstate(divide="ignore"):  # an empty component has weight 0
                sets.append((np.log(weights) - 0.5 * (p * np.log(2 * np.pi) + logdet), means, prec))
        size = 2 + k + k * p + k * p * p

        def per_partition(batches):
            bad, out = 0.0, [[0.0, 0.0, np.zeros(k), np.zeros((k, p)), np.zeros((k, p, p))] for _ in sets]
            for b in batches:
                if b.num_rows == 0:
                    continue
                x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                     for c in cols])
                bad += float((~np.isfinite(x)).any(axis=1).sum())
                for acc, (const, means, prec) in zip(out, sets):
                    s = np.empty((x.shape[0], k))
                    for j in range(k):
                        d = x - means[j]
                        s[:, j] = const[j] - 0.5 * np.einsum("ij,ij->i", d @ prec[j], d)
                    mx = s.max(axis=1, keepdims=True)
                    lse = mx[:, 0] + np.log(np.exp(s - mx).sum(axis=1))
                    r = np.exp(s - lse[:, None])
                    acc[0] += x.shape[0]
                    acc[1] += lse.sum()
                    acc[2] += r.sum(axis=0)
                    for j in range(k):
                        d = x - means[j]
                        rd = r[:, j, None] * d
                        acc[3][j] += rd.sum(axis=0)
                        acc[4][j] += rd.T @ d
            vals = np.concatenate([np.concatenate([[n, ll], sr, srx.reshape(-1), srxx.reshape(-1)])
                                   for n, ll, sr, srx, srxx in out] + [[bad]])
            yield pa.RecordBatch.from_pydict({"comp": np.zeros(len(vals), np.int32),
                                              "slot": np.arange(len(vals), dtype=np.int32),
                                              "value": vals})

        rows = (data.select(*cols).mapInArrow(per_partition, _partial_sums_schema())
                .groupBy("slot").agg(F.sum("value").alias("value")).collect())
        v = np.zeros(size * len(sets) + 1)
        for r in rows:
            v[r["slot"]] = r["value"]
        out = []
        for at in range(0, size * len(sets), size):
            u = v[at:at + size]
            out.append((u[0], u[2:2 + k], u[2 + k:2 + k + k * p].reshape(k, p), u[2 + k + k * p:].reshape(k, p, p), u[1], v[-1]))
        return out

    def fit_predict(self, df: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
        return self.fit(df, features, id_col).transform(df)

    def np_joint_log_likelihood(self, x: np.ndarray) -> np.ndarray:
        k, p = self.means_.shape
        prec = np.linalg.inv(self.covariances_)
        logdet = np.linalg.slogdet(self.covariances_)[1]
        out = np.empty((x.shape[0], k))
        for j in range(k):
            d = x - self.means_[j]
            out[:, j] = (np.log(self.weights_[j]) - 0.5 * (p * np.log(2 * np.pi) + logdet[j])
                         - 0.5 * np.einsum("ij,jk,ik->i", d, prec[j], d))
        return out

    def joint_log_likelihood(self) -> list[Column]:
        """log π_k + log N(x; μ_k, Σ_k) per component (expressions, narrow inputs)."""
        return [F.lit(float(np.log(w))) + gaussian_logpdf(self.features, m, c)
                for w, m, c in zip(self.weights_, self.means_, self.covariances_)]

    def predict_cols(self) -> tuple[Column, Column, list[Column]]:
        """(component, row log-likelihood, responsibilities) as columns."""
        jll = self.joint_log_likelihood()
        resp = [F.exp(c) for c in log_softmax(jll)]
        return argmax_index(jll), logsumexp(jll), resp

    def transform(self, df: DataFrame, component: str = "component",
                  log_likelihood: str = "log_likelihood", prob_prefix: str = "resp_") -> DataFrame:
        """Component scores are projected once, then argmax / log-sum-exp read columns."""
        k = len(self.weights_)
        names = [f"_jll{j}" for j in range(k)]
        p = len(self.features)
        if is_wide(p * p, k):
            staged = append_scores(df, self.features, names, self.np_joint_log_likelihood)
        else:
            staged = df.select("*", *[c.alias(n) for c, n in zip(self.joint_log_likelihood(), names)])
        jll = [F.col(n) for n in names]
        staged = staged.withColumn(log_likelihood, logsumexp(jll))
        out = staged.select("*", argmax_index(jll).alias(component),
                            *[F.exp(c - F.col(log_likelihood)).alias(f"{prob_prefix}{j}")
                              for j, c in enumerate(jll)])
        return out.drop(*names)
