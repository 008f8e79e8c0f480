"""Bounded Lloyd steps, k-means|| seeds and EM restarts against plain NumPy."""

import numpy as np
import pytest

from tablelearn.plans.cluster import GaussianMixture, KMeans
from tablelearn.sources.tables import embedding_view

from .conftest import SF001


def table(spark, x):
    names = [f"x{j}" for j in range(x.shape[1])]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                                 "id bigint, " + ", ".join(f"{n} double" for n in names)).repartition(4), names


def blobs(rng, k, n=400, p=4, spread=0.3):
    return rng.normal(size=(k, p))[rng.integers(k, size=n)] * 3 + rng.normal(size=(n, p)) * spread


@pytest.mark.parametrize("k,p", [(2, 1), (9, 4), (30, 6)])
def test_bounds_change_nothing_but_the_work(spark, k, p):
    x = blobs(np.random.default_rng(k), max(2, k // 2), p=p)
    df, names = table(spark, x)
    plain = KMeans(k, seed=3, bounds=False).fit(df, names, "id")
    bound = KMeans(k, seed=3, bounds=True, checkpoint_interval=3).fit(df, names, "id")
    assert bound.n_iter_ == plain.n_iter_ > 2
    assert bound.centroids_ == pytest.approx(plain.centroids_, abs=1e-9)
    assert plain.distance_evals_ == plain.n_iter_ * k * len(x)
    assert bound.distance_evals_ < (0.8 if k > 2 else 1.01) * plain.distance_evals_


def test_many_clusters_skip_most_distances(spark):
    x = blobs(np.random.default_rng(1), 64, n=1500, p=3, spread=0.05)
    df, names = table(spark, x)
    m = KMeans(64, seed=1).fit(df, names, "id")
    assert m.bounds and m.distance_evals_ < 0.5 * m.n_iter_ * 64 * len(x)


def test_parallel_seeds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 3)) * 50
    x = centres[rng.integers(12, size=600)] + rng.normal(size=(600, 3)) * 0.1
    df, names = table(spark, x)
    first = KMeans(12, seed=1, init="k-means||").fit(df, names, "id")
    again = KMeans(12, seed=1, init="k-means||").fit(df.repartition(7), names, "id")
    assert first.centroids_ == pytest.approx(again.centroids_)
    # every centre has its centroid; random rows miss some
    d = np.sqrt(((centres[:, None] - first.centroids_[None]) ** 2).sum(-1))
    assert d.min(axis=1).max() < 1.0
    same = spark.createDataFrame([(i, 1.0) for i in range(9)], "id bigint, x double")
    assert KMeans(2, init="k-means||").fit(same, ["x"], "id").centroids_.tolist() == [[1.0], [1.0]]


def em(x, means, reg, tol, steps):
    k, p = means.shape
    w, covs, lls = np.full(k, 1 / k), np.stack([np.eye(p)] * k), []
    for _ in range(steps):
        s = np.stack([np.log(w[j]) - 0.5 * (p * np.log(2 * np.pi) + np.linalg.slogdet(covs[j])[1] + np.einsum(
            "ij,jk,ik->i", x - means[j], np.linalg.inv(covs[j]), x - means[j])) for j in range(k)], 1)
        lse = np.logaddexp.reduce(s, axis=1)
        r = np.exp(s - lse[:, None])
        lls.append(lse.sum())
        old, w = w, r.sum(0) / len(x)
        means = (r.T @ x) / r.sum(0)[:, None]
        covs = np.stack([(r[:, j, None] * (x - means[j])).T @ (x - means[j]) / r[:, j].sum() + reg * np.eye(p) for j in range(k)])
        if np.abs(w - old).sum() < tol:
            break
    return w, means, covs, lls


def test_mixture_over_whole_vectors(spark):
    df = embedding_view(spark, SF001, 64)
    cols = [f"x{i + 1}" for i in range(64)]
    x = np.array(df.orderBy("vec_id").select(*cols).collect())
    start = x[:3]
    m = GaussianMixture(3, reg_covar=1e-3, init_means=start).fit(df, cols, "vec_id")
    w, means, covs, lls = em(x, start, 1e-3, 1e-3, 100)
    assert m.n_iter_ == len(lls) and m.log_likelihood_ == pytest.approx(lls, rel=1e-9)
    assert m.weights_ == pytest.approx(w) and m.means_ == pytest.approx(means) and m.covariances_ == pytest.approx(covs, abs=1e-9)


def test_restarts_run_side_by_side_and_the_likeliest_wins(spark):
    x = blobs(np.random.default_rng(8), 4, n=300, p=2, spread=0.5)
    df, names = table(spark, x)
    many = GaussianMixture(4, n_init=4, seed=1, init_params="random", max_iter=40).fit(df, names, "id")
    alone = [GaussianMixture(4, seed=1 + r, init_params="random", max_iter=40).fit(df, names, "id") for r in range(4)]
    assert [n for n, _ in many.restarts_] == [a.n_iter_ for a in alone]
    assert [ll for _, ll in many.restarts_] == pytest.approx([a.log_likelihood_[-1] for a in alone])
    best = max(alone, key=lambda a: a.log_likelihood_[-1])
    assert many.means_ == pytest.approx(best.means_) and many.n_iter_ == best.n_iter_
    started = GaussianMixture(4, seed=1).fit(df, names, "id")  # k-means by default
    assert started.log_likelihood_[0] >= max(a.log_likelihood_[0] for a in alone) - 300
    with pytest.raises(ValueError):
        GaussianMixture(2, n_init=0)


@pytest.mark.parametrize("tasks", [8, 150])
def test_one_scan_moments_far_from_zero(spark, tasks):
    """Block merging keeps all digits at means of 1e8, per group and in two levels."""
    from tablelearn.operators import moments

    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 14)) * 0.5 + 1e8
    names = [f"x{j}" for j in range(14)]
    rows = [("ab"[i % 3 == 0], *map(float, r)) for i, r in enumerate(x)] + [("c", *map(float, x[0])), ("a", *[float("nan")] * 14), (None, *map(float, x[0]))]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{n} double" for n in names)).repartition(90)
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = {r.g: r for r in moments.co_moments(df, names, "g").collect()}
        table = {(r.g, r.i, r.j): r.value for r in moments.covariance_table(df, names, by="g").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    groups = {"b": x[::3], "a": np.delete(x, slice(None, None, 3), axis=0)}
    for g, part in groups.items():
        assert got[g].n == len(part) and got[g].bad == (g == "a")
        assert np.array(got[g].mean) == pytest.approx(part.mean(axis=0), rel=1e-14)
        want = np.cov((part - 1e8).T)
        assert np.array([table[g, i, j] for i in range(14) for j in range(i, 14)]) == pytest.approx(want[np.triu_indices(14)], abs=1e-7)
    assert got["c"].n == 1 and table["c", 0, 0] is None and got[None].bad == 1
    plan = moments.covariance_table(df, names, by="g")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Repartition") <= 2
