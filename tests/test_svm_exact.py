"""Dual SVM with its certificate, and kernel Pegasos, against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.plans.dual_svm import DualSVM
from tablelearn.plans.kernel_svm import KernelPegasos, kernel_matrix, kernel_sums


def table(spark, x, y, parts=4):
    cols = ", ".join(f"x{j} double" for j in range(x.shape[1]))
    return spark.createDataFrame([(i, [float(v) for v in r], *map(float, r), v) for i, (r, v) in enumerate(zip(x.tolist(), y))],
                                 f"id bigint, v array<double>, {cols}, y int").repartition(parts), [f"x{j}" for j in range(x.shape[1])]


def primal(w, b, x, y, c):
    return 0.5 * w @ w + c * np.maximum(0, 1 - y * (x @ w + b)).sum()


def subgradient(x, y, c, steps=60_000):
    """A long plain run of the primal; the best value seen."""
    w, b, best = np.zeros(x.shape[1]), 0.0, np.inf
    for t in range(1, steps):
        hit = y * (x @ w + b) < 1
        best = min(best, primal(w, b, x, y, c))
        eta = 1.0 / (t + 50)
        w = w - eta * (w - c * (y[hit] @ x[hit]))
        b = b + eta * c * y[hit].sum() * 0.05
    return best


def blobs(rng, n=160, p=3, k=2):
    y = rng.integers(k, size=n)
    return rng.normal(size=(n, p)) + 1.2 * rng.normal(size=(k, p))[y] + np.array([4.0] + [0.0] * (p - 1)), y


@pytest.mark.parametrize("c", [0.05, 1.0])
def test_gap_and_objective(spark, c):
    x, y = blobs(np.random.default_rng(0))
    df, feats = table(spark, x, y.tolist())
    m = DualSVM(C=c, tol=1e-3).fit(df, feats, "y")
    assert m.gap_[0] <= 1e-3
    s = np.where(y == 1, 1.0, -1.0)
    assert primal(m.coef_[0], m.intercept_[0], x, s, c) == pytest.approx(m.primal_[0], rel=1e-9)
    best = subgradient(x, s, c)
    assert m.dual_[0] <= best * (1 + 1e-9) and m.primal_[0] <= best * (1 + 2e-3)
    got = {r.id: r.p for r in df.select("id", m.predict_col().alias("p")).collect()}
    assert got == {i: int(v) for i, v in enumerate(x @ m.coef_[0] + m.intercept_[0] >= 0)}


def test_multiclass_and_many_tasks(spark):
    x, y = blobs(np.random.default_rng(1), n=120, p=4, k=3)
    few = DualSVM(tol=1e-3).fit(table(spark, x, y.tolist(), 1)[0], *table(spark, x, y.tolist())[1:], "y")
    many = DualSVM(tol=1e-3).fit(table(spark, x, y.tolist(), 12)[0], *table(spark, x, y.tolist())[1:], "y")
    assert few.coef_.shape == (3, 4) and (few.gap_ <= 1e-3).all() and (many.gap_ <= 1e-3).all()
    assert many.primal_ == pytest.approx(few.primal_, rel=2e-3)
    for k in range(3):
        s = np.where(y == k, 1.0, -1.0)
        assert many.primal_[k] == pytest.approx(primal(many.coef_[k], many.intercept_[k], x, s, 1.0))


def test_separable_and_bad_tables(spark):
    x = np.array([[-2.0, 0.0], [-1.0, 0.0], [1.0, 0.0], [2.0, 0.0]])
    df, feats = table(spark, x, [0, 0, 1, 1], 2)
    m = DualSVM(C=1e3, tol=1e-4).fit(df, feats, "y")
    assert m.coef_[0] == pytest.approx([1.0, 0.0], abs=0.02) and abs(m.intercept_[0]) < 0.02
    with pytest.raises(ValueError, match="two classes"):
        DualSVM().fit(df.where("y = 1"), feats, "y")
    with pytest.raises(ValueError, match="empty"):
        DualSVM().fit(df.limit(0), feats, "y")


def pegasos(x, y, classes, lam, steps, tol, **kw):
    k_ = kernel_matrix(x, x, **kw)
    ys = np.stack([np.where(y == c, 1.0, -1.0) for c in classes], 1)
    c, f = np.zeros_like(ys), np.zeros_like(ys)
    for t in range(1, steps + 1):
        n = len(x)
        hit = ys * (f / (lam * max(t - 1, 1) * n)) < 1
        c += hit
        new = f + k_ @ (ys * hit)
        moved = ((new / (lam * t * n) - f / (lam * max(t - 1, 1) * n)) ** 2).sum(1).mean() / len(classes)
        f = new
        if moved < tol:
            break
    return c, f / (lam * t * n), t


@pytest.mark.parametrize("kernel", ["rbf", "linear", "poly"])
@pytest.mark.parametrize("k,bytes_", [(2, 64 << 20), (3, 64 << 20), (3, 0)])
def test_kernel_pegasos_equals_numpy(spark, kernel, k, bytes_):
    x, y = blobs(np.random.default_rng(2), n=90, p=3, k=k)
    df, _ = table(spark, x, y.tolist(), 3)
    kw = dict(kernel=kernel, gamma=0.3, degree=2)
    m = KernelPegasos(lam=0.05, max_iter=6 if bytes_ == 0 else 25, tol=1e-4, checkpoint_interval=4, block_rows=40,
                      broadcast_bytes=bytes_, **kw).fit(df, "id", "v", "y")
    classes = [1] if k == 2 else list(range(k))
    c, f, t = pegasos(x, y, classes, 0.05, m.max_iter, 1e-4, **kw)
    assert m.n_iter_ == t
    assert {r.id: list(r.c) for r in m.support_.collect()} == {i: r.astype(int).tolist() for i, r in enumerate(c) if r.any()}
    scores = {r.id: list(r.scores) for r in m.decision(df, "id", "v").collect()}
    assert all(scores[i] == pytest.approx(f[i], rel=1e-6, abs=1e-6) for i in range(len(x)))
    want = (f[:, 0] >= 0).astype(int) if k == 2 else f.argmax(1)
    assert [r.prediction for r in m.predict(df, "id", "v").orderBy("id").collect()] == want.tolist()


def test_kernel_sums_without_support(spark):
    df, _ = table(spark, np.ones((3, 2)), [0, 1, 0])
    none = spark.createDataFrame([], "sv array<double>, sw array<double>")
    for limit in (1 << 20, -1):
        out = kernel_sums(df.select("id", "v"), "id", "v", none, 0, 2, 2, broadcast_bytes=limit)
        assert [list(r.sums) for r in out.collect()] == [[0.0, 0.0]] * 3


@pytest.mark.parametrize("interval", [0, 3])
def test_kernel_pegasos_releases_what_its_steps_sent(spark, monkeypatch, interval):
    sc, sent, real = spark.sparkContext, [], spark.sparkContext.broadcast
    monkeypatch.setattr(sc, "broadcast", lambda v: sent.append(real(v)) or sent[-1])
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    df, _ = table(spark, x, (x[:, 0] > 0).astype(int).tolist())
    m = KernelPegasos(lam=0.05, max_iter=5, tol=0.0, checkpoint_interval=interval).fit(df, "id", "v", "y")
    assert m.n_iter_ == 5 and len(sent) >= 5
    assert not any(b._jbroadcast.isValid() for b in sent)
    assert m.decision(df, "id", "v").count() == 60


def test_kernel_grid_cuts_its_blocks(spark):
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=(130, 3)), rng.normal(size=(130, 2))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(x.tolist(), w.tolist()))],
                               "id bigint, v array<double>, sw array<double>")
    out = kernel_sums(df.select("id", "v"), "id", "v", df.select(F.col("v").alias("sv"), "sw"), None, 3, 2,
                      broadcast_bytes=0, block_rows=7, grid_rows=50)
    want = kernel_matrix(x, x, "rbf", 1.0, 2) @ w
    got = {r["id"]: r["sums"] for r in out.collect()}
    assert np.allclose([got[i] for i in range(130)], want)


def test_kernel_support_is_gathered_in_pieces(spark, monkeypatch):
    """The driver holds a piece of the support at a time, and the sums are those of all pieces."""
    monkeypatch.setattr("tablelearn.plans.kernel_svm.PIECE_BYTES", 400, raising=False)
    sc, sizes, real = spark.sparkContext, [], spark.sparkContext.broadcast
    monkeypatch.setattr(sc, "broadcast", lambda v: sizes.append(sum(a.nbytes for a in v)) or real(v))
    rng = np.random.default_rng(5)
    x, w = rng.normal(size=(130, 3)), rng.normal(size=(130, 2))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(x.tolist(), w.tolist()))],
                               "id bigint, v array<double>, sw array<double>")
    sent = []
    out = kernel_sums(df.select("id", "v"), "id", "v", df.select(F.col("v").alias("sv"), "sw"), None, 3, 2, sent=sent)
    got = {r["id"]: r["sums"] for r in out.collect()}
    assert np.allclose([got[i] for i in range(130)], kernel_matrix(x, x, "rbf", 1.0, 2) @ w)
    assert len(sent) == len(sizes) == 13 and sum(sizes) == 130 * 5 * 8 and max(sizes) < 1200
