"""Coordinate descent, the unsquared norm and Newton's method against their optimality conditions."""

import numpy as np
import pytest

from tablelearn.plans.linear import (ElasticNet, Lasso, LinearModel, LogisticRegression, Ridge, coordinate_descent,
                                     norm_penalised)

FEATS = ["a", "b", "c"]


def table(spark, x, y, copies=1):
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)] * copies
    return spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(3)


@pytest.fixture(scope="module")
def xy():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) + np.array([1e5, -3.0, 0.0])
    return x, 2.0 * x[:, 0] - 0.01 * x[:, 1] + rng.normal(size=200) * 0.1


@pytest.mark.parametrize("ratio", [0.0, 1.0, 3.0])
def test_optimality_of_the_path(spark, xy, ratio):
    x, y = xy
    model = ElasticNet(alpha=1.0, ratio=ratio).fit(table(spark, x, y), FEATS, "y")
    l2, l1 = ratio / (ratio + 1), 1 / (ratio + 1)
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (3.0, 0.5, 0.02, 0.0):
        m = model.refit(alpha)
        w = m.weights
        slope = xc.T @ (xc @ w - yc) / len(x) + alpha * l2 * w
        assert all(abs(s) <= alpha * l1 + 1e-8 if v == 0 else abs(s + alpha * l1 * np.sign(v)) < 1e-8 for s, v in zip(slope, w))
        assert m.intercept == pytest.approx(y.mean() - x.mean(0) @ w)
    assert (model.refit(0.5).weights[1:] == 0).all() and model.refit(0.5).weights[0] != 0
    assert (model.refit(100.0 * (1 + ratio)).weights == 0).all()


def test_no_penalty_is_least_squares(spark, xy):
    x, y = xy
    w = Lasso(alpha=0.0).fit(table(spark, x, y), FEATS, "y").coef_
    want = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x - x.mean(0)]), y, rcond=None)[0][1:]
    assert w[1:] == pytest.approx(want, abs=1e-8)


def test_coordinate_descent_with_constant_and_equal_columns():
    x = np.array([[1.0, 1.0, 0.0], [2.0, 2.0, 0.0], [4.0, 4.0, 0.0]])
    a, b = x.T @ x / 3, x.T @ np.array([2.0, 4.0, 8.0]) / 3
    w, _, off = coordinate_descent(a, b, np.full(3, 0.01), np.zeros(3), np.zeros(3), 1000, 1e-12)
    assert off <= 1e-12 and w[2] == 0.0 and w[0] + w[1] == pytest.approx((b[0] - 0.01) / a[0, 0])


def test_norm_penalty_is_a_minimum(spark, xy):
    x, y = xy
    rng = np.random.default_rng(1)
    for alpha in (0.001, 0.3, 1.5, 1e6):
        w = Ridge(alpha=alpha, squared=False).fit(table(spark, x, y), FEATS, "y").weights
        xc, yc = x - x.mean(0), y - y.mean()

        def loss(v):
            return 0.5 * np.mean((xc @ v - yc) ** 2) + alpha * np.linalg.norm(v)
        assert all(loss(w) <= loss(w + d) + 1e-12 for d in rng.normal(size=(200, 3)) * 1e-3)
    assert not w.any()  # shrunk to exactly nothing
    assert norm_penalised(np.eye(2), np.array([3.0, 4.0]), 1.0) == pytest.approx([2.4, 3.2])
    with pytest.raises(ValueError, match="stands alone"):
        LinearModel(alpha=1.0, norm_share=1.0, l1_share=1.0).fit(table(spark, x, y), FEATS, "y")


def logistic(rng, n=300):
    x = rng.normal(size=(n, 3)) * np.array([1.0, 5.0, 0.2])
    p = 1 / (1 + np.exp(-(0.5 + x @ np.array([1.5, -0.4, 2.0]))))
    return x, (rng.random(n) < p).astype(float)


def test_newton_converges_fast_and_ignores_duplication(spark):
    x, y = logistic(np.random.default_rng(2))
    one = LogisticRegression().fit(table(spark, x, y), FEATS, "y")
    many = LogisticRegression().fit(table(spark, x, y, copies=7), FEATS, "y")
    assert one.converged_ and one.n_iter_ < 15
    assert one.coef_ == pytest.approx(many.coef_, abs=1e-7)
    xi = np.column_stack([np.ones(len(x)), x])
    assert np.abs(xi.T @ (y - 1 / (1 + np.exp(-xi @ one.coef_)))).max() < 1e-6
    assert all(b <= a for a, b in zip(one.loss_, one.loss_[1:]))
    slow = LogisticRegression(solver="gradient", learning_rate=0.2, max_iter=20, tol=1e-6).fit(table(spark, x, y), FEATS, "y")
    assert slow.n_iter_ == 20 and not slow.converged_


def test_newton_penalised_wide_and_far_start(spark, monkeypatch):
    from tablelearn.functions import arrow_scores

    x, y = logistic(np.random.default_rng(3))
    fit = lambda **kw: LogisticRegression(penalty="l2", C=0.5, **kw).fit(table(spark, x, y), FEATS, "y")
    want = fit()
    xi = np.column_stack([np.ones(len(x)), x])
    lam = np.array([0.0, 2.0, 2.0, 2.0])
    assert np.abs(xi.T @ (y - 1 / (1 + np.exp(-xi @ want.coef_))) - lam * want.coef_).max() < 1e-6
    assert fit(init=[30.0, -30.0, 10.0, 50.0]).coef_ == pytest.approx(want.coef_, abs=1e-6)  # halved steps
    monkeypatch.setattr(arrow_scores, "MAX_GENERATED_AGGREGATES", 3)
    assert fit().coef_ == pytest.approx(want.coef_, abs=1e-8)


def test_newton_on_separable_and_singular_tables(spark):
    x = np.array([[i, 2.0 * i, 1.0] for i in range(20)])
    m = LogisticRegression(max_iter=60).fit(table(spark, x, (np.arange(20) > 9).astype(float)), FEATS, "y")
    assert np.isfinite(m.coef_).all() and m.loss_[-1] < 1e-3
    same = LogisticRegression().fit(table(spark, x, (np.arange(20) % 2).astype(float)), FEATS, "y")
    assert same.converged_ and np.isfinite(same.coef_).all()
