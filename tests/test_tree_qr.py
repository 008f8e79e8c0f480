"""Tree QR: least squares and PCA of badly scaled and collinear columns, models with string classes."""

import numpy as np
import pytest

from tablelearn.operators.tree_qr import tree_qr
from tablelearn.plans.base import ModelTable
from tablelearn.plans.bayes import GaussianNB, LinearDiscriminantAnalysis
from tablelearn.plans.decompose import PCA
from tablelearn.plans.linear import LinearRegression


def table(spark, x, y=None, parts=7):
    names = [f"x{j}" for j in range(x.shape[1])]
    cols = ", ".join(f"{n} double" for n in names)
    rows = [(*map(float, r), 0.0 if y is None else float(v)) for r, v in zip(x, x[:, 0] if y is None else y)]
    return spark.createDataFrame(rows, f"{cols}, y double").repartition(parts), names


@pytest.mark.parametrize("tasks", [8, 200])
def test_triangle(spark, tasks):
    x = np.random.default_rng(0).normal(size=(150, 4))
    df, names = table(spark, x)
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        n, r = tree_qr(df, names)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    a = np.column_stack([np.ones(150), x])
    assert n == 150 and np.allclose(np.triu(r), r) and (np.diag(r) >= 0).all()
    assert r.T @ r == pytest.approx(a.T @ a)
    assert tree_qr(df.limit(0), names)[0] == 0
    with pytest.raises(ValueError, match="NULL, NaN"):
        tree_qr(df.withColumn("x0", df["x0"] * float("nan")), names)


@pytest.mark.parametrize("name", ["scaled", "collinear", "few", "nearly"])
def test_least_squares_is_numpys(spark, name):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    if name == "scaled":
        x = x * np.array([1e9, 1.0, 1e-6]) + np.array([1e9, 0.0, 1.0])
    if name == "collinear":
        x[:, 2] = 2 * x[:, 0] - x[:, 1]
    if name == "nearly":  # the Gram matrix of these loses the slope, the triangle does not
        x[:, 2] = x[:, 0] + 1e-7 * x[:, 2]
    if name == "few":
        x = x[:2]
    y = x @ np.array([1.0, -2.0, 0.5]) + 3.0 + (rng.normal(size=len(x)) * 1e-3 if name != "few" else 0.0)
    df, names = table(spark, x, y)
    m = LinearRegression().fit(df, names, "y")
    a = np.column_stack([np.ones(len(x)), x])
    want = np.linalg.lstsq(a, y, rcond=None)[0]
    assert a @ m.coef_ == pytest.approx(a @ want, rel=1e-7, abs=1e-7)
    assert m.coef_ == pytest.approx(want, rel=1e-4, abs=1e-6 * np.abs(want).max())
    assert m.training_mse() == pytest.approx(np.mean((a @ want - y) ** 2), rel=1e-4, abs=1e-12)


def test_pca_is_numpys_svd(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 4)) * np.array([1e6, 10.0, 1.0, 1e-4]) + np.array([1e8, 0.0, -5.0, 1.0])
    df, names = table(spark, x)
    m = PCA(n_components=4).fit(df, names)
    _, s, v = np.linalg.svd(x - x.mean(axis=0))
    assert m.explained_variance_ == pytest.approx(s ** 2 / 119, rel=1e-5)
    assert np.abs(np.sum(m.components_ * v, axis=1)) == pytest.approx(np.ones(4), abs=1e-8)
    assert m.mean_ == pytest.approx(x.mean(axis=0), rel=1e-12)


def test_models_with_string_classes_are_saved(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(20, 2)), rng.normal(size=(20, 2)) + 4])
    df = spark.createDataFrame([(*map(float, r), "ab"[i >= 20]) for i, r in enumerate(x)], "x double, z double, c string")
    for kind in (GaussianNB, LinearDiscriminantAnalysis):
        m = kind().fit(df, ["x", "z"], "c")
        path = str(tmp_path / kind.__name__)
        m.model_table().save(spark, path)
        back = kind.from_table(ModelTable.load(spark, path))
        assert back.classes == ["a", "b"]
        assert sorted(back.transform(df).collect()) == sorted(m.transform(df).collect())
