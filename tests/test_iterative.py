"""Training loops and folds against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from modlake.operators import iterative as T
from modlake.operators import learn as L


def made(n=400, p=4, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, p))
    y = (x[:, 0] - x[:, 1] + r.normal(size=n) > 0.3).astype(int)
    return x, y, r.uniform(0.5, 2, n)


def frame(spark, x, y, w):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, a), int(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w, strict=True))]
    kind = "id long, " + ", ".join(f"{n} double" for n in names) + ", y int, w double"
    return spark.createDataFrame(rows, kind).repartition(5), names


def test_proximal_steps_equal_numpy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 37)
    x, y, w = made()
    df, names = frame(spark, x, y, w)
    trace = []
    end = T.l1_descent(T.blocks(df, names, "y", "w", str(tmp_path / "b")), 4, alpha=0.05, rate=0.5, tol=1e-3, trace=trace)
    coef, intercept = np.zeros(4), 0.0
    for b, c in trace:
        g = w * (1 / (1 + np.exp(-(x @ coef + intercept))) - y)
        moved = coef - 0.5 * (x.T @ g) / w.sum()
        fresh = np.sign(moved) * np.maximum(np.abs(moved) - 0.025, 0)
        start = intercept - 0.5 * g.sum() / w.sum()
        delta = max(np.abs(fresh - coef).max(), abs(start - intercept))
        coef, intercept = fresh, start
        assert abs(b - intercept) < 1e-9 and np.abs(c - coef).max() < 1e-9
    assert end.converged and end.steps == len(trace) and delta < 1e-3 and (coef == 0).any()
    short = T.l1_descent(T.blocks(df, names, "y", "w", str(tmp_path / "c")), 4, max_iter=2)
    assert short.steps == 2 and not short.converged


def test_squared_hinge_is_stationary(spark):
    x, y, w = made(seed=3)
    df, names = frame(spark, x * [1, 5, 0.1, 2], y, w)
    for c in (0.01, 1.0, 10.0):
        model = L.train_linear_svm(df, names, "y", c)
        worst = L.svm_gradient(df, model.linear, "y", c).agg(F.max(F.abs("gradient"))).first()[0]
        assert worst < 1e-8
    margins = model.score(df).selectExpr("avg(cast((y_score > 0) = (y = 1) as int))").first()[0]
    assert margins > 0.75 and not model.is_probability
    with pytest.raises(ValueError):
        L.train_linear_svm(df.withColumn("y", F.lit(1)), names, "y")


def test_rows_without_a_feature_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 1), (None, 0)], "a double, y int")
    with pytest.raises(Exception, match="lacks a feature"):
        T.blocks(df, ["a"], "y", None, str(tmp_path / "b"))


def test_folds_are_even_in_every_class(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 = 0 as int) as y", "'kept' as _b_own")
    got = L.folded(df, "id", 3, label="y")
    sizes = got.groupBy("y").pivot("fold", [0, 1, 2]).count().collect()
    assert len(sizes) == 2 and all(max(r[1:]) - min(r[1:]) <= 1 for r in sizes)
    assert got.columns == ["id", "y", "_b_own", "fold"] and got.select("id").distinct().count() == 1000
