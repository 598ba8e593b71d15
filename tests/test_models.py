"""Linear models by their certificates, forests and boosted trees by errors and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.operators import linear as L
from tablecraft.operators import trees as T


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        a, b = float(rng.integers(0, 20)), float(rng.integers(0, 9))
        rows.append((i, a, b, "u" if a + 2 * b + rng.normal(0, 4) > 18 else "v", 3 * a - b * b + float(rng.integers(0, 3))))
    odd = [(300, None, 1.0, "u", 1.0), (301, math.nan, 1.0, "u", 1.0), (302, 1.0, 2.0, None, None)]
    return spark.createDataFrame(rows + odd, "id long, a double, b double, label string, y double").cache()


def test_logistic_gradient_vanishes_and_odd_rows_go(points):
    fit, certificate = L.logistic_regression(points, ["a", "b"], F.col("label") == "u")
    assert fit.n == 300 and certificate["gradient_norm"] < 1e-6
    assert all(x >= y - 1e-12 for x, y in zip(fit.losses, fit.losses[1:]))  # up to rounding
    shares = L.predict(points, {"u": (fit, certificate)}).filter("a is null").select("prediction").collect()
    assert shares[0][0] is None


def test_svm_gap_bounds_the_objective(points):
    fit, certificate = L.linear_svm(points, ["a", "b"], F.col("label") == "u")
    assert 0 <= certificate["gap"] <= L.HINGE_WIDTHS[-1] / 4 + 1e-6
    rows = points.filter("label is not null and a is not null and not isnan(a)").toPandas()
    x = np.column_stack([np.ones(len(rows)), *[(rows[c] - m) / s for c, m, s in zip("ab", fit.means, fit.scales)]])
    y = np.where(rows["label"] == "u", 1.0, -1.0)

    def objective(w):
        return np.maximum(0, 1 - y * (x @ w)).mean() + 0.01 / 2 * w @ w
    w = np.array(fit.weights)
    assert objective(w) == pytest.approx(certificate["primal"], abs=1e-9)
    rng = np.random.default_rng(1)
    assert all(objective(w + rng.normal(0, 0.2, 3)) >= certificate["dual"] for _ in range(200))


def test_models_of_empty_tables(points):
    none = points.limit(0)
    assert L.logistic_regression(none, ["a"], F.col("label") == "u")[0].n == 0
    assert L.linear_svm(none, ["a"], F.col("label") == "u")[1]["gap"] == 0.0
    assert T.boosted_trees(none, ["a"], "label").losses == []
    forest = T.regression_forest(none, ["a"], "y", ["id"], trees=2, depth=1)
    assert forest.splits == [] and len(forest.trees) == 2


def test_forest_halves_the_error_and_first_cut_is_the_best(points):
    forest = T.regression_forest(points, ["a", "b"], "y", ["id"], trees=6, depth=4, per_split=2)
    scored = forest.predict(points)
    errors = scored.filter("y is not null and prediction is not null").agg(
        F.avg((F.col("prediction") - F.col("y")) ** 2), F.var_pop("y")).first()
    assert errors[0] < errors[1] / 4
    assert scored.filter("a is null or isnan(a)").filter("prediction is not null").count() == 0
    rows = points.filter("a is not null and not isnan(a) and y is not null").withColumn(
        "n", T.draws(F.col("id"), F.lit(0))).toPandas()
    best = max(((_fall(rows, c, v), c, v) for c in "ab" for v in sorted(set(rows[c]))), key=lambda r: r[0])
    root = next(r for r in forest.splits if r["tree"] == 0 and r["node"] == 1)
    assert "ab"[root["feature"]] == best[1] and forest.cuts[root["feature"]][root["bin"]] == best[2]


def _fall(rows, column, cut):
    left = rows[column] <= cut
    n, g = rows["n"], rows["n"] * rows["y"]
    if n[left].sum() == 0 or n[~left].sum() == 0:
        return -1.0
    return g[left].sum() ** 2 / n[left].sum() + g[~left].sum() ** 2 / n[~left].sum() - g.sum() ** 2 / n.sum()


def test_boosting_loss_falls_for_three_classes(points):
    three = points.filter("y is not null and a is not null and not isnan(a)").withColumn(
        "of", F.when(F.col("y") < 0, "low").when(F.col("y") < 25, "mid").otherwise("high"))
    model = T.boosted_trees(three, ["a", "b"], "of", rounds=4, depth=3, rate=0.5)
    for c in ("low", "mid", "high"):
        losses = [loss for _, label, loss in model.losses if label == c]
        assert len(losses) == 5 and all(x > y for x, y in zip(losses, losses[1:]))
    right = model.predict(three).agg(F.avg((F.col("prediction") == F.col("of")).cast("double"))).first()[0]
    assert right > 0.85


def test_bins_count_the_cuts_below_and_are_looked_up_once(spark, points, monkeypatch):
    at = [[-math.inf, -2.5, 0.0, 1.0, 7.25, math.inf], [3.0], []]
    values = [None, math.nan, -math.inf, -3.0, -2.5, -0.0, 0.0, 0.5, 1.0, 7.25, 7.5, math.inf]
    rows = spark.createDataFrame([(v, v, v) for v in values], "`a b` double, b double, c double")
    for row in T.with_bins(rows, ["a b", "b", "c"], at, "bins").collect():
        v = row["b"]
        none = v is None or math.isnan(v)
        assert row["bins"] == [None if none else sum(c < v for c in cuts) for cuts in at], v
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df)
    materialize = T.materialize
    monkeypatch.setattr(T, "materialize", kept)
    T.boosted_trees(points, ["a", "b"], "label", rounds=0)
    assert plans[0].count("bucketizer") == 2 and "lambda" not in plans[0], plans[0]  # one look-up a feature


def test_draws_are_worked_out_once_a_row_and_tree(points, monkeypatch):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df)
    materialize = T.materialize
    monkeypatch.setattr(T, "materialize", kept)
    T.regression_forest(points, ["a", "b"], "y", ["id"], trees=3, depth=0)
    before_sums = [line for line in plans[0].splitlines() if "md5" in line]
    assert len(before_sums) == 1 and "Project" in before_sums[0], plans[0]
