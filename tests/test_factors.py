"""Alternating least squares against its own normal equations and a dense solver."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.operators import factors as FA

SCHEMA = "u string, i long, r double"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(20, 2)), rng.normal(size=(15, 2))
    out = [(f"u{a}", int(b), float(x[a] @ y[b] + rng.normal(0, 0.1)))
           for a in range(20) for b in range(15) if rng.random() < 0.6]
    return out + out[:7] + [("u0", int(b), 1.0) for b in range(15)]  # repeated pairs, one user with every item


def dense(rows, rank, rounds, ridge, start):
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    x, y = {}, dict(start)
    for _ in range(rounds):
        for keys, mine, others, at, to in ((users, x, y, 0, 1), (items, y, x, 1, 0)):
            for k in keys:
                own = [r for r in rows if r[at] == k]
                m = np.array([others[r[to]] for r in own])
                mine[k] = np.linalg.solve(m.T @ m + ridge * len(own) * np.eye(rank), m.T @ np.array([r[2] for r in own]))
    return x, y


def test_als_equals_a_dense_solver(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    start = df.select("i").distinct().select("i", FA._hashed_factors("i", 3).alias("f")).collect()
    x, y = dense(rows, 3, 4, 0.05, {r["i"]: np.array(r["f"]) for r in start})
    fit = FA.als(df, "u", "i", "r", rank=3, rounds=4, ridge=0.05)
    for table, key, want in ((fit.users, "u", x), (fit.items, "i", y)):
        got = {r[key]: r["factors"] for r in table.collect()}
        assert got.keys() == want.keys()
        assert all(np.allclose(got[k], want[k], atol=1e-8) for k in want)
    pairs = fit.predict(df.select("u", "i").distinct()).collect()
    assert all(r["prediction"] == pytest.approx(x[r["u"]] @ y[r["i"]], abs=1e-8) for r in pairs)


def test_als_errors_fall_and_normal_equations_hold(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    fit = FA.als(df, "u", "i", "r", rank=2, rounds=6, ridge=0.01)
    objectives = [e[2] for e in fit.errors]
    assert len(objectives) == 12 and all(b <= a + 1e-12 for a, b in zip(objectives, objectives[1:]))
    assert objectives[-1] < objectives[0] / 2
    assert FA.largest_residual(df, "r", fit) < 1e-9
    # the reported error is that of the predictions
    seen = fit.predict(df).select(F.sqrt(F.avg((F.col("r") - F.col("prediction")) ** 2))).first()[0]
    assert seen == pytest.approx(fit.errors[-1][3], abs=1e-9)


def test_als_splits_a_hot_key_without_changing_the_factors(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {r["u"]: r["factors"] for r in FA.als(df, "u", "i", "r", rank=2, rounds=2).users.collect()}
    monkeypatch.setattr(FA, "PER_PART", 4)
    ratings = FA._collapsed(df, "u", "i", "r")
    assert ratings.filter("u = 'u0'").select("user_part").distinct().count() > 1
    split = {r["u"]: r["factors"] for r in FA.als(df, "u", "i", "r", rank=2, rounds=2).users.collect()}
    assert all(np.allclose(split[k], whole[k], atol=1e-9) for k in whole)


def test_als_odd_rows(spark):
    odd = [(None, 1, 1.0), ("a", None, 1.0), ("a", 1, None), ("a", 1, math.nan), ("a", 1, math.inf)]
    empty = FA.als(spark.createDataFrame(odd, SCHEMA), "u", "i", "r", rank=2, rounds=2)
    assert empty.errors == () and empty.users.count() == 0 and empty.items.count() == 0
    df = spark.createDataFrame([*odd, ("a", 1, 2.0), ("b", 1, 4.0)], SCHEMA)
    fit = FA.als(df, "u", "i", "r", rank=2, rounds=3, ridge=1e-4)
    got = {(r["u"], r["i"]): r["prediction"] for r in fit.predict(
        spark.createDataFrame([("a", 1), ("b", 1), ("new", 1), ("a", 9)], "u string, i long")).collect()}
    assert got[("a", 1)] == pytest.approx(2.0, abs=0.01) and got[("b", 1)] == pytest.approx(4.0, abs=0.01)
    assert got[("new", 1)] is None and got[("a", 9)] is None
    with pytest.raises(ValueError):
        FA.als(df, "u", "i", "r", rank=0)
