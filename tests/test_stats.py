"""Rank statistics against brute force; z-score is global, not per batch (Q5); PCC (Q9)."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from tablecraft.operators import stats as S


def _frame(spark, a, b):
    rows = [(float(x), "a") for x in a] + [(float(x), "b") for x in b]
    return spark.createDataFrame(rows, "x double, g string")


def _brute_u(a, b):
    return sum(1.0 if x > y else 0.5 if x == y else 0.0 for x, y in itertools.product(a, b))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=25), st.lists(st.integers(0, 6), min_size=1, max_size=25))
def test_mann_whitney_u_equals_pair_counting(spark, a, b):
    row = S.mann_whitney(_frame(spark, a, b), "x", "g", "a", "b", buckets=4).first()
    assert (row["n1"], row["n2"]) == (len(a), len(b))
    assert row["u"] == _brute_u(a, b)


def test_mann_whitney_ties_sample_and_p(spark):
    rnd = random.Random(7)
    a = [rnd.randint(0, 20) for _ in range(60)]
    b = [rnd.randint(3, 25) for _ in range(45)]
    row = S.test_result(S.mann_whitney(_frame(spark, a, b), "x", "g", "a", "b"), "mann_whitney")
    assert row["u"] == _brute_u(a, b)
    # tie-corrected normal approximation, continuity 0.5, recomputed in numpy
    allv = np.array(a + b, dtype=float)
    _, counts = np.unique(allv, return_counts=True)
    n1, n2, n = len(a), len(b), len(a) + len(b)
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - (counts ** 3 - counts).sum() / (n * (n - 1))))
    big = max(row["u"], n1 * n2 - row["u"])
    z = (big - n1 * n2 / 2 - 0.5) / sigma
    assert row["z"] == pytest.approx(z, rel=1e-12)
    assert row["p"] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-12)


def _midranks(values):
    s = pd.Series(values, dtype=float)
    return s.rank(method="average").to_numpy()


def test_spearman_matches_numpy_and_mllib(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 9)), float(rnd.randint(0, 30)) + i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = S.spearman(df, "x", "y", buckets=8).first()["rho"]
    x, y = zip(*rows)
    want = np.corrcoef(_midranks(x), _midranks(y))[0, 1]
    assert got == pytest.approx(want, rel=1e-12)
    assert S.spearman_mllib(df, "x", "y") == pytest.approx(want, rel=1e-9)


def test_cumulative_counts_across_buckets_and_keys(spark):
    rows = [(k, v, c) for k in ("p", "q") for v, c in [(1, 2), (3, 1), (7, 4), (9, 1), (12, 3)]]
    df = spark.createDataFrame(rows, "k string, v int, c long")
    out = S.cumulative_counts(df, "v", "c", keys="k", buckets=3).collect()
    got = {(r["k"], r["v"]): r["before_c"] for r in out}
    for k in ("p", "q"):
        assert [got[(k, v)] for v in (1, 3, 7, 9, 12)] == [0, 2, 3, 7, 8]


def test_ks_statistic_brute_force(spark):
    rnd = random.Random(11)
    a = [rnd.randint(0, 40) for _ in range(80)]
    b = [rnd.randint(5, 50) for _ in range(70)]
    row = S.test_result(S.ks_2samp(_frame(spark, a, b), "x", "g", "a", "b"), "ks")
    grid = sorted(set(a + b))
    d = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in grid)
    assert row["d"] == pytest.approx(d, abs=1e-15)
    assert 0.0 <= row["p"] <= 1.0


def test_kruskal_matches_formula(spark):
    rnd = random.Random(5)
    groups = {g: [rnd.randint(0, 12) + i for _ in range(30 + 5 * i)] for i, g in enumerate("abc")}
    rows = [(float(v), g) for g, vs in groups.items() for v in vs]
    row = S.test_result(S.kruskal(spark.createDataFrame(rows, "x double, g string"), "x", "g"), "kruskal")
    values = np.array([v for v, _ in rows])
    ranks = _midranks(values)
    labels = np.array([g for _, g in rows])
    n = len(values)
    h = 12 / (n * (n + 1)) * sum(ranks[labels == g].sum() ** 2 / (labels == g).sum() for g in "abc") - 3 * (n + 1)
    _, t = np.unique(values, return_counts=True)
    h /= 1 - (t ** 3 - t).sum() / (n ** 3 - n)
    assert row["h"] == pytest.approx(h, rel=1e-10)
    assert row["p"] == pytest.approx(math.exp(-h / 2), rel=1e-9)  # chi2 with 2 dof


def test_levene_median_matches_formula(spark):
    rnd = random.Random(9)
    groups = {g: [rnd.gauss(0, 1 + i) for _ in range(25 + 4 * i)] for i, g in enumerate("xyz")}
    rows = [(v, g) for g, vs in groups.items() for v in vs]
    row = S.test_result(S.levene(spark.createDataFrame(rows, "x double, g string"), "x", "g"), "levene")
    zs = {g: np.abs(np.array(v) - np.median(v)) for g, v in groups.items()}
    n, k = len(rows), 3
    zbar = np.concatenate(list(zs.values())).mean()
    num = (n - k) * sum(len(z) * (z.mean() - zbar) ** 2 for z in zs.values())
    den = (k - 1) * sum(((z - z.mean()) ** 2).sum() for z in zs.values())
    assert row["w"] == pytest.approx(num / den, rel=1e-9)
    assert 0.0 <= row["p"] <= 1.0


def test_group_medians_even_and_odd(spark):
    rows = [("a", 1.0), ("a", 5.0), ("a", 3.0), ("b", 4.0), ("b", 2.0), ("b", 2.0), ("b", 10.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["median"] for r in S.group_medians(df, "x", "g").collect()}
    assert got == {"a": 3.0, "b": 3.0}


def test_zscore_is_global_across_partitions(spark):
    pdf = pd.DataFrame({"x": [float(i) for i in range(40)]})
    df = spark.createDataFrame(pdf).repartition(4)
    got = sorted(r["z"] for r in S.zscore(df, "x").collect())
    want = sorted(((pdf.x - pdf.x.mean()) / pdf.x.std()).tolist())
    assert got == pytest.approx(want, rel=1e-12)


def test_zscore_by_group_and_zero_deviation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, x double")
    got = {(r["g"], r["x"]): r["z"] for r in S.zscore(df, "x", by="g").collect()}
    assert got[("a", 1.0)] == pytest.approx(-1 / math.sqrt(2)) and got[("b", 5.0)] is None


def test_chance_criterion_filtered_and_as_coded(spark):
    rows = [("A",), ("A",), ("B",), ("C",), ("Label",)]
    df = spark.createDataFrame(rows, "Label string")
    assert S.chance_criterion(df).first()["pcc"] == pytest.approx(0.375)
    assert S.chance_criterion(df, denominator="all").first()["pcc"] == pytest.approx(0.24)


def test_distribution_helpers():
    assert S.chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, rel=1e-9)
    assert S.f_sf(3.0, 2, 10) == pytest.approx(1.6 ** -5, rel=1e-12)  # closed form for d1 = 2
    assert S.normal_sf2(1.959963984540054) == pytest.approx(0.05, rel=1e-12)
    assert 0.0 < S.ks_sf(0.2, 100, 100) < 0.1


def test_hot_value_holding_a_third_of_rows(spark):
    rnd = random.Random(21)
    values = [5.0] * 1000 + [float(rnd.randint(0, 400)) for _ in range(2000)]
    groups = ["a" if i % 3 else "b" for i in range(len(values))]
    df = spark.createDataFrame(list(zip(values, groups)), "x double, g string").repartition(6)
    ranks = {r["x"]: (r["n"], r["midrank"]) for r in S.midranks(df, "x", buckets=16).collect()}
    want = pd.Series(values).rank(method="average")
    for v, r in zip(values, want):
        assert ranks[v][1] == r
    assert ranks[5.0][0] >= 1000
    row = S.mann_whitney(df, "x", "g", "a", "b", buckets=16).first()
    r = want.to_numpy()
    g = np.array(groups)
    n1 = int((g == "a").sum())
    assert row["u"] == r[g == "a"].sum() - n1 * (n1 + 1) / 2
    med = {m["g"]: m["median"] for m in S.group_medians(df, "x", "g", buckets=16).collect()}
    assert med == {k: float(np.median(np.array(values)[g == k])) for k in ("a", "b")}


def test_auto_buckets_grows_with_distinct_values():
    class Counted:
        def __init__(self, n):
            self.n = n

        def count(self):
            return self.n
    assert S.auto_buckets(Counted(10)) == 256
    assert S.auto_buckets(Counted(300_000_000)) == 512
    assert S.auto_buckets(Counted(5_000_000_000)) == 8192
    assert S.auto_buckets(Counted(10 ** 12)) == 1 << 20  # no upper limit


def test_sized_and_given_bucket_counts_agree(spark):
    rnd = random.Random(4)
    rows = [(k, float(rnd.randint(0, 500)), rnd.randint(1, 5)) for k in ("p", "q") for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, v double, c long").groupBy("k", "v").agg(F.sum("c").alias("c"))
    small = {(r["k"], r["v"]): r["before_c"] for r in S.cumulative_counts(df, "v", "c", keys="k").collect()}
    ranged = {(r["k"], r["v"]): r["before_c"] for r in S.cumulative_counts(df, "v", "c", keys="k", buckets=8).collect()}
    assert small == ranged and len(small) == df.count()
