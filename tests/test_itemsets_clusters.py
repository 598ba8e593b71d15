"""Item sets, k-means, silhouette, one-sample KS and checked JSON lines against plain Python."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.operators import itemsets, stats
from tablecraft.operators.clusters import kmeans_rounds, silhouette
from tablecraft.sources import readers as RD


# ------------------------------------------------------------------ item sets
def brute_sets(baskets, least, most):
    held = Counter(s for items in baskets.values() for k in range(1, most + 1) for s in itertools.combinations(sorted(items), k))
    return {s: n for s, n in held.items() if n >= least}


@pytest.mark.parametrize("per_task", [1000, 2])
def test_frequent_sets_match_brute_force(spark, monkeypatch, per_task):
    """Also with baskets split into parts of two items."""
    monkeypatch.setattr(itemsets, "PER_TASK", per_task)
    rng = random.Random(2)
    baskets = {b: {rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))} for b in range(120)}
    baskets[999] = set("abcdefghijklmnop")  # a large basket
    rows = [(b, i) for b, items in baskets.items() for i in items] + [(0, next(iter(baskets[0]))), (None, "a"), (5, None)]
    rng.shuffle(rows)
    found = itemsets.frequent_sets(spark.createDataFrame(rows, "b int, i string"), "b", "i", 0.02, most=4)
    want = brute_sets(baskets, math.ceil(0.02 * 121), 4)
    assert {tuple(r["items"]): r["support"] for r in found.collect()} == want and max(map(len, want)) == 4


def test_frequent_sets_of_nothing(spark):
    nothing = spark.createDataFrame([], "b int, i string")
    assert itemsets.frequent_sets(nothing, "b", "i", 0.5).count() == 0


def test_candidates_need_every_subset(spark):
    frequent = spark.createDataFrame([(["a", "b"],), (["a", "c"],), (["b", "c"],), (["b", "d"],)], "items array<string>")
    assert [r["items"] for r in itemsets._candidates(frequent, 3).collect()] == [["a", "b", "c"]]  # c, d is not frequent


# ------------------------------------------------------------------ clusters
def points_of(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<float>, label string")


def test_kmeans_matches_plain_rounds(spark):
    import hashlib
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 1, (40, 3)) for c in (0, 4, 9)]).astype(np.float32)
    rows = [(i, [float(a) for a in v], "") for i, v in enumerate(x)]
    odd = [(500, None, ""), (None, [0.0, 0.0, 0.0], ""), (501, [0.0, float("nan"), 1.0], "")]
    got = {r.cluster: (r.n, r.cost) for r in kmeans_rounds(points_of(spark, rows + odd), "v", "id", 3, 4).collect()}
    p = x.astype(np.float64)
    centres = p[sorted(range(len(p)), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:3]].copy()
    for _ in range(4):
        to = ((p[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([p[to == c].mean(axis=0) if (to == c).any() else centres[c] for c in range(3)])
    d = ((p[:, None] - centres) ** 2).sum(axis=2)
    for c, (n, cost) in got.items():
        assert n == (d.argmin(axis=1) == c).sum() and abs(cost - d.min(axis=1)[d.argmin(axis=1) == c].sum()) < 1e-9
    assert kmeans_rounds(points_of(spark, rows[:2]), "v", "id", 5, 2).agg(F.sum("n")).first()[0] == 2
    assert kmeans_rounds(points_of(spark, []), "v", "id", 5, 2).count() == 0


def test_silhouette_matches_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4)).astype(np.float32) + np.repeat([0, 1, 5], 20)[:, None].astype(np.float32)
    label = ["a"] * 20 + ["b"] * 20 + ["c"] * 19 + ["alone"]
    rows = [(i, [float(a) for a in v], c) for i, (v, c) in enumerate(zip(x, label, strict=True))] + [(70, None, "a"), (71, [0.0] * 4, None)]
    got = {r.cluster: (r.n, r.silhouette) for r in silhouette(points_of(spark, rows), "v", "label").collect()}
    p, label = x.astype(np.float64), np.array(label)
    far = ((p[:, None] - p) ** 2).sum(axis=2)
    for c in set(label):
        values = []
        for i in np.flatnonzero(label == c):
            own = (label == c) & (np.arange(len(p)) != i)
            a, b = far[i, own].mean() if own.any() else 0, min(far[i, label == o].mean() for o in set(label) - {c})
            values.append((b - a) / max(a, b) if own.any() else 0)
        assert got[c][0] == len(values) and abs(got[c][1] - np.mean(values)) < 1e-9
    one = silhouette(points_of(spark, [(1, [1.0], "a"), (2, [2.0], "a")]), "v", "label").first()
    assert (one.n, one.silhouette) == (2, 0.0) and silhouette(points_of(spark, []), "v", "label").count() == 0


# ------------------------------------------------------------------ one-sample KS
def test_normal_cdf(spark):
    z = [x / 8 for x in range(-80, 81)]
    rows = spark.createDataFrame([(x,) for x in z], "z double").select("z", stats.normal_cdf(F.col("z")).alias("p")).collect()
    assert all(abs(r.p - 0.5 * math.erfc(-r.z / math.sqrt(2))) < 1e-13 for r in rows)


def test_ks_1samp(spark):
    rng = random.Random(4)
    x = [round(rng.gauss(3, 2), 1) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in x] + [(None,)], "x double")
    for given in ((), (3.0, 2.0)):
        r = stats.ks_1samp(df, "x", *given).first()
        m = given[0] if given else sum(x) / 300
        s = given[1] if given else math.sqrt(sum((v - m) ** 2 for v in x) / 300)
        f = {v: 0.5 * math.erfc(-(v - m) / s / math.sqrt(2)) for v in x}
        plus = max(sum(w <= v for w in x) / 300 - f[v] for v in f)
        minus = max(f[v] - sum(w < v for w in x) / 300 for v in f)
        assert r.n == 300 and abs(r.d_plus - plus) < 1e-12 and abs(r.d_minus - minus) < 1e-12 and r.d == max(r.d_plus, r.d_minus)
    assert stats.ks_1samp(df.limit(0), "x").first().d is None
    assert stats.ks_1samp(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x").first().d is None


# ------------------------------------------------------------------ text files
def test_json_lines_checked(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', '{"a": 2}', '{"a": "no"}', "", '{"a": 3', "[1]", "7", "null", '{"a": 4, "c": 5}', "text"]
    (tmp_path / "l.json").write_text("\n".join(lines) + "\n")
    rows = RD.json_lines_checked(spark, str(tmp_path / "l.json"), "a INT, b STRING").collect()
    by = {r.line: r for r in rows}
    assert len(rows) == len(lines) and all(r.path.endswith("l.json") for r in rows)
    assert {k: r.reason for k, r in by.items() if r.reason} == {
        '{"a": "no"}': "wrong type", "": "blank", '{"a": 3': "no JSON object", "[1]": "no JSON object", "7": "no JSON object",
        "null": "no JSON object", "text": "no JSON object"}
    assert by[lines[0]].doc == (1, "x") and by[lines[8]].doc == (4, None) and by['{"a": "no"}'].doc is None
    good, bad = RD.json_lines_split(spark, str(tmp_path / "l.json"), "a INT, b STRING")
    assert sorted(r.a for r in good.collect()) == [1, 2, 4] and good.columns == ["a", "b"] and bad.count() == 7


def test_whole_files_share_tasks(spark, tmp_path):
    """Many small files: one row each with its name, packed into few tasks."""
    for i in range(60):
        (tmp_path / f"f{i}.txt").write_text(f"{i}\n" * (i + 1))
    whole = RD.read_whole_texts(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: r.value for r in whole.collect()}
    assert got == {f"f{i}.txt": f"{i}\n" * (i + 1) for i in range(60)}
    assert whole.rdd.getNumPartitions() < 60
