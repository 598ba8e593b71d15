"""Token-id files, word runs and whitening against brute force, and on odd inputs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import pfor, registry, runs, whitening

public_tokenizers = pytest.importorskip("public_tokenizers")


# ------------------------------------------------------------------ token-id files
@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def whole(definition):
    """The library itself, a whole text at a time."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("n, most", [(1, 1), (5, 3), (8192, 50_000), (100, 2**32 - 1), (777, 2), (64, 1 << 20), (9, 0)])
def test_blocks_round_trip(n, most):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most + 1, n).astype(np.uint32)
    ids[rng.integers(n)] = most
    assert (pfor.decode_block(pfor.encode_block(ids)) == ids).all()


def test_blocks_pack_at_the_percentile():
    """Nine tenths of the values set the width; the rest are exceptions."""
    ids = np.r_[np.arange(90) % 16, np.full(10, 40_000)].astype(np.uint32) + np.uint32(7)
    n, least, width, outliers = pfor.BLOCK_HEAD.unpack_from(pfor.encode_block(ids))
    assert (n, least, width, outliers) == (100, 7, 4, 10)


def test_words_make_the_same_ids_as_whole_texts(definition, whole):
    rng, tokens = random.Random(1), pfor.Tokens(definition)
    bits = ["a", "B", "é", "É", "ß", "ÿ", "÷", "×", "İ", "Σ", "ς", "́", "̸", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x85", "　",
            "\xa0", "'", "'s", "'LL", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "1", "23", "½", "Ⅷ", ".", "...", "—", "漢", "字", "🙂", "\x00",
            "​", "ﬁ", "Å", "Å", "the", "The", "ŒUVRE", "œ", "_"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for text, ids in zip(texts, tokens.batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)


def test_token_files(odd, none, spark, definition, whole, tmp_path, monkeypatch):
    monkeypatch.setattr(pfor, "FILE_IDS", 20)
    files = pfor.write_tokens(odd, definition, str(tmp_path / "tokens")).cache()
    rows = sorted(pfor.read_documents(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]  # null first, repeats kept
    texts = {r.doc_id: r.text for r in odd.collect()}
    start = 0
    for r in rows:
        ids = [*whole(texts[r.doc_id]), pfor.END_ID]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())), r
        got = pfor.read_ids(files, start, start + min(len(ids), 300)).tolist()
        assert got == ids[:300]
        start += len(ids)
    everything = pfor.read_ids(files, 0, start)
    assert len(everything) == start and pfor.read_ids(files, start, start + 5).size == 0
    assert pfor.read_ids(files, 9, 300).tolist() == everything[9:300].tolist()
    assert files.count() > 1 and files.agg(F.sum("n_docs")).first()[0] == 10
    empty = pfor.write_tokens(none, definition, str(tmp_path / "nothing"))
    assert empty.count() == 0 and pfor.read_documents(empty).count() == 0


def test_cut_file_fails(docs_of, definition, tmp_path):
    files = pfor.write_tokens(docs_of([(1, "a b c")]), definition, str(tmp_path / "cut"))
    path = files.first().path
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[:-9])
    with pytest.raises(Exception, match="cut short"):
        pfor.read_documents(files).collect()


def test_one_id_on_many_rows(spark, definition, whole, tmp_path):
    """A hot id, with equal and with different texts, is split over ranges and each row is written once."""
    docs = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
                                             F.concat(F.lit("w"), F.col("id") % 2).alias("text"))
    files = pfor.write_tokens(docs, definition, str(tmp_path / "hot"))
    rows = pfor.read_documents(files).orderBy("start").collect()
    assert len(rows) == 3000 and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    assert [r.start for r in rows] == list(np.cumsum([0, *[r.n_tokens for r in rows[:-1]]]))


# ------------------------------------------------------------------ word runs
def brute_runs(x):
    """Every maximal stretch by every period; the least period of equal stretches."""
    n, out = len(x), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_match_brute_force():
    rng, found = random.Random(3), 0
    for _ in range(1200):
        n, letters = rng.randrange(160), rng.choice([1, 2, 3, 5, 50])
        x = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            if n > 8:
                a, q = rng.randrange(n), rng.randrange(1, max(2, n // 4))
                for i in range(a + q, min(n, a + q * rng.randrange(2, 9) + rng.randrange(q))):
                    x[i] = x[i - q]
        want = brute_runs(x)
        found += len(want)
        assert runs.find_runs(np.array(x, np.int64)) == want, x
    assert found > 500


@pytest.mark.parametrize("length, low, high", [(1, 1, 3), (2, 3, 6), (8, 11, 22), (32, 43, 86)])
def test_zero_mismatches_are_the_occurrences(length, low, high):
    rng = np.random.default_rng(length)
    x = np.tile(rng.integers(0, 3, 16), 12).astype(np.uint64)
    squares = np.r_[0, np.cumsum(x * x)].astype(np.uint64)
    starts = np.arange(0, len(x) - length, length)
    got = runs.zero_mismatches(x, squares, starts, length, low, high)
    for row, s in zip(got, starts, strict=True):
        assert row.tolist() == [s + q + length <= len(x) and (x[s:s + length] == x[s + q:s + q + length]).all() for q in range(low, high)]


def test_long_periodic_texts():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 9000, 30_000)
    assert runs.find_runs(np.tile(base, 5)) == [(0, 150_000, 30_000)]
    assert runs.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    nested = np.tile(np.r_[np.zeros(300, np.int64), 1], 40)
    assert runs.find_runs(nested) == sorted([(301 * i, 300, 1) for i in range(40)] + [(0, 301 * 40, 301)], key=lambda r: (r[0], r[2]))


def test_run_rows(odd, none, docs_of):
    by = {r.doc_id: r for r in runs.find_word_runs(odd).collect()}
    assert [(r.start, r.length, r.period) for r in by[6].runs] == [(0, 210_000, 7)] and by[6].collapsed == "aa bb cc dd ee ff gg"
    assert by[1].runs == [] and by[1].collapsed == by[2].collapsed == by[3].collapsed == "" and by[5].collapsed == "same text here"
    assert runs.find_word_runs(odd).count() == 10 and runs.find_word_runs(none).count() == 0
    texts = [(1, "x a a a a a a b b b b b b y"), (2, "a A a A a A a A"), (3, "z"), (None, "q q q q q q q")]
    got = {r.doc_id: r for r in runs.run_digests(docs_of(texts)).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period, got[1].exponent_milli) == (2, 1, 6, 1, 6000)
    assert got[1].runs_sha256 == hashlib.sha256(b"1,6,1\n7,6,1\n").hexdigest()
    assert got[1].collapsed_sha256 == hashlib.sha256(b"x a b y").hexdigest()
    assert (got[2].start, got[2].length, got[2].period) == (0, 8, 2)
    assert (got[3].n_runs, got[3].start, got[3].exponent_milli) == (0, None, None) and got[3].runs_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None].length == 7


def test_run_query_matches_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.queries()["op13_runs"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        words = (docs[r.doc_id] or "").encode().split()
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if len(words) > 1500:
            continue
        want = brute_runs(words)
        dropped = {i for s, length, q in want for i in range(s + q, s + length)}
        assert r.n_runs == len(want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest()
    assert any(r.n_runs for r in rows)


# ------------------------------------------------------------------ whitening
def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, n string, whitened string")


def test_whitening_matches_brute_force(spark, sf_dir):
    rows = registry.queries()["op12_whitening"](spark, sf_dir).toPandas()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x = np.floor(64 * np.stack(given.embedding.to_numpy()).astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    assert len(rows) == 16 * len(given) and (rows.n == n).all() and rows.identity_error.max() < 1e-10
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[given.vec_id].to_numpy()
    want = (n * x - total) / n @ vectors / np.sqrt(values)
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-9
    assert np.allclose(rows[rows.vec_id == given.vec_id[0]].sort_values("component").explained, values / np.trace(cov), rtol=1e-12)
    deviation = rows.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[given.vec_id].to_numpy()
    assert (deviation == ((n * x - total) ** 2).sum(axis=1)).all()


def test_whitening_odd(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(v) for v in rng.normal(size=3)], "l", "n", "w") for i in range(40)]
    odd = [(100, None, "", "", ""), (101, [1.0, None, 2.0], "", "", ""), (102, [float("nan"), 0.0, 0.0], "", "", ""),
           (103, [float("inf"), 0.0, 0.0], "", "", ""), (104, [1.0, 2.0], "", "", ""), (105, [], "", "", ""), (106, [3e38, 0.0, 0.0], "", "", ""),
           (None, good[0][1], "", "", ""), (0, good[0][1], "", "", "")]
    vectors = whitening.quantised(vectors_of(spark, good + odd))
    fitted = whitening.fit_whitening(vectors)
    rows = whitening.whiten(vectors, fitted).collect()
    assert fitted.centre.n == 40 and len(fitted.variances) == 3 and fitted.identity_error < 1e-12  # repeats fitted once
    assert len(rows) == 42 * 3 + 2  # other lengths once, null
    assert {r.vec_id for r in rows if r.component is None} == {104, 105} and {r.vec_id for r in rows} >= {None, 0, 39}
    assert not {r.vec_id for r in rows} & {100, 101, 102, 103, 106}
    same = whitening.quantised(vectors_of(spark, [(i, [1.0, 2.0], "", "", "") for i in range(5)]))
    for nothing in (same, same.limit(0)):
        assert whitening.fit_whitening(nothing) is None and whitening.whiten(nothing, None).count() == 0
    line = whitening.quantised(vectors_of(spark, [(i, [float(i), 2.0 * i, 0.0], "", "", "") for i in range(9)]))
    fitted = whitening.fit_whitening(line)
    assert len(fitted.variances) == 1  # the other directions have no variance
    assert whitening.whiten(line, fitted).count() == 9


def test_large_deviations():
    centre = whitening.Centre(3, np.array([5, 5]), np.array([1, 2]))
    assert centre.deviation(np.array([[7, 5], [4 * 10**9, 5]])) == [5 * 5 + 2 * 2, None]
    assert centre.deviation(np.array([[10**9, 5]])) == [(3 * 10**9 - 16) ** 2 + 4]


@pytest.mark.parametrize("kind", ["flat", "gap", "decay"])
def test_jacobi_davidson_reaches_double_precision(kind):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((160, 900))
    if kind == "gap":
        m[0] *= 5
    if kind == "decay":
        m *= (0.9 ** np.arange(160))[:, None]
    a, products = m @ m.T / 900, []

    def multiply(block):
        products.append(block.shape[1])
        return a @ block

    values, vectors, residual = whitening.jacobi_davidson(multiply, 160, 16)
    want = np.linalg.eigh(a)[0][::-1][:16]
    assert np.allclose(values, want, rtol=1e-12) and residual < 1e-13 and max(products) <= 20
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    a = q @ np.diag(np.r_[np.linspace(-3, -1, 10), np.linspace(1, 4, 20)]) @ q.T
    rhs = rng.standard_normal((30, 4))
    assert np.abs(a @ whitening.minres(lambda b: a @ b, rhs, 30) - rhs).max() < 1e-8
