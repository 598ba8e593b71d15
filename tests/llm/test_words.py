"""Words as arrays, and the index of places that may align, against plain loops."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import decontam, pfor, words
from tablecraft.llm.common import alnum_words


def test_keys_part_the_words_that_splitting_parts():
    rng = random.Random(0)
    bits = ["a", "B", "é", " ", "\n", "漢", "9", "abcdefgh", "abcdefghijk", "\x00", ".", "É"]
    texts = [None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(2000)]
    got = [k.tolist() for k in words.keys_of_texts(texts)]
    key_of = {}
    for text, keys in zip(texts, got, strict=True):
        assert all(key_of.setdefault(w, k) == k for w, k in zip(alnum_words(text), keys, strict=True)), repr(text)
    assert len(set(key_of.values())) == len(key_of) > 500
    column = pa.array(texts)[7:1007]  # a column that does not start its buffer, a few texts at a time
    cut = [k.tolist() for _, offsets, data in words.text_slices(column, 40)
           for keys, first in [words.alnum_keys(offsets, data)] for k in np.split(keys, first[1:-1])]
    assert cut == got[7:1007]
    assert words.keys_of_texts([]) == [] and [k.size for k in words.keys_of_texts([None, "", " "])] == [0, 0, 0]


def test_index_holds_the_places_that_may_align(spark, docs_of):
    """Places without a partner and texts without a candidate stay out; what aligns is all there."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["a", "b", "x", "y", "z", "u"]) for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(100, "a " + "x " * 30 + "b"), (101, "q a x x b q"), (102, "a b"), (103, None), (104, ""), (104, ""), (105, "s"), (106, "s s")]
    key = {w: int(words.keys_of_texts([w])[0][0]) for w in "abs"}
    marks = spark.createDataFrame([(5, 2, key["a"], 5, key["b"], True), (6, 9, key["b"], 1, key["a"], False), (7, 0, key["s"], 0, key["s"], True)],
                                  "item_key long, at int, term long, at2 int, term2 long, whole boolean")
    index = decontam.positional_index(docs_of(rows).select("doc_id", "text"), marks)
    by = {r.doc_id: r for r in index.collect()}
    assert index.count() == len(rows) and by[100].n_words == 32 and by[103].n_words == by[104].n_words == 0
    assert by[100].postings == [] and by[102].postings and {r.text for r in (by[100], by[102], by[103], by[104])} == {None}
    assert by[101].text == "q a x x b q" and by[105].text == "s"
    postings = index.select("doc_key", "doc_id", F.inline("postings")).dropDuplicates(["doc_key", "term"])
    ids = {r.doc_key: r.doc_id for r in by.values()}
    got = sorted((ids[r.doc_key], r.item_key, r.place, r.gap, r.whole) for r in decontam.alignments(postings, marks).collect())
    want = []
    for i, text in rows:
        w = alnum_words(text)
        for item, at, one, at2, two, whole in [(5, 2, b"a", 5, b"b", True), (6, 9, b"b", 1, b"a", False), (7, 0, b"s", 0, b"s", True)]:
            want += [(i, item, p - at, q - at2 - p + at, whole) for p in range(len(w)) for q in range(len(w))
                     if w[p] == one and w[q] == two and abs(q - at2 - p + at) <= decontam.SLACK]
    assert got == sorted(want) and want


# ------------------------------------------------------------------ words of token-id files
@pytest.fixture(scope="module")
def definition():
    with open(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def test_tasks_of_a_worker_share_what_it_has_encoded(definition, monkeypatch):
    monkeypatch.setattr(pfor, "_TOKENS", {})
    tokens = pfor.tokens_of(definition)
    texts = ["The quick brown fox", "the Quick, brown fox."]
    ids = tokens.batch(texts)
    assert pfor.tokens_of(definition) is tokens
    monkeypatch.setattr(tokens, "_encode", None)  # nothing is encoded twice
    monkeypatch.setattr(tokens, "_letters", None)
    assert pfor.tokens_of(definition).batch(texts[::-1]) == ids[::-1]


@pytest.mark.parametrize("most, at_once", [(1_000_000, 1 << 18), (40, 7)])
def test_looked_up_words_make_the_ids_of_whole_texts(definition, monkeypatch, most, at_once):
    """Long words, zero bytes, a table that grows, and one that is forgotten again and again."""
    monkeypatch.setattr(pfor, "CACHE_WORDS", most)
    monkeypatch.setattr(pfor, "LOOKUP_WORDS", at_once)
    tokens, rng = pfor.Tokens(definition), random.Random(2)
    tokens.short = pfor._WordTable(4)
    bits = ["a", "Bc", "é", "À", "Þ", "ß", "×", "ÿ", "Ā", "́", "-", "\x00", "\t", "0", "fourteen", "FIFTEEN", "漢", " ", " ", "\n"]
    texts = [None, "", " \n ", *("".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(800))]
    texts += ["x" * n + "\x00" * z for n in range(1, 18) for z in range(3)]
    for text, ids in zip(texts, tokens.batch(texts), strict=True):
        want = tokens.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)


def test_pieces_part_letters_from_what_follows():
    text = "Élan, don't naïve×2 x Œuvre ab\nn\u0301c 9z Þ"
    raw = np.frombuffer(text.encode(), np.uint8)
    letters, lower = pfor.latin_letters(raw)
    starts, ends, first, latin = pfor.pieces(raw, letters, np.array([0, len(raw)]))
    got = [((lower if k else raw)[s:e].tobytes().decode(), k) for s, e, k in zip(starts, ends, latin.tolist(), strict=True)]
    assert got == [("élan", True), (",", False), ("don", True), ("'t", False), ("naïve×2", False), ("x", True), ("Œuvre", False),
                   ("ab", True), ("n\u0301c", False), ("9z", False), ("þ", True)]
    assert first.tolist() == [0, len(got)]
