"""The operators against brute force, and on odd inputs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tablecraft.llm import bpe, chat, decontam, exact, langid, licenses, minhash, pii, registry, sharding, toxicity
from tablecraft.llm.components import components

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ------------------------------------------------------------------ exact copies
def test_exact_groups(odd, none):
    got = {(r.doc_id, r.text_sha256): r for r in exact.exact_groups(odd, all_digests=True).collect()}
    assert len(got) == 9  # the repeated row comes out once
    assert got[1, sha("")].keep_id == got[2, sha("")].keep_id == 2 and got[2, sha("")].group_size == 2
    assert [got[i, sha("same text here")].kept for i in (4, 5)] == [False, True]
    assert got[5, sha("same text here")].group_size == 3
    assert got[None, sha("one two three four five six")].kept
    assert exact.exact_groups(none).count() == 0


def test_exact_hashes_only_survivors(docs_of):
    got = {r.doc_id: r for r in exact.exact_groups(docs_of([(1, "a"), (2, "bcd"), (3, "bcd"), (4, "bce")])).collect()}
    assert got[1].text_sha256 is None and got[2].text_sha256 == sha("bcd") and (got[2].keep_id, got[4].keep_id) == (3, 4)


def test_drop_copies(odd, docs_of):
    kept = exact.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 8]
    both = exact.drop_copies(docs_of([(9, "twice"), (9, "twice"), (3, "other"), (9, "other")])).collect()
    assert sorted((r.doc_id, r.text) for r in both) == [(9, "other"), (9, "twice")]


# ------------------------------------------------------------------ near copies
def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def near_brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    comp = {i: i for i, _ in sets}
    moved = True
    while moved:
        moved = False
        for i, a in sets:
            for j, b in sets:
                if a and b and comp[j] < comp[i] and 100 * len(a & b) >= 75 * len(a | b):
                    comp[i], moved = comp[j], True
    return {i: (len(s), comp[i]) for i, s in sets}


def near_rows(seed=5):
    """Drifting copies of two texts, of sizes around the threshold, short texts and strangers."""
    rng, rows = random.Random(seed), []
    for base in (sentence(rng, 120).split(), sentence(rng, 60).split()):
        for _ in range(60):
            w = list(base)
            for _ in range(rng.randrange(9)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
            rows.append(" ".join(w[:rng.choice([len(w), len(w), len(w) - 10])]))
    rows += [sentence(rng, rng.randrange(1, 30)) for _ in range(20)] + ["A b", "a B", "a b c d e", "a b c d", "", "  ", None]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_near_groups_match_brute_force(docs_of):
    rows = near_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(docs_of(rows)).collect()}
    assert got == near_brute(rows)


def test_near_groups_odd(odd, none):
    got = minhash.near_groups(odd).collect()
    assert len(got) == 10
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[1].kept and by[2].kept
    assert by[None].component_id is None and by[None].kept and by[5].component_id == 4 and not by[5].kept
    assert minhash.near_groups(none).count() == 0


def test_circulant_signature_estimates_similarity():
    import numpy as np
    c, rng = minhash.Circulant(), np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 1400).astype(np.uint64)
    a, b = np.sort(pool[:1200]), np.sort(pool[200:])
    assert abs((c.signature(a) == c.signature(b)).mean() - 1000 / 1400) < 0.1


def test_components(spark):
    links = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (3, 3), (20, 21), (21, 20), (None, 4)] + [(100, i) for i in range(101, 150)], "a long, b long")
    got = {r.id: r.component_id for r in components(links).collect()}
    assert got == {9: 6, 8: 6, 7: 6, 6: 6, 20: 20, 21: 20} | {i: 100 for i in range(100, 150)}
    assert components(links.limit(0)).count() == 0


# ------------------------------------------------------------------ decontamination
def test_passages_match_brute_force(spark, docs_of):
    rng = random.Random(1)
    items = [("a", sentence(rng, 25, 60)), ("b", sentence(rng, 12, 60)), ("c", "w1 W2, w3"), ("d", ""), ("e", None), ("f", "w7"), ("b", "w9 w9 w9")]
    rows = [(i, sentence(rng, 60, 60)) for i in range(30)]
    cut = items[0][1].split()
    rows += [(50, "x " + " ".join(cut[3:18]) + " y " + items[1][1].upper()), (51, " ".join(cut[:9])), (52, None), (53, ""), (53, ""),
             (54, " ".join(cut[2:7]) + " extra " + " ".join(cut[7:14])), (55, "w9 w9 w9 w9 w9")]
    bench = spark.createDataFrame(items, "item_id string, text string").withColumn("doc_id", F.lit(1))
    out, matches = decontam.find_passages(docs_of(rows), bench)
    got = sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in out.collect())
    want = []
    for i, text in rows:
        w, hit, found = WORDS.findall(lower(text)), set(), set()
        for item, passage in items:
            p = WORDS.findall(lower(passage))
            n = min(10, len(p))
            for s in range(len(p) - n + 1 if p else 0):
                for at in range(len(w) - n + 1):
                    if w[at:at + n] == p[s:s + n]:
                        hit.update(range(at, at + n))
                        found.add(item)
        want.append((i, len(w), len(hit), tuple(sorted(found))))
    assert got == sorted(want)
    assert matches.filter("gap <> 0").count() > 0  # the interrupted copy is a proximity match


def test_proximity_of_copies_with_replaced_words(spark, docs_of):
    passage = "the quick onyx goblin jumps over one lazy dwarf today"  # one window
    rows = [(i, "the quick one over today lazy jumps dwarf goblin") for i in range(4)]  # all but onyx, in another order
    rows += [(10, passage), (11, passage.replace("onyx", "red")), (12, passage.replace("onyx", "very red")), (13, "nothing at all"),
             (20, "some rare zebra words stand here"), (21, "some rare words")]
    items = [("a", passage), ("b", "some absentword rare zebra words stand here")]
    out, matches = decontam.find_passages(docs_of(rows), spark.createDataFrame(items, "item_id string, text string"))
    got = {r.doc_id: r for r in out.collect()}
    assert (got[10].n_hit, got[11].n_hit, got[12].n_hit, got[20].n_hit) == (10, 0, 0, 0)
    assert got[11].n_near and got[12].n_near and got[20].n_near and not got[13].n_near
    keys = {r.doc_key: r.doc_id for r in got.values()}
    rows = matches.collect()
    assert [(keys[r.doc_key], r.item_id, r.place, r.gap) for r in rows if r.phrase] == [(10, "a", 0, 0)]
    assert {(11, "a", 0, 0), (20, "b", 0, 0)} & {(keys[r.doc_key], r.item_id, r.place, r.gap) for r in rows if not r.phrase}
    assert sum(not r.phrase for r in rows) == sum(r.n_near for r in got.values())


def test_alignments_meet_near_places_only(spark):
    rng = random.Random(8)
    places = [sorted(rng.sample(range(400), 120)) for _ in range(2)]
    postings = spark.createDataFrame([(1, 10, places[0]), (1, 20, places[1])], "doc_key long, term long, places array<int>")
    marks = spark.createDataFrame([(5, 7, 10, 2, 20, True)], "item_key long, at int, term long, at2 int, term2 long, whole boolean")
    out = decontam.alignments(postings, marks)
    want = {(a - 7, b - 2 - a + 7) for a in places[0] for b in places[1] if abs(b - 2 - a + 7) <= decontam.SLACK}
    assert sorted((r.place, r.gap) for r in out.collect()) == sorted(want)  # places before the document's start among them
    joins = re.findall(r"Join \[([^\]]*at2#[^\]]*)\]", out._jdf.queryExecution().executedPlan().toString())
    assert joins and all("bin#" in keys for keys in joins)


def test_passages_empty(spark, odd, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontam.find_passages(odd, bench)[0].collect()} == {0}
    assert decontam.find_passages(odd, bench)[0].count() == 10
    assert decontam.find_passages(none, spark.createDataFrame([(1, "a b")], "item_id long, text string"))[0].count() == 0


# ------------------------------------------------------------------ toxicity
def toxic_rows(insulted):
    """400 texts, every fourth toxic: a share of those by an insult, the group named mostly in toxic ones."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = sentence(rng, 20).split() + (["grobian"] if toxic and rng.random() < insulted else [])
        if toxic and rng.random() < 0.9 or rng.random() < 0.03:
            words.append("muslim")
        rng.shuffle(words)
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_learns(spark, docs_of):
    rows, labels = toxic_rows(1.0)
    docs = docs_of(rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert sum((got[i] >= 0.7) == bool(t) for i, t in labels) >= 396
    assert all(got[i] == pytest.approx(float(model.score(t))) for i, t in rows)
    assert set(toxicity.keep_clean(docs, model).columns) == set(docs.columns)
    assert toxicity.keep_clean(docs, model).count() == sum(s < 0.7 for s in got.values())


def test_swapped_groups_keep_neutral_mentions_clean(spark, docs_of):
    rows, labels = toxic_rows(0.5)
    docs, marks = docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    fair, plain = toxicity.train(docs, marks), toxicity.train(docs, marks, counterfactual=0.0)
    probe = "the muslim family bought bread"
    gap = lambda m: abs(m.score(probe) - m.score(probe.replace("muslim", "christian")))
    assert plain.score(probe) >= 0.7 > fair.score(probe) and gap(fair) < 0.1 * gap(plain)
    assert fair.score("such a grobian") > fair.score(probe)


def test_toxicity_odd(spark, odd, none):
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(odd, nothing)
    scores = [r.score for r in toxicity.score_documents(odd, model).collect()]
    assert len(scores) == 10 and all(0 <= s < 0.7 for s in scores)
    odd_labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (6, 0), (6, 0)], "doc_id long, toxic int")
    assert 0 <= toxicity.train(odd, odd_labels).score(None) <= 1
    assert toxicity.score_documents(none, model).count() == 0
    assert ("muslim", "jewish") in toxicity.identity_swaps("A Muslim. Nothing!")


# ------------------------------------------------------------------ language
def test_language_spans(spark):
    train = spark.createDataFrame(
        [("the house and the garden were there with them", "en"), ("das haus und der garten waren dort mit ihnen", "de"),
         ("это дом и сад они были там", "ru")] * 20, "text string, lang string")
    model = langid.train(train)
    mixed = "the garden and the house were there with them and the house das haus und der garten waren dort mit ihnen und der garten дом и сад"
    lang, score, spans = langid.label_text(mixed, model)
    assert [x for _, _, x in spans] == ["en", "de", "ru"] and 0 <= score <= 1
    assert mixed[spans[2][0]:spans[2][1]] == "дом и сад" and mixed[spans[1][0]:].startswith("das haus")
    assert langid.label_text("дом", model)[0] == "ru"


def test_viterbi_matches_brute_force():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.normal(0, 6, (6, 3))
        cost = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 4.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(map(cost, itertools.product(range(3), repeat=6)))
        assert cost(list(langid.viterbi(s, 4.0))) == pytest.approx(best)


def test_language_odd(spark, odd, none):
    model = langid.train(odd)
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 8)] == ["und"] * 4 and got[6].lang_pred == "en" and got[8].score == 0
    assert langid.identify(odd, langid.train(none)).first().lang_pred == "und"
    assert langid.identify(none, model).count() == 0


# ------------------------------------------------------------------ shards
def test_shards(spark, docs_of):
    docs = docs_of([(i, "x" * (i % 7)) for i in range(3000)] + [(None, None), (5, "again"), (5, "again")])
    got = sharding.shard_documents(docs).collect()
    assert {r.grown_shard - 24 for r in got if r.grown_shard != r.shard} == {0}
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) == 24 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.doc_id == 5}) == 1 and {r.size for r in got if r.doc_id is None} == {8}


def test_weights_move_rows_only_where_they_change(spark, none):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    both = sharding.with_shard(sharding.with_shard(ids, "doc_id", 24, "a"), "doc_id", 24, "b", {3: 3.0}).collect()
    assert {r.b for r in both if r.a != r.b} == {3}
    share = sum(r.b == 3 for r in both) / len(both)
    assert abs(share - 3 / 26) < 0.03
    cut = sharding.with_slot(ids.withColumn("s", F.col("doc_id") % 2), "s", ["doc_id"], blocks=7).collect()
    assert all(sorted(r.slot for r in cut if r.s == s) == list(range(2000)) for s in (0, 1))
    assert sharding.shard_documents(none).count() == 0


# ------------------------------------------------------------------ licences
def test_licences_match_brute_force(docs_of, odd, none):
    rows = [(1, "CC-BY and cc by-nc 4.0. All rights, reserved! all rights all rights reserved"), (2, "Licensed under the Apache License, Version 2.0"),
            (3, "the General Public License general public license"), (4, "public license general"), (5, None), (6, "Licensed under CC BY-NC 4.0"),
            (7, "apache license")]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs_of(rows)).collect()}
    for i, text in rows:
        w = WORDS.findall(lower(text))
        want = sorted((s, label) for p, label in licenses.BASE_PHRASES for s in range(len(w)) if w[s:s + len(p.split())] == p.split())
        assert [(x.start, x.label) for x in got[i].base] == want and got[i].n_words == len(w)
    assert [x.label for x in got[2].found] == ["apache-2.0"] and not got[7].found and [x.label for x in got[6].found] == ["cc-by-nc"]
    assert licenses.scan_licenses(odd).count() == 10 and licenses.scan_licenses(none).count() == 0


# ------------------------------------------------------------------ BPE
def test_bpe_round_trip(odd, none, docs_of):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.tiktoken")
    enc = bpe.encoder(bpe.read_ranks(path), P.PATTERN)
    texts = ["", "a  b   c\n\n d", "x" * 3000, " lead", "tail ", "it's <|endoftext|> é漢字    x 12 345", "ab cd  ef \n gh " * 9000]
    for t in texts:
        assert bpe.encode(t, enc) == enc.encode_ordinary(t)
        for size in (1, 3, 10) if len(t) < 4000 else (50,):
            assert sum((enc.encode_ordinary(p) for p in bpe.pieces(t, size)), []) == enc.encode_ordinary(t)
    got = {r.doc_id: r for r in bpe.tokenize(docs_of(list(enumerate([None, *texts]))), path, P.PATTERN).collect()}
    assert got[0].ids == b"" and all(bytes(got[i + 1].decoded).decode() == t for i, t in enumerate(texts))
    assert bpe.tokenize(odd, path, P.PATTERN, outputs="digests").count() == 10
    assert bpe.tokenize(none, path, P.PATTERN).count() == 0
    assert bpe.with_token_counts(odd, path, P.PATTERN).filter("decodes").count() == 10


# ------------------------------------------------------------------ personal data
def test_patterns_match_plain_regular_expressions():
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            odd = [int(c) for c in reversed(d)]
            return 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(odd)) % 10 == 0
        return kind == "email" or 10 <= len(d) <= 15

    rng = random.Random(4)
    texts = ["a@b.c_d@e.f g@h i@@j.k l@m..n o.@p-q.r.s@t.u", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.0255", "4111 1111-1111 1111 +44 (20) 7946-0958."]
    texts += ["".join(rng.choice("01259.@+ -()ab_é") for _ in range(60)) for _ in range(3000)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(40)) for _ in range(1000)]
    for t in texts:
        want = sorted(((k, *m.span()) for k, p in plain.items() for m in re.finditer(p, t) if valid(k, m.group())), key=lambda x: (x[1], pii.KINDS.index(x[0])))
        assert pii.base_spans(t) == want, t


def test_skip_chain_labels_repeats(docs_of, odd, none):
    text = "Call +44 20 7946 0958 now. " + "word " * 50 + "Later 442079460958 again, room 12, 2024."
    docs = docs_of([(i, text if i % 2 else f"room {i} in 20{i:02d}, mail a{i}@b.org or +44 20 7946 {i:04d}") for i in range(40)])
    model = pii.train(docs)
    got = {r.doc_id: r for r in pii.find_pii(docs, model).collect()}
    added = [(x.kind, text[x.start:x.end]) for x in got[1].added]
    assert added == [("phone", "442079460958")] and not got[2].added
    many = pii.find_pii(odd, pii.train(odd)).collect()
    assert len(many) == 10 and {len(r.base) for r in many if r.doc_id in (1, 2, 3)} == {0}
    assert pii.find_pii(none, pii.train(none)).count() == 0
    digits = "1" * 200_000  # long digit runs stay linear
    assert pii.base_spans(digits + ".") == []


def test_every_repeat_of_a_found_span_is_labelled(docs_of):
    counts = (3, 20, 200)
    rows = [(n, "Call +44 20 7946 0958 now. " + "then 442079460958 at 2024, " * n) for n in counts]
    rows += [(n + 1, "order 442079460958 " * n + "room 12, and +44 20 7946 0958") for n in counts]
    rows += [(1000 + i, "item 123456789012 part 98765432 " * 5) for i in range(600)]  # the shape's potential is at its floor
    model = pii.train(docs_of(rows))
    assert model.unary([pii._shape("442079460958")])[0, 1:].max() <= -8
    for n, (_, text) in zip(counts * 2, rows, strict=False):
        added = pii.added_spans(text, pii.base_spans(text), model)
        assert [(k, text[a:b]) for k, a, b in added] == [("phone", "442079460958")] * n, text[:40]
    assert pii.key_groups(pii.nodes_of(rows[0][1], pii.base_spans(rows[0][1]))) == [(0, 1, 3, 5), (2, 4, 6)]


def test_field_runs_on_every_document(docs_of):
    """Shape evidence counts with and without a match or a repeat; what a check rejected is no match by its shape."""
    rng = random.Random(6)
    names = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    rows = [(i, f"mail {n}@{n}host.de or 10.20.30.{i % 200} room {i}") for i, n in enumerate(names)]
    rows += [(1000 + i, f"paid with 41111111111111{i:02d} there") for i in range(100)]
    rows += [(2000 + i, t) for i, t in enumerate([
        "only joe@exämple.de here", "joe@exämple.de and 10.20.30.40", "joe@exämple.de, 10.20.30.40, again 010.20.30.40 and 10.20.30.40",
        "room 269", "in 2024 paid 4111111111111112", "4111111111111112 or 4111111111111111", "host 10.20.30.444", "none", ""])]
    docs = docs_of(rows)
    got = {r.doc_id: [(x.kind, rows[r.doc_id - 2000 + 400][1][x.start:x.end]) for x in r.added]
           for r in pii.find_pii(docs, pii.train(docs)).collect() if r.doc_id >= 2000}
    assert [got[2000 + i] for i in range(9)] == [[("email", "joe@exämple.de")]] * 3 + [[]] * 6


# ------------------------------------------------------------------ chat
def test_chat_round_trip(spark):
    rows = [(1, 2, "assistant", "b<|end|>&lt;"), (1, 1, "user", None), (1, 3, "assistant", "</s>[INST]"), (1, 3, "assistant", "</s>[INST]"),
            (2, None, None, ""), (None, 0, "us<er\n", "x & y"), (3, 0, "user", "a"), (3, 0, "assistant", "z<|next|>"), (3, 1, "user", "漢字 " * 5000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_conversations(turns)
    got = {r.conv_id: [(t.role, t.text, t.loss) for t in r.turns] for r in chat.read_conversations(out).collect()}
    assert got[1] == [("user", "", False), ("assistant", "b<|end|>&lt;", True)] + [("assistant", "</s>[INST]", True)] * 2
    assert got[2] == [("", "", False)] and got[None] == [("us<er\n", "x & y", False)]
    assert [t[0] for t in got[3]] == ["assistant", "user", "user"]
    one = out.filter("conv_id = 1").first()
    assert one.formatted.count("<|turn|>") == 2  # adjacent assistant turns are one block
    at, loss = 0, ""
    for m in one.loss_mask:
        at += m.skip
        loss += one.formatted[at:at + m.chars] if m.loss else ""
        at += m.chars
        if one.formatted.startswith("<|end|>", at):
            at += 7
    assert loss.replace("&lt;", "<").replace("&amp;", "&") == "b<|end|>&lt;" + "</s>[INST]" * 2
    assert chat.format_conversations(turns.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ queries
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, sf_dir, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = registry.queries()[name](spark, sf_dir).toPandas()
    want = con.sql(registry.oracle_sql()[name]).df()
    rows = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).values.tolist()))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_queries_return_a_row_per_document(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name, query in registry.queries().items():
        if name not in ("op2_chat_format", "op5_exact_dedup", "op12_whitening"):  # op12: a row per vector and component
            assert query(spark, sf_dir).count() == n, name


# ------------------------------------------------------------------ near copies: hard groups
def replaced_copies(m, k, words=150, seed=0):
    """Copies of one text with k words replaced each: pairs lie around or just under the threshold."""
    rng, base, out = random.Random(seed), [f"b{i}" for i in range(words)], []
    for i in range(m):
        w = list(base)
        for j in rng.sample(range(words), k):
            w[j] = f"x{rng.randrange(10**9)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("k", [2, 3, 4])
def test_near_groups_of_replaced_copies(docs_of, k):
    rows = replaced_copies(150, k) + [(1000 + i, t) for i, t in replaced_copies(60, k, 40, seed=1)] + [(2000, " ".join(f"b{i}" for i in range(150)))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(docs_of(rows)).collect()}
    assert got == near_brute(rows)


def test_near_groups_of_one_id_with_two_texts(docs_of):
    a, b = sentence(random.Random(1), 60, 10**6), sentence(random.Random(2), 60, 10**6)
    rows = [(5, a), (5, b), (7, a + " a"), (8, b + " b"), (8, b + " b")]
    got = sorted((r.doc_id, r.component_id, r.n_shingles) for r in minhash.near_groups(docs_of(rows)).collect())
    assert got == [(5, 5, 56), (5, 5, 56), (7, 5, 57), (8, 5, 57), (8, 5, 57)]


def test_near_threshold_copies_are_compared_in_proportion(docs_of, monkeypatch):
    """Sets whose pairs lie just under the threshold: comparisons grow with the group, not with its square."""
    counted = []
    confirmed = minhash._confirmed

    def counting(pairs, sets):
        counted[-1] += pairs.count()
        return confirmed(pairs, sets)

    monkeypatch.setattr(minhash, "_confirmed", counting)
    for m in (300, 600, 1200):
        counted.append(0)
        rows = replaced_copies(m, 4)
        assert minhash.near_groups(docs_of(rows)).select("component_id").distinct().count() > 0.9 * m
    assert counted[1] < 2.6 * counted[0] and counted[2] < 2.6 * counted[1] and counted[2] < 0.05 * 1200 * 1199 / 2


def test_near_groups_leave_little_scratch(spark, docs_of):
    """Working tables are deleted; what the result still reads stays."""
    import os

    from tablecraft.session import checkpoint_root
    folder = f"{checkpoint_root(spark)}/tablecraft-llm".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = minhash.near_groups(docs_of(replaced_copies(30, 2)))
    assert sorted(n.rpartition("-")[0] for n in set(os.listdir(folder)) - before) == ["components", "sketches"]
    assert got.count() == 30 and got.count() == 30


def test_written_tables_leave_no_shuffle_files(spark):
    """A written table's shuffle files go with its query; the session's setting stays as it was."""
    from tablecraft.llm import common
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}
    rows = spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count()
    before = shuffled()
    rows.collect()
    assert shuffled() - before  # what a query leaves otherwise
    seen, setting = shuffled(), spark.conf.get(common.FREE_SHUFFLES, "false")
    out = common.written(rows, "freed")
    assert not shuffled() - seen
    assert spark.conf.get(common.FREE_SHUFFLES, "false") == setting
    assert sorted(map(tuple, out.collect())) == [(k, 100) for k in range(10)]
    with pytest.raises(ZeroDivisionError), common.shuffles_freed(spark):
        1 / 0
    assert spark.conf.get(common.FREE_SHUFFLES, "false") == setting
