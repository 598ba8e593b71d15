"""The pipeline's rows against its stages' brute force."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_pipeline(spark, sf_dir):
    from test_operators import WORDS, lower, near_brute
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).collect()}
    assert all(i in clean for i, t in labels.items() if t == 0 and i in docs)
    last = {}
    for i in sorted(clean):
        last[docs[i].text] = i
    kept = [i for i, (_, c) in near_brute([(i, docs[i].text) for i in last.values()]).items() if i == c]
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = set()
    for item in bench:
        w = WORDS.findall(lower(item))
        windows |= {tuple(w[s:s + min(10, len(w))]) for s in range(max(1, len(w) - 9)) if w}

    def contaminated(text):
        w = WORDS.findall(lower(text))
        return any(tuple(w[s:s + n]) in windows for n in {len(x) for x in windows} for s in range(len(w) - n + 1))

    want = {i for i in kept if not contaminated(docs[i].text)}
    assert {r.doc_id for r in out} == want and all(r.decodes for r in out)
    assert {r.doc_id: r.text for r in out} == {i: docs[i].text for i in want}
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_stages_drop_the_row_that_was_judged(spark, sf_dir):
    """Null ids are dropped too, and another text under a dropped row's id stays."""
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("text IS NOT NULL AND length(text) > 100").first().text
    schema = "doc_id long, text string, source string"
    docs = spark.createDataFrame([(None, passage, "a"), (7, passage, "b"), (7, "a clean text", "c"), (8, None, "d"), (None, "clean", "e")], schema)
    left = corpus_pipeline.drop_contaminated(spark, docs, sf_dir)
    assert sorted(r.source for r in left.collect()) == ["c", "d", "e"] and left.columns == docs.columns
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(3, text, "a"), (5, text.upper(), "b"), (5, "quite another text of its own", "c"), (None, text, "d")], schema)
    assert sorted(r.source for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()) == ["a", "c", "d"]


def test_stages_on_clashing_columns_and_empty_tables(spark, sf_dir):
    """Columns that have names of results or of working columns stay as they came; no rows give no rows."""
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("text IS NOT NULL AND length(text) > 100").first().text
    text = " ".join(f"w{i}" for i in range(40))
    schema = "doc_id long, text string, doc_key string, n_tokens string, decodes string, score string, kept string, n_hit string, component_id string"
    docs = spark.createDataFrame([(i, t, f"k{i}", "n", "d", "s", "q", "h", "c") for i, t in enumerate([text, text + " x", passage, None, "", text])], schema)
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        left = stage(spark, left, sf_dir)
        assert left.columns == docs.columns, name
    assert sorted((r.doc_id, r.doc_key, r.kept) for r in left.collect()) == [(1, "k1", "q"), (4, "k4", "q")]
    out = corpus_pipeline.tokenize(spark, left, sf_dir)
    assert sorted(out.columns) == sorted([*docs.columns, "ids_sha256"]) and all(r.decodes is True for r in out.collect())
    assert corpus_pipeline.tokenize(spark, docs.limit(0), sf_dir).count() == 0
