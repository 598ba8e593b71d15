"""The operators' queries, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import bpe, chat, decontam, exact, langid, licenses, minhash, pfor, pii, runs, sharding, toxicity, whitening
from tablecraft.session import ensure_checkpoint_dir, scratch_path
from tablecraft.sources.tables import read_table

TOXIC_FOLDS, TOXIC_HELD = 3, 1
LANG_FOLDS, LANG_HELD = 4, 2
#: The conversation whose texts hold another template's control strings.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(fold(TOXIC_FOLDS) != TOXIC_HELD))
    return toxicity.score_documents(docs, model).select(
        "doc_id", F.coalesce(fold(TOXIC_FOLDS) == TOXIC_HELD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(turns.dtypes)
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    read = chat.read_conversations(chat.format_conversations(turns.unionByName(probe)))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    per_turn = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(per_turn, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(read_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = decontam.find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read_table(spark, sf_dir, "documents"), all_digests=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(F.coalesce(fold(LANG_FOLDS), F.lit(-1)) != LANG_HELD))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(fold(LANG_FOLDS) == LANG_HELD, F.lit(False)).alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, base = F.transform("base", lambda b: b["start"]), F.transform("base", lambda b: b["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    cover = F.array_max(F.transform("found", lambda x: x["cover"]))
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("found", lambda x: x["label"]))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(cover, F.lit(0.0))).alias("score"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.tokenize(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN, outputs="digests")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.train(docs))
    rank = F.array(*[F.lit(k) for k in pii.KINDS])

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        placed = F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(placed, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"), listed(F.concat("base", "added")).alias("spans"))


def op11_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    files = pfor.write_tokens(read_table(spark, sf_dir, "documents"), definition, scratch_path(spark, "token-blocks"))
    return pfor.read_documents(files)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.quantised(read_table(spark, sf_dir, "embeddings"))
    return whitening.whiten(vectors, whitening.fit_whitening(vectors))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(read_table(spark, sf_dir, "documents"), plant=True)


_QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_chat_format, op3_minhash, op4_decontamination, op5_exact_dedup, op6_language_id,
    op7_sharding, op8_licenses, op9_bpe, op10_pii, op11_token_blocks, op12_whitening, op13_runs)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return f(spark, sf_dir)
        run.__name__, run.__doc__ = f.__name__, f.__doc__
        return run
    return {name: ready(f) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from tablecraft.llm.oracle import SQL
    return dict(SQL)
