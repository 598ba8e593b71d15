"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes what the one before kept.  ``run(spark, sf_dir)`` applies them
all; the last returns the kept documents with their token counts.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tablecraft.llm import bpe, decontam, exact, minhash, toxicity  # noqa: E402
from tablecraft.llm.common import row_key, written  # noqa: E402
from tablecraft.session import ensure_checkpoint_dir  # noqa: E402
from tablecraft.sources.tables import read_table  # noqa: E402


#: A column name of the pipeline's own, which no table has.
ROW_KEY = "__corpus_row_key"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of each row's id and text; columns of any other name stay as they are."""
    return docs.withColumn(ROW_KEY, row_key("doc_id", "text"))


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` that are not in ``gone`` (doc_id and the column ``key``): a row goes by its id and text, null ids too."""
    rows, keys = keyed(docs), gone.select(F.col(key).alias("__key"), F.col("doc_id").alias("__id")).distinct()
    return rows.join(keys, (rows[ROW_KEY] == keys["__key"]) & rows["doc_id"].eqNullSafe(keys["__id"]), "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Score with the counterfactual-regularised classifier; documents at or above the threshold go.

    Null and empty texts have a score like any other; null ids and repeated
    rows are scored row by row.  An empty table stays empty.
    """
    ensure_checkpoint_dir(spark)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays.

    Null and empty texts are equal.  Rows that repeat id and text are one; an id
    with two texts is two documents; null ids lose to any id.
    """
    ensure_checkpoint_dir(spark)
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every near-duplicate group the least doc_id stays.

    Null and blank texts and null ids are in no group and stay.  Of an id with
    two texts only the text that was judged goes; equal rows share their fate.
    """
    ensure_checkpoint_dir(spark)
    groups = minhash.near_groups(keyed(docs), carry=("doc_id", ROW_KEY))
    return without(docs, groups.filter("NOT kept"), ROW_KEY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go.

    Null and empty texts hold none and stay.  A row goes by its id and text, so
    null ids go too and another text under the same id stays.  No benchmark: all stay.
    """
    ensure_checkpoint_dir(spark)
    rows, _ = decontam.find_passages(docs, read_table(spark, sf_dir, "benchmark"))
    return without(docs, rows.filter("n_hit > 0"), "doc_key")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digest of every text, and whether the ids decode to it.

    Null and empty texts have no tokens.  ``n_tokens, decodes, ids_sha256``
    replace columns of these names that the documents may have; every other
    column stays.
    """
    import public_tokenizers
    ensure_checkpoint_dir(spark)
    return bpe.with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("tokenize", tokenize),
]

#: The classifier, near-duplicate groups and token ids have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: its kept rows with ``n_tokens, decodes, ids_sha256``."""
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
