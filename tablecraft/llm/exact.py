"""Exact deduplication by progressive refinement.

Texts are grouped by byte length, rows of repeated lengths by a hash of their
first bytes, and only rows whose (length, prefix hash) repeats have their full
content hashed.  Each step passes on small keys, never texts: two fixed-size
bitmaps tell the scan which rows are still alive, and exact joins on the keys
decide.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import bitmap_of, in_bitmap, map_texts, share, written

PREFIX_CHARS = 64


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, the text (null: empty), its byte length and its prefix hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix_hash"))


def exact_groups(docs: DataFrame, all_digests: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, prefix_hash, text_sha256, copies, keep_id,
    group_size, kept``.

    ``text_sha256`` (lowercase hex of the UTF-8 text) is null for rows that
    left at an earlier step, unless ``all_digests`` asks for every digest; the
    grouping never uses those.  Of equal texts the largest doc_id stays.

    Null text counts as empty.  A row repeated with its id and text counts in
    ``group_size`` and comes out once; one id with two texts gives two rows.
    Null ids lose to any id; a group of null ids only keeps its (one) row.
    No rows give no rows; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    rows = keyed(docs)
    # 1. length
    lengths = rows.groupBy("n_bytes").count().filter("count > 1").select("n_bytes")
    # 2. prefix hash, of rows with a repeated length
    pairs = (rows.select("n_bytes", "prefix_hash").join(lengths, "n_bytes", "left_semi")
             .groupBy("n_bytes", "prefix_hash").count().filter("count > 1")
             .select(F.xxhash64("n_bytes", "prefix_hash").alias("key")))
    alive = share(spark, bitmap_of(pairs, "key"))

    # 3. full content, of rows whose (length, prefix hash) repeats
    def setup():
        bits = alive.value

        def work(rows_):
            live = [in_bitmap(bits, r["key"]) for r in rows_]
            sha = [hashlib.sha256(r["text"].encode("utf-8")).hexdigest() if on or all_digests else None
                   for r, on in zip(rows_, live, strict=True)]
            return [live, sha]
        return work

    staged = rows.select("doc_id", "n_bytes", "prefix_hash",
                         F.struct("text", F.xxhash64("n_bytes", "prefix_hash").alias("key")).alias("cell"))
    hashed = written(map_texts(staged, setup, "alive boolean, text_sha256 string",
                               carry=("doc_id", "n_bytes", "prefix_hash"), text="cell"), "exact")
    # equal ids and texts become one row, with their number
    same = ["doc_id", "n_bytes", "prefix_hash", "text_sha256"]
    live = written(hashed.filter("alive").groupBy(*same).agg(F.count("*").alias("copies")), "live")
    key = ["n_bytes", "prefix_hash", "text_sha256"]
    # written, so that the join reads plain exchanges and a large group can be split over tasks
    groups = written(live.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
                     .filter("group_size > 1"), "groups")
    grouped = (live.join(groups, key, "left")
               .select(*same, "copies", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                       F.coalesce("group_size", "copies").cast("long").alias("group_size")))
    alone = hashed.filter("NOT alive").select(
        *same, F.lit(1).cast("long").alias("copies"), F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"))
    return (grouped.unionByName(alone)
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    Of rows that repeat both id and text, one stays.  Rows are matched to their
    decision by id and content digest, so two texts under one id are told apart.
    """
    groups = written(exact_groups(docs).filter("group_size > 1"), "copies")
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    marked = docs.withColumn("__sha", digest)

    def matched(rows: DataFrame, how: str) -> DataFrame:
        keys = rows.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__of"))
        return marked.join(keys, marked["doc_id"].eqNullSafe(keys["__id"]) & (marked["__sha"] == keys["__of"]), how)

    repeated = groups.filter("kept AND copies > 1")
    single = matched(groups.filter("NOT kept OR copies > 1"), "left_anti").select(*docs.columns)
    if repeated.isEmpty():  # ids are unique: nothing to add, so no second scan
        return single
    return single.unionByName(
        matched(repeated, "left_semi").dropDuplicates(["doc_id", "__sha"]).select(*docs.columns))
