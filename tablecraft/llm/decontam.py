"""Benchmark decontamination over a distributed positional inverted index.

The corpus is scanned once to count the benchmark's words, once to store the
postings (document, word, positions) of every window's rarest words, where two
of them may stand as in an item, and the texts that may hold a window.  Postings
minus the word's place in the item give alignments; the lists of a window's
two rarest words are intersected, and the survivors are compared word by word.
Any two of the three rarest words that the corpus has, nearly as far apart as in
the item, are a proximity match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablecraft.llm.common import bitmap_of, map_texts, mix64, row_key, share, written
from tablecraft.llm.words import alnum_keys, in_bitmap_all, keys_of_texts, text_slices

WINDOW = 10
#: Extra words that may stand between two anchors of a proximity match.
SLACK = 3
#: Rarest words of a window of which any two make a proximity match.
ANCHORS = 3
#: Words counted by a task before it hands its counts on.
FLUSH_WORDS = 1_000_000


def pair_keys(one: np.ndarray, two: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Key of two words (their keys) and how many places the second stands behind the first."""
    a, b, d = (x.astype(np.int64, copy=False).view(np.uint64) for x in (one, two, apart))
    return mix64(mix64(a * np.uint64(0x9E3779B97F4A7C15) + d) ^ b).view(np.int64)


def windows_of(words: list, width: int = WINDOW) -> range:
    """Start places of the windows of an item; a shorter item, but not an empty one, is one window."""
    return range(max(1, len(words) - width + 1)) if words else range(0)


def item_words(benchmark: DataFrame) -> DataFrame:
    """``item_id, words`` (word keys in order) of every item that has words; an id's repeats are told apart by ``item_key``."""
    def setup():
        return lambda texts: [keys_of_texts(texts)]
    return (map_texts(benchmark.withColumn("item_key", row_key("item_id", "text")), setup, "words array<long>", carry=("item_key", "item_id"))
            .filter(F.size("words") > 0).dropDuplicates(["item_key"]))


def word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``term, tf``: occurrences in the whole corpus of each word key in ``vocabulary`` (column term)."""
    bits = share(docs.sparkSession, bitmap_of(vocabulary, "term"))
    out = T.StructType([T.StructField("term", T.LongType()), T.StructField("tf", T.LongType())])

    def run(batches):
        from collections import Counter
        known, counts, seen = np.frombuffer(bits.value, np.uint8), Counter(), 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], names=["term", "tf"])

        for batch in batches:
            for _, offsets, data in text_slices(batch.column(0)):
                keys, _ = alnum_keys(offsets, data)
                terms, n = pa.array(keys[in_bitmap_all(known, keys)]).value_counts().flatten()
                counts.update(dict(zip(terms.to_pylist(), n.to_pylist(), strict=True)))
                seen += len(keys)
                if seen >= FLUSH_WORDS:
                    yield flush()
                    counts.clear()
                    seen = 0
        yield flush()

    from tablecraft.session import ship_package
    ship_package(docs.sparkSession)
    return (docs.select("text").mapInArrow(run, out).groupBy("term").agg(F.sum("tf").alias("tf"))
            .join(vocabulary, "term"))


def anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """Pairs of the ``ANCHORS`` rarest words of each window that the corpus has:
    ``item_key, at, term, at2, term2, whole``, distinct, the rarer word first.

    ``whole``: the two rarest words of a window that the corpus has every word
    of; only such windows can occur as they are.  The other pairs find windows
    with replaced words.  Places are taken from the item; a window of one word
    has it twice.
    """
    width = F.least(F.size("words"), F.lit(WINDOW))
    wins = (items.select("item_key", "words", width.alias("width"))
            .select("item_key", "width", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("width"))).alias("start"))
            .select("item_key", "start", F.posexplode(F.slice("words", F.col("start") + 1, F.col("width"))).alias("off", "term")))
    ranked = (wins.join(counts, "term", "left")
              .groupBy("item_key", "start")
              .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("tf", F.lit(0)).alias("tf"), F.col("off"), F.col("term")))).alias("w"))
              .withColumn("known", F.filter("w", lambda x: x["tf"] > 0)))
    whole = F.size("known") == F.size("w")

    def pair(i: int, j: int):
        one, two = F.get("known", F.lit(i)), F.get("known", F.lit(j))
        return F.struct((F.col("start") + one["off"]).alias("at"), one["term"].alias("term"), (F.col("start") + two["off"]).alias("at2"),
                        two["term"].alias("term2"), (whole if (i, j) in ((0, 0), (0, 1)) else F.lit(False)).alias("whole"))
    pairs = F.when(F.size("w") == 1, F.array(pair(0, 0))).otherwise(
        F.array(*[pair(i, j) for j in range(1, ANCHORS) for i in range(j)]))
    return (ranked.select("item_key", F.inline(F.filter(pairs, lambda x: x["term2"].isNotNull())))
            .groupBy("item_key", "at", "term", "at2", "term2").agg(F.max("whole").alias("whole")))


def near_pairs(marks: DataFrame) -> DataFrame:
    """``key, exact``: ``pair_keys`` of each of the ``anchors`` pairs at every distance that makes
    an alignment, the word that stands first named first; ``exact``: at a ``whole`` pair's own distance."""
    def run(batches):
        for batch in batches:
            at, term, at2, term2, whole = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for gap in range(-SLACK, SLACK + 1):
                apart = at2.astype(np.int64) - at + gap
                turned = apart < 0
                keys = pair_keys(np.where(turned, term2, term), np.where(turned, term, term2), np.abs(apart))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(whole.astype(bool) & (gap == 0))], names=["key", "exact"])

    from tablecraft.session import ship_package
    ship_package(marks.sparkSession)
    return marks.select("at", "term", "at2", "term2", "whole").mapInArrow(run, "key long, exact boolean")


def near_places(keys: np.ndarray, places: np.ndarray, rows: np.ndarray, near: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the words (key, place, row, in order) stand with another one, or alone, as the bitmap
    ``near`` has it, and the rows where two stand as ``exact`` has it."""
    kept, whole = np.zeros(len(keys), bool), []
    for step in range(WINDOW + SLACK):  # places of a row differ, so words this many apart in the list are at least as far apart in it
        one, two = slice(0, len(keys) - step), slice(step, len(keys))
        apart = places[two] - places[one]
        i = np.flatnonzero((rows[one] == rows[two]) & (apart < WINDOW + SLACK))
        if not len(i):
            break
        pairs = pair_keys(keys[i], keys[i + step], apart[i])
        found = in_bitmap_all(near, pairs)
        kept[i[found]] = kept[i[found] + step] = True
        whole.append(rows[i[in_bitmap_all(exact, pairs)]])
    return kept, np.unique(np.concatenate(whole)) if whole else np.empty(0, np.int64)


def positional_index(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``doc_key, doc_id, n_words, postings`` (array of term and its positions) and ``text`` of every row, written out.

    Postings hold the words of ``marks`` (see ``anchors``) at the places where
    two may stand so that they make an alignment; the text stays where they may
    stand as in a ``whole`` pair.  "May": by bitmaps, the joins on the postings decide.
    """
    spark = docs.sparkSession
    pairs = near_pairs(marks)
    terms = share(spark, bitmap_of(marks.select(F.explode(F.array("term", "term2")).alias("term")), "term"))
    close, exactly = share(spark, bitmap_of(pairs, "key")), share(spark, bitmap_of(pairs.filter("exact"), "key"))
    keyed = docs.select(row_key("doc_id", "text").alias("doc_key"), "doc_id", "text")
    ddl = "n_words long, postings array<struct<term: long, places: array<int>>>"
    out = T.StructType([*keyed.schema.fields[:2], *T.StructType.fromDDL(ddl).fields, keyed.schema["text"]])
    listed = to_arrow_schema(out).field("postings").type

    def postings(keys, places, rows, n):
        order = np.lexsort((keys, rows))  # stable: the places of a word in a row stay in order
        keys, places, rows = keys[order], places[order], rows[order]
        heads = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])]) if len(keys) else np.empty(0, np.int64)
        entry, inner = listed.value_type, listed.value_type.field("places").type
        lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(keys)), pa.int32()), pa.array(places, pa.int32()), type=inner)
        entries = pa.StructArray.from_arrays([pa.array(keys[heads]), lists], fields=list(entry))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[heads], np.arange(n + 1)), pa.int32()), entries, type=listed)

    def run(batches):
        known, near, exact = (np.frombuffer(b.value, np.uint8) for b in (terms, close, exactly))
        for batch in batches:
            for at, offsets, data in text_slices(batch.column(2)):
                keys, first = alnum_keys(offsets, data)
                n, sizes = len(offsets) - 1, np.diff(first)
                at_words = np.flatnonzero(in_bitmap_all(known, keys))
                rows = np.searchsorted(first, at_words, "right") - 1
                places, keys = at_words - first[rows], keys[at_words]
                kept, whole = near_places(keys, places, rows, near, exact)
                wanted = np.zeros(n, bool)
                wanted[whole] = True
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes), postings(keys[kept], places[kept], rows[kept], n),
                     part.column(2).take(pa.array(np.arange(n), mask=~wanted))], names=out.names)

    from tablecraft.session import ship_package
    ship_package(spark)
    return written(keyed.mapInArrow(run, out), "index")


def alignments(postings: DataFrame, marks: DataFrame) -> DataFrame:
    """Intersect the offset-adjusted posting lists of each pair of a window's rarest words.

    A posting minus the word's place in the item is where the item would start
    in the document.  ``doc_key, item_key, place, gap, whole``: the rarer word's
    starts at which the other one agrees (gap 0), or stands up to ``SLACK``
    words off (the gap), and whether a ``whole`` pair says so.  Starts meet by
    bins of ``SLACK + 1`` places, each with its neighbours, so only near ones do
    and a long document is dealt over the tasks.
    """
    def starts(at: str, term: str) -> DataFrame:
        lists = marks.select("item_key", F.col(at).alias("at"), F.col(term).alias("term")).distinct()
        return (postings.join(lists, "term")
                .select("doc_key", "item_key", "at", F.explode(F.transform("places", lambda p: p - F.col("at"))).alias("place")))

    def slot(place: str):
        return F.floor(F.col(place) / (SLACK + 1))

    pairs = marks.select("item_key", "at", "at2", "whole")
    rare = starts("at", "term").join(pairs, ["item_key", "at"]).select(
        "doc_key", "item_key", "at2", "place", "whole", F.explode(F.array(*[slot("place") + i for i in (-1, 0, 1)])).alias("bin"))
    other = starts("at2", "term2").select(F.col("doc_key").alias("k"), F.col("item_key").alias("i"), F.col("at").alias("a"), F.col("place").alias("place2"),
                                            slot("place").alias("b"))
    gap = F.col("place2") - F.col("place")
    return (rare.join(other, (F.col("doc_key") == F.col("k")) & (F.col("item_key") == F.col("i")) & (F.col("at2") == F.col("a"))
                      & (F.col("bin") == F.col("b")) & (F.abs(gap) <= SLACK))
            .groupBy("doc_key", "item_key", "place", gap.alias("gap")).agg(F.max("whole").alias("whole")))


def find_passages(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(documents, matches)``.

    documents: one row per row of ``docs``: ``doc_key, doc_id, n_words, n_hit``
    (words inside an occurrence of a window), ``items`` (sorted ids, as strings,
    of items with occurring windows), ``n_near`` (proximity matches).
    matches: ``doc_key, item_id, place, gap, phrase``: where an item would
    start; ``phrase`` rows (gap 0) were compared word by word and hold a window,
    the others are proximity matches: two of a window's ``ANCHORS`` rarest words
    that the corpus has stand as far apart as in the item (gap 0) or up to
    ``SLACK`` words off.

    A window is ``WINDOW`` consecutive words of an item; a shorter item is one
    window.  Null and empty texts have no words and no windows.  Rows that
    repeat id and text share their matches; an item id that stands twice counts
    once.  Empty tables give no matches.  Other columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    items = written(item_words(benchmark.select("item_id", "text")), "items")
    vocabulary = items.select(F.explode("words").alias("term")).distinct()
    marks = written(anchors(items, word_counts(docs, vocabulary)), "anchors")
    index = positional_index(docs, marks)

    postings = (index.select("doc_key", F.explode("postings").alias("p")).select("doc_key", "p.term", "p.places")
                .dropDuplicates(["doc_key", "term"]))
    found = written(alignments(postings, marks), "alignments")
    exact = found.filter("gap = 0 AND whole")

    # the whole texts of candidate documents, to compare word by word
    texts = index.select("doc_key", "text").filter("text IS NOT NULL").dropDuplicates(["doc_key"])
    cases = (exact.groupBy("doc_key", "item_key").agg(F.collect_set("place").alias("places")).join(items, "item_key")
             .groupBy("doc_key").agg(F.collect_list(F.struct("item_key", F.col("item_id").cast("string").alias("id"), "words", "places")).alias("cases")))

    def verify():
        def work(cells):
            hits, ids, phrases = [], [], []
            for c, keys in zip(cells, keys_of_texts([c["text"] for c in cells]), strict=True):
                words = keys.tolist()
                covered, hit_items, starts = set(), set(), []
                for case in c["cases"]:
                    item = case["words"]
                    width = min(WINDOW, len(item))
                    for place in case["places"]:
                        run, longest = 0, 0  # words that agree up to here
                        for i, w in enumerate(item):
                            run = run + 1 if 0 <= place + i < len(words) and words[place + i] == w else 0
                            longest = max(longest, run)
                            if run >= width:
                                covered.update(range(place + i + 1 - (width if run == width else 1), place + i + 1))
                                if case["id"] is not None:
                                    hit_items.add(case["id"])
                        if longest >= width:
                            starts.append({"item_key": case["item_key"], "place": place})
                hits.append(len(covered))
                ids.append(sorted(hit_items))
                phrases.append(starts)
            return [hits, ids, phrases]
        return work

    checked = written(map_texts(
        texts.join(cases, "doc_key").select("doc_key", F.struct("text", "cases").alias("cell")), verify,
        "n_hit long, items array<string>, phrases array<struct<item_key: long, place: int>>", carry=("doc_key",), text="cell"), "checked")
    phrases = (checked.select("doc_key", F.inline("phrases"))
               .select("doc_key", "item_key", "place", F.lit(0).alias("gap"), F.lit(True).alias("phrase")))
    told = (found.join(phrases, ["doc_key", "item_key", "place", "gap"], "left")
            .withColumn("phrase", F.coalesce("phrase", F.lit(False))))
    near = told.filter("NOT phrase").groupBy("doc_key").agg(F.count("*").alias("n_near"))
    rows = (index.select("doc_key", "doc_id", "n_words").join(checked.drop("phrases"), "doc_key", "left").join(near, "doc_key", "left")
            .select("doc_key", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))
    return rows, told.join(items.select("item_key", "item_id"), "item_key").select("doc_key", "item_id", "place", "gap", "phrase")
