"""Text analyses: token counts, word counts and splits, letter counts, n-gram lengths.

Whole texts are processed: counts are per-row expressions (no explode of the
text into lines or words where a per-row count will do), followed by one
global or grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.functions.text import (
    has_word, letter_count, lines_with_word, token_count, word_occurrences)


def count_tokens(df: DataFrame, id_col: str = "id", text: str = "value") -> DataFrame:
    """Per text: its id and the number of whitespace-separated tokens, by id."""
    return df.select(F.col(id_col).alias("id"), token_count(text).alias("tokens")).orderBy("id")


TOKEN_COUNTS_SQL = r"""
    SELECT {id_col} AS id,
           size(array_remove(split({text}, '[ \\t\\n\\x0B\\f\\r]+'), '')) AS tokens
    FROM {view}
    ORDER BY id
"""


def count_tokens_sql(df: DataFrame, id_col: str = "id", text: str = "value",
                     view: str = "texts") -> DataFrame:
    """SQL form of :func:`count_tokens` over a temporary view of ``df``."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(TOKEN_COUNTS_SQL.format(id_col=id_col, text=text, view=view))


def read_books(spark: SparkSession, paths) -> DataFrame:
    """One row per file (whole text) with the five-digit id taken from the file name."""
    return (spark.read.text(paths, wholetext=True)
            .select(F.regexp_extract(F.col("_metadata.file_path"), r"(\d{5})\.txt$", 1).alias("id"),
                    F.col("value")))


def count_tokens_files(spark: SparkSession, paths) -> DataFrame:
    """:func:`count_tokens` over ``NNNNN.txt`` files."""
    return count_tokens(read_books(spark, paths))


def count_word(df: DataFrame, word: str = "love", unit: str = "occurrence",
               text: str = "value", boundary: str = "java") -> DataFrame:
    """Case-insensitive whole-word count over all texts, as one row ``count``.

    ``unit="occurrence"`` counts every occurrence; ``unit="line"`` counts the
    newline-separated lines that hold the word at least once.
    """
    if unit == "occurrence":
        per_row = word_occurrences(text, word, boundary)
    elif unit == "line":
        per_row = lines_with_word(text, word, boundary)
    else:
        raise ValueError("unit must be 'occurrence' or 'line'")
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).cast("long").alias("count"))


def word_split(df: DataFrame, word: str = "love", text: str = "value",
               boundary: str = "java") -> DataFrame:
    """Rows with and without ``word``: ``has <word>`` in (``<word>ful``, ``<word>less``) and count."""
    label = f"has {word}"
    flag = F.when(has_word(text, word, boundary), F.lit(f"{word}ful")).otherwise(F.lit(f"{word}less"))
    return (df.select(flag.alias(label))
            .groupBy(label).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col(label).endswith("less")))


WORD_SPLIT_SQL = r"""
    WITH flagged AS (
        SELECT coalesce({text} RLIKE '{pattern}', FALSE) AS present FROM {view})
    SELECT if(present, '{word}ful', '{word}less') AS `has {word}`, count(1) AS count
    FROM flagged
    GROUP BY present
    ORDER BY present DESC
"""


def word_split_sql(df: DataFrame, word: str = "love", text: str = "value",
                   view: str = "texts", boundary: str = "java") -> DataFrame:
    from tablecraft.functions.text import word_regex
    df.createOrReplaceTempView(view)
    pattern = word_regex(word, boundary).replace("\\", "\\\\").replace("'", "\\'")
    return df.sparkSession.sql(WORD_SPLIT_SQL.format(text=text, pattern=pattern, word=word, view=view))


def count_letter(df: DataFrame, text: str = "value", letter: str = "a",
                 key: str = "doc_id") -> DataFrame:
    """Per row: key and count of ``letter`` (case-insensitive, null text = 0)."""
    return df.select(F.col(key), letter_count(text, letter).alias("n"))


def mean_word_length(df: DataFrame, ngram: str = "ngram", year: str = "year") -> DataFrame:
    """Mean length per year of n-grams made only of letters once the ``_TAG`` is cut.

    The word (the first run of characters other than ``_``, as
    ``regexp_extract(ngram, '([^_]+)_?', 1)`` gives it) is cut with plain
    string functions and computed once, here and in the SQL form.
    """
    word = F.substring_index(F.expr(f"ltrim('_', `{ngram}`)"), "_", 1)
    return (df.select(F.col(year), word.alias("word"))
            .filter(~F.col("word").rlike("[^a-zA-Z]+"))
            .groupBy(year).agg(F.avg(F.length("word")).alias("mean_length"))
            .orderBy(year))


MEAN_WORD_LENGTH_SQL = """
    WITH words AS (
        SELECT year, substring_index(ltrim('_', ngram), '_', 1) AS word FROM {view})
    SELECT year, avg(char_length(word)) AS mean_length
    FROM words
    WHERE word NOT RLIKE '[^a-zA-Z]'
    GROUP BY year
    ORDER BY year
"""


def mean_word_length_sql(df: DataFrame, view: str = "ngrams") -> DataFrame:
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(MEAN_WORD_LENGTH_SQL.format(view=view))


def save_matching(df: DataFrame, col: str, word: str, path: str, by: str,
                  mode: str = "overwrite", boundary: str = "java") -> None:
    """Write rows whose ``col`` holds ``word`` to Parquet partitioned by ``by``."""
    from tablecraft.sources.sinks import write_partitioned
    write_partitioned(df.filter(has_word(col, word, boundary)), path, by, mode=mode)
