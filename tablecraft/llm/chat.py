"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of
one role become one block, and blocks are joined to one string:

    <|turn|>role<|text|>first text<|next|>second text<|end|>

``&`` and ``<`` inside roles and texts are escaped, so no marker can appear in
them, and reading back undoes it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_mask`` of every conversation.

    ``turns``: ``conv_id, turn, role, text``.  Rows are ordered by turn, ties by
    role, then text; repeated rows are turns of their own.  Null roles and texts
    count as empty, null turns come first, null conv_ids form one conversation.
    ``loss_mask`` has a struct per turn in the order of the string: ``skip``
    code points outside the mask, then ``chars`` code points of text that are
    under the mask if ``loss`` (an assistant's text).  No rows give no rows;
    other columns are not looked at.  The string of a conversation is one row's
    value, so it is the one thing that has to fit a task.
    """
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    sorted_turns = (turns.groupBy("conv_id")
                    .agg(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text"))).alias("t"))
                    .select("conv_id", F.array_sort("t").alias("t")))
    # block numbers: a turn starts a block when its role differs from the one before
    starts = F.filter(F.transform("t", lambda x, i: F.when((i == 0) | (x["role"] != F.get("t", i - 1)["role"]), i)),
                      lambda i: i.isNotNull())
    marked = (sorted_turns.select("conv_id", "t", F.size("t").alias("n"), starts.alias("s"))
              .select("conv_id", "t", "s", F.transform("s", lambda b, i: F.slice(
                  "t", b + 1, F.coalesce(F.get("s", i + 1), F.col("n")) - b)).alias("blocks")))
    block = F.transform("blocks", lambda b: F.concat(
        F.lit(TURN), escape(b[0]["role"]), F.lit(TEXT),
        F.array_join(F.transform(b, lambda x: escape(x["text"])), NEXT), F.lit(END)))

    def mask(b: Column) -> Column:
        head = F.length(escape(b[0]["role"])) + len(TURN) + len(TEXT)
        return F.transform(b, lambda x, i: F.struct(
            F.when(i == 0, head).otherwise(F.lit(len(NEXT))).cast("long").alias("skip"),
            F.length(escape(x["text"])).cast("long").alias("chars"),
            (x["role"] == LOSS_ROLE).alias("loss")))

    return marked.select("conv_id", F.array_join(block, "").alias("formatted"),
                         F.flatten(F.transform("blocks", mask)).alias("loss_mask"))


def read_conversations(formatted: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns`` (role, text, loss): the turns read back from the string.

    The mask's lengths are checked against the string; a difference is an error.
    """
    blocks = F.filter(F.split("formatted", r"<\|end\|>"), lambda b: b != "")

    def parse(b: Column) -> Column:
        parts = F.split(b, r"<\|text\|>", 2)
        role = unescape(F.replace(parts[0], F.lit(TURN), F.lit("")))
        return F.transform(F.split(parts[1], r"<\|next\|>"), lambda x: F.struct(role.alias("role"), x.alias("raw")))

    read = formatted.select("conv_id", "formatted", "loss_mask", F.flatten(F.transform(blocks, parse)).alias("raw"))
    same = F.transform("raw", lambda x: F.length(x["raw"]).cast("long")) == F.transform("loss_mask", lambda m: m["chars"])
    turns = F.zip_with("raw", "loss_mask", lambda x, m: F.struct(
        x["role"].alias("role"), unescape(x["raw"]).alias("text"), m["loss"].alias("loss")))
    return read.select("conv_id", "formatted", F.when(same, turns).otherwise(
        F.raise_error(F.lit("the loss mask does not fit the formatted string"))).alias("turns"))
