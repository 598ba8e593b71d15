"""Adapters that stand up the analyses' input shapes over the given tables.

The analyses were written for trip records, tweets, books, page-view dumps,
n-grams, comments, crawl headers, network flows, game matches and paper
metadata.  None of those ship with the test data, so each is derived from the
TPC-H-like tables with integer arithmetic on keys only.  Every adapter here has
a DuckDB twin in ``tablecraft.plans.oracle`` written to the same rules, which is
what lets the driver compare results value by value.

All adapters are lazy projections (plus, for pageviews and papers, one bounded
group-by), so Catalyst prunes the scan to the columns an analysis needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.functions.text import WHITESPACE
from tablecraft.sources.tables import read_table

# The dirty country spellings the papers fixture draws from,
# in order; element i is used where (l_suppkey + l_linenumber) % 24 == i.
DIRTY_COUNTRIES = (
    "China", " P.R. China ", "PEOPLES REPUBLIC OF CHINA", "USA", "U.S.A.",
    "united states", "United States of America", "UK", "United Kingdom.",
    "Ukraine", "Italy", "ITALY;", "México", "Brazil", "Brasil", "South Korea",
    "Republic of Korea", "India", "Indiana, USA", "Scotland UK",
    "The Netherlands", "Australia,", "", None,
)

MATCH_EPOCH_SHIFT = 473_385_600  # seconds: moves 1995-2001 order dates to 2010-2016


def _s(c: Column) -> Column:
    return c.cast("string")


# --------------------------------------------------------------------------- trips
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips from ``lineitem``: one trip per line item."""
    li = read_table(spark, sf_dir, "lineitem")
    pu = (F.col("l_suppkey") % 100).cast("int")
    do = (F.col("l_partkey") % 50).cast("int")
    offset = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1440).cast("int")
    pickup = F.timestamp_add("MINUTE", offset, F.col("l_shipdate"))
    dropoff = F.timestamp_add("MINUTE", F.floor("l_quantity").cast("int"), pickup)
    return li.select(
        pu.alias("PULocationID"),
        do.alias("DOLocationID"),
        (F.lit(1) + pu % 2).cast("int").alias("payment_type"),
        pickup.alias("lpep_pickup_datetime"),
        dropoff.alias("lpep_dropoff_datetime"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice")).alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("l_tax").alias("tip_amount"),
        F.col("l_quantity").alias("tolls_amount"),
        F.lit(None).cast("double").alias("ehail_fee"),
        F.lit(0.3).alias("improvement_surcharge"),
        (F.col("l_extendedprice") + F.col("l_tax")).alias("total_amount"),
    )


# -------------------------------------------------------------------------- tweets
def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested tweets from ``events``: ``user`` struct and ``entities.hashtags``."""
    ev = read_table(spark, sf_dir, "events")
    uid, eid = F.col("user_id"), F.col("event_id")
    user = F.struct(
        uid.alias("id"),
        F.concat(F.lit("user_"), _s(uid)).alias("screen_name"),
        ((uid * 37) % 1000).cast("int").alias("friends_count"),
        F.when(uid % 7 == 0, F.lit("a geek at work"))
         .when(uid % 7 == 1, F.lit("geeky"))
         .otherwise(F.col("event_type")).alias("description"),
        F.concat(F.lit("Mon Jan 01 00:00:00 +0000 "), _s(F.lit(2006) + uid % 14)).alias("created_at"),
    )
    tag_type = "array<struct<text:string>>"
    hashtags = F.when(eid % 9 == 0, F.array().cast(tag_type)).otherwise(
        F.array(
            F.struct(F.col("event_type").alias("text")),
            F.struct(F.concat(F.lit("k"), _s(eid % 40)).alias("text")),
        ))
    return ev.select(
        eid.alias("id"),
        F.when(eid % 50 == 0, F.lit(None).cast("string"))
         .otherwise(_s(F.to_date("ts"))).alias("created_at"),
        user.alias("user"),
        F.struct(hashtags.alias("hashtags")).alias("entities"),
    )


# --------------------------------------------------------------------------- texts
def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per book: ``value`` text and the file id of five digits or more."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id"),
        F.lpad(_s(F.col("doc_id")), F.greatest(F.lit(5), F.length(_s(F.col("doc_id")))), F.lit("0")).alias("id"),
        F.col("text").alias("value"),
    )


# ----------------------------------------------------------------------- pageviews
def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly page-view dump rows from ``events``.

    ``hourly_counts`` packs one month: per day the day letter (``chr(64+day)``)
    then, per hour with views, the hour letter (``chr(65+hour)``) and count;
    days joined by commas with a trailing comma.  ``user_id % 3`` stands in for
    the monthly file a row comes from.  Groups are bounded (24 hours, 31 days).
    """
    ev = read_table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).alias("file"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("page"),
    )
    per_hour = ev.groupBy("file", "month", "page", "day", "hour").count()
    per_day = (
        per_hour.groupBy("file", "month", "page", "day")
        .agg(F.sort_array(F.collect_list(F.struct("hour", "count"))).alias("hours"),
             F.sum("count").alias("views"))
        .select("file", "month", "page", "day", "views",
                F.concat(F.char(F.col("day") + 64),
                         F.array_join(F.transform(
                             "hours", lambda h: F.concat(F.char(h["hour"] + 65), _s(h["count"]))), ""))
                .alias("packed"))
    )
    per_month = (
        per_day.groupBy("file", "month", "page")
        .agg(F.sort_array(F.collect_list(F.struct("day", "packed"))).alias("days"),
             F.sum("views").alias("monthly_total"))
    )
    return per_month.select(
        F.lit("en.z").alias("project"),
        F.col("page"),
        F.col("monthly_total"),
        F.concat(F.array_join(F.transform("days", lambda d: d["packed"]), ","), F.lit(","))
         .alias("hourly_counts"),
    )


# -------------------------------------------------------------------------- ngrams
def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word n-grams with an optional part-of-speech tag, per year, from ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    words = docs.select(
        (F.lit(1900) + F.col("doc_id") % 100).cast("int").alias("year"),
        F.explode(F.split("text", WHITESPACE)).alias("word"),
    ).filter(F.col("word") != "")
    return words.select(
        F.when(F.length("word") % 2 == 0, F.concat("word", F.lit("_NOUN")))
         .otherwise(F.col("word")).alias("ngram"),
        "year",
    )


# ------------------------------------------------------------------------ comments
def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments with the author's account creation time (epoch seconds), from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("comment_id"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("author_created_utc"),
        F.when(F.col("o_orderkey") % 31 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("subreddit_id"),
    )


# --------------------------------------------------------------------- crawl lines
def crawl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl header lines from ``events``: one fetch-time line and one noise line each."""
    ev = read_table(spark, sf_dir, "events")
    fetch = F.concat(F.lit("x_commoncrawl_FetchTimestamp:"),
                     _s(F.unix_millis(F.col("ts").cast("timestamp"))))
    noise = F.concat(F.lit("x_other:"), _s(F.col("event_id")))
    return ev.select(F.explode(F.array(fetch, noise)).alias("value"))


# --------------------------------------------------------------------------- flows

def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string network flow rows from ``lineitem`` with repeated header rows.

    ``Label`` is the return flag; every row with ``(l_orderkey*8 + l_linenumber)
    % 500 == 0`` is a repeated header (``Label = 'Label'``).  Features are
    shifted by class so a forest can separate them.
    """
    li = read_table(spark, sf_dir, "lineitem")
    header = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) % 500 == 0
    shift = (F.when(F.col("l_returnflag") == "A", 0.0)
             .when(F.col("l_returnflag") == "N", 100.0).otherwise(200.0))
    return li.select(
        _s(F.col("l_quantity") + shift).alias("Fwd Mean"),
        _s(F.col("l_extendedprice") / 1000.0).alias("Fwd Std"),
        _s(F.col("l_tax") * 100.0 + shift / 10.0).alias("Bwd Mean"),
        _s(F.col("l_discount") * 100.0).alias("Flow Bytes"),
        F.when(header, F.lit("Label")).otherwise(F.col("l_returnflag")).alias("Label"),
    )


# ------------------------------------------------------------------------- matches
def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game matches from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    radiant_win = (F.when(k % 211 == 0, F.lit(None).cast("string"))
                   .when(k % 5 < 3, F.lit("t")).otherwise(F.lit("f")))
    dire_bonus = F.when(radiant_win == "f", 120).otherwise(0)
    return o.select(
        k.alias("match_id"),
        (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + MATCH_EPOCH_SHIFT).alias("start_time"),
        radiant_win.alias("radiant_win"),
        (F.lit(1200) + (k * 7919) % 2400 + dire_bonus).cast("int").alias("duration"),
        ((k * 31) % 600).cast("int").alias("first_blood_time"),
        ((k * 17) % 2048).cast("int").alias("tower_status_radiant"),
        ((k * 29) % 2048).cast("int").alias("tower_status_dire"),
        ((k * 5) % 64).cast("int").alias("barracks_status_radiant"),
        ((k * 11) % 64).cast("int").alias("barracks_status_dire"),
        (F.col("o_custkey") % 27).cast("int").alias("game_mode"),
        F.when(k % 13 == 0, 9).otherwise(10).cast("int").alias("human_players"),
        (k % 8).cast("int").alias("lobby_type"),
        F.col("o_orderstatus").alias("pgroup"),
        F.when(k % 10 == 0, F.col("o_orderpriority")).alias("chat"),
        F.when(k % 4 == 0, F.lit("obj")).alias("objectives"),
        F.when(k % 3 == 0, F.lit(None).cast("int")).otherwise(F.lit(21)).alias("version"),
    )


# -------------------------------------------------------------------------- papers
# Fixed value: the author record of the paper schema.
AUTHOR_TYPE = (
    "struct<first:string,middle:array<string>,last:string,suffix:string,email:string,"
    "affiliation:struct<institution:string,laboratory:string,"
    "location:struct<addrLine:string,country:string,postBox:string,postCode:string,"
    "region:string,settlement:string>>>"
)
PAPER_SCHEMA = f"metadata struct<title:string,authors:array<{AUTHOR_TYPE}>>"


def paper_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat author rows (one per line item) before nesting."""
    li = read_table(spark, sf_dir, "lineitem")
    supp = F.col("l_suppkey")
    country = F.element_at(
        F.array(*[F.lit(c).cast("string") for c in DIRTY_COUNTRIES]),
        ((supp + F.col("l_linenumber")) % 24 + 1).cast("int"))
    institution = (F.when(supp % 40 == 7, F.lit(None).cast("string"))
                   .when(supp % 40 == 11, F.lit(""))
                   .otherwise(F.concat(F.lit("Inst "), _s(supp % 40))))
    null_s = F.lit(None).cast("string")
    author = F.struct(
        F.when(supp % 20 == 3, F.lit("")).otherwise(F.concat(F.lit("F"), _s(supp % 20))).alias("first"),
        F.array().cast("array<string>").alias("middle"),
        F.concat(F.lit("L"), _s(F.col("l_partkey") % 30)).alias("last"),
        F.lit("").alias("suffix"),
        null_s.alias("email"),
        F.struct(
            institution.alias("institution"),
            null_s.alias("laboratory"),
            F.struct(null_s.alias("addrLine"), country.alias("country"), null_s.alias("postBox"),
                     null_s.alias("postCode"), null_s.alias("region"),
                     null_s.alias("settlement")).alias("location"),
        ).alias("affiliation"),
    )
    return li.select(F.col("l_orderkey"), F.col("l_linenumber"), author.alias("author"))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paper metadata: one row per order, one author per line item.

    Order keys and author lines are unioned and grouped once by key (one
    shuffle, no join): keys that come only from line items are dropped, so this
    equals ``orders LEFT JOIN lines``.  An order without line items gets an
    empty author list.  The per-order list
    holds the order's lines (17 at most at sf0.1) and grows with the order.
    Orders whose key is a multiple of 101 carry null metadata.
    """
    lines = paper_authors(spark, sf_dir).select(
        F.col("l_orderkey").alias("key"),
        F.struct("l_linenumber", "author").alias("line"),
        F.lit(False).alias("is_order"))
    line_type = lines.schema["line"].dataType.simpleString()
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.lit(None).cast(line_type).alias("line"),
        F.lit(True).alias("is_order"))
    grouped = (orders.unionByName(lines)
               .groupBy("key")
               .agg(F.max("is_order").alias("has_order"),
                    F.sort_array(F.collect_list("line")).alias("lines"))
               .filter(F.col("has_order")))
    metadata = F.when(F.col("key") % 101 == 0, F.lit(None)).otherwise(
        F.struct(F.concat(F.lit("Paper "), _s(F.col("key"))).alias("title"),
                 F.transform("lines", lambda x: x["author"]).alias("authors")))
    return grouped.select(F.col("key").alias("paper_id"), metadata.alias("metadata"))
