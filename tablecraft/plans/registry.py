"""The registered analyses: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry stands up its fixture over the given tables (whole tables, no row
subsets) and runs the library function.  Output columns are aliased to the
names used by the DuckDB twins in ``tablecraft.plans.oracle``; arrays are
joined to text and timestamps shown as text where the twin does the same, and
noisy floating results are rounded to 6 places on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.functions.udfs import (
    FARE_FIELDS, fare_struct, fare_struct_udf, join_ids_mapped, letter_udf, sorted_distinct_grouped, zscore_in_series,
)
from tablecraft.operators import matches as M
from tablecraft.operators import profiles as P
from tablecraft.operators import rankings as R
from tablecraft.operators import stats as S
from tablecraft.operators import text as T
from tablecraft.operators.series import mean_daily_views, read_pageviews
from tablecraft.session import ensure_checkpoint_dir, pin_utc, scratch_path, ship_package
from tablecraft.sources import fixtures as FX
from tablecraft.sources.readers import json_lines_checked, read_csv_inferred, read_lines, read_whole_texts
from tablecraft.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

SLICE_DAY = "1996-06-15"


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def view_name(base: str) -> str:
    """A per-call temporary view name, so concurrent analyses never share a view."""
    return f"{base}_{uuid.uuid4().hex[:8]}"


def r6(c) -> F.Column:
    """Round to 6 places; -0.0 becomes 0.0 so both engines agree on zero."""
    r = F.round(F.col(c) if isinstance(c, str) else c, 6)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


# ----------------------------------------------------------------------- trips
@register("top_pair")
def q_top_pair(spark, sf):
    return R.top_pair(FX.trips(spark, sf))


@register("mean_by")
def q_mean_by(spark, sf):
    return P.mean_by(FX.trips(spark, sf), exact_scale=2)


@register("mean_by_sql")
def q_mean_by_sql(spark, sf):
    return P.mean_by_sql(FX.trips(spark, sf), view=view_name("trips"), exact_scale=2)


@register("distinct_per_hour")
def q_distinct_per_hour(spark, sf):
    out = P.distinct_per_hour(FX.trips(spark, sf))
    return out.select("pickup_hour", F.array_join("pickup_locations", ",").alias("pickup_locations"))


@register("zscore")
def q_zscore(spark, sf):
    z = S.zscore(FX.trips(spark, sf), "fare_amount")
    return z.select("PULocationID", "DOLocationID", "fare_amount", r6("z").alias("z"))


@register("zscore_by")
def q_zscore_by(spark, sf):
    z = S.zscore(FX.trips(spark, sf), "fare_amount", by="PULocationID")
    return z.select("PULocationID", "DOLocationID", "fare_amount", r6("z").alias("z"))


@register("fare_struct")
def q_fare_struct(spark, sf):
    packed = FX.trips(spark, sf).select(fare_struct().alias("fare"))
    return packed.select(*[F.col(f"fare.{c}").cast("double").alias(c)
                           for c in packed.schema["fare"].dataType.names])


@register("fare_struct_batches")
def q_fare_struct_batches(spark, sf):
    """``fare_struct`` by the pandas UDF that takes many series and gives a struct."""
    packed = FX.trips(spark, sf).select(fare_struct_udf()(*FARE_FIELDS).alias("fare"))
    return packed.select(*[F.nanvl(F.col(f"fare.{c}").cast("double"), F.lit(None)).alias(c) for c in FARE_FIELDS])


@register("zscore_series")
def q_zscore_series(spark, sf):
    """``zscore`` by the pandas UDF over series, with statistics of all rows."""
    z = zscore_in_series(FX.trips(spark, sf), "fare_amount")
    return z.select("PULocationID", "DOLocationID", "fare_amount", r6("z").alias("z"))


@register("locations_grouped")
def q_locations_grouped(spark, sf):
    """Sorted distinct pickup locations of every hour by a grouped Python function."""
    hours = FX.trips(spark, sf).select(F.hour("lpep_pickup_datetime").alias("hour"), "PULocationID")
    out = sorted_distinct_grouped(hours, "hour", "PULocationID", "locations")
    return out.select("hour", F.array_join("locations", ",").alias("locations"))


@register("priciest_pairs")
def q_priciest_pairs(spark, sf):
    return R.priciest_pairs(FX.trips(spark, sf))


@register("day_slice")
def q_day_slice(spark, sf):
    out = P.day_slice(FX.trips(spark, sf), SLICE_DAY)
    return (out.withColumn("lpep_pickup_datetime", F.col("lpep_pickup_datetime").cast("string"))
            .withColumn("lpep_dropoff_datetime", F.col("lpep_dropoff_datetime").cast("string")))


@register("distinct_by_hour")
def q_distinct_by_hour(spark, sf):
    return P.distinct_counts_by_hour(FX.trips(spark, sf))


@register("pairs_by_hour")
def q_pairs_by_hour(spark, sf):
    return P.pair_count_by_hour(FX.trips(spark, sf))


@register("join_ids")
def q_join_ids(spark, sf):
    return P.join_ids(FX.trips(spark, sf))


@register("join_ids_batch")
def q_join_ids_batch(spark, sf):
    return join_ids_mapped(FX.trips(spark, sf))


@register("by_weekday")
def q_by_weekday(spark, sf):
    return P.trips_by_weekday(FX.trips(spark, sf))


@register("mean_matrix")
def q_mean_matrix(spark, sf):
    return P.mean_matrix(FX.trips(spark, sf), exact_scale=2)


@register("spearman")
def q_spearman(spark, sf):
    return S.spearman(FX.trips(spark, sf), "tolls_amount", "fare_amount").select(r6("rho").alias("rho"))


@register("predict_class")
def q_predict_class(spark, sf):
    from tablecraft.operators.ml import predict_class, split_by_hash
    trips = FX.trips(spark, sf)
    train, new = split_by_hash(trips, 0.7, "PULocationID", "DOLocationID", "lpep_pickup_datetime")
    return predict_class(train, new, keep=("PULocationID", "DOLocationID"))


# ---------------------------------------------------------------------- tweets
@register("top_users")
def q_top_users(spark, sf):
    return R.top_users(FX.tweets(spark, sf))


@register("top_tags")
def q_top_tags(spark, sf):
    return R.top_tags(FX.tweets(spark, sf))


@register("creation_years")
def q_creation_years(spark, sf):
    return P.creation_years(FX.tweets(spark, sf))


@register("keyword_partitioned")
def q_keyword_partitioned(spark, sf):
    path = scratch_path(spark, "geek-tweets")
    T.save_matching(FX.tweets(spark, sf), "user.description", "geek", path, by="created_at")
    back = spark.read.parquet(path)
    return (back.groupBy(F.col("created_at").cast("string").alias("created_at"))
            .agg(F.count(F.lit(1)).alias("count")))


# ----------------------------------------------------------------------- texts
@register("token_counts")
def q_token_counts(spark, sf):
    return T.count_tokens(FX.texts(spark, sf))


@register("word_occurrences")
def q_word_occurrences(spark, sf):
    return T.count_word(FX.texts(spark, sf), "the", unit="occurrence", boundary="ascii")


@register("word_lines")
def q_word_lines(spark, sf):
    return T.count_word(FX.texts(spark, sf), "the", unit="line", boundary="ascii")


@register("word_split")
def q_word_split(spark, sf):
    return T.word_split(FX.texts(spark, sf), "the", boundary="ascii")


@register("word_split_sql")
def q_word_split_sql(spark, sf):
    return T.word_split_sql(FX.texts(spark, sf), "the", view=view_name("texts"), boundary="ascii")


@register("letter_count")
def q_letter_count(spark, sf):
    return T.count_letter(FX.texts(spark, sf))


@register("letter_udf")
def q_letter_udf(spark, sf):
    texts = FX.texts(spark, sf)
    return texts.select("doc_id", letter_udf("a")(F.col("value")).alias("n"))


@register("daily_views")
def q_daily_views(spark, sf):
    return mean_daily_views(FX.pageviews(spark, sf), "en.z", "view")


@register("daily_views_dump")
def q_daily_views_dump(spark, sf):
    path = scratch_path(spark, "pageviews-dump")
    dump = FX.pageviews(spark, sf)
    dump.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in dump.columns])).write.text(path)
    return mean_daily_views(read_pageviews(spark, path), "en.z", "view")


@register("word_length_by_year")
def q_word_length_by_year(spark, sf):
    return T.mean_word_length(FX.ngrams(spark, sf))


@register("word_length_by_year_sql")
def q_word_length_by_year_sql(spark, sf):
    return T.mean_word_length_sql(FX.ngrams(spark, sf), view=view_name("ngrams"))


@register("by_account_month")
def q_by_account_month(spark, sf):
    return P.by_account_month(FX.comments(spark, sf))


@register("crawl_hours")
def q_crawl_hours(spark, sf):
    return P.crawl_hours(FX.crawl_lines(spark, sf))


@register("crawl_hours_lines")
def q_crawl_hours_lines(spark, sf):
    path = scratch_path(spark, "crawl-lines")
    FX.crawl_lines(spark, sf).write.text(path)
    return P.crawl_hours(read_lines(spark, path))


@register("chance_criterion")
def q_chance_criterion(spark, sf):
    return S.chance_criterion(FX.flows(spark, sf))


@register("tune_forest")
def q_tune_forest(spark, sf):
    from tablecraft.operators.ml import tune_forest
    return tune_forest(FX.flows(spark, sf))


# --------------------------------------------------------------------- matches
def _cleaned(spark, sf):
    return M.clean_matches(FX.matches(spark, sf))


@register("clean_matches")
def q_clean_matches(spark, sf):
    return _cleaned(spark, sf)


@register("by_mode")
def q_by_mode(spark, sf):
    return P.matches_by_mode(_cleaned(spark, sf))


@register("hist")
def q_hist(spark, sf):
    return P.histogram(_cleaned(spark, sf), "duration_mins", 20)


@register("hist_by")
def q_hist_by(spark, sf):
    return P.histogram(_cleaned(spark, sf), "duration_mins", 20, by="win_type")


@register("mann_whitney")
def q_mann_whitney(spark, sf):
    mw = S.mann_whitney(_cleaned(spark, sf), "duration_mins", "win_type", "radiant", "dire")
    return mw.select("n1", "n2", "u", r6("z").alias("z"))


@register("ks_2samp")
def q_ks_2samp(spark, sf):
    return S.ks_2samp(_cleaned(spark, sf), "duration_mins", "win_type", "radiant", "dire")


@register("kruskal")
def q_kruskal(spark, sf):
    return S.kruskal(_cleaned(spark, sf), "duration_mins", "game_mode").select("k", "n", r6("h").alias("h"))


@register("levene")
def q_levene(spark, sf):
    return S.levene(_cleaned(spark, sf), "duration_mins", "game_mode").select("k", "n", r6("w").alias("w"))


@register("binned_pairs")
def q_binned_pairs(spark, sf):
    return P.binned_pairs(_cleaned(spark, sf), "first_blood_time", "duration", 20)


@register("pair_corr")
def q_pair_corr(spark, sf):
    return P.pair_corr(_cleaned(spark, sf), "first_blood_time", "duration").select(r6("r").alias("r"))


@register("bit_advantage")
def q_bit_advantage(spark, sf):
    return M.bit_advantages(_cleaned(spark, sf))


@register("advantage_hist")
def q_advantage_hist(spark, sf):
    adv = M.with_advantages(_cleaned(spark, sf))
    return P.histogram(adv, "tower_adv_radiant", 20, by="win_type")


@register("advantage_hist_barracks")
def q_advantage_hist_barracks(spark, sf):
    adv = M.with_advantages(_cleaned(spark, sf))
    return P.histogram(adv, "barracks_adv_radiant", 20, by="win_type")


@register("null_profile")
def q_null_profile(spark, sf):
    return P.null_profile(FX.matches(spark, sf))


@register("csv_inferred")
def q_csv_inferred(spark, sf):
    """Orders as CSV, read back with inferred types: the types, and sums that need them."""
    src = scratch_path(spark, "orders-csv")
    read_table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date")).write.option("header", True).csv(src)
    back = read_csv_inferred(spark, src)
    kinds = ",".join({"int": "whole", "bigint": "whole"}.get(kind, kind) for _, kind in back.dtypes)
    return back.groupBy("o_orderstatus", F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("orders"), F.sum(F.col("o_custkey").cast("bigint")).alias("custkeys"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("price")).withColumn("types", F.lit(kinds))


@register("csv_to_partitioned")
def q_csv_to_partitioned(spark, sf):
    from tablecraft.operators.ingest import csv_to_partitioned
    src = scratch_path(spark, "matches-csv")
    FX.matches(spark, sf).write.option("header", True).csv(src)
    out = scratch_path(spark, "matches-by-lobby")
    back = csv_to_partitioned(spark, src, out, by="lobby_type")
    return back.groupBy(F.col("lobby_type").cast("int").alias("lobby_type")).agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------- papers
@register("top_authors")
def q_top_authors(spark, sf):
    return R.top_authors(FX.papers(spark, sf))


@register("top_institutions")
def q_top_institutions(spark, sf):
    return R.top_institutions(FX.papers(spark, sf))


@register("top_countries")
def q_top_countries(spark, sf):
    return R.top_countries(FX.papers(spark, sf))


@register("country_count")
def q_country_count(spark, sf):
    return R.count_countries(FX.papers(spark, sf))


@register("top_saved")
def q_top_saved(spark, sf):
    from tablecraft.sources.sinks import save_small_csv
    path = scratch_path(spark, "top-countries")
    save_small_csv(R.top_countries(FX.papers(spark, sf)), path)
    return R.top_saved(spark, path, "country STRING, count BIGINT", n=10)


@register("merge_drops")
def q_merge_drops(spark, sf):
    from tablecraft.operators.ingest import drop_counts, merge_drops
    # Both drops are written by one job: one folder per drop (drop=0, drop=1).
    root = scratch_path(spark, "papers-drops")
    (FX.papers(spark, sf).select((F.col("paper_id") % 2).alias("drop"), "metadata")
     .write.partitionBy("drop").json(root))
    drops = [f"{root}/drop={part}" for part in (0, 1)]
    out = scratch_path(spark, "papers-merged")
    return drop_counts(merge_drops(spark, drops, out))


# -------------------------------------------------------------------- archives
#: Paper ids per archive, so the number of archives grows with the table.
IDS_PER_ARCHIVE = 1000


def _paper_archives(spark, sf):
    """Pack every paper as a JSON member into archives of consecutive ids; return the glob."""
    from tablecraft.operators.ingest import pack_archives
    root = scratch_path(spark, "paper-archives")
    papers = FX.papers(spark, sf)
    written = pack_archives(
        papers, root,
        archive=F.concat(F.lit("papers-"), F.floor(F.col("paper_id") / IDS_PER_ARCHIVE).cast("string"),
                         F.lit(".tar.gz")),
        member=F.concat(F.lit("paper-"), F.col("paper_id").cast("string"), F.lit(".json")),
        doc=F.to_json(F.struct("metadata")))
    written.write.format("noop").mode("overwrite").save()
    return f"{root}/*.tar.gz"


@register("archive_rows")
def q_archive_rows(spark, sf):
    from tablecraft.operators.ingest import read_archives
    rows = read_archives(spark, _paper_archives(spark, sf))
    return rows.select("member", F.col("metadata.title").alias("title"),
                       F.coalesce(F.size("metadata.authors"), F.lit(0)).alias("authors"), "error")


@register("archive_counts")
def q_archive_counts(spark, sf):
    from tablecraft.operators.ingest import archive_counts
    counts = archive_counts(spark, _paper_archives(spark, sf))
    return counts.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("archive"), "members", "complete")


@register("archive_files")
def q_archive_files(spark, sf):
    from tablecraft.operators.ingest import count_files
    return count_files(spark, _paper_archives(spark, sf)).select("files", (F.col("bytes") > 0).alias("any_bytes"))


# ------------------------------------------------- item sets, clusters, text files
@register("frequent_sets")
def q_frequent_sets(spark, sf):
    """Brands that orders hold together."""
    from tablecraft.operators.itemsets import frequent_sets
    lines = read_table(spark, sf, "lineitem").join(read_table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    found = frequent_sets(lines, "l_orderkey", "p_brand", min_support=0.001)
    return found.select(F.array_join("items", ",").alias("items"), "size", "support")


@register("kmeans")
def q_kmeans(spark, sf):
    from tablecraft.operators.clusters import kmeans_rounds
    found = kmeans_rounds(read_table(spark, sf, "embeddings"), "embedding", "vec_id", k=8, rounds=5)
    return found.select("cluster", "n", r6("cost").alias("cost"))


@register("silhouette")
def q_silhouette(spark, sf):
    from tablecraft.operators.clusters import silhouette
    found = silhouette(read_table(spark, sf, "embeddings"), "embedding", "label")
    return found.select("cluster", "n", r6("silhouette").alias("silhouette"))


@register("ks_1samp")
def q_ks_1samp(spark, sf):
    found = S.ks_1samp(_cleaned(spark, sf), "duration_mins")
    return found.select("n", r6("d").alias("d"), r6("d_plus").alias("d_plus"), r6("d_minus").alias("d_minus"))


@register("json_lines")
def q_json_lines(spark, sf):
    """Orders as JSON lines, some of them broken, by file folder and outcome."""
    root, key = scratch_path(spark, "json-lines"), F.col("o_orderkey")
    good = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
    line = (F.when(key % 97 == 0, F.concat(F.lit('{"o_orderkey":'), key.cast("string"))).when(key % 89 == 0, "  ")
            .when(key % 83 == 0, F.concat(F.lit('{"o_orderkey":'), key.cast("string"), F.lit(',"o_custkey":"none"}')))
            .when(key % 79 == 0, "[1, 2]").otherwise(good))
    read_table(spark, sf, "orders").select(line.alias("value"), (key % 4).alias("drop")).write.partitionBy("drop").text(root)
    rows = json_lines_checked(spark, f"{root}/*", "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING")
    return rows.groupBy(F.regexp_extract("path", "drop=([0-9]+)", 1).alias("file"), F.coalesce("reason", F.lit("good")).alias("outcome")).agg(
        F.count("*").alias("lines"), F.coalesce(F.sum("doc.o_custkey"), F.lit(0)).alias("custkeys"))


@register("whole_files")
def q_whole_files(spark, sf):
    """One text file for every 100 customers: lines and characters of each, by file name."""
    root = scratch_path(spark, "whole-files")
    customers = read_table(spark, sf, "customer").select(
        F.concat_ws(" ", "c_custkey", "c_name").alias("value"), F.floor(F.col("c_custkey") / 100).alias("file"))
    customers.repartition("file").write.partitionBy("file").text(root)
    whole = read_whole_texts(spark, f"{root}/*")
    return whole.select(F.regexp_extract("path", "file=([0-9]+)", 1).alias("file"), F.length("value").alias("chars"),
                        (F.size(F.split("value", "\n")) - 1).alias("lines"))


# ------------------------------------------------------- models with a checked result
@register("logistic_regression")
def q_logistic_regression(spark, sf):
    """Radiant wins by duration and first blood: weights, loss and whether the gradient vanishes."""
    from tablecraft.operators.linear import logistic_regression
    fit, certificate = logistic_regression(_cleaned(spark, sf), ["duration", "first_blood_time"], F.col("win_type") == "radiant")
    row = (fit.n, *fit.weights, fit.losses[-1] if fit.losses else 0.0, certificate["gradient_norm"] < 1e-6)
    found = spark.createDataFrame([row], "n long, constant double, duration double, first_blood double, loss double, certified boolean")
    return found.select("n", *[r6(c).alias(c) for c in ("constant", "duration", "first_blood", "loss")], "certified")


def _labelled_flows(spark, sf):
    return FX.flows(spark, sf).filter(F.col("Label") != "Label")


@register("linear_svm")
def q_linear_svm(spark, sf):
    """Each flow class against the rest: objective, its lower bound and their gap."""
    from tablecraft.operators.linear import one_against_rest
    flows = _labelled_flows(spark, sf)
    classes = sorted(r["Label"] for r in flows.select("Label").distinct().collect())
    fits = one_against_rest(flows, ["Fwd Mean", "Bwd Mean"], "Label", classes)
    rows = [(c, f.n, cert["primal"], cert["dual"], cert["gap"]) for c, (f, cert) in fits.items()]
    return spark.createDataFrame(rows, "label string, n long, primal double, dual double, gap double")


@register("regression_forest")
def q_regression_forest(spark, sf):
    """Splits of a forest for the price of a line (in cents)."""
    from tablecraft.operators.trees import regression_forest
    lines = read_table(spark, sf, "lineitem").withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("double"))
    forest = regression_forest(lines, ["l_quantity", "l_discount", "l_tax"], "cents", ["l_orderkey", "l_linenumber"],
                               trees=5, depth=3, per_split=2)
    return forest.split_rows(spark).select("tree", "node", "feature", r6("threshold").alias("threshold"), "n_left", "n_right",
                                           r6("mean_left").alias("mean_left"), r6("mean_right").alias("mean_right"))


@register("boosted_trees")
def q_boosted_trees(spark, sf):
    """Log loss of each flow class after every boosting round."""
    from tablecraft.operators.trees import boosted_trees
    model = boosted_trees(_labelled_flows(spark, sf), ["Fwd Mean", "Bwd Mean", "Flow Bytes"], "Label", rounds=5)
    return spark.createDataFrame(model.losses, "round int, label string, loss double")


@register("als")
def q_als(spark, sf):
    """Suppliers and parts by the quantities of their lines: objective and error of every half round."""
    from tablecraft.operators.factors import als
    fit = als(read_table(spark, sf, "lineitem"), "l_suppkey", "l_partkey", "l_quantity", rank=2, rounds=3)
    rows = spark.createDataFrame(fit.errors, "round int, side string, objective double, rmse double")
    return rows.select("round", "side", r6("objective").alias("objective"), r6("rmse").alias("rmse"))


@register("saved_pipeline")
def q_saved_pipeline(spark, sf):
    """A fitted pipeline and its saved and loaded copy, compared row by row."""
    from tablecraft.operators.ml import linear_classifier, load_pipeline, save_model
    flows = _labelled_flows(spark, sf).select(F.col("Fwd Mean").try_cast("double").alias("fwd"),
                                              F.col("Bwd Mean").try_cast("double").alias("bwd"), "Label")
    fitted, path = linear_classifier(flows, ["fwd", "bwd"], "Label"), scratch_path(spark, "saved-pipeline")
    save_model(fitted, path)
    before = fitted.transform(flows).select("fwd", "bwd", "Label", F.col("prediction").alias("before"))
    both = load_pipeline(path).transform(before)
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("differences"))


# ------------------------------------------------------------------- SQL forms
@register("distinct_per_hour_sql")
def q_distinct_per_hour_sql(spark, sf):
    out = P.distinct_per_hour_sql(FX.trips(spark, sf), view=view_name("trips"))
    return out.select("pickup_hour", F.array_join("pickup_locations", ",").alias("pickup_locations"))


@register("top_users_sql")
def q_top_users_sql(spark, sf):
    return R.top_users_sql(FX.tweets(spark, sf), view=view_name("tweets"))


@register("top_tags_sql")
def q_top_tags_sql(spark, sf):
    return R.top_tags_sql(FX.tweets(spark, sf), view=view_name("tweets"))


@register("token_counts_sql")
def q_token_counts_sql(spark, sf):
    return T.count_tokens_sql(FX.texts(spark, sf), view=view_name("texts"))


@register("creation_years_sql")
def q_creation_years_sql(spark, sf):
    return P.creation_years_sql(FX.tweets(spark, sf), view=view_name("tweets2"))
