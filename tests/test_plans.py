"""Plan checks: top-k operator, nested column pruning, no Python in native queries, pushdown."""

from tablecraft.operators import rankings as R
from tablecraft.plans import queries
from tablecraft.sources import fixtures as FX


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_is_take_ordered(spark, sf_dir):
    plan = _plan(queries()["top_tags"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan


def test_nested_pruning_on_parquet_papers(spark, sf_dir, tmp_path):
    path = str(tmp_path / "papers")
    FX.papers(spark, sf_dir).write.parquet(path)
    df = spark.read.parquet(path)
    plan = _plan(R.top_institutions(df))
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "institution" in schema and "country" not in schema and "title" not in schema


NATIVE = ["top_pair", "mean_by", "distinct_per_hour", "zscore", "spearman", "top_countries",
          "word_occurrences", "token_counts", "daily_views", "mann_whitney", "hist_by", "null_profile"]


def test_native_queries_have_no_python(spark, sf_dir):
    for name in NATIVE:
        plan = _plan(queries()[name](spark, sf_dir))
        for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert op not in plan, (name, op)


def test_udf_forms_do_use_python(spark, sf_dir):
    assert "ArrowEvalPython" in _plan(queries()["letter_udf"](spark, sf_dir))
    assert "MapInPandas" in _plan(queries()["join_ids_batch"](spark, sf_dir))


def test_scan_prunes_columns(spark, sf_dir):
    plan = _plan(queries()["top_pair"](spark, sf_dir))
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "l_suppkey" in schema and "l_partkey" in schema and "l_comment" not in schema
    assert "l_extendedprice" not in schema


def test_filters_reach_the_parquet_scan(spark, sf_dir, tmp_path):
    from tablecraft.operators.matches import clean_matches
    from tablecraft.operators.profiles import day_slice
    path = str(tmp_path / "matches")
    FX.matches(spark, sf_dir).write.parquet(path)
    plan = _plan(clean_matches(spark.read.parquet(path)))
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "human_players" in pushed
    trips = str(tmp_path / "trips")
    FX.trips(spark, sf_dir).write.parquet(trips)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = _plan(day_slice(spark.read.parquet(trips), "1996-06-15"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(lpep_pickup_datetime" in pushed and "LessThan(lpep_pickup_datetime" in pushed


def test_partitioned_write_reads_back_pruned(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F
    from tablecraft.sources.sinks import write_partitioned
    path = str(tmp_path / "by_lobby")
    write_partitioned(FX.matches(spark, sf_dir), path, "lobby_type")
    plan = _plan(spark.read.parquet(path).filter(F.col("lobby_type") == 3))
    assert "PartitionFilters: [isnotnull(lobby_type" in plan and "= 3)" in plan
