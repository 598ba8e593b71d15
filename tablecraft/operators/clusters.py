"""Clustering of vector columns as grouped sums: Lloyd rounds with hashed seeds, and
the silhouette in closed form.  No pairs of points are ever formed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _usable(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """``keep`` and the vector as doubles ``x``; null vectors and vectors with null or NaN entries go."""
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")), F.lit(False)))
    return df.filter(F.col(vector).isNotNull() & good).select(*keep, F.col(vector).cast("array<double>").alias("x"))


def _add(values) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _squared_distance(x, y) -> Column:
    return _add(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)))


def _vector_means(df: DataFrame, group: str) -> DataFrame:
    """``group`` and the mean vector ``centre`` of its rows, summed per entry."""
    entries = df.select(group, F.posexplode("x").alias("at", "v")).groupBy(group, "at").agg(F.avg("v").alias("v"))
    listed = entries.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("entries"))
    return listed.select(group, F.transform("entries", lambda e: e["v"]).alias("centre"))


def kmeans_rounds(df: DataFrame, vector: str, key: str, k: int, rounds: int) -> DataFrame:
    """K-means: ``cluster`` (0 to k - 1), its ``n`` rows and ``cost`` (squared distances to its centre).

    Seeds are the k rows with the least MD5 of the key's text, in that order (a
    repeated key: one row of it).  Every round gives a row to its nearest
    centre (ties: the lower cluster) and moves a centre to the mean of its rows;
    a centre without rows stays.  Deterministic on any partitioning but for the
    last place of sums.  Centres, k vectors, are all that the driver sees.
    Null vectors, null keys and vectors with null or NaN entries are left out;
    fewer rows than k give as many clusters.
    """
    points = _usable(df.filter(F.col(key).isNotNull()), vector, key)
    seeds = points.groupBy(key).agg(F.min("x").alias("x")).orderBy(F.md5(F.col(key).cast("string")), key).limit(k)
    centres = [r["x"] for r in seeds.select("x").collect()]
    if not centres:
        return points.sparkSession.createDataFrame([], "cluster int, n long, cost double")

    def assigned() -> DataFrame:
        held = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])
        to = F.transform(held, lambda c: _squared_distance(F.col("x"), c))
        near = points.withColumn("to", to).withColumn("d", F.array_min("to"))
        return near.select("x", "d", (F.array_position("to", F.col("d")) - 1).cast("int").alias("cluster"))

    for _ in range(rounds):
        for r in _vector_means(assigned(), "cluster").collect():
            centres[r["cluster"]] = r["centre"]
    return assigned().groupBy("cluster").agg(F.count("*").alias("n"), F.sum("d").alias("cost"))


def silhouette(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Mean silhouette (squared Euclidean) of each cluster: ``cluster, n, silhouette``.

    The mean squared distance of x to a cluster of N rows with vector sum S and
    sum of squares Q is ``|x|^2 + Q / N - 2 x.S / N``, so each row needs only
    the clusters' sums, one vector a cluster.  A row alone in its cluster counts
    0; with a single cluster all do.  Null clusters and null vectors or vectors
    with null or NaN entries are left out.  The mean over all rows is the mean
    of the clusters' values weighted by ``n``.
    """
    points = _usable(df.filter(F.col(cluster).isNotNull()), vector, F.col(cluster).alias("cluster"))
    square = _add(F.transform("x", lambda v: v * v))
    sizes = points.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(square).alias("q"))
    sums = _vector_means(points, "cluster").join(sizes, "cluster")
    every = sums.agg(F.collect_list(F.struct("cluster", "centre", "n", "q")).alias("all")).select(F.col("all")).scalar()
    own = F.filter("all", lambda c: c["cluster"] == F.col("cluster"))[0]
    others = F.filter("all", lambda c: c["cluster"] != F.col("cluster"))

    def mean_distance(c) -> Column:
        return F.col("xx") + c["q"] / c["n"] - 2 * _add(F.zip_with("x", c["centre"], lambda a, b: a * b))

    staged = (points.withColumn("all", every).withColumn("xx", square).withColumn("own", own)
              .withColumn("b", F.array_min(F.transform(others, mean_distance)))
              .withColumn("a", F.greatest(F.lit(0.0), mean_distance(F.col("own"))) * F.col("own.n") / (F.col("own.n") - F.lit(1.0) + (F.col("own.n") == 1).cast("int"))))
    value = F.when((F.col("own.n") == 1) | F.col("b").isNull() | (F.greatest("a", "b") == 0), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return staged.groupBy("cluster").agg(F.count("*").alias("n"), F.avg(value).alias("silhouette"))
