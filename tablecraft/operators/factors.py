"""Recommendation by alternating least squares as grouped sums.

Each half of a round fixes one side's factors and solves one small system per key
of the other: its normal equations are sums over its ratings, so they are grown
by partial aggregation in every task and no task collects a key's ratings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.session import scratch_path

#: Ratings of one key that meet its factors in one task; a key with more is split.
PER_PART = 100_000


@dataclass(frozen=True)
class Factors:
    """``users``, ``items``: tables of key and ``factors``; ``errors``: what every half round reached."""

    user: str
    item: str
    users: DataFrame
    items: DataFrame
    ridge: float
    errors: tuple[tuple[int, str, float, float], ...]

    def predict(self, pairs: DataFrame, name: str = "prediction") -> DataFrame:
        """``pairs`` with the dot product of their factors; null where a key was not in the fit."""
        dot = F.aggregate(F.zip_with("__x", "__y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return (pairs.join(self.users.withColumnRenamed("factors", "__x"), self.user, "left")
                .join(self.items.withColumnRenamed("factors", "__y"), self.item, "left")
                .withColumn(name, dot).drop("__x", "__y"))


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared scratch folder and read again."""
    path = scratch_path(df.sparkSession, "als")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hashed_factors(key: str, rank: int) -> Column:
    """``rank`` numbers of [0, 1) from the MD5 of the key's text and the place."""
    def number(j: int) -> Column:
        text = F.concat(F.col(key).cast("string"), F.lit(f":{j}"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return F.array(*[number(j) for j in range(rank)])


def _collapsed(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One row for each pair: ``w`` ratings, their sum ``s`` and sum of squares ``ss``, and the part
    of its user's and of its item's ratings that it stands in (``user_part``, ``item_part``)."""
    value = F.col(rating).cast("double")
    pairs = _kept(df.filter(F.col(user).isNotNull() & F.col(item).isNotNull() & (F.abs(value) < float("inf")))
                        .groupBy(user, item).agg(F.count("*").cast("double").alias("w"), F.sum(value).alias("s"),
                                                 F.sum(value * value).alias("ss")))
    out = pairs
    for key, other, part in ((user, item, "user_part"), (item, user, "item_part")):
        # only keys that have to be split: fewer than one for every PER_PART rows
        large = pairs.groupBy(key).agg(F.ceil(F.count("*") / PER_PART).alias("parts")).filter("parts > 1")
        out = (out.join(large, key, "left")
               .withColumn(part, F.coalesce(F.pmod(F.xxhash64(other), F.col("parts")), F.lit(0)).cast("int")).drop("parts"))
    return _kept(out)


def _upper(rank: int) -> list[tuple[int, int]]:
    return [(j, k) for j in range(rank) for k in range(j, rank)]


def _normal_sums(ratings: DataFrame, parts: DataFrame, fixed: DataFrame, key: str, other: str, part: str, rank: int) -> DataFrame:
    """For each ``key``: ``n`` ratings, their ``ss``, the Gram entries ``gram`` (upper triangle) and ``rhs``.

    The factors of a split key are repeated once for each of its parts
    (``parts``: the parts that have ratings), and ratings meet them by key and
    part.  The sums then run in every task before they are shuffled.
    """
    spread = parts.join(fixed, other).select(other, part, "factors")
    y = [F.col("factors")[j] for j in range(rank)]
    sums = ratings.join(spread, [other, part]).groupBy(key).agg(
        F.sum("w").alias("n"), F.sum("ss").alias("ss"),
        *[F.sum(F.col("w") * y[j] * y[k]).alias(f"g{j}_{k}") for j, k in _upper(rank)],
        *[F.sum(F.col("s") * y[j]).alias(f"b{j}") for j in range(rank)])
    return sums.select(key, "n", "ss", F.array(*[f"g{j}_{k}" for j, k in _upper(rank)]).alias("gram"),
                       F.array(*[f"b{j}" for j in range(rank)]).alias("rhs"))


def _systems(pdf: pd.DataFrame, rank: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """The matrices, ridge times n on the diagonal, and right sides of a batch."""
    j, k = np.array(_upper(rank)).T
    left = np.zeros((len(pdf), rank, rank))
    left[:, j, k] = left[:, k, j] = np.stack(pdf["gram"].to_numpy())
    left[:, range(rank), range(rank)] += ridge * pdf["n"].to_numpy()[:, None]
    return left, np.stack(pdf["rhs"].to_numpy())


def _solved(sums: DataFrame, key: str, rank: int, ridge: float) -> DataFrame:
    """``key, factors``, the ``n`` and ``fit`` (ss less rhs times factors) of every system, solved by batches."""
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                left, right = _systems(pdf, rank, ridge)
                found = np.linalg.solve(left, right[:, :, None])[:, :, 0]
                yield pd.DataFrame({key: pdf[key], "factors": list(found), "n": pdf["n"],
                                    "fit": pdf["ss"] - (found * right).sum(axis=1)})
    kind = sums.schema[key].dataType.simpleString()
    return sums.mapInPandas(solve, f"`{key}` {kind}, factors array<double>, n double, fit double")


def als(df: DataFrame, user: str, item: str, rating: str, rank: int = 10, rounds: int = 10, ridge: float = 0.1) -> Factors:
    """Factors of users and items that minimise, in turns, the squared error of
    rating against their dot product plus ``ridge`` times the squared length of
    each key's factors for each of its ratings.

    Items begin with numbers hashed from their key; each round solves all users,
    then all items.  ``errors`` has (round, side, objective, rmse), the first a
    mean for each rating, which never rises.  Ratings of a pair that repeats all
    count.  Rows with a null key, or a null, NaN or infinite rating are left
    out; no rows give empty tables and no errors.  Only four sums a half round
    reach the driver.
    """
    if rank < 1 or ridge <= 0:
        raise ValueError("rank must be at least 1 and ridge above 0")
    ratings = _collapsed(df.select(user, item, rating), user, item, rating)
    n = ratings.agg(F.sum("w")).first()[0]
    sides = {user: "user_part", item: "item_part"}
    parts = {key: _kept(ratings.select(key, part).distinct()) for key, part in sides.items()}
    solved = {key: ratings.select(key).distinct().select(key, _hashed_factors(key, rank).alias("factors"), F.lit(0.0).alias("n"), F.lit(0.0).alias("fit"))
              for key in (user, item)}
    lengths, errors = {user: 0.0, item: 0.0}, []
    for turn in range(1, rounds + 1 if n else 1):
        for side, key, other in (("user", user, item), ("item", item, user)):
            sums = _normal_sums(ratings, parts[other], solved[other].select(other, "factors"), key, other, sides[other], rank)
            solved[key] = _kept(_solved(sums, key, rank, ridge))
            squared = F.aggregate("factors", F.lit(0.0), lambda a, b: a + b * b)
            got = solved[key].agg(F.sum("fit").alias("fit"), F.sum(F.col("n") * squared).alias("length")).first()
            # at the solution, x G x = rhs x - ridge n x x: the squared error is fit - ridge n x x
            lengths[key] = ridge * got["length"]
            errors.append((turn, side, (got["fit"] + lengths[other]) / n, (max(0.0, got["fit"] - lengths[key]) / n) ** 0.5))
    return Factors(user, item, solved[user].select(user, "factors"), solved[item].select(item, "factors"), ridge, tuple(errors))


def largest_residual(df: DataFrame, rating: str, fit: Factors) -> float:
    """The largest absolute entry of the items' normal equations at the fitted factors, for each rating.

    Summed anew from all rows: zero, but for rounding, shows that no other
    factors of the items would do better with these users.
    """
    rank = fit.items.select(F.max(F.size("factors"))).first()[0]
    if not rank:
        return 0.0
    ratings = _collapsed(df.select(fit.user, fit.item, rating), fit.user, fit.item, rating)
    parts = ratings.select(fit.user, "user_part").distinct()
    sums, ridge = _normal_sums(ratings, parts, fit.users, fit.item, fit.user, "user_part", rank), fit.ridge

    def residual(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                left, right = _systems(pdf, rank, ridge)
                at = np.stack(pdf["factors"].to_numpy())
                off = np.abs(np.einsum("ijk,ik->ij", left, at) - right).max(axis=1) / pdf["n"].to_numpy()
                yield pd.DataFrame({"off": off})
    return sums.join(fit.items, fit.item).mapInPandas(residual, "off double").agg(F.max("off")).first()[0]
