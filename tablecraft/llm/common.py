"""Helpers shared by the training-data operators: Arrow batch maps, word
splitting, shared scratch tables and fixed-size membership bitmaps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablecraft.session import checkpoint_root, ensure_checkpoint_dir, ship_package

#: Rows handed to a Python worker function at once; bounds its working memory.
SLICE_ROWS = 128

_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def alnum_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then words of ASCII letters and digits and any non-ASCII character."""
    return text.encode("utf-8").translate(_ALNUM).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then words between ASCII spaces, tabs and line ends."""
    return text.encode("utf-8").translate(_LOWER).split() if text else []


def letter_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then words of ASCII letters and any non-ASCII character."""
    return text.encode("utf-8").translate(_LETTERS).split() if text else []


def fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def map_texts(df: DataFrame, setup: Callable[[], Callable[[list], list[list]]], ddl: str,
              carry: tuple[str, ...] = ("doc_id",), text: str = "text",
              keep: bool = False) -> DataFrame:
    """Run ``setup()(texts) -> [values of each new column]`` over Arrow batches.

    ``setup`` runs once per task.  Output: the ``carry`` columns as they came,
    then the columns of ``ddl``.  With ``keep`` the last column of ``ddl`` is a
    boolean that selects rows and is left out of the result.  Texts are handed
    over ``SLICE_ROWS`` at a time and each slice is emitted at once, so a
    worker holds a few texts, never a partition.
    """
    ship_package(df.sparkSession)
    by_name = {f.name: f for f in df.schema.fields}
    new = fields(ddl)
    out = T.StructType([by_name[c] for c in carry] + (new[:-1] if keep else new))
    arrow = to_arrow_schema(T.StructType([by_name[c] for c in carry] + new))
    n = len(carry)
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                work = work or setup()
                part = batch.slice(at, SLICE_ROWS)
                got = [pa.array(v, type=arrow.field(n + i).type)
                       for i, v in enumerate(work(part.column(n).to_pylist()))]
                made = pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n)] + (got[:-1] if keep else got), names=names)
                yield made.filter(got[-1]) if keep else made

    picked = [F.col(f"`{c}`") for c in carry] + [F.col(f"`{text}`").alias("__text")]
    return df.select(*picked).mapInArrow(run, out)


def row_key(*cols: str):
    """A 64-bit key of the given columns' content; equal rows share it."""
    return F.xxhash64(*[F.col(c) for c in cols])


#: Folders of tables written inside the open ``scratch`` blocks, innermost last.
_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[set[str]]:
    """Tables ``written`` inside the block are deleted when it ends well.

    The block is handed a set; tables whose name is put there stay, for results
    that are still to be read, until the block around it ends.  Every folder is
    this call's own.
    """
    kept: set[str] = set()
    _OPEN.append([])
    try:
        yield kept
    except BaseException:
        _OPEN.pop()
        raise
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _OPEN.pop():
        if path.rpartition("/")[2].rpartition("-")[0] in kept:
            if _OPEN:
                _OPEN[-1].append(path)
        else:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


#: Spark's setting that deletes a query's shuffle files when the query has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside the block leave no shuffle files behind.

    Without it they stay until the driver's garbage collector finds their
    plans, so a job of many written tables holds the shuffles of all of them.
    A query inside the block still has its files for as long as it runs, also
    where an executor is lost.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{checkpoint_root(spark)}/tablecraft-llm/{name}-{uuid.uuid4().hex[:12]}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


# ------------------------------------------------------- fixed-size membership bitmaps
#: Bits of one membership bitmap: 2**23 bits are 1 MB whatever the input's size.
BITMAP_BITS = 1 << 23


def bitmap_of(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> bytes:
    """A ``bits``-bit bitmap of the long column ``key``: bit ``pmod(key, bits)`` is set.

    A one-hash Bloom filter of proven size: it lets rows through that are not
    in ``keys`` (more of them as it fills), never the other way round.  It only
    thins rows before a shuffle; an exact join always follows.
    """
    width = 1 << 15  # positions of one native bitmap value
    rows = (keys.select(F.pmod(F.col(key), F.lit(bits)).alias("p"))
            .groupBy((F.col("p") / width).cast("int").alias("b"))
            .agg(F.bitmap_construct_agg((F.col("p") % width).cast("long")).alias("m"))
            .collect())  # at most bits / 32768 rows of 4 KB
    out = bytearray(bits // 8)
    for r in rows:
        out[r.b * width // 8:(r.b + 1) * width // 8] = bytes(r.m)
    return bytes(out)


def in_bitmap(bitmap: bytes, key: int) -> bool:
    p = key % (len(bitmap) * 8)
    return bool(bitmap[p >> 3] >> (p & 7) & 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the splitmix64 finaliser's fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def share(spark: SparkSession, value):
    """Broadcast a value whose size the caller has bounded."""
    return spark.sparkContext.broadcast(value)
