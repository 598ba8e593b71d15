"""File ingest: JSON drops to one Parquet table, CSV to partitioned Parquet,
tar.gz archives of JSON documents to rows.

Archives are streamed member by member inside executor tasks (one archive per
task; memory holds one member and a batch of at most ``BATCH_BYTES``), never
downloaded to the driver.  An archive with a broken format gives an ``error``
row; a storage error fails the task, so Spark tries it again.
"""

from __future__ import annotations

import gzip
import tarfile
import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.sources.fixtures import PAPER_SCHEMA
from tablecraft.sources.sinks import write_partitioned

ARCHIVE_ROW_SCHEMA = "path string, member string, doc string, error string"
ARCHIVE_COUNT_SCHEMA = "path string, members long, complete boolean, error string"
BATCH_BYTES = 8 << 20
#: Faults of an archive's own format; anything else is a storage error.
BAD_FORMAT = (tarfile.TarError, gzip.BadGzipFile, zlib.error, EOFError)
#: Hadoop names of stores that Arrow knows by another name.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


# ------------------------------------------------------------------- JSON drops
def merge_drops(spark: SparkSession, paths: Sequence[str], out: str,
                schema: str = PAPER_SCHEMA, mode: str = "errorifexists") -> DataFrame:
    """Read JSON drops with one declared schema, union by name, write Parquet, read back."""
    frames = [spark.read.schema(schema).json(p).select("metadata") for p in paths]
    merged = frames[0]
    for f in frames[1:]:
        merged = merged.unionByName(f)
    merged.write.mode(mode).parquet(out)
    return spark.read.parquet(out)


def drop_counts(df: DataFrame) -> DataFrame:
    """Rows and rows with non-null ``metadata`` (one row)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count("metadata").alias("non_null"))


# ----------------------------------------------------------------- CSV → Parquet
def csv_to_partitioned(spark: SparkSession, src, out: str, by: str,
                       schema: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Rewrite header CSV (all text unless ``schema``) as Parquet partitioned by ``by``.

    Returns the read-back table; partition values are re-typed by Spark's
    partition inference on read.
    """
    reader = spark.read.option("header", True)
    if schema:
        reader = reader.schema(schema)
    write_partitioned(reader.csv(src), out, by, mode=mode)
    return spark.read.parquet(out)


# ---------------------------------------------------------------------- archives
def _filesystem(path: str):
    """Arrow file system and inner path of a Hadoop-style URI."""
    from pyarrow import fs as pafs
    scheme, colon, rest = path.partition(":")
    return pafs.FileSystem.from_uri(ARROW_SCHEMES.get(scheme, scheme) + colon + rest)


class _Header(tarfile.TarInfo):
    """A member's header, of which plain files' are read straight: name, size and checksum.

    Every other header, and one that does not add up, is the library's matter.
    """

    @classmethod
    def frombuf(cls, buf, encoding, errors):
        # a regular file without a name prefix, its size and checksum in octal digits
        if len(buf) == tarfile.BLOCKSIZE and buf[156:157] == tarfile.REGTYPE and buf[257:262] == b"ustar" and not buf[345]:
            try:
                size, told = (int(buf[a:b].rstrip(b" \0"), 8) for a, b in ((124, 136), (148, 156)))
            except ValueError:
                size = told = -1
            if size >= 0 and told == 256 + sum(buf) - sum(buf[148:156]):
                member = cls(buf[:100].partition(b"\0")[0].decode(encoding, errors))
                member.size = size
                return member
        return super().frombuf(buf, encoding, errors)


#: The header of an empty member without a name, and the sum of its bytes with a blank checksum.
_BLANK = tarfile.TarInfo("").tobuf(tarfile.USTAR_FORMAT)
_BLANK_SUM = 256 + sum(_BLANK) - sum(_BLANK[124:136]) - sum(_BLANK[148:156])


def _member_header(name: str, size: int) -> bytes:
    """The header of a member as the library writes it; names and sizes that fit are put into a header made once."""
    if name and len(name) <= 100 and name.isascii() and size < 8 ** 11:
        told, digits = name.encode("ascii"), b"%011o\0" % size
        total = _BLANK_SUM + sum(told) + sum(digits)
        return b"".join((told.ljust(100, b"\0"), _BLANK[100:124], digits, _BLANK[136:148], b"%06o\0 " % total, _BLANK[156:]))
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf(tarfile.DEFAULT_FORMAT, "utf-8", "surrogateescape")


@contextmanager
def _open_archive(path: str):
    """The members of a tar.gz, streamed; the end of the compressed data is checked on leaving."""
    filesystem, inner = _filesystem(path)
    with filesystem.open_input_stream(inner, compression=None) as raw, gzip.GzipFile(fileobj=raw) as data:
        with tarfile.open(fileobj=data, mode="r|", tarinfo=_Header) as tar:
            yield tar
        while data.read(1 << 20):
            pass


def _archive_members(suffixes: tuple[str, ...]):
    columns = ["path", "member", "doc", "error"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path in (p for pdf in batches for p in pdf["path"]):
            rows: list[tuple] = []
            held = 0
            try:
                with _open_archive(path) as tar:
                    for member in tar:
                        if not member.isfile() or (suffixes and not member.name.endswith(suffixes)):
                            continue
                        data = tar.extractfile(member).read()
                        try:
                            rows.append((path, member.name, data.decode("utf-8"), None))
                        except UnicodeDecodeError as exc:  # member that is no text
                            rows.append((path, member.name, None, f"{type(exc).__name__}: {exc}"))
                        held += len(data)
                        if held >= BATCH_BYTES:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
            except BAD_FORMAT as exc:  # broken or cut archive: one error row after what was read
                rows.append((path, None, None, f"{type(exc).__name__}: {exc}"))
            if rows:
                yield pd.DataFrame(rows, columns=columns)
    return read


def _count_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path in pdf["path"]:
            members, error = 0, None
            try:
                with _open_archive(path) as tar:
                    for member in tar:
                        members += member.isfile()
            except BAD_FORMAT as exc:
                error = f"{type(exc).__name__}: {exc}"
            yield pd.DataFrame([(path, members, error is None, error)],
                               columns=["path", "members", "complete", "error"])


#: Compressed bytes of archives that one task reads, about.
ARCHIVE_TASK_BYTES = 256 << 20


def _archive_tasks(archives: int, size: int, cores: int) -> int:
    """Tasks for so many archives of ``size`` bytes in all: by bytes, a task for every core at least, none without an archive."""
    return max(1, min(archives, max(cores, -(-size // ARCHIVE_TASK_BYTES))))


def _archive_listing(spark: SparkSession, glob: str) -> DataFrame:
    """Paths of the archives, dealt to tasks by their bytes.

    Listed with the ``binaryFile`` source reading only ``path`` and ``length``
    (the content column is pruned).  The number of tasks follows the bytes, so
    very many small archives share tasks.  Ranges of the path's hash give each
    task as many archives as the others, of all sizes; as long as there are no
    more archives than tasks, every archive has its own.
    """
    listing = spark.read.format("binaryFile").load(glob).select("path", "length")
    total = listing.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()
    tasks = _archive_tasks(total["n"], total["size"], spark.sparkContext.defaultParallelism)
    return listing.select("path").repartitionByRange(tasks, F.xxhash64("path"))


def archive_members(spark: SparkSession, glob: str,
                    suffixes: tuple[str, ...] = (".json", ".jsonl")) -> DataFrame:
    """One row per archive member: ``path, member, doc, error``.

    A broken or cut archive adds a row with only ``path`` and ``error``.
    """
    return _archive_listing(spark, glob).mapInPandas(_archive_members(suffixes), schema=ARCHIVE_ROW_SCHEMA)


def read_archives(spark: SparkSession, glob: str, schema: str = PAPER_SCHEMA,
                  suffixes: tuple[str, ...] = (".json", ".jsonl")) -> DataFrame:
    """Archive members parsed as JSON with a declared schema (JVM-side ``from_json``).

    A member that is not valid JSON keeps ``doc`` and gets ``error = 'malformed json'``.
    """
    members = archive_members(spark, glob, suffixes)
    parsed = members.withColumn("parsed", F.from_json("doc", schema, {"mode": "PERMISSIVE"}))
    # json_object_keys is null for text that is not a JSON object ('{}' gives []).
    bad = F.col("doc").isNotNull() & F.json_object_keys("doc").isNull()
    return (parsed.withColumn("error", F.when(F.col("error").isNotNull(), F.col("error"))
                              .when(bad, F.lit("malformed json")))
            .select("path", "member", "parsed.*", "error"))


ARCHIVE_WRITE_SCHEMA = "archive string, members long"


def _archive_writer(root: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = _filesystem(root)
        filesystem.create_dir(base, recursive=True)
        current, part, stream, tar, size, count, done = None, None, None, None, 0, 0, []

        def close():
            if tar is not None:
                # two empty blocks end an archive, which fills whole records
                end = size + 2 * tarfile.BLOCKSIZE
                tar.write(bytes(end - size + -end % tarfile.RECORDSIZE))
                tar.close()
                stream.close()
                filesystem.move(part, f"{base}/{current}")
                done.append((current, count))

        for pdf in batches:
            for name, member, doc in zip(pdf["archive"], pdf["member"], pdf["doc"]):
                if name != current:
                    close()
                    current, size, count = name, 0, 0
                    part = f"{base}/{name}.{uuid.uuid4().hex}.part"
                    stream = filesystem.open_output_stream(part, compression=None)
                    tar = gzip.GzipFile("", "wb", compresslevel=1, fileobj=stream, mtime=0)
                data = (doc or "").encode("utf-8")
                block = b"".join((_member_header(member, len(data)), data, bytes(-len(data) % tarfile.BLOCKSIZE)))
                tar.write(block)
                size += len(block)
                count += 1
        close()
        if done:
            yield pd.DataFrame(done, columns=["archive", "members"])
    return write


def pack_archives(df: DataFrame, root: str, archive, member, doc) -> DataFrame:
    """Write rows as members of tar.gz archives under ``root``; one row per archive written.

    Rows are shuffled by archive name and sorted by member, so each archive is
    written by exactly one task, member by member (memory holds one member).
    Each attempt writes under a name of its own and renames when the archive is
    whole; names and contents are deterministic, so a retried task ends with the
    same archive.  Runs when the returned frame is evaluated.
    """
    rows = df.select(archive.alias("archive"), member.alias("member"), doc.alias("doc"))
    return (rows.repartition("archive").sortWithinPartitions("archive", "member")
            .mapInPandas(_archive_writer(root), schema=ARCHIVE_WRITE_SCHEMA))


def archive_counts(spark: SparkSession, glob: str) -> DataFrame:
    """``path, members, complete, error``: every file member of each archive, whatever its name.

    Only member headers are looked at.  ``complete`` is false where the archive
    is broken or cut short; ``members`` then counts what could be read.
    """
    return _archive_listing(spark, glob).mapInPandas(_count_members, schema=ARCHIVE_COUNT_SCHEMA)


def count_files(spark: SparkSession, glob: str) -> DataFrame:
    """Files and bytes under a prefix, from file metadata only (content pruned)."""
    listing = spark.read.format("binaryFile").load(glob).select("path", "length")
    return listing.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
