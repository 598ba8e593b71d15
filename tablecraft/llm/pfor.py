"""Token ids as binary files of patched frame-of-reference blocks.

A block subtracts its least id, packs every difference at the width that holds
``PERCENTILE`` percent of them, and lists the outliers with their places.  A
file ends with a table of its documents, the byte offset of every block and a
trailer, so any id is found by its number without reading what stands before.

    file    = HEAD  block*  documents  block offsets  TRAILER
    HEAD    = b"TIDBLK1\\0", ids of a full block (u32)
    block   = n (u32), least id (u32), width (u8), outliers (u32),
              packed differences, outlier places (u32 each), outlier differences (u32 each)
    documents      = flags (u8 each, 1: null id), ids (i64 each), ids in the document (u64 each)
    block offsets  = u64 each
    TRAILER = ids, documents, blocks, offset of documents, offset of block offsets (u64 each), b"TIDBLK1\\0"

All integers are little-endian; differences are packed from the least bit up.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.common import mix64, share, written
from tablecraft.llm.words import eights, first_bytes, text_slices, word_spans
from tablecraft.session import ship_package

MAGIC = b"TIDBLK1\0"
HEAD = struct.Struct("<8sI")
BLOCK_HEAD = struct.Struct("<IIBI")
TRAILER = struct.Struct("<QQQQQ8s")
#: Ids of a full block, and the share of them that the packed width has to hold.
BLOCK_IDS = 8192
PERCENTILE = 90
#: A file is closed after the document that brings it to this many ids or documents.
FILE_IDS, FILE_DOCS = 1 << 24, 1 << 20
#: Bytes of files that one reading task takes.
TASK_BYTES = 128 << 20
END_ID = 2
#: Words whose ids a worker remembers before it starts afresh.
CACHE_WORDS = 1_000_000
#: Bytes of a word that a row of the word table holds, and words looked up at once.
ROW_BYTES, LOOKUP_WORDS = 15, 1 << 18
#: Bytes that stand in words: all but spaces and line feeds.
_IN_WORD = np.array([b not in b" \n" for b in range(256)])


# ------------------------------------------------------------------ blocks
def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of every uint32, one after another."""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def encode_block(ids: np.ndarray) -> bytes:
    """One block of uint32 ids (not empty)."""
    least = int(ids.min())
    rest = ids - np.uint32(least)
    rank = -(-len(rest) * PERCENTILE // 100) - 1
    width = int(np.partition(rest, rank)[rank]).bit_length()
    places = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    return b"".join((BLOCK_HEAD.pack(len(ids), least, width, len(places)), pack(rest, width),
                     places.astype("<u4").tobytes(), rest[places].astype("<u4").tobytes()))


def decode_block(data: bytes) -> np.ndarray:
    n, least, width, outliers = BLOCK_HEAD.unpack_from(data)
    at = BLOCK_HEAD.size
    end = at + (n * width + 7) // 8
    rest = unpack(data[at:end], n, width)
    places, values = np.frombuffer(data, "<u4", 2 * outliers, end).reshape(2, outliers)
    rest[places] = values
    return rest + np.uint32(least)


# ------------------------------------------------------------------ files
class Writer:
    """Writes documents' ids to an open binary stream; holds less than two blocks of ids."""

    def __init__(self, stream, block_ids: int = BLOCK_IDS):
        self.stream, self.block_ids, self.at, self.n = stream, block_ids, 0, 0
        self.null, self.ids, self.sizes, self.starts = bytearray(), array("q"), array("Q"), array("Q")
        self.pending: list[bytes] = []
        self.held = 0
        self._put(HEAD.pack(MAGIC, block_ids))

    def _put(self, data: bytes):
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes):
        """One document: its ids as packed little-endian uint32."""
        size = len(ids) // 4
        self.null.append(doc_id is None)
        self.ids.append(doc_id or 0)
        self.sizes.append(size)
        self.n += size
        self.pending.append(ids)
        self.held += size
        if self.held >= self.block_ids:
            self._flush(False)

    def _flush(self, last: bool):
        values = np.frombuffer(b"".join(self.pending), "<u4")
        whole = len(values) if last else len(values) // self.block_ids * self.block_ids
        for at in range(0, whole, self.block_ids):
            self.starts.append(self.at)
            self._put(encode_block(values[at:min(at + self.block_ids, whole)]))
        self.pending, self.held = [values[whole:].tobytes()], len(values) - whole

    def close(self):
        self._flush(True)
        documents = self.at
        self._put(bytes(self.null))
        self._put(np.asarray(self.ids, "<i8").tobytes())
        self._put(np.asarray(self.sizes, "<u8").tobytes())
        offsets = self.at
        self._put(np.asarray(self.starts, "<u8").tobytes())
        self._put(TRAILER.pack(self.n, len(self.ids), len(self.starts), documents, offsets, MAGIC))
        self.stream.close()


class Reader:
    """Reads a file through a seekable stream; any range of ids costs only its blocks."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        self.n, self.n_docs, self.n_blocks, documents, offsets, magic = TRAILER.unpack(self._bytes(size - TRAILER.size, TRAILER.size))
        head, self.block_ids = HEAD.unpack(self._bytes(0, HEAD.size))
        if magic != MAGIC or head != MAGIC:
            raise ValueError("not a file of token blocks, or cut short")
        table = self._bytes(documents, offsets - documents)
        self.null = np.frombuffer(table, np.uint8, self.n_docs)
        self.doc_ids = np.frombuffer(table, "<i8", self.n_docs, self.n_docs)
        self.sizes = np.frombuffer(table, "<u8", self.n_docs, 9 * self.n_docs)
        self.starts = np.append(np.frombuffer(self._bytes(offsets, 8 * self.n_blocks), "<u8"), np.uint64(documents)).astype(np.int64)

    def _bytes(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block(self, k: int) -> np.ndarray:
        return decode_block(self._bytes(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k])))

    def chunks(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids numbered ``start`` to ``stop - 1`` of this file, block by block."""
        for k in range(start // self.block_ids, -(-stop // self.block_ids) if stop > start else 0):
            first = k * self.block_ids
            yield self.block(k)[max(0, start - first):stop - first]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """``doc_id, start in the file, ids, crc32`` of every document; each block is decoded once."""
        at, k, block = 0, -1, None
        for null, doc_id, size in zip(self.null.tolist(), self.doc_ids.tolist(), self.sizes.tolist(), strict=True):
            crc, done = 0, 0
            while done < size:
                if (at + done) // self.block_ids != k:
                    k = (at + done) // self.block_ids
                    block = self.block(k).astype("<u4", copy=False)
                low = at + done - k * self.block_ids
                part = block[low:low + size - done]
                crc, done = zlib.crc32(part.tobytes(), crc), done + len(part)
            yield None if null else doc_id, at, size, crc
            at += size


# ------------------------------------------------------------------ tokenizer
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def latin_letters(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes of UTF-8 text belong to A-Z, a-z and the letters from U+00C0 to U+00FF
    (all unchanged by NFC), and the bytes with those lower-cased."""
    mark, lower = _LETTER[raw], _LOWER[raw]
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    second = second[(raw[second] != 0x97) & (raw[second] != 0xB7)]  # not the signs of times and division
    mark[second] = mark[second - 1] = True
    lower[second[raw[second] < 0x9F]] += 0x20
    return mark, lower


def pieces(raw: np.ndarray, letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``starts, ends, first, latin``: words between spaces and line feeds, each run of letters
    that begins a word apart from its rest (``latin``: such a run).

    Only where nothing or an ASCII character follows the run: the tokenizer
    always ends a match between the two.  ``first`` as in ``words.word_spans``.
    """
    starts, ends, first = word_spans(_IN_WORD[raw], offsets)
    if not len(starts):
        return starts, ends, first, np.zeros(0, bool)
    heads, tails, _ = word_spans(letters, offsets)
    latin, to = letters[starts], ends.copy()
    to[latin] = tails[np.searchsorted(heads, starts[latin])]
    split = to < ends
    split &= latin & (raw[np.minimum(to, len(raw) - 1)] < 0x80)
    latin &= split | (to == ends)
    before = np.concatenate(([0], np.cumsum(split)))
    at, n = np.arange(len(starts)) + before[:-1], len(starts) + int(before[-1])
    out_starts, out_ends, out_latin = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
    out_starts[at], out_ends[at], out_latin[at] = starts, np.where(latin, to, ends), latin
    rest = at[split] + 1
    out_starts[rest], out_ends[rest] = to[split], ends[split]
    return out_starts, out_ends, first + before[first], out_latin


class _WordTable:
    """Numbers of words by open addressing in arrays.

    A row holds the whole word (``ROW_BYTES`` bytes at most) and its size, so
    two words never share one.
    """

    def __init__(self, slots: int = 1 << 16):
        self.rows, self.numbers, self.used = np.zeros((slots, 2), np.uint64), np.zeros(slots, np.int32), 0

    def _slots(self, rows: np.ndarray) -> np.ndarray:
        return (mix64(rows[:, 0] + rows[:, 1] * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(len(self.rows) - 1)).astype(np.int64)

    def find(self, rows: np.ndarray) -> np.ndarray:
        """The number of each row, or -1."""
        out, at, slots = np.full(len(rows), -1, np.int64), np.arange(len(rows)), self._slots(rows)
        while len(at):
            there, asked = self.rows[slots], rows[at]
            same = (there[:, 0] == asked[:, 0]) & (there[:, 1] == asked[:, 1])
            out[at[same]] = self.numbers[slots[same]]
            more = ~same & (there[:, 1] != 0)
            at, slots = at[more], slots[more] + 1 & len(self.rows) - 1
        return out

    def add(self, rows: np.ndarray, numbers: np.ndarray):
        """Rows that differ from one another and are not there yet."""
        self.used += len(rows)
        if self.used * 2 > len(self.rows):
            held = np.flatnonzero(self.rows[:, 1])
            rows, numbers = np.concatenate((self.rows[held], rows)), np.concatenate((self.numbers[held], numbers))
            slots = 1 << (self.used * 4 - 1).bit_length()
            self.rows, self.numbers = np.zeros((slots, 2), np.uint64), np.zeros(slots, np.int32)
        at, slots = np.arange(len(rows)), self._slots(rows)
        while len(at):
            free = self.rows[slots, 1] == 0
            self.rows[slots[free]] = rows[at[free]]  # of rows that meet in a free slot one stays
            self.numbers[slots[free]] = numbers[at[free]]
            lost = (self.rows[slots] != rows[at]).any(1)
            at, slots = at[lost], slots[lost] + 1 & len(self.rows) - 1


class Tokens:
    """Ids of whole texts by a ``tokenizers`` file, special tokens' strings as ordinary text.

    The tokenizer drops white space before its merges, so no token crosses a
    space or line feed, and ids of a text are those of its words one after
    another.  Words are encoded by the library once and remembered, and looked
    up as arrays.  Latin letters that begin a word (see ``pieces``) are one match
    of its pattern: they go straight to the library's model, lower-cased and
    spelt in the byte alphabet.
    """

    def __init__(self, definition: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
        spelt = {c: "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in letters}
        self.alphabet = str.maketrans({c: s for c, s in spelt.items() if s != c})
        self._forget()

    def _forget(self):
        #: numbers of short words, numbers of the others, and of each number: where its ids start and how many they are
        self.short, self.long = _WordTable(), {}
        self.pool, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.known, self.filled = 0, 0

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, letters: str) -> bytes:
        spelt = letters if letters.isascii() else letters.translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _learn(self, words: dict[bytes, bool]) -> np.ndarray:
        """Encode new words (true: Latin letters); their numbers."""
        ids = [self._letters(w.decode("utf-8")) if latin else self._encode(w.decode("utf-8")) for w, latin in words.items()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        number, at, total = self.known, self.filled, int(sizes.sum())
        self.known, self.filled = number + len(ids), at + total

        def room(held: np.ndarray, n: int) -> np.ndarray:
            return held if n <= len(held) else np.concatenate((held, np.empty(max(2 * n, 1 << 16) - len(held), held.dtype)))
        self.pool = room(self.pool, self.filled)
        self.starts, self.sizes = room(self.starts, self.known), room(self.sizes, self.known)
        self.pool[at:self.filled] = np.frombuffer(b"".join(ids), "<u4")
        self.sizes[number:self.known] = sizes
        self.starts[number:self.known] = at + np.cumsum(sizes) - sizes
        return np.arange(number, self.known)

    def _numbers(self, data: bytes, places: np.ndarray, starts: np.ndarray, ends: np.ndarray, latin: np.ndarray) -> np.ndarray:
        """The number of each word ``data[start:end]``; ``places`` are the ``eights`` of the data."""
        sizes = ends - starts
        rows = np.empty((len(starts), 2), np.uint64)
        rows[:, 0] = first_bytes(places, starts, sizes)
        rows[:, 1] = first_bytes(places, np.minimum(starts + 8, len(data)), np.maximum(sizes - 8, 0)) | sizes.astype(np.uint64) << np.uint64(56)
        out, fits = np.full(len(starts), -1, np.int64), sizes <= ROW_BYTES
        out[fits] = self.short.find(rows[fits])
        new: dict[bytes, int] = {}  # word -> where it stands first
        left = np.flatnonzero(out < 0).tolist()
        words = [data[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist(), strict=True)]
        for i, word in zip(left, words, strict=True):
            if word not in self.long:
                new.setdefault(word, i)
        first = np.fromiter(new.values(), np.int64, len(new))
        numbers = self._learn(dict(zip(new, latin[first].tolist(), strict=True)))
        short = fits[first]
        self.short.add(rows[first[short]], numbers[short])
        number_of = dict(zip(new, numbers.tolist(), strict=True))
        self.long |= {w: n for w, n in number_of.items() if len(w) > ROW_BYTES}
        out[left] = [number_of[w] if w in number_of else self.long[w] for w in words]
        return out

    def slice_ids(self, offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """``ids, edges`` of a slice of texts (see ``words.text_slices``): those of text i are ``ids[edges[i]:edges[i + 1]]``."""
        raw = np.frombuffer(data, np.uint8)
        letters, lower = latin_letters(raw)
        starts, ends, first, latin = pieces(raw, letters, offsets)
        # letters are looked up lower-cased, the rest as it stands: both from one run of bytes
        both = lower.tobytes() + data
        starts, ends = (np.where(latin, x, x + len(data)) for x in (starts, ends))
        places, parts, stops, total = eights(both), [np.empty(0, np.uint32)], [np.zeros(1, np.int64)], 0
        for at in range(0, len(starts), LOOKUP_WORDS):
            if self.known > CACHE_WORDS:
                self._forget()
            some = slice(at, at + LOOKUP_WORDS)
            numbers = self._numbers(both, places, starts[some], ends[some], latin[some])
            sizes = self.sizes[numbers]
            stop = np.cumsum(sizes)
            parts.append(self.pool[np.repeat(self.starts[numbers] - stop + sizes, sizes) + np.arange(stop[-1])])
            stops.append(total + stop)
            total += int(stop[-1])
        return np.concatenate(parts), np.concatenate(stops)[first]

    def batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """Packed little-endian uint32 ids of each text."""
        out = []
        for _, offsets, data in text_slices(pa.array(texts, pa.large_string())):
            ids, edges = self.slice_ids(offsets, data)
            out += [part.astype("<u4").tobytes() for part in np.split(ids, edges[1:-1])]
        return out


#: The tokenizer of this worker process, by its definition; tasks that follow find its words known.
_TOKENS: dict[str, Tokens] = {}


def tokens_of(definition: str) -> Tokens:
    """The worker's own ``Tokens``, made once; only the last definition's is held."""
    if definition not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[definition] = Tokens(definition)
    return _TOKENS[definition]


# ------------------------------------------------------------------ Spark
def _filesystem(path: str):
    from pyarrow import fs
    scheme, colon, rest = path.partition(":")
    # Arrow's names of stores that Hadoop calls otherwise
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + colon + rest if colon else "file://" + path)


#: Columns of results; whole numbers but for the path.
WRITTEN = ("part", "seq", "path", "n_ids", "n_docs", "n_bytes")
READ = ("doc_id", "start", "n_tokens", "ids_crc32")


def _schema(names: tuple[str, ...]) -> str:
    return ", ".join(f"{c} {'string' if c == 'path' else 'long'}" for c in names)


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if c == "path" else pa.int64())
                                       for c, v in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def write_tokens(docs: DataFrame, definition: str, root: str, end_id: int = END_ID) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write all ids in ascending doc_id order.

    Texts are dealt to tasks by ranges of the id and sorted; each task encodes
    its rows in turn and streams them to files under ``root`` (any store that
    Arrow opens).  One row per file comes back: ``part, seq`` (the order of the
    files), ``path, n_ids, n_docs, n_bytes, base`` (ids in all files before).
    A file carries its attempt's name and counts only once its task's row is
    committed, so a lost executor leaves at most a file that nothing lists.

    Null and empty texts are the end id alone.  Null ids come first; rows that
    share an id stand in the order of a hash of their texts, and equal rows are
    each written.  Other columns are not looked at.  No rows give no files.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = share(spark, definition)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _filesystem(root)
        filesystem.create_dir(base, recursive=True)
        context, tokens, writer, done, seq = TaskContext.get(), None, None, [], 0

        def close():
            nonlocal writer, seq
            writer.close()
            done.append((context.partitionId(), seq, f"{root}/{name}", writer.n, len(writer.ids), writer.at))
            writer, seq = None, seq + 1

        for batch in batches:
            for at, offsets, data in text_slices(batch.column(1)):
                tokens = tokens or tokens_of(shared.value)
                ids, edges = tokens.slice_ids(offsets, data)
                packed, edges = ids.astype("<u4", copy=False).tobytes(), (4 * edges).tolist()
                for doc_id, start, stop in zip(batch.column(0).slice(at, len(offsets) - 1).to_pylist(), edges, edges[1:], strict=False):
                    if writer is None:
                        name = f"{context.partitionId():06d}-{seq:05d}-{context.taskAttemptId()}.tid"
                        writer = Writer(filesystem.open_output_stream(f"{base}/{name}", compression=None))
                    writer.add(doc_id, packed[start:stop] + end)
                    if writer.n >= FILE_IDS or len(writer.ids) >= FILE_DOCS:
                        close()
        if writer is not None:
            close()
        if done:
            yield _batch(done, WRITTEN)

    # the row number only parts rows that are equal, so that a hot id is split over ranges
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("__tie"), F.monotonically_increasing_id().alias("__row"))
    ordered = keyed.repartitionByRange("doc_id", "__tie", "__row").sortWithinPartitions("doc_id", "__tie", "__row")
    files = written(ordered.select("doc_id", "text").mapInArrow(run, _schema(WRITTEN)), "token-files")
    # a running sum over one row per part, then over the files of each part
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return files.join(before, "part").withColumn("base", F.col("before") + inside).drop("before")


def _tasks(files: DataFrame) -> DataFrame:
    """The files dealt to tasks of about ``TASK_BYTES``, or one each per core if there are few."""
    size = files.agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(1, min(size["n"], max(cores, (size["b"] or 0) // TASK_BYTES))))


def read_documents(files: DataFrame) -> DataFrame:
    """From the files: ``doc_id, start`` (ids of all documents before), ``n_tokens, ids_crc32``.

    ``files`` is what ``write_tokens`` returns.  A broken or cut file fails the task.
    """
    ship_package(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                filesystem, inner = _filesystem(path)
                with filesystem.open_input_file(inner) as source:
                    rows = []
                    for doc_id, at, size, crc in Reader(source).documents():
                        rows.append((doc_id, base + at, size, crc))
                        if len(rows) == 10_000:
                            yield _batch(rows, READ)
                            rows = []
                    if rows:
                        yield _batch(rows, READ)

    return _tasks(files).select("path", "base").mapInArrow(run, _schema(READ))


def read_ids(files: DataFrame, start: int, stop: int) -> np.ndarray:
    """The ids numbered ``start`` to ``stop - 1`` of the whole corpus, read by the block index.

    For a loader that wants a bounded range (a training batch): the caller holds
    what it asks for, and only the blocks of that range are read.
    """
    parts = [np.empty(0, np.uint32)]
    for f in files.filter((F.col("base") < stop) & (F.col("base") + F.col("n_ids") > start)).orderBy("base").collect():
        filesystem, inner = _filesystem(f["path"])
        with filesystem.open_input_file(inner) as source:
            parts += Reader(source).chunks(max(0, start - f["base"]), min(f["n_ids"], stop - f["base"]))
    return np.concatenate(parts)
