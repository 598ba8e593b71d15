"""Words of Arrow text columns as numpy arrays: where they stand and a key of each.

Texts are taken from a column's buffer as they lie there, so no Python object is
made per text or word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablecraft.llm.common import _ALNUM, mix64

#: Bytes of text worked on at once (a longer text is taken alone); bounds a worker's arrays.
SLICE_BYTES = 1 << 21
#: Parts the first eight bytes of a longer word from the rest of it.
_NEXT = np.uint64(0x9E3779B97F4A7C15)
#: Masks that keep the first 0 to 8 bytes of a little-endian integer.
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_ALNUM_BYTES = np.frombuffer(_ALNUM, np.uint8) != 32


def _offsets(texts: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    raw = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    return raw[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """``row, offsets, data`` of runs of rows with about ``most`` bytes: the texts' bytes end to end,
    text i of the run at ``offsets[i]:offsets[i + 1]``.  Null texts are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    ends, buffer, at = _offsets(texts), texts.buffers()[2], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        first, last = int(ends[at]), int(ends[to])
        yield at, ends[at:to + 1] - first, buffer[first:last].to_pybytes() if last > first else b""
        at = to


def word_spans(mark: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, ends, first``: the stretches of true bytes that no text border cuts, and the
    number of the first one of each text (and of all, at the end)."""
    n = len(mark)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    opens, closes = mark.copy(), mark.copy()
    opens[1:] &= ~mark[:-1]
    closes[:-1] &= ~mark[1:]
    heads = offsets[:-1][offsets[:-1] < n]
    opens[heads] = mark[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    closes[tails] = mark[tails]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def eights(data: bytes) -> np.ndarray:
    """The eight bytes from every place on, as little-endian integers; behind the end stand zeros."""
    padded = np.frombuffer(data + bytes(8), np.uint8)
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def first_bytes(places: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Up to eight bytes of each stretch as an integer; ``places`` are the ``eights`` of the data."""
    return places[starts] & _FIRST[np.minimum(sizes, 8)]


def span_keys(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Signed 64-bit keys of the words ``data[start:end]``; words of up to eight bytes without zero bytes never share one."""
    places, sizes = eights(data), ends - starts
    out = mix64(first_bytes(places, starts, sizes))
    rest, at = np.flatnonzero(sizes > 8), 8
    while len(rest):
        out[rest] = mix64((out[rest] + _NEXT) ^ first_bytes(places, starts[rest] + at, sizes[rest] - at))
        at += 8
        rest = rest[sizes[rest] > at]
    return out.view(np.int64)


def alnum_keys(offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``keys, first`` of the words of ``common.alnum_words`` in every text of a slice."""
    lower = data.translate(_ALNUM)
    starts, ends, first = word_spans(_ALNUM_BYTES[np.frombuffer(data, np.uint8)], offsets)
    return span_keys(lower, starts, ends), first


def keys_of_texts(texts: list[str | None]) -> list[np.ndarray]:
    """The word keys, in order, of each text."""
    out = []
    for _, offsets, data in text_slices(pa.array(texts, pa.large_string())):
        keys, first = alnum_keys(offsets, data)
        out += np.split(keys, first[1:-1])
    return out


def in_bitmap_all(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``common.in_bitmap`` for an array of keys; the bitmap's size is a power of two."""
    p = keys & np.int64(len(bitmap) * 8 - 1)
    return (bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
