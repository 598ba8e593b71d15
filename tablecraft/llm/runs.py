"""Runs of repeated word sequences, found by block convolution at dyadic scales.

A run of period q and length at least 4 q keeps ``word[i] == word[i + q]`` over
at least 3 q places.  Scale L = 1, 2, 4, ... takes the periods from 4 L / 3 to
8 L / 3, so those places hold at least three whole aligned blocks of L words.
For every block a number-theoretic transform gives the sum of squared
differences between its words' numbers and each stretch of the window that
follows at such a distance; it is zero where the block occurs again.  Three
neighbouring blocks with a zero at the same distance seed an extension, which
compares the words themselves.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import map_texts

#: 15 * 2**27 + 1, a prime whose products fit 64 bits, and a generator of its multiplicative group.
PRIME, GENERATOR = 2013265921, 31
_P = np.uint64(PRIME)
#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Numbers in one batch of transforms, unless a single one is longer.
BATCH = 1 << 17


@lru_cache(maxsize=64)
def _powers(size: int, inverse: bool) -> np.ndarray:
    """The first ``size`` powers of a root of unity of order ``2 * size``."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * size), PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    out, step = np.ones(1, np.uint64), root
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % _P])
    return out


def _transform(x: np.ndarray) -> np.ndarray:
    """The transform of every column of ``x`` (2**k rows), rows in bit-reversed order."""
    n, m = x.shape
    half = n // 2
    while half:
        y = x.reshape(-1, 2, half, m)
        a, b = y[:, 0], y[:, 1]
        out = np.empty_like(y)
        total = a + b
        np.minimum(total, total - _P, out=out[:, 0])  # below zero wraps to a large number
        np.remainder((a + _P - b) * _powers(half, False)[:, None], _P, out=out[:, 1])
        x, half = out.reshape(n, m), half // 2
    return x


def _inverse(x: np.ndarray) -> np.ndarray:
    """Back from bit-reversed order."""
    n, m = x.shape
    half = 1
    while half < n:
        y = x.reshape(-1, 2, half, m)
        a, b = y[:, 0], y[:, 1] * _powers(half, True)[:, None] % _P
        out = np.empty_like(y)
        total = a + b
        np.minimum(total, total - _P, out=out[:, 0])
        np.minimum(a - b, a + _P - b, out=out[:, 1])
        x, half = out.reshape(n, m), half * 2
    return x * np.uint64(pow(n, PRIME - 2, PRIME)) % _P


def zero_mismatches(codes: np.ndarray, squares: np.ndarray, starts: np.ndarray, length: int, low: int, high: int) -> np.ndarray:
    """Whether each block ``codes[s:s + length]`` occurs again at the distances ``low`` to ``high - 1``.

    A row per start, a column per distance; false where the text ends before.
    The sum of squared differences is exact modulo ``PRIME``: it is zero at
    every occurrence, and words are compared before anything is reported.
    ``squares`` are the running sums of squares modulo ``PRIME``, from 0.
    """
    n, width = len(codes), high - low - 1 + length
    size = 1 << max(1, (width - 1).bit_length())
    blocks = np.zeros((size, len(starts)), np.uint64)
    blocks[:length] = codes[starts[None, :] + np.arange(length - 1, -1, -1)[:, None]]
    at = starts[None, :] + low + np.arange(width)[:, None]
    window = np.zeros((size, len(starts)), np.uint64)
    window[:width] = np.where(at < n, codes[np.minimum(at, n - 1)], 0)
    product = _inverse(_transform(blocks) * _transform(window) % _P)[length - 1:width]
    first = starts[None, :] + np.arange(low, high)[:, None]
    there = first + length <= n
    first = np.where(there, first, 0)
    sums = (squares[starts + length] - squares[starts])[None, :] + squares[first + length] - squares[first]
    return ((sums % _P == np.uint64(2) * product % _P) & there).T


def _distances(codes: np.ndarray) -> np.ndarray:
    """How far the next place of the same word is; the text's length if there is none."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    out = np.full(n, n, np.int64)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


class _Known:
    """Runs found so far, asked whether one of them covers a stretch."""

    def __init__(self):
        self.runs: dict[tuple[int, int], int] = {}

    def covers(self, start: np.ndarray, end: np.ndarray, period: int | None = None) -> np.ndarray:
        """Of a period of at most ``period``, if given."""
        runs = sorted(k for k, q in self.runs.items() if period is None or q <= period)
        if not runs:
            return np.zeros(len(start), bool)
        s, e = np.array(runs).T
        at = np.searchsorted(s, start, "right") - 1
        return (at >= 0) & (np.maximum.accumulate(e)[np.maximum(at, 0)] >= end)


def _chains(block: np.ndarray, distance: np.ndarray):
    """``distance, first, last`` of three or more neighbouring blocks with a zero at one distance."""
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    cut = np.flatnonzero((np.diff(distance) != 0) | (np.diff(block) != 1)) + 1
    first, last = np.r_[0, cut], np.r_[cut, len(block)] - 1
    kept = last - first >= 2
    return distance[first[kept]], block[first[kept]], block[last[kept]]


def _extended(codes: np.ndarray, q: int, start: int, end: int, step: int):
    """Every maximal stretch around ``[start, end)`` whose words come again q places on."""
    most, low, high = len(codes) - q, max(0, start - step), min(len(codes) - q, end + step)
    while True:
        same = codes[low:high] == codes[low + q:high + q]
        grow_low, grow_high = low > 0 and same[0], high < most and same[-1]
        if not (grow_low or grow_high):
            break
        low, high = max(0, low - (high - low)) if grow_low else low, min(most, high + high - low) if grow_high else high
    edges = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
    return [(low + int(a), low + int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def find_runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period.

    Two exact conditions spare transforms: all words of a block have to come
    again within the window, in three neighbouring blocks; and a block that
    lies with its window in a known run of a period up to L can only give that
    run again (two periods over a stretch as long as both share a divisor).
    """
    n = len(codes)
    known = _Known()
    if n < LEAST_WORDS:
        return []
    codes = codes.astype(np.uint64)
    squares = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * codes % _P, out=squares[1:])
    farthest, length = _distances(codes), 1
    while (low := 4 * length // 3 + (length > 1)) <= n // LEAST_PERIODS:
        high = min(8 * length // 3 + 1, n // LEAST_PERIODS + 1)  # 4 L / 3 and 8 L / 3 are never whole
        blocks = n // length
        again = farthest[:blocks] < high
        three = again[:-2] & again[1:-1] & again[2:]
        if three.any():
            viable = np.zeros(blocks, bool)
            for shift in range(3):
                viable[shift:blocks - 2 + shift] |= three
            ks = np.flatnonzero(viable)
            ks = ks[ks * length + low + length <= n]
            if known.runs:
                ks = ks[~known.covers(ks * length, np.minimum(ks * length + high - 1 + length, n), length)]
            hits_k, hits_q = [], []
            per = max(1, BATCH // (4 * length))
            for at in range(0, len(ks), per):
                part = ks[at:at + per]
                k, q = np.nonzero(zero_mismatches(codes, squares, part * length, length, low, high))
                hits_k.append(part[k])
                hits_q.append(q + low)
            if hits_k and sum(map(len, hits_k)) >= 3:
                qs, firsts, lasts = _chains(np.concatenate(hits_k), np.concatenate(hits_q))
                fresh = ~known.covers(firsts * length, (lasts + 1) * length + qs)
                for q, first, last in zip(qs[fresh].tolist(), firsts[fresh].tolist(), lasts[fresh].tolist(), strict=True):
                    for s, e in _extended(codes, q, first * length, (last + 1) * length, length):
                        if e + q - s >= max(LEAST_WORDS, LEAST_PERIODS * q):
                            known.runs.setdefault((s, e + q), q)
        if blocks % 2:
            farthest = farthest[:blocks - 1]
        farthest = np.maximum(farthest[:blocks // 2 * 2:2], farthest[1:blocks // 2 * 2:2])
        length *= 2
    return sorted(((s, e - s, q) for (s, e), q in known.runs.items()), key=lambda r: (r[0], r[2]))


def repeated(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return np.cumsum(edge[:n]) > 0


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers: equal words, equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, with a tail made periodic in a tenth of the documents, chosen by a checksum of the id."""
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def find_word_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per document: ``doc_id, runs`` (start, length, period of each, by start, then period),
    ``collapsed`` (the words joined by one space, without those a run repeats).

    Words are what stands between ASCII blanks, as it is written.  With
    ``plant`` the words are first changed as ``planted`` says.  Null, empty and
    blank texts have no words, no runs and an empty text; a null id is never
    planted.  Repeated rows and ids are looked at each on their own; the other
    columns are not looked at.  A whole text is one row's value: time grows
    with n log n squared at most, memory with n.
    """
    return _mapped(docs, plant, "runs array<struct<start:long,length:long,period:long>>, collapsed string",
                   lambda words, runs, kept: ([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], kept.decode("utf-8")))


def run_digests(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per document: ``doc_id, n_runs``, the longest run's ``start, length, period, exponent_milli``
    (ties: least start, then period; null without runs), ``runs_sha256, collapsed_sha256``.

    The rows of ``find_word_runs``, hashed where they are made.
    """
    def digests(words, runs, kept):
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        return (len(runs), s, length, q, 1000 * length // q if runs else None,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())

    return _mapped(docs, plant, "n_runs long, start long, length long, period long, exponent_milli long, "
                   "runs_sha256 string, collapsed_sha256 string", digests)


def _mapped(docs: DataFrame, plant: bool, ddl: str, shape) -> DataFrame:
    def setup():
        def work(cells):
            rows = []
            for c in cells:
                words = (c["text"] or "").encode("utf-8").split()
                words = planted(c["id"], words) if plant else words
                runs = find_runs(numbered(words))
                kept = b" ".join(w for w, gone in zip(words, repeated(len(words), runs).tolist(), strict=True) if not gone) if runs else b" ".join(words)
                rows.append(shape(words, runs, kept))
            return [list(column) for column in zip(*rows, strict=True)]
        return work

    cells = docs.select("doc_id", F.struct(F.col("doc_id").alias("id"), "text").alias("cell"))
    return map_texts(cells, setup, ddl, text="cell")
