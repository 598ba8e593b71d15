"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame

from tablecraft.llm.common import map_texts, share

#: Texts longer than this many characters are encoded in pieces.
PIECE_CHARS = 50_000
#: A single space between two characters that are no white space starts a new match of the
#: pattern whatever stands before it, so a text can be cut there without changing any match.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str) -> bytes:
    """The rank file (base64 token and rank a line); its size is the vocabulary's, not the data's."""
    with open(path, "rb") as f:
        return f.read()


def pieces(text: str, size: int = PIECE_CHARS):
    """Cut ``text`` at the first safe boundary after every ``size`` characters."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


_ENCODERS: dict = {}


def encoder(ranks: bytes, pattern: str):
    """The tiktoken encoding of a rank file, made once per process."""
    import tiktoken
    key = (hashlib.sha1(ranks).hexdigest(), pattern)
    if key not in _ENCODERS:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _ENCODERS[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _ENCODERS[key]


def encode(text: str, enc) -> list[int]:
    ids: list[int] = []
    for piece in pieces(text):
        ids += enc.encode_ordinary(piece)
    return ids


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, dtype="<u4").tobytes()


def tokenize(docs: DataFrame, path: str, pattern: str, outputs: str = "ids") -> DataFrame:
    """Encode every whole text and decode it again.

    ``outputs='ids'``: ``doc_id, ids`` (packed little-endian uint32), ``decoded``
    (bytes).  ``outputs='digests'``: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``, hashed where they are made so that ids never travel.

    Special tokens are ordinary text.  Null and empty texts have no tokens.
    Long texts are encoded in pieces cut where no match of the pattern can
    cross; a text without such a place is one piece.  Repeated rows and ids are
    encoded each on their own; other columns are not looked at.
    """
    ranks = share(docs.sparkSession, read_ranks(path))
    digests = outputs == "digests"

    def setup():
        enc = encoder(ranks.value, pattern)

        def work(texts):
            made = [encode(t or "", enc) for t in texts]
            back = [enc.decode_bytes(ids) for ids in made]
            if not digests:
                return [[packed(ids) for ids in made], back]
            return [[len(ids) for ids in made],
                    [hashlib.sha256(packed(ids)).hexdigest() for ids in made],
                    [hashlib.sha256(b).hexdigest() for b in back]]
        return work

    ddl = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded binary"
    return map_texts(docs, setup, ddl)


def with_token_counts(docs: DataFrame, path: str, pattern: str, name: str = "n_tokens") -> DataFrame:
    """All columns of ``docs`` and the number of tokens of each text, whether it decodes to itself, and the ids' digest.

    Columns of ``docs`` that have a new column's name are replaced.
    """
    ranks = share(docs.sparkSession, read_ranks(path))

    def setup():
        enc = encoder(ranks.value, pattern)

        def work(texts):
            made = [encode(t or "", enc) for t in texts]
            same = [enc.decode_bytes(ids) == (t or "").encode("utf-8") for ids, t in zip(made, texts, strict=True)]
            return [[len(ids) for ids in made], same, [hashlib.sha256(packed(ids)).hexdigest() for ids in made]]
        return work

    carry = tuple(c for c in docs.columns if c.lower() not in (name.lower(), "decodes", "ids_sha256"))
    return map_texts(docs, setup, f"{name} long, decodes boolean, ids_sha256 string", carry=carry)
