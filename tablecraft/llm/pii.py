"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IPs, card and phone numbers.  The field's nodes
are those spans and the other tokens with a digit or ``@``; neighbours share a
chain potential, and tokens that repeat or resemble each other anywhere in the
document share a skip potential, through one shared variable for all of them.
Loopy message passing then labels tokens the patterns missed consistently with
the ones they found.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.common import map_texts, share

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Hashed token shapes, and the tables that count them by different hashes.
SHAPES, HASHES = 4096, 3
#: Digits from which two digit strings are compared without their separators.
SAME_DIGITS = 7
#: Rounds after which the damping grows by a tenth of what is left to 1.
ROUNDS, DAMPING = 12, 0.3
#: Change of a message, in nats, under which it has settled.
SETTLED = 1e-6
#: Nodes from which the documents gathered so far are labelled.
BATCH_NODES = 50_000
#: Links whose messages are computed at once; bounds the working memory.
BLOCK_LINKS = 1 << 16
#: Belief from which a label is taken.
TAKE = 0.5

_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a digit run that fails fails from all its places, so it is tried from its start only
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# tried from the start of a word only
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_EDGES = ".,;:!?()[]{}<>\"'"


def _luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, each found from its ``@`` outwards."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' valid matches by start, then kind; code points, end exclusive."""
    if not text:
        return []
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


@dataclass
class Node:
    start: int
    end: int
    label: int  # of the pattern that matched; 0: none did
    shape: tuple  # its row in each table
    keys: tuple


def _keys(s: str) -> tuple:
    """What a token shares with others that repeat or resemble it."""
    digits = re.sub(r"[^0-9]", "", s)
    keys = [s.lower()]
    if len(digits) >= SAME_DIGITS:
        keys.append("#" + digits)
    if "@" in s:
        keys.append("@" + s.lower().split("@")[0])
    return tuple(keys)


def _rejected(s: str) -> bool:
    """Whether a token that no pattern matched has a pattern's form, so that its check (octets, Luhn, digits) failed."""
    return bool(_IP.search(s) or ("+" in s and _PHONE.search(s)) or any(m.end() - m.start() >= 14 for m in _CARD.finditer(s)))


def _shape(s: str, rejected: bool = False) -> tuple:
    """Hashes of the token's character classes, runs of other classes than digits cut to three; a rejected token's shapes are its own."""
    form = re.sub(r"([^9])\1{3,}", r"\1\1\1", re.sub(r"[a-zà-ÿ]", "a", re.sub(r"[0-9]", "9", s[:64].lower())))
    h = xxhash.xxh3_64_intdigest((form + "\n" * rejected).encode("utf-8", "surrogatepass"))
    return tuple(t * SHAPES + (h >> 16 * t) % SHAPES for t in range(HASHES))


def nodes_of(text: str, base: list) -> list[Node]:
    """Pattern spans (labelled) and the tokens with a digit or ``@`` that touch none, in order."""
    out = [Node(a, b, KINDS.index(k) + 1, _shape(text[a:b]), _keys(text[a:b])) for k, a, b in base]
    taken, i = sorted((a, b) for _, a, b in base), 0
    reach = 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in _EDGES:
            a += 1
        while b > a and text[b - 1] in _EDGES:
            b -= 1
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if a < b and reach <= a:
            out.append(Node(a, b, 0, _shape(text[a:b], _rejected(text[a:b])), _keys(text[a:b])))
    return sorted(out, key=lambda n: (n.start, n.end, n.label))


def skip_links(nodes: list[Node]) -> list[tuple[int, int]]:
    """Each node with the next one that shares a key: as many links as keys, not as pairs."""
    last, out = {}, set()
    for i, n in enumerate(nodes):
        for k in n.keys:
            if k in last:
                out.add((last[k], i))
            last[k] = i
    return sorted(out)


def key_groups(nodes: list[Node]) -> list[tuple[int, ...]]:
    """The nodes that share a key, for every key that several have; keys of the same nodes give one group."""
    found: dict[str, list[int]] = {}
    for i, n in enumerate(nodes):
        for k in n.keys[1:] or n.keys:  # equal tokens share all their keys
            found.setdefault(k, []).append(i)
    return list(dict.fromkeys(tuple(g) for g in found.values() if len(g) > 1))


@dataclass
class Potentials:
    shape: np.ndarray  # (HASHES * SHAPES, labels), smoothed counts
    chain: np.ndarray  # (labels, labels)
    skip: np.ndarray

    def unary(self, shapes: list[tuple]) -> np.ndarray:
        """Log-shares of the labels: a shape's count is the least over the tables, so shapes that collide in one stay apart."""
        n = self.shape[np.array(shapes, np.int64).reshape(-1, HASHES)].min(axis=1)
        return np.clip(np.log(n / n.sum(axis=1, keepdims=True)), -8.0, 0.0)


def propagate_all(docs: list[list[Node]], model: Potentials) -> list[np.ndarray]:
    """Beliefs (nodes x labels) of each document by loopy sum-product message passing, in the log domain.

    Nodes that share a key are tied to one more variable, so a label is two
    hops from all its repeats.  A token that stands ``m`` times unmatched is one
    token: each place brings an m-th of its shape's and neighbours' evidence, so
    places without a match do not outvote the match by their number.  A
    document's messages are passed until they settle; a swing that does not die
    away by itself is damped more and more.  The documents only share the
    arrays: what stands beside one does not change its beliefs.
    """
    k, unary, ends, links = len(LABELS), [], [], []
    size, starts = 0, []
    for nodes in docs:
        groups = key_groups(nodes)
        times = np.ones(len(nodes))
        for g in groups:
            unsure = sum(not nodes[i].label for i in g)
            for i in g:
                if not nodes[i].label:
                    times[i] = max(times[i], unsure)
        own = np.zeros((len(nodes) + len(groups), k))
        own[:len(nodes)] = model.unary([x.shape for x in nodes]) / times[:, None]
        for i, x in enumerate(nodes):
            if x.label:
                own[i] = -50.0
                own[i, x.label] = 0.0
        starts.append(len(links))
        links += [(size + i, size + i + 1, max(times[i], times[i + 1])) for i in range(len(nodes) - 1)]
        links += [(size + i, size + len(nodes) + h, 0) for h, g in enumerate(groups) for i in g]
        unary.append(own)
        ends.append((size, size + len(nodes)))
        size += len(own)
    unary = np.concatenate(unary) if unary else np.zeros((0, k))
    table = np.array(links).reshape(-1, 3)
    a, b = table[:, 0].astype(np.int64), table[:, 1].astype(np.int64)
    shares, which = np.unique(table[:, 2], return_inverse=True)
    pots = np.exp(np.stack([model.chain / m if m else model.skip for m in shares])) if links else None
    owner = np.repeat(np.arange(len(docs)), np.diff([*starts, len(links)]))

    def inbox(to_b, to_a, a, b):
        return unary + np.stack([np.bincount(b, to_b[:, j], size) + np.bincount(a, to_a[:, j], size) for j in range(k)], axis=1)

    def sent(cavity, which, pots):
        top = cavity.max(axis=1, keepdims=True)
        e, out = np.exp(cavity - top), np.empty_like(cavity)
        for at in range(0, len(e), BLOCK_LINKS):
            part = slice(at, at + BLOCK_LINKS)
            out[part] = (e[part, :, None] * pots[which[part]]).sum(axis=1)
        out = np.log(out)
        return out - out.max(axis=1, keepdims=True)

    done_b, done_a = np.zeros((len(links), k)), np.zeros((len(links), k))
    live, damping, turn = np.arange(len(links)), DAMPING, 0
    while len(live):
        x, y, kind, to_b, to_a = a[live], b[live], which[live], done_b[live], done_a[live]
        box = inbox(to_b, to_a, x, y)
        new_b = sent(box[x] - to_a, kind, pots)
        new_a = sent(box[y] - to_b, kind, pots.transpose(0, 2, 1))
        step = (1 - damping) * np.maximum(np.abs(new_b - to_b).max(axis=1), np.abs(new_a - to_a).max(axis=1))
        done_b[live], done_a[live] = damping * to_b + (1 - damping) * new_b, damping * to_a + (1 - damping) * new_a
        moved = np.zeros(len(docs))
        np.maximum.at(moved, owner[live], step)
        live = live[moved[owner[live]] > SETTLED]
        turn += 1
        if turn % ROUNDS == 0:
            damping = 1 - (1 - damping) * 0.9
    belief = inbox(done_b, done_a, a, b) if links else unary
    belief = np.exp(belief - belief.max(axis=1, keepdims=True)) if size else belief
    belief = belief / belief.sum(axis=1, keepdims=True)
    return [belief[s:e] for s, e in ends]


def propagate(nodes: list[Node], model: Potentials) -> np.ndarray:
    """Beliefs (nodes x labels) of one document."""
    return propagate_all([nodes], model)[0]


def added_to(texts: list, bases: list, model: Potentials) -> list[list[tuple[str, int, int]]]:
    """``added_spans`` of every text; the field runs on each that has a node without a label."""
    out, held, size = [[] for _ in texts], [], 0

    def label():
        for (at, nodes), belief in zip(held, propagate_all([n for _, n in held], model), strict=True):
            out[at] = [(LABELS[i], x.start, x.end) for x, p in zip(nodes, belief, strict=True)
                       if not x.label and (i := int(p.argmax())) and p[i] > TAKE]
        held.clear()

    for at, (text, base) in enumerate(zip(texts, bases, strict=True)):
        nodes = nodes_of(text, base) if text else []
        if any(not x.label for x in nodes):
            held.append((at, nodes))
            size += len(nodes)
        if size >= BATCH_NODES:
            label()
            size = 0
    label()
    return out


def added_spans(text: str | None, base: list, model: Potentials) -> list[tuple[str, int, int]]:
    """Spans the field adds to the patterns' spans, by any of its potentials; none touches them."""
    return added_to([text], [base], model)[0]


def count_labels(docs: DataFrame) -> DataFrame:
    """``what, i, j, n``: over all rows, labels by shape, by neighbours and by shared key.

    The patterns' labels teach the field; tokens that resemble a span the
    patterns found are left open, not taught as no personal data.
    """
    out = T.StructType([T.StructField("what", T.IntegerType()), T.StructField("i", T.IntegerType()),
                        T.StructField("j", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches):
        k = len(LABELS)
        tables = [np.zeros((HASHES * SHAPES, k), np.int64), np.zeros((k, k), np.int64), np.zeros((k, k), np.int64)]
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                for text in batch.column(0).slice(at, 128).to_pylist():
                    if not text or not (_DIGIT.search(text) or "@" in text):
                        continue
                    nodes = nodes_of(text, base_spans(text))
                    known = {x for n in nodes if n.label for x in n.keys}
                    open_ = [not n.label and bool(known.intersection(n.keys)) for n in nodes]
                    for n, unsure in zip(nodes, open_, strict=True):
                        if not unsure:
                            tables[0][list(n.shape), n.label] += 1
                    for i in range(len(nodes) - 1):
                        if not open_[i] and not open_[i + 1]:
                            tables[1][nodes[i].label, nodes[i + 1].label] += 1
                    for i, j in skip_links(nodes):
                        if not open_[i] and not open_[j]:
                            tables[2][nodes[i].label, nodes[j].label] += 1
        for what, table in enumerate(tables):
            i, j = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), what), pa.int32()), pa.array(i, pa.int32()),
                                              pa.array(j, pa.int32()), pa.array(table[i, j], pa.int64())], names=["what", "i", "j", "n"])

    from tablecraft.session import ship_package
    ship_package(docs.sparkSession)
    return docs.select("text").mapInArrow(run, out).groupBy("what", "i", "j").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Potentials:
    """Potentials as smoothed log-ratios of the counts over all of ``docs`` (their number is fixed)."""
    k = len(LABELS)
    tables = [np.full((HASHES * SHAPES, k), 0.5), np.full((k, k), 0.5), np.full((k, k), 0.5)]
    for r in count_labels(docs).collect():  # at most HASHES * SHAPES * labels rows
        tables[r.what][r.i, r.j] += r.n
    shape, chain, skip = tables
    skip = skip + skip.T

    def lift(t):
        return np.log(t * t.sum() / (t.sum(1, keepdims=True) * t.sum(0, keepdims=True)))
    # what repeats has one label: same labels are favoured at least as strongly as shapes speak against them
    pull = np.clip(lift(skip), -8.0, 8.0)
    pull[np.diag_indices(k)] = np.maximum(np.diag(pull), 8.0)
    pull[0, 1:], pull[1:, 0] = -8.0, -8.0
    return Potentials(shape, np.clip(lift(chain), -2.0, 2.0), pull)


def find_pii(docs: DataFrame, model: Potentials) -> DataFrame:
    """``doc_id, base, added``: spans (kind, start, end) by the patterns and by the field, by start, then kind.

    Null and empty texts have none.  Repeated rows are searched each; no rows
    give no rows; other columns are not looked at.
    """
    shared = share(docs.sparkSession, model)

    def setup():
        m = shared.value

        def work(texts):
            base = [base_spans(t) for t in texts]
            return [[[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in found]
                    for found in (base, added_to(texts, base, m))]
        return work
    one = "array<struct<kind: string, start: int, end: int>>"
    return map_texts(docs, setup, f"base {one}, added {one}")
