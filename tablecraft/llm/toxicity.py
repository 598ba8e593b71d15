"""Counterfactual-regularised toxicity classifier.

A sparse logistic model over the words (and word beginnings) of a text.  For
every labelled sentence that names a group, the group's word is swapped for
another of its kind and for a word that names no group, and the squared change
of the score is part of the loss: weight that neutral group mentions would pick
up from their company is taken from them.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.common import letter_words, map_texts, share, written

#: Hashed feature space.
BITS = 20
#: Word beginnings that are features too, in bytes (inflected forms share them).
PREFIXES = (4, 5, 6)
#: Most labelled rows of either class that the model is fitted on (the least by a hash of the id).
SAMPLE_TOXIC, SAMPLE_CLEAN = 5_000, 10_000
THRESHOLD = 0.7
#: Words that name groups; words of one line are swapped for each other.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf"), ("old", "young"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
_SENTENCE = re.compile(r"[.!?\n]+")


def feature_ids(word: bytes) -> list[int]:
    """Hashed features of one word: itself and its beginnings; no word has none."""
    if not word:
        return []
    mask = (1 << BITS) - 1
    return [zlib.crc32(b"=" + word) & mask] + [zlib.crc32(b"^" + word[:n]) & mask for n in PREFIXES if len(word) >= n]


class _Features(dict):
    def __init__(self, of, size: int = 200_000):
        self.of, self.size = of, size

    def __missing__(self, word: bytes):
        if len(self) >= self.size:
            self.clear()
        self[word] = got = self.of(word)
        return got


def identity_swaps(text: str, groups=IDENTITY_GROUPS) -> list[tuple[str, str]]:
    """(word, word put in its place) of every sentence that names a group; "" is a word that names none."""
    kin = {w: g for g in groups for w in g}
    out = []
    for sentence in _SENTENCE.split(text.lower()):
        words = set(re.findall(r"[^\W\d_]+", sentence))
        for w in sorted(words & kin.keys()):
            out += [(w, "")] + [(w, o) for o in kin[w] if o != w and o not in words]
    return out


@dataclass
class Model:
    weights: dict  # feature id -> weight, zeros left out
    bias: float

    def score(self, text: str | None) -> float:
        on = set().union(*[feature_ids(w) for w in set(letter_words(text))]) if text else ()
        return sigmoid(self.bias + sum(self.weights.get(i, 0.0) for i in sorted(on)))


def sigmoid(z: float) -> float:
    return 1 / (1 + np.exp(-z)) if z >= 0 else np.exp(z) / (1 + np.exp(z))


def fit_weights(rows: list[np.ndarray], labels: np.ndarray, prior: float, swaps: dict, used: np.ndarray,
                counterfactual: float = 3.0, l1: float = 2e-5, l2: float = 1e-5, steps: int = 400) -> Model:
    """Proximal gradient for the weighted logistic loss + L1 + L2 + swapped-sentence penalty.

    rows: distinct feature ids of each labelled text, all of them in ``used``
    (sorted); prior: share of label 1 among all labelled rows, which the sample
    is weighted back to; swaps: (word, other word) -> sentences.
    """
    n1, n = int(labels.sum()), len(labels)
    if not n1 or n1 == n:
        return Model({}, float(np.log((n1 + 1) / (n - n1 + 1))))
    k = len(used)
    cols = np.searchsorted(used, np.concatenate(rows))
    row_of = np.repeat(np.arange(n), np.fromiter((len(r) for r in rows), np.int64, n))
    marks = [(np.array(feature_ids(a.encode()), int), np.array(feature_ids(b.encode()), int), c) for (a, b), c in sorted(swaps.items())]
    weight = np.where(labels == 1, prior / n1, (1 - prior) / (n - n1))
    total = max(sum(c for *_, c in marks), 1)
    diffs = np.zeros((len(marks), k)) if marks else None
    for i, (a, b, _) in enumerate(marks):
        np.add.at(diffs[i], np.searchsorted(used, b), 1.0)
        np.add.at(diffs[i], np.searchsorted(used, a), -1.0)
    share_of = np.array([c / total for *_, c in marks])

    def matvec(w):
        return np.bincount(row_of, w[cols], n)

    def rmatvec(r):
        return np.bincount(cols, r[row_of], k)

    v = np.ones(k) / np.sqrt(max(k, 1))
    for _ in range(20):  # largest curvature, by power iteration
        u = rmatvec(weight * matvec(v)) / 4
        if marks:
            u = u + 2 * counterfactual * diffs.T @ (share_of * (diffs @ v))
        top = float(np.linalg.norm(u))
        v = u / max(top, 1e-12)
    step = 1 / (top * 1.1 + l2 + 0.25)
    w, b = np.zeros(k), float(np.log(prior / (1 - prior)))
    yw, yb, t = w, b, 1.0
    for _ in range(steps):
        r = weight * (1 / (1 + np.exp(-np.clip(matvec(yw) + yb, -60, 60))) - labels)
        grad = rmatvec(r) + l2 * yw
        if marks:
            grad = grad + 2 * counterfactual * diffs.T @ (share_of * (diffs @ yw))
        to = yw - step * grad
        to, tb = np.sign(to) * np.maximum(np.abs(to) - step * l1, 0), yb - step * r.sum()
        tt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        yw, yb = to + (t - 1) / tt * (to - w), tb + (t - 1) / tt * (tb - b)
        w, b, t = to, tb, tt
    return Model({int(used[i]): float(w[i]) for i in np.flatnonzero(w)}, float(b))


def train(docs: DataFrame, labels: DataFrame, groups=IDENTITY_GROUPS, counterfactual: float = 3.0,
          sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id, toxic) and the texts of those ids.

    Up to ``sample_toxic`` rows of label 1 and ``sample_clean`` of label 0, the
    least by a hash of the id.  Null ids and labels and repeated labels of an id
    are left out; without rows of both labels the score is a constant.
    """
    ids = (labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id")
           .agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r.toxic: r.n for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ranked = ids.withColumn("h", F.xxhash64("doc_id"))
    picked = None
    for label, most in ((1, sample_toxic), (0, sample_clean)):
        part = ranked.filter(F.col("toxic") == label).orderBy("h", "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    picked = F.broadcast(picked.select("doc_id", "toxic"))  # at most sample_toxic + sample_clean rows

    def setup():
        def work(texts):
            feats = [np.unique(np.array([i for w in set(letter_words(t)) for i in feature_ids(w)], np.int32)).tobytes()
                     for t in texts]
            return [feats, [[{"a": a, "b": b} for a, b in identity_swaps(t or "", groups)] for t in texts]]
        return work

    rows = docs.select("doc_id", "text").join(picked, "doc_id")
    table = written(map_texts(rows, setup, "feats binary, swaps array<struct<a: string, b: string>>",
                              carry=("doc_id", "toxic")), "sample")
    swaps = {(r.a, r.b): r.n for r in table.select(F.explode("swaps").alias("s")).groupBy("s.a", "s.b")
             .agg(F.count("*").alias("n")).collect()}  # at most the lexicon's pairs
    telling = _telling_features(table)
    used = np.unique(np.array([r.f for r in telling.collect()] + [i for pair in swaps for w in pair for i in feature_ids(w.encode())], np.int64))
    known = share(docs.sparkSession, used)

    def select():
        return lambda packed: [[np.intersect1d(np.frombuffer(x, np.int32), known.value).astype(np.int32).tobytes() for x in packed]]

    got = map_texts(table.select("doc_id", "toxic", "feats"), select, "kept binary", carry=("doc_id", "toxic"), text="feats").collect()
    got.sort(key=lambda r: (r.doc_id, r.kept))  # bounded: the sample's telling features
    every = counts.get(1, 0) + counts.get(0, 0)
    prior = min(max(counts.get(1, 0) / every, 1e-6), 1 - 1e-6) if every else 0.5
    return fit_weights([np.frombuffer(r.kept, np.int32) for r in got], np.array([r.toxic for r in got], float),
                       prior, swaps, used, counterfactual)


def _telling_features(table: DataFrame) -> DataFrame:
    """``f``: features whose share differs between the classes by three standard errors or more."""
    sizes = {r.toxic: r.n for r in table.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    out = T.StructType([T.StructField("f", T.IntegerType()), T.StructField("on1", T.LongType()), T.StructField("on0", T.LongType())])

    def run(batches):
        on = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for toxic, feats in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                on[toxic][np.frombuffer(feats, np.int32)] += 1
        f = np.flatnonzero(on.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(on[1][f]), pa.array(on[0][f])], names=["f", "on1", "on0"])

    p = (F.col("on1") + F.col("on0")) / (n1 + n0)
    z = (F.col("on1") / n1 - F.col("on0") / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    return (table.select("toxic", "feats").mapInArrow(run, out).groupBy("f").agg(F.sum("on1").alias("on1"), F.sum("on0").alias("on0"))
            .filter("on1 + on0 >= 3").filter((p < 1) & (F.abs(z) >= 3)).select("f"))


def _scorer(model):
    def setup():
        weights, bias = model.value.weights, model.value.bias
        seen = _Features(lambda w: tuple(i for i in feature_ids(w) if i in weights))

        def scores(texts):
            out = []
            for t in texts:
                on = set().union(*map(seen.__getitem__, set(letter_words(t))))
                out.append(float(sigmoid(bias + sum(weights[i] for i in sorted(on)))))
            return out
        return scores
    return setup


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every row; null and empty texts get the score of no words.

    Equal texts get equal scores; repeated rows are scored each; no rows give
    no rows; other columns are not looked at.
    """
    make = _scorer(share(docs.sparkSession, model))

    def setup():
        scores = make()
        return lambda texts: [scores(texts)]
    return map_texts(docs, setup, "score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    make = _scorer(share(docs.sparkSession, model))

    def setup():
        scores = make()
        return lambda texts: [[s < threshold for s in scores(texts)]]
    return map_texts(docs, setup, "clean boolean", carry=tuple(docs.columns), keep=True)
