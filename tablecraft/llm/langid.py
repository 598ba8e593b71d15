"""Language identification of mixed-language texts.

Letter trigrams score each word under each language; the word's script rules
out languages that do not use it; Viterbi decoding with a penalty for switching
labels the words, and runs of one label are the spans.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.common import map_texts, share

BITS = 16
#: Log-score a language switch costs.
SWITCH = 14.0
#: Cost of a word in a script that a language hardly uses.
OFF_SCRIPT = 60.0
#: Least share of a language's letters for a script to count as used.
SCRIPT_SHARE = 0.01
#: Characters scored at once.
CHUNK = 1 << 20
#: Most languages learned (the model is 2**BITS numbers each).
MAX_LANGUAGES = 512
#: First and last code point of script ranges.
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = ("other", *dict.fromkeys(name for name, _, _ in SCRIPTS))

_TABLES: list = []


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (0: no letter), and the script's number."""
    if not _TABLES:
        low = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                small = ch.lower()
                low[c] = ord(small) if len(small) == 1 else c
        script = np.zeros(0x110000, np.uint8)
        for name, a, b in SCRIPTS:
            script[a:b + 1] = SCRIPT_NAMES.index(name)
        _TABLES.extend([low, script])
    return _TABLES[0], _TABLES[1]


def analyse(text: str):
    """Per chunk of ``text``: trigram hashes of its letters, first letters of words (index into
    them), word starts and ends (characters), and words' scripts."""
    low, script = letter_tables()
    at = 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        while end < len(text) and text[end - 1].isalpha() and end - at < 2 * CHUNK:
            end += 1
        codes = np.frombuffer(text[at:end].encode("utf-32-le", "surrogatepass"), np.uint32)
        folded = np.concatenate([np.zeros(1, np.uint32), low[codes], np.zeros(1, np.uint32)])
        is_letter = folded[1:-1] > 0
        places = np.flatnonzero(is_letter)
        if len(places):
            with np.errstate(over="ignore"):
                h = (folded[places] * np.uint32(0x9E3779B1) ^ folded[places + 1] * np.uint32(0x85EBCA77)
                     ^ folded[places + 2] * np.uint32(0xC2B2AE3D))
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            first = np.flatnonzero(np.concatenate([[True], np.diff(places) > 1]))
            last = np.concatenate([first[1:], [len(places)]]) - 1
            yield h >> np.uint32(32 - BITS), first, at + places[first], at + places[last] + 1, script[codes[places[first]]]
        at = end


@dataclass
class Model:
    languages: list
    scores: np.ndarray  # (2**BITS, languages) log-probabilities
    allowed: np.ndarray  # (scripts, languages) cost of the script


def count_trigrams(docs: DataFrame) -> DataFrame:
    """``lang, slot, n`` over all rows of ``docs`` (text, lang): trigram hashes, then scripts."""
    out = T.StructType([T.StructField("lang", T.StringType()), T.StructField("slot", T.IntegerType()),
                        T.StructField("n", T.LongType())])

    def run(batches):
        counts: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    table = counts.setdefault(lang, np.zeros((1 << BITS) + len(SCRIPT_NAMES), np.int64))
                    for h, _, starts, ends, scripts in analyse(text):
                        table[:1 << BITS] += np.bincount(h, minlength=1 << BITS)
                        table[1 << BITS:] += np.bincount(scripts, ends - starts, len(SCRIPT_NAMES)).astype(np.int64)
        for lang, table in counts.items():
            slots = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots), pa.string()), pa.array(slots, pa.int32()),
                                              pa.array(table[slots], pa.int64())], names=["lang", "slot", "n"])

    from tablecraft.session import ship_package
    ship_package(docs.sparkSession)
    return docs.select("text", "lang").mapInArrow(run, out).groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Model:
    """Learn from every row with a text and a language; the model's size depends on neither."""
    found = count_trigrams(docs.filter("text IS NOT NULL AND lang IS NOT NULL")).toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"{len(langs)} languages; MAX_LANGUAGES is {MAX_LANGUAGES}")
    table = np.zeros((len(langs), (1 << BITS) + len(SCRIPT_NAMES)))
    row = {x: i for i, x in enumerate(langs)}
    np.add.at(table, ([row[x] for x in found.column("lang").to_pylist()], found.column("slot").to_numpy()), found.column("n").to_numpy())
    grams, scripts = table[:, :1 << BITS], table[:, 1 << BITS:]
    logp = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * (1 << BITS)))
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
    narrow = np.where(used | ~used.any(0), 0.0, -OFF_SCRIPT)  # a script that no language uses rules none out
    return Model(langs, np.ascontiguousarray(logp.T.astype(np.float32)), np.ascontiguousarray(narrow.T))


def viterbi(s: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of each row of ``s`` (words x languages); ties keep the earlier label, then the first."""
    total = s.sum(0)
    best = int(np.argmax(total))
    if s.shape[1] == 1:
        return np.zeros(len(s), np.int64)
    # one label is best if no stretch of words prefers another by more than half a switch
    sums = np.concatenate([np.zeros((1, s.shape[1])), np.cumsum(s - s[:, [best]], axis=0)])
    if (sums - np.minimum.accumulate(sums, axis=0)).max() <= switch / 2:
        return np.full(len(s), best)
    v, back = s[0].tolist(), []
    for row in s[1:].tolist():
        top = max(v)
        arg, floor = v.index(top), top - switch
        back.append([i if x >= floor else arg for i, x in enumerate(v)])
        v = [max(x, floor) + y for x, y in zip(v, row, strict=True)]
    path = [v.index(max(v))]
    for links in reversed(back):
        path.append(links[path[-1]])
    return np.array(path[::-1])


def label_text(text: str | None, model: Model):
    """(language, score, spans [(start, end, language)]) of one text."""
    parts = list(analyse(text)) if text and model.languages else []
    if not parts:
        return "und", 0.0, []
    s = np.concatenate([np.add.reduceat(model.scores[h], first, axis=0, dtype=np.float64) + model.allowed[scripts]
                        for h, first, _, _, scripts in parts])
    starts, ends = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
    path = viterbi(s)
    letters = np.bincount(path, ends - starts, len(model.languages))
    top = int(np.argmax(letters))
    cut = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
    to = np.concatenate([cut[1:], [len(path)]]) - 1
    spans = [(int(starts[a]), int(ends[b]), model.languages[path[a]]) for a, b in zip(cut, to, strict=True)]
    total = s.sum(0)
    rest = np.delete(total, top)
    lead = float(total[top] - rest.max()) if len(rest) else 60.0
    sure = 1 / (1 + np.exp(-np.clip(lead, -60, 60)))
    return model.languages[top], float(letters[top] / letters.sum() * sure), spans


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` (start, end in code points, lang) of every whole text.

    ``lang_pred`` has the most letters in its spans (ties: the first by name);
    ``und``, with score 0 and no spans, if the text is null, has no letter, or
    nothing was learned.  score: its share of the letters times the logistic of
    its lead over all words.  Repeated rows are labelled each; no rows give no
    rows; other columns are not looked at.
    """
    shared = share(docs.sparkSession, model)

    def setup():
        m = shared.value

        def work(texts):
            got = [label_text(t, m) for t in texts]
            return [[g[0] for g in got], [g[1] for g in got],
                    [[{"start": a, "end": b, "lang": x} for a, b, x in g[2]] for g in got]]
        return work
    return map_texts(docs, setup, "lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>")
