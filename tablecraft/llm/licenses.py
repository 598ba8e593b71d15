"""License scans with a positional index of rare words.

Licence templates are indexed by word and place.  A file's licence words are
looked up from the highest IDF (over all files) down; postings minus places
give alignments, intersected by relative position, and a template counts only
where its mandatory key phrases stand.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.common import alnum_words, map_texts, share

#: Phrases that name a licence wherever their words stand consecutively.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Label, template, mandatory key phrases (parts of the template).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction", ("hereby granted free of charge",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", ("redistribution and use", "source and binary forms")),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ("cc0",)),
)
#: Words by which a template's parts may have moved against each other.
SLACK = 2
#: Least share of a template's words, weighted by IDF, at one alignment.
COVER = 0.6


def _split(text: str) -> list[bytes]:
    return alnum_words(text)


@dataclass
class Index:
    """Base phrases and templates as words, with the IDF of each word."""

    idf: dict
    phrases: list = field(default_factory=list)  # (label, words)
    templates: list = field(default_factory=list)  # (label, words, key phrases as words)

    def __post_init__(self):
        self.phrases = [(label, _split(p)) for p, label in BASE_PHRASES]
        self.templates = [(label, _split(t), [_split(k) for k in keys]) for label, t, keys in TEMPLATES]
        self.postings: dict = {}  # word -> [(template, place)]
        for i, (_, words, _) in enumerate(self.templates):
            for p, w in enumerate(words):
                self.postings.setdefault(w, []).append((i, p))
        self.vocabulary = set(self.postings) | {w for _, p in self.phrases for w in p} | {
            w for _, _, keys in self.templates for k in keys for w in k}
        # the rarest word of each phrase and key phrase: a file with none of them matches nothing
        sought = [p for _, p in self.phrases] + [k for _, _, keys in self.templates for k in keys]
        self.seeds = {self.rarest(p)[0] for p in sought}

    def rarest(self, words) -> list:
        return sorted(set(words), key=lambda w: (-self.idf.get(w, 0.0), w))

    def places(self, phrase: list, at: dict) -> list[int]:
        """Where ``phrase`` stands, from its rarest word's places in the file on: ``at`` word -> places."""
        starts = None
        for w in self.rarest(phrase):
            for off in (i for i, x in enumerate(phrase) if x == w):
                here = {p - off for p in at.get(w, ())}
                starts = here if starts is None else starts & here
                if not starts:
                    return []
        return sorted(starts)

    def scan(self, words: list[bytes]):
        """(base places [(start, label)], template hits {label: cover})."""
        if self.seeds.isdisjoint(words):
            return [], {}
        at: dict = {}
        for i, w in enumerate(words):
            if w in self.vocabulary:
                at.setdefault(w, []).append(i)
        base = sorted((p, label) for label, phrase in self.phrases for p in self.places(phrase, at))
        hits: dict = {}
        keys = {i: [self.places(k, at) for k in ks] for i, (_, _, ks) in enumerate(self.templates)}
        live = {i for i, found in keys.items() if all(found)}
        # votes of the file's licence words, rarest first, for (template, start)
        votes: dict = {}
        for w in self.rarest(at):
            for i, off in self.postings.get(w, ()):
                if i in live:
                    for p in at[w]:
                        votes.setdefault(i, {}).setdefault(p - off, set()).add(off)
        for i in sorted(live):
            label, template, ks = self.templates[i]
            weigh = [self.idf.get(w, 0.0) + 1e-9 for w in template]
            # alignments to try: where a key phrase stands
            offs = [self._offset(template, k) for k in ks]
            best = 0.0
            for start in {p - off for off, found in zip(offs, keys[i], strict=True) for p in found}:
                near = range(start - SLACK, start + SLACK + 1)
                if not all(any(p - off in near for p in found) for off, found in zip(offs, keys[i], strict=True)):
                    continue
                there = set().union(*[votes.get(i, {}).get(s, set()) for s in near])
                best = max(best, sum(weigh[o] for o in there) / sum(weigh))
            if best >= COVER:
                hits[label] = max(hits.get(label, 0.0), best)
        return base, hits

    @staticmethod
    def _offset(template: list, key: list) -> int:
        return next((i for i in range(len(template) - len(key) + 1) if template[i:i + len(key)] == key), 0)


def inverse_frequencies(docs: DataFrame) -> dict:
    """IDF over all rows of ``docs`` of each licence word (their number is the templates')."""
    vocabulary = Index({}).vocabulary
    out = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches):
        counts, rows = dict.fromkeys(vocabulary, 0), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(at, 256).to_pylist():
                    rows += 1
                    for w in vocabulary.intersection(alnum_words(text)):
                        counts[w] += 1
        counts[b""] = rows
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    from tablecraft.session import ship_package
    ship_package(docs.sparkSession)
    found = {bytes(r.word): r.n for r in docs.select("text").mapInArrow(run, out).groupBy("word").agg(F.sum("n").alias("n")).collect()}
    rows = found.pop(b"", 0)
    return {w: float(np.log((rows + 1) / (n + 1))) for w, n in sorted(found.items())}


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, base`` (places of base phrases: start word, label), ``found`` (template label, cover).

    Null and empty texts have no words.  Repeated rows are scanned each; no rows
    give no rows; other columns are not looked at.
    """
    idf = share(docs.sparkSession, inverse_frequencies(docs.select("text")))

    def setup():
        index = Index(idf.value)

        def work(texts):
            sizes, base, found = [], [], []
            for t in texts:
                words = alnum_words(t)
                places, hits = index.scan(words)
                sizes.append(len(words))
                base.append([{"start": p, "label": x} for p, x in places])
                found.append([{"label": x, "cover": min(c, 1.0)} for x, c in sorted(hits.items())])
            return [sizes, base, found]
        return work
    return map_texts(docs, setup, "n_words long, base array<struct<start: long, label: string>>, "
                                  "found array<struct<label: string, cover: double>>")
