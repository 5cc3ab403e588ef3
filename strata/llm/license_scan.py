"""Licence scan by a positional index of rare words.

Every template (a licence's notice or its opening words) posts each of its words with its place.
For a file and a template, the file's highest-IDF words among the template's are looked up; an
occurrence at word f of a word that the template has at t votes for the offset f - t. Offsets at
which enough of the looked-up words agree (within a few words, as names, years and small changes
shift what follows them) are where the template may stand. There its mandatory key phrases must
stand word by word, and its share of words found near their places is the score.

IDF comes from the document frequencies of the templates' words in all documents. The index is as
large as the templates, whatever the corpus; each text is read once for the frequencies and once for
the search, and no row is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import as_row, col, fields, list_array, prepare, text_of
from strata.llm.kernels import LETTER_DIGIT, Words, hash_ranges

#: Phrases that stand for a label wherever their words stand consecutively (fixed).
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: label; words of the notice; phrases that must stand in it.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction", ("permission is hereby granted free of charge",
                                    "deal in the software without restriction")),
    ("apache-2.0", "licensed under the apache license version 2 0",
     ("apache license version 2 0",)),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this "
                   "file except in compliance with the license you may obtain a copy of the license at",
     ("apache license version 2 0", "except in compliance with the license")),
    ("gpl-2.0", "licensed under the gnu general public license version 2",
     ("general public license version 2",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3",
     ("general public license version 3",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of "
            "the gnu general public license as published by the free software foundation",
     ("gnu general public license as published by the free software foundation",)),
    ("lgpl", "licensed under the gnu lesser general public license",
     ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license",
     ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms",
      "provided that the following conditions are met")),
    ("bsd", "released under the bsd license", ("bsd license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted provided that the above copyright notice",
     ("distribute this software for any purpose with or without fee is hereby granted",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license v 2 0",)),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0",
     ("eclipse public license 2 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software released into the public domain",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will "
             "the authors be held liable for any damages arising from the use of this software",
     ("in no event will the authors be held liable",)),
    ("cc0", "released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
)

#: Highest-IDF words of a template that are looked up in a file; the share of the template's own
#: highest-IDF words that must agree on an offset; words that offsets may differ by; the least
#: share of the template's words found there.
LOOK_UP, AGREE, SLACK, LEAST = 6, 0.5, 8, 0.5
_BLOCK = 4096  # offsets scored at once
MATCH = T.ArrayType(fields(("label", T.StringType()), ("first", T.LongType()),
                           ("last", T.LongType()), ("score", T.DoubleType())))
PLACE = T.ArrayType(fields(("label", T.StringType()), ("word", T.LongType())))


@dataclass(frozen=True)
class Licenses:
    """Templates, base phrases and the IDF of the templates' words."""
    templates: tuple = TEMPLATES
    phrases: tuple = PHRASES
    idf: tuple = ()  # (word, idf)

    def vocabulary(self) -> list[str]:
        said = [p for p, _ in self.phrases]
        for _, text, keys in self.templates:
            said += [text, *keys]
        return sorted({w for t in said for w in t.split()})


class _Index:
    """The words of a batch as numbers, and the templates in these numbers."""

    def __init__(self, licenses: Licenses):
        self.words = licenses.vocabulary()
        raw = [w.encode() for w in self.words]
        ends = np.cumsum([len(w) for w in raw])
        size = np.array([len(w) for w in raw])
        h = hash_ranges(np.frombuffer(b"".join(raw), np.uint8), ends - size, ends)
        order = np.argsort(h)
        self.hash, self.size, self.number = h[order], size[order], order
        number = {w: i for i, w in enumerate(self.words)}

        def ids(text):
            return tuple(number[w] for w in text.split())
        self.phrases = [(ids(p), label) for p, label in licenses.phrases]
        idf = dict(licenses.idf)
        rank = sorted(number, key=lambda w: (-idf.get(w, 0.0), w))
        place = {number[w]: i for i, w in enumerate(rank)}
        self.templates = []
        for label, text, keys in licenses.templates:
            t = np.array(ids(text))
            rare = sorted(set(t.tolist()), key=place.get)  # highest IDF first
            need = np.array(sorted({w for k in keys for w in ids(k)}))
            self.templates.append((label, t, rare, need, [ids(k) for k in keys]))

    def numbers(self, w: Words) -> np.ndarray:
        """The number of each word, or -1. A word is known by its hash and its length."""
        at = np.minimum(np.searchsorted(self.hash, w.hash), len(self.hash) - 1)
        same = (self.hash[at] == w.hash) & (self.size[at] == w.ends - w.starts)
        return np.where(same, self.number[at], -1).astype(np.int32)


def _places(words: np.ndarray, bounds: np.ndarray, phrase: tuple) -> np.ndarray:
    """Where the words of a phrase stand consecutively inside a text."""
    at = np.flatnonzero(words == phrase[0])
    at = at[at + len(phrase) <= bounds[np.searchsorted(bounds, at, "right")]]
    for k, w in enumerate(phrase[1:], 1):
        at = at[words[at + k] == w]
    return at


def _offsets(words: np.ndarray, template: np.ndarray, rare: list[int]):
    """Votes of the looked-up words: offset and number of the word, by offset."""
    offset, voter = [], []
    for k, w in enumerate(rare):
        f = np.flatnonzero(words == w)
        for t in np.flatnonzero(template == w).tolist():
            offset.append(f - t)
            voter.append(np.full(len(f), k))
    offset, voter = np.concatenate(offset), np.concatenate(voter)
    order = np.argsort(offset, kind="stable")
    return offset[order], voter[order]


def _scores(words: np.ndarray, template: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each offset, the share of the template's words that stand within SLACK words of their
    places."""
    out = np.empty(len(offsets))
    for i in range(0, len(offsets), _BLOCK):
        at = offsets[i:i + _BLOCK, None] + np.arange(len(template))
        found = np.zeros(at.shape, bool)
        for d in range(-SLACK, SLACK + 1):
            inside = (at + d >= 0) & (at + d < len(words))
            found |= inside & (words[np.where(inside, at + d, 0)] == template)
        out[i:i + _BLOCK] = found.mean(1)
    return out


def _matches(words: np.ndarray, keys: list[np.ndarray], template: np.ndarray,
             rare: list[int]):
    """(first, last, score) of the template's places in one text, none over another. ``keys`` are
    the places of its mandatory phrases in this text."""
    held = set(np.unique(words).tolist())
    looked = [w for w in rare if w in held][:LOOK_UP]
    need = max(math.ceil(AGREE * min(LOOK_UP, len(rare))), 1)
    if len(looked) < need:
        return
    offset, voter = _offsets(words, template, looked)
    end = np.searchsorted(offset, offset + 2 * SLACK, "right")
    agree = np.zeros(len(offset), np.int64)
    for k in range(len(looked)):
        seen = np.concatenate([[0], np.cumsum(voter == k)])
        agree += seen[end] > seen[:-1]
    good = agree >= need
    for k in keys:  # a phrase between the first and the last place that the votes allow
        low = np.searchsorted(k, offset - SLACK, "left")
        good &= np.searchsorted(k, offset + 3 * SLACK + len(template), "right") > low
    good = np.flatnonzero(good)
    middle = np.unique(offset[(good + end[good] - 1) // 2])  # the middle vote of those that agree
    score = _scores(words, template, middle)
    middle, score = middle[score >= LEAST], score[score >= LEAST]
    i = 0
    while i < len(middle):
        at = int(middle[i])
        near = int(np.searchsorted(middle, at + SLACK, "right"))
        best = i + int(np.argmax(score[i:near]))  # the first of the best nearby
        first = int(middle[best])
        yield max(0, first), min(len(words), first + len(template)) - 1, float(score[best])
        i = int(np.searchsorted(middle, first + len(template)))  # places don't overlap


def _scan(licenses: Licenses):
    def run(batches):
        index = _Index(licenses)
        label_type = pa.struct([("label", pa.string()), ("word", pa.int64())])
        match_type = pa.struct([("label", pa.string()), ("first", pa.int64()),
                                ("last", pa.int64()), ("score", pa.float64())])
        for b in batches:
            w = Words(text_of(b), LETTER_DIGIT)
            words, bounds = index.numbers(w), w.bounds
            docs = len(w.counts)
            at, kind = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for k, (phrase, _) in enumerate(index.phrases):
                some = _places(words, bounds, phrase)
                at.append(some)
                kind.append(np.full(len(some), k))
            at, kind = np.concatenate(at), np.concatenate(kind)
            order = np.lexsort((kind, at))
            at, kind = at[order], kind[order]
            doc = np.searchsorted(bounds, at, "right") - 1
            names = np.array([label for _, label in index.phrases], object)
            places = list_array(
                [{"label": n, "word": x} for n, x in zip(names[kind], (at - bounds[doc]).tolist())],
                np.bincount(doc, minlength=docs), label_type)
            matches = [[] for _ in range(docs)]
            hit = np.flatnonzero(words >= 0)
            held = np.zeros((docs, len(index.words)), bool)  # which file holds which word
            held[np.searchsorted(bounds, hit, "right") - 1, words[hit]] = True
            for label, template, rare, need, keys in index.templates:
                files = np.flatnonzero(held[:, need].all(1))
                if not len(files):
                    continue
                where = [_places(words, bounds, k) for k in keys]
                for d in files.tolist():
                    lo, hi = int(bounds[d]), int(bounds[d + 1])
                    own = [x[np.searchsorted(x, lo):np.searchsorted(x, hi)] - lo for x in where]
                    if all(len(x) for x in own):
                        matches[d] += [
                            {"label": label, "first": f, "last": z, "score": s}
                            for f, z, s in _matches(words[lo:hi], own, template, rare)]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(w.counts, pa.int64()), places,
                 pa.array(matches, pa.list_(match_type))],
                names=["row", "n_words", "places", "matches"])
    return run


def _frequencies(licenses: Licenses):
    def run(batches):
        index = _Index(licenses)
        some, docs = np.zeros(len(index.words), np.int64), 0
        for b in batches:
            w = Words(text_of(b), LETTER_DIGIT)
            words = index.numbers(w)
            hit = np.flatnonzero(words >= 0)
            doc = np.searchsorted(w.bounds, hit, "right") - 1
            pairs = np.unique(doc * len(index.words) + words[hit])
            some += np.bincount(pairs % len(index.words), minlength=len(index.words))
            docs += len(w.counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*index.words, None], pa.string()), pa.array([*some.tolist(), docs])],
            names=["word", "n"])
    return run


def fit(docs: DataFrame, templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> Licenses:
    """The index with the IDF ``ln((N + 1) / (df + 1))`` of its words over all documents. The
    driver gets one number per word of the templates."""
    prepare(docs.sparkSession)
    plain = Licenses(templates, phrases)
    counts = docs.select("text").mapInArrow(_frequencies(plain), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {r["word"]: r["n"] for r in counts}
    total = n.pop(None, 0)
    return Licenses(templates, phrases, tuple(sorted(
        (w, math.log((total + 1) / (k + 1))) for w, k in n.items())))


def scan(docs: DataFrame, licenses: Licenses, keep_columns: bool = True) -> DataFrame:
    """Each row of ``docs`` (struct ``row``; only its doc_id without ``keep_columns``) with
    ``n_words``, the ``places`` (label, word) of the base phrases, and the ``matches`` (label, first
    and last word, score) of the templates.

    Null and empty texts have no words and no places. A template may stand several times in a file;
    two places of one template don't overlap, those of different templates may. Repeated rows are
    scanned alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    row = as_row(docs) if keep_columns else F.struct(col("doc_id").alias("doc_id")).alias("row")
    df = docs.select(col("text").alias("text"), row)
    return df.mapInArrow(_scan(licenses), fields(
        ("row", df.schema["row"].dataType), ("n_words", T.LongType()),
        ("places", PLACE), ("matches", MATCH)))
