"""Language identification by nearest centroid.

A text is a vector of its byte n-grams (2 and 3 bytes, lower case, everything that is no letter
taken as a blank) in a fixed number of hash buckets, weighted by TF-IDF and normalised. Document
frequencies come from every learning document. Each language has several centroids, found by
spherical k-means over a bounded sample of its learning documents; clusters of a few odd documents
are dropped. A text gets the language of the centroid with the largest cosine, and is rejected
when that is below the centroid's own limit, a low quantile of its cluster's cosines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import as_row, col, fields, prepare, text_of
from strata.llm.kernels import byte_class, flat

#: Hash buckets, centroids per language, learning documents per language that k-means sees
#: (expected number; chosen by a hash of the id, all of them if there are fewer).
BUCKETS, CENTROIDS, SAMPLE = 4096, 4, 300
#: A cluster of less than this part of its language's sample, or of one document, is no centroid.
SHARE = 0.05
#: Rejected: a best cosine under this part of the LOWEST quantile of its centroid's cluster; for a
#: text of fewer than GRAMS different n-grams the limit falls with their number, as its cosine
#: with any centroid does.
REJECT, LOWEST, GRAMS = 0.5, 0.05, 100
_ROUNDS = 12  # of k-means

_LETTER = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
_FOLD = np.where(_LETTER, np.arange(256) | np.where(np.arange(256) < 0x80, 0x20, 0),
                 0x20).astype(np.uint32)


def vectors(texts: pa.Array, buckets: int, step: int = 128):
    """Term-frequency rows (float32, 1 + log of the count) of the texts, some at a time."""
    data, offsets = flat(texts)
    for i in range(0, len(offsets) - 1, step):
        o = offsets[i:i + step + 1] - offsets[i]
        b = _FOLD[data[offsets[i]:offsets[i] + o[-1]]]
        n = len(o) - 1
        doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(o))
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(263) + b[2:]
        counts = np.zeros(n * buckets, np.int64)
        for h, by, shift, size in ((two, 2654435761, 16, 2), (three, 2246822519, 15, 3)):
            ok = doc[:len(h)] == doc[size - 1:]  # grams don't run into the next text
            if size == 2:
                ok &= (b[:-1] != 0x20) | (b[1:] != 0x20)
            bucket = ((h[ok] * np.uint32(by)) >> np.uint32(shift)) % np.uint32(buckets)
            counts += np.bincount(doc[:len(h)][ok] * np.int64(buckets) + bucket,
                                  minlength=n * buckets)
        x = counts.reshape(n, buckets).astype(np.float32)
        yield np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray   # (languages * clusters, buckets), rows of length 1
    langs: list[str]        # the language of each centroid
    floors: np.ndarray      # a smaller cosine with this centroid is rejected


def _kmeans(x: np.ndarray, k: int, share: float = SHARE) -> np.ndarray:
    """Spherical k-means from k-means++ seeds (a fixed generator). Clusters under the least share
    go one at a time, the smallest first, and their documents to the others."""
    draw = np.random.default_rng(0)
    seeds = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(seeds) < min(k, len(x)):
        far = np.maximum(1 - (x @ x[seeds].T).max(axis=1), 0).astype(np.float64)
        far[seeds] = 0
        if far.sum() <= 0:
            break
        seeds.append(int(draw.choice(len(x), p=far / far.sum())))
    c = x[seeds]
    while True:
        for _ in range(_ROUNDS):
            near = np.argmax(x @ c.T, axis=1)
            c = _unit(np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j]
                                for j in range(len(c))]))
        n = np.bincount(np.argmax(x @ c.T, axis=1), minlength=len(c))
        if len(c) == 1 or n.min() >= max(2, share * len(x)):
            return c
        c = np.delete(c, np.argmin(n), axis=0)


def _frequencies(buckets: int):
    """One row per bucket and task: in how many texts it occurs."""
    def run(batches):
        total, n = np.zeros(buckets, np.int64), 0
        for b in batches:
            for x in vectors(text_of(b), buckets):
                total += (x > 0).sum(axis=0)
                n += len(x)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))],
            names=["bucket", "texts"])
    return run


def _dense(buckets: int):
    def run(batches):
        for b in batches:
            x = np.concatenate([np.zeros((0, buckets), np.float32),
                                *vectors(text_of(b), buckets)]).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["id", "lang", "x"])
    return run


def fit(train: DataFrame, buckets: int = BUCKETS, centroids: int = CENTROIDS,
        sample: int = SAMPLE, reject: float = REJECT) -> Model:
    """Learn from (doc_id, text, lang); rows with a null text or lang teach nothing. The driver
    gets one number per bucket and about ``sample`` vectors per language."""
    prepare(train.sparkSession)
    train = train.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    df = {r["bucket"]: r["n"] for r in train.select("text").mapInArrow(
        _frequencies(buckets), "bucket long, texts long")
        .groupBy("bucket").agg(F.sum("texts").alias("n")).collect()}
    total = df.pop(-1, 0)
    idf = np.log((1 + total) / (1 + np.array([df.get(i, 0) for i in range(buckets)]))) + 1
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    sizes = train.groupBy("lang").agg(F.count("*").alias("size")).collect()
    keep = F.lit(False)
    for r in sizes:
        keep = keep | ((F.col("lang") == r["lang"]) & (share < sample / r["size"]))
    rows = sorted(((r["id"] is None, str(r["id"]), r["lang"], bytes(r["x"])) for r in train.where(keep)
                   .select(F.col("doc_id").alias("id"), "lang", "text")
                   .mapInArrow(_dense(buckets), train.select(F.col("doc_id").alias("id"), "lang")
                               .schema.add("x", T.BinaryType())).collect()))
    lang = np.array([r[2] for r in rows], dtype=object)
    x = _unit(np.frombuffer(b"".join(r[3] for r in rows), np.float16)
              .reshape(-1, buckets).astype(np.float32) * idf.astype(np.float32))
    every, names, floors = [np.zeros((0, buckets), np.float32)], [], []
    for name in sorted(set(lang.tolist())):
        own = x[(lang == name) & (np.abs(x).sum(axis=1) > 0)]
        if len(own):
            c = _kmeans(own, centroids)
            every.append(c)
            names += [name] * len(c)
            cos = own @ c.T
            near = np.argmax(cos, axis=1)
            floors += [reject * float(np.quantile(cos[near == j, j], LOWEST))
                       if (near == j).any() else reject for j in range(len(c))]
    return Model(idf.astype(np.float32), np.concatenate(every).astype(np.float32),
                 names, np.array(floors, np.float32))


def _predict(model: Model):
    def run(batches):
        buckets = len(model.idf)
        langs = np.array(model.langs, dtype=object)
        for b in batches:
            texts = text_of(b)
            best, name, limit = [], [], [np.zeros(0)]
            for x in vectors(texts, buckets):
                full = np.minimum(1, (x > 0).sum(axis=1) / GRAMS)
                if len(langs):
                    cos = _unit(x * model.idf) @ model.centroids.T
                    at = np.argmax(cos, axis=1)
                    best.append(np.clip(cos[np.arange(len(at)), at], 0, 1))
                    name += langs[at].tolist()
                    limit.append(model.floors[at] * full)
                else:
                    best.append(np.zeros(len(x)))
                    name += ["und"] * len(x)
                    limit.append(np.full(len(x), np.inf))
            score = np.concatenate([np.zeros(0), *best]).astype(np.float64)
            letters = [t is not None and (t.isalpha() or any(map(str.isalpha, t)))
                       for t in texts.to_pylist()]
            none = ~np.array(letters, bool)
            score[none] = 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(["und" if out else y for out, y in zip(none, name)], pa.string()),
                 pa.array(score), pa.array(none | (score < np.concatenate(limit))), b.column("row")],
                names=["lang_pred", "score", "rejected", "row"])
    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Each row of ``docs`` (as struct ``row``) with lang_pred, score (best cosine, 0 to 1) and
    rejected. Only the text is read. A null text or one without any letter is ``und``, score 0
    and rejected; so is every text when nothing was learned. Repeated rows get the same result.
    """
    prepare(docs.sparkSession)
    df = docs.select(as_row(docs))
    return df.mapInArrow(_predict(model), fields(
        ("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType()),
        ("row", df.schema["row"].dataType)))


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id's text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame, **parameters) -> Model:
    """The model of the documents table: held-out documents and null ids teach nothing."""
    return fit(docs.where(~held_out() & F.col("doc_id").isNotNull()), **parameters)
