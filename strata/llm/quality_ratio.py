"""Quality rules: counted rules, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams (words, pairs of words, 3 bytes) are counted: one over
trusted documents (labelled good and not toxic), one over the whole corpus. A text's score is the
sum of its n-grams' log ratios by the number of its n-grams. Every document is kept or not by one
threshold on that score, without drawing lots: the one that best separates trusted documents from
bad ones (labelled bad or toxic) while it keeps nearly all trusted ones. For that, a trusted
document is scored without its own trusted counts, as one that nobody had labelled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.bucket_table import BLOCK, BucketTable, Reader, Tally, grown, write_table
from strata.llm.common import as_row, fields, prepare, text_of
from strata.llm.kernels import NON_SPACE, U, Words, byte_class, grams, mix

#: Hash buckets of each multinomial: one for so many bytes of text, at least so many; beyond so many
#: they grow with the square root of the text. Added count per bucket.
BUCKET_BYTES, BUCKETS, LINEAR_BUCKETS, ADDED = 40, 1 << 16, 1 << 20, 0.5
#: Words of a repeated window; base limits: least words, hundredths of repeated words.
REPEAT, MIN_WORDS, MAX_REPEAT = 8, 20, 30
#: Most trusted documents (part of them) the threshold may reject; its step on the score axis.
MAX_LOSS, STEP = 0.002, 0.005
#: Labels up to this number are broadcast, more are joined by a shuffle.
BROADCAST_LABELS = 250_000

_SYMBOL = byte_class(lambda b: chr(b) in "#*$%&|<>")
_BLANKS = " \t\n\x0b\x0c\r"
L = T.LongType()


def base_counts(texts: pa.Array, w: Words) -> dict[str, np.ndarray]:
    """word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    def per_text(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[w.offsets[1:]] - total[w.offsets[:-1]]

    chars = per_text(NON_SPACE[w.data] & ((w.data & 0xC0) != 0x80))
    dup = np.zeros(len(w.counts), np.int64)
    for i, t in enumerate(texts.to_pylist()):
        if t and "\n" in t:
            lines = [x for x in t.split("\n") if x.strip(_BLANKS)]
            dup[i] = len(lines) - len(set(lines))
    inside = np.zeros(len(w.hash) + 1, np.int64)
    g = grams(w.hash, REPEAT)
    if len(g):
        doc = w.doc_of_word()
        at = np.flatnonzero(doc[:len(g)] == doc[REPEAT - 1:])
        key = mix(g[at] + doc[at].astype(U) * U(0xD1B54A32D192ED03))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(inside, at[twice], 1)
        np.add.at(inside, at[twice] + REPEAT, -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(inside[:-1]) > 0)])
    return {"word_chars": chars, "n_symbols": per_text(_SYMBOL[w.data]), "n_dup_lines": dup,
            "n_repeat_words": total[w.bounds[1:]] - total[w.bounds[:-1]]}


def features(w: Words, buckets: int):
    """(text, bucket) of every n-gram of a batch: words, word pairs, 3 bytes as they stand."""
    m = U(buckets - 1)
    word = w.doc_of_word()
    yield word, ((w.hash >> U(7)) & m).astype(np.int64)
    pair = grams(w.hash, 2)
    ok = word[:-1] == word[1:]
    yield word[:-1][ok], ((pair[ok] >> U(9)) & m).astype(np.int64)
    d = w.data.astype(U)
    three = (d[:-2] << U(16)) | (d[1:-1] << U(8)) | d[2:]
    three = ((three * U(0x9E3779B97F4A7C15)) >> U(24)) & m
    doc = np.repeat(np.arange(len(w.counts)), np.diff(w.offsets))
    ok = doc[:-2] == doc[2:]
    yield doc[:-2][ok], three[ok].astype(np.int64)


def _counts(buckets: int):
    """Blocks of a task's n-grams: of all its documents, and of the trusted ones."""
    def run(batches):
        tally = Tally()
        for b in batches:
            w = Words(text_of(b), NON_SPACE, 2)
            good = b.column("trusted").to_numpy(zero_copy_only=False).astype(np.int64)
            for doc, at in features(w, buckets):
                tally.add(at, good[doc])
            if tally.full():
                yield from tally.send()
        yield from tally.send()
    return run


@dataclass
class Model:
    table: BucketTable  # n-grams of the corpus, and of the trusted documents as marked
    added: float
    threshold: float    # smaller scores are rejected

    @property
    def counts(self) -> np.ndarray:
        """(corpus and trusted, buckets): the whole table at once, to look into small ones."""
        return self.table.reader().counts(np.arange(self.table.buckets))

    def ratio(self) -> Reader:
        """Reads log(trusted / corpus) of buckets, but for the sums of both."""
        return self.table.reader()

    def _sums(self) -> tuple[float, float]:
        more = self.added * self.table.buckets
        return self.table.total + more, self.table.marked + more

    def unseen(self, ratio: Reader, at: np.ndarray, own: np.ndarray, size: int) -> float:
        """Sum of the ratios of a trusted document's n-grams (buckets ``at``, each ``own`` times,
        ``size`` in all), had it not been labelled: it stays a part of the corpus."""
        corpus, trusted = self._sums()
        counts = ratio.counts(at)
        log_t = np.log((counts[1] - own + self.added) / (trusted - size))
        log_c = np.log((counts[0] + self.added) / corpus)
        return float(((log_t - log_c) * own).sum())

    def scores(self, w: Words, ratio: Reader, unseen: np.ndarray) -> np.ndarray:
        """Mean ratio of each text's n-grams; ``unseen`` texts as if not labelled."""
        total, n = np.zeros(len(w.counts)), np.zeros(len(w.counts), np.int64)
        apart: dict[int, list] = {int(d): [] for d in np.flatnonzero(unseen)}
        for doc, at in features(w, len(ratio)):
            total += np.bincount(doc, ratio.ratios(at), len(n))
            n += np.bincount(doc, minlength=len(n))
            for d, held in apart.items():  # texts follow one another
                held.append(at[np.searchsorted(doc, d):np.searchsorted(doc, d, "right")])
        corpus, trusted = self._sums()
        total += n * np.log(corpus / trusted)
        for d, held in apart.items():
            at, own = np.unique(np.concatenate(held), return_counts=True)
            total[d] = self.unseen(ratio, at, own, int(own.sum()))
        return total / np.maximum(n, 1)


def _score(model: Model, unseen: bool):
    def run(batches):
        ratio = model.ratio()
        for b in batches:
            texts = text_of(b)
            w = Words(texts, NON_SPACE, 2)
            own = (b.column("row").field("trusted").to_numpy(zero_copy_only=False).astype(bool)
                   if unseen else np.zeros(len(b), bool))
            base = base_counts(texts, w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.counts, pa.int64())] + [pa.array(v, pa.int64()) for v in base.values()]
                + [pa.array(model.scores(w, ratio, own)), b.column("row")],
                names=["n_words", *base, "score", "row"])
    return run


def _scored(docs: DataFrame, model: Model, unseen: bool = False) -> DataFrame:
    df = docs.select(as_row(docs))
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return df.mapInArrow(_score(model, unseen), fields(
        *[(c, L) for c in longs], ("score", T.DoubleType()), ("row", df.schema["row"].dataType)))


def _failed():
    """The base rules: too few words, or too many in repeated windows."""
    return ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT))


def fit(docs: DataFrame, labels: DataFrame, buckets: int | None = None, added: float = ADDED,
        max_loss: float = MAX_LOSS) -> Model:
    """Count both multinomials over all documents in one pass, and set the threshold from the
    scores of all labelled documents that pass the base rules, trusted ones as unseen. The driver
    gets one row per range of buckets and per score step. Without a number of ``buckets`` it follows
    the bytes of all texts, without a limit.

    A document with several labels is trusted if all of them are good, and bad if one of them is
    bad or toxic; a null quality or toxic says nothing. Without trusted documents every ratio is 0
    and every document is kept; without bad ones nothing is rejected.
    """
    prepare(docs.sparkSession)
    by_doc = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    if by_doc.count() <= BROADCAST_LABELS:
        by_doc = F.broadcast(by_doc)
    labelled = docs.select("doc_id", "text").join(by_doc, "doc_id", "left").select(
        "text", F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
        .alias("trusted"),
        F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)).alias("bad"))
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = grown(size, BUCKET_BYTES, BUCKETS, LINEAR_BUCKETS)
    counted = write_table(labelled.select("text", "trusted").mapInArrow(_counts(buckets), BLOCK),
                          buckets, added)
    if not counted.marked:
        return Model(BucketTable(buckets), added, float("-inf"))  # every ratio is 0
    model = Model(counted, added, float("-inf"))
    known = _scored(labelled.where("trusted or bad"), model, unseen=True).where(~_failed())
    steps = known.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(
        F.count_if(F.col("row.trusted")).alias("good"), F.count_if(F.col("row.bad")).alias("bad"))
    steps = sorted((r["step"], r["good"], r["bad"]) for r in steps.collect())
    good, bad = sum(s[1] for s in steps), sum(s[2] for s in steps)
    best, lost, caught = 0.0, 0, 0
    for step, g, b in steps:  # reject below step + 1
        lost, caught = lost + g, caught + b
        if lost > max_loss * good:
            break
        if bad and caught / bad - lost / good > best:
            best, model.threshold = caught / bad - lost / good, (step + 1) * STEP
    return model


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """Each row of ``docs`` (as struct ``row``) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, score, base_failed and kept. Null and empty texts have no words, score 0 and
    fail the base rule of least words; repeated rows are judged alike; an empty table gives no
    rows."""
    prepare(docs.sparkSession)
    return (_scored(docs, model).withColumn("base_failed", _failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= model.threshold)))
