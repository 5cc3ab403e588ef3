"""URL filters: host and path rules, and a character language-model ratio for the rest.

Two variable-order Markov models are counted over the URLs that rules accept and reject: for
every order up to ORDER, how often a character follows its context. The whole URL counts, from
scheme to fragment; host and path are the rules' columns only. A character's probability
blends all orders, each order's counts with the next shorter one's probability as prior. A URL's
score is the difference of both log-likelihoods by its length; the limit is calibrated on ruled
URLs that were not counted yet, which then join the counts. Contexts are hashed into tables whose
size follows the characters of all ruled URLs, without a limit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bucket_table import grown
from strata.llm.common import prepare
from strata.llm.kernels import U, flat, mix

#: Longest context, weight of the shorter context's probability.
ORDER, PRIOR = 4, 2.0
#: Hash buckets of an order: one for so many bytes of the ruled URLs, at least so many; beyond so
#: many they grow with the square root of the URLs (a task holds 80 bytes a bucket).
BUCKET_BYTES, BUCKETS, LINEAR_BUCKETS = 8, 1 << 16, 1 << 18
#: One ruled URL in so many (by a hash) calibrates and is counted last; step of the score axis.
HELD, STEP = 5, 0.005
_PAD = "\x00" * ORDER
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(url: str = "url"):
    """(host, path) columns: host after the first ``://`` in lower case, path up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def apply_rules(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Add host, path, rule and rule_verdict. ``rules`` are (verdict, host and path prefix); one
    fits its host and all subdomains; the longest fitting rule wins."""
    host, path = parse()
    df = pages.withColumn("host", host).withColumn("path", path)
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[1])):
        h, slash, p = r.partition("/")
        fits = (((F.col("host") == h) | F.col("host").endswith("." + h))
                & F.col("path").startswith(slash + p))
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return df.withColumn("rule", none if rule is None else rule).withColumn(
        "rule_verdict", none if verdict is None else verdict)


def _contexts(texts: pa.Array, buckets: int):
    """Text of each character, and per order the buckets of its context and of both together."""
    data, offsets = flat(pa.array([_PAD + (t or "") for t in texts.to_pylist()], pa.string()))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(data))
    at = at[at - offsets[:-1][doc] >= ORDER]
    m, out = U(buckets - 1), []
    context = np.zeros(len(at), U)
    for order in range(ORDER + 1):
        if order:
            context = mix(context * U(257) + data[at - order].astype(U) + U(1))
        both = mix(context ^ mix(data[at].astype(U) + U(order * 1000)))
        out.append(((context & m).astype(np.int64), (both & m).astype(np.int64)))
    return doc[at], out


def _count(buckets: int):
    """(side, table, bucket, n): table 2 * order counts contexts, 2 * order + 1 what follows."""
    def run(batches):
        total = np.zeros((2, 2 * ORDER + 2, buckets), np.uint32)
        for b in batches:
            side = b.column("accepted").to_numpy(zero_copy_only=False).astype(np.int64)
            doc, tables = _contexts(b.column("chars"), buckets)
            for order, pair in enumerate(tables):
                for i, bucket in enumerate(pair):
                    for s in (0, 1):
                        np.add.at(total[s, 2 * order + i], bucket[side[doc] == s], 1)
        s, t, k = np.nonzero(total)
        for i in range(0, max(1, len(s)), 200_000):
            z = slice(i, i + 200_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[z]), pa.array(t[z]), pa.array(k[z]), pa.array(total[s[z], t[z], k[z]].astype(np.int64))],
                names=["side", "tab", "bucket", "n"])
    return run


@dataclass
class Model:
    counts: np.ndarray  # (rejected and accepted, 2 * ORDER + 2, buckets)
    limit: float        # smaller scores are blocked

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood ratio per character; 0 without characters or without both models."""
        doc, tables = _contexts(texts, self.counts.shape[2])
        if not (self.counts[0].any() and self.counts[1].any()):
            return np.zeros(len(texts))
        logs = []
        for side in (0, 1):
            p = np.full(len(doc), 1 / 256)
            for order, (context, both) in enumerate(tables):
                p = ((self.counts[side, 2 * order + 1][both] + PRIOR * p)
                     / (self.counts[side, 2 * order][context] + PRIOR))
            logs.append(np.log(np.minimum(p, 1)))
        n = np.bincount(doc, minlength=len(texts))
        return np.bincount(doc, logs[1] - logs[0], len(texts)) / np.maximum(n, 1)


def _score(model: Model, names: list[str]):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array(model.scores(b.column("chars")))],
                names=[*names, "score"])
    return run


def _with_score(df: DataFrame, model: Model) -> DataFrame:
    names = [c for c in df.columns if c != "chars"]
    return df.mapInArrow(_score(model, names), df.select(*names).schema.add("score", "double"))


def _counted(data: DataFrame, buckets: int) -> np.ndarray:
    """The counts of a model; at most 2 * (2 * ORDER + 2) * buckets numbers reach the driver."""
    counts = np.zeros((2, 2 * ORDER + 2, buckets), np.float32)
    t = (data.mapInArrow(_count(buckets), "side long, tab long, bucket long, n long")
         .groupBy("side", "tab", "bucket").agg(F.sum("n").alias("n")).toArrow())
    counts[tuple(t.column(c).to_numpy() for c in ("side", "tab", "bucket"))] = \
        t.column("n").to_numpy()
    return counts


def fit(ruled: DataFrame) -> Model:
    """Count over all ruled URLs but the calibrating part, then set the limit where accepted and
    rejected ones separate best. With one side only, nothing is known: limit 0, scores 0."""
    prepare(ruled.sparkSession)
    data = ruled.where("rule is not null").select(
        F.col("url").alias("chars"), (F.col("rule_verdict") == "allow").alias("accepted"))
    held = F.pmod(F.xxhash64("chars"), F.lit(HELD)) == 0
    size = data.agg(F.sum(F.octet_length("chars"))).first()[0] or 0
    buckets = grown(size, BUCKET_BYTES, BUCKETS, LINEAR_BUCKETS)
    model = Model(_counted(data.where(~held), buckets), 0.0)
    steps = _with_score(data.where(held), model).groupBy(F.floor(F.col("score") / STEP).alias("s")
        ).agg(F.count_if("accepted").alias("good"), F.count_if(~F.col("accepted")).alias("bad"))
    steps = sorted((r["s"], r["good"], r["bad"]) for r in steps.collect())
    good, bad = sum(s[1] for s in steps), sum(s[2] for s in steps)
    best = 0.0
    if good and bad:
        lost = caught = 0
        for s, g, b in steps:
            lost, caught = lost + g, caught + b
            if caught / bad - lost / good > best:
                best, model.limit = caught / bad - lost / good, (s + 1) * STEP
    return Model(model.counts + _counted(data.where(held), buckets), model.limit)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict (the rule's, else the model's) and score of each page.
    A URL without ``://`` has empty host and path, so no rule fits it, and is judged by its own
    characters; a null or empty one has score 0. Repeated pages are judged alike; an empty table
    gives no rows."""
    prepare(pages.sparkSession)
    ruled = apply_rules(pages.select("page_id", "url"), rules)
    model = fit(ruled)
    scored = _with_score(ruled.select("page_id", "host", "path", "rule", "rule_verdict",
                                      F.col("url").alias("chars")), model)
    own = F.when(F.col("score") >= model.limit, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", own).alias("verdict"), "score")
