"""MinHash near-dedup with bottom-k sketches.

One hash function: a text's sketch is its k smallest distinct shingle hashes. Texts with equal
shingle sets form a class at once (count and a 128-bit sum over the whole set); classes meet in
inverted lists of retained values; a pair goes on if the union sketch (k smallest of both)
estimates enough overlap; the pair's exact Jaccard over all shingles decides.

No list is expanded into all its pairs. Two sketches that must share ``need`` values share one of
their ``size - need + 1`` rarest values, so only those are listed. In each list the most popular
member (its values are the most frequent ones, so it lies in the middle of a group of near copies)
is paired with the others, which joins a large group into one component. Left are members of one
list in *different* components. Their whole shingle sets are ordered, first those that no other
component has, then the rarest; a pair can only reach the similarity if its first common shingle
stands early in both (prefix and position bounds), which leaves few pairs. So every pair of
different components that shares a listed value is decided exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import as_row, fields, list_array, materialise, prepare, text_of, tidy
from strata.llm.components import connected_components
from strata.llm.kernels import mix, shingle_sets

#: Words of a shingle, similarity in hundredths, retained values of a sketch.
SHINGLE, PERCENT, K = 5, 75, 64
#: A pair stays a candidate while this share of its union sketch (hundredths) is in both. At a
#: true similarity of 0.75 the chance of less is 2e-8 (binomial tail, k = 64).
SHARE = 40
#: Members of a list block in the second round, and earlier values of a member that are compared
#: to tell whether a pair has been made already.
BLOCK, SEEN = 256, 16
#: Largest table of ids (long) that is broadcast; more are joined by a shuffle.
BROADCAST_IDS = 250_000

L = T.LongType()


def _signature(shingle: int, k: int):
    def run(batches):
        task, serial = TaskContext.get().partitionId() << 36, 0
        for b in batches:
            sets = list(shingle_sets(text_of(b), shingle))
            sizes = np.array([len(s) for s in sets], np.int64)
            cut = np.minimum(sizes, k)
            every = np.concatenate(sets).view(np.uint64) if sets else np.zeros(0, np.uint64)
            at = np.concatenate([[0], np.cumsum(sizes)])
            sums = []
            for salt in (0x51ED270B, 0xB492B66F):  # prefix sums wrap, their differences don't care
                c = np.concatenate([np.zeros(1, np.uint64),
                                    np.cumsum(mix(every ^ np.uint64(salt)), dtype=np.uint64)])
                sums.append((c[at[1:]] - c[at[:-1]]).view(np.int64))
            sketch = np.concatenate([s[:k] for s in sets]) if sets else np.zeros(0, np.int64)
            ids = task + serial + np.arange(len(sets), dtype=np.int64)
            serial += len(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]),
                 list_array(sketch, cut, pa.int64()), b.column("row")],
                names=["rid", "n", "h1", "h2", "sketch", "row"])
        tidy()
    return run


def _exact(shingle: int, percent: int):
    """Keep the pairs whose whole shingle sets reach the similarity."""
    def run(batches):
        for b in batches:
            u, v = b.column("u").to_numpy(), b.column("v").to_numpy()
            ids, first = np.unique(np.concatenate([u, v]), return_index=True)
            texts = pa.concat_arrays([b.column("tu").cast(pa.large_string()),
                                      b.column("tv").cast(pa.large_string())])
            sets = dict(zip(ids.tolist(), shingle_sets(texts.take(pa.array(first)), shingle)))
            keep = []
            for x, y in zip(u.tolist(), v.tolist()):
                p, q = sets[x], sets[y]
                if len(p) > len(q):
                    p, q = q, p
                if not len(p) or 100 * len(p) < percent * len(q):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int(np.count_nonzero(q[at] == p))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("u").filter(keep),
                                              b.column("v").filter(keep)], names=["u", "v"])
    return run


def _every(shingle: int):
    """Each distinct shingle of each class text."""
    def run(batches):
        for b in batches:
            sets = list(shingle_sets(b.column("text"), shingle))
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(c).to_numpy(), sizes)) for c in ("cid", "root")]
                + [pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))],
                names=["cid", "root", "value"])
    return run


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, shingle: int,
           percent: int, estimate: bool = True) -> DataFrame:
    """Pairs (u, v) of classes that pass the union-sketch estimate and then the exact check."""
    both = pairs = materialise(pairs, "pairs")
    sk = classes.select("cid", "sketch")
    if estimate:
        both = (pairs.join(sk.toDF("u", "su"), "u").join(sk.toDF("v", "sv"), "v")
                .withColumn("best", F.slice(F.array_sort(F.array_union("su", "sv")), 1, k))
                .withColumn("shared", F.size(F.array_intersect(F.array_intersect("su", "sv"),
                                                               "best")))
                .where(F.col("shared") * 100 >= F.size("best") * SHARE).select("u", "v"))
    # u's text travels to v: v, the list's head, may be hot, but u's texts are moved once a
    # pair and AQE splits a hot v
    rows = (both.join(texts.toDF("u", "tu"), "u").join(texts.toDF("v", "tv"), "v")
            .select("u", "v", "tu", "tv"))
    return materialise(rows.mapInArrow(_exact(shingle, percent), "u long, v long"), "links")


def _texts(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, text) of the wanted classes."""
    wanted = materialise(wanted.select("cid").distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    return materialise(sets.select(F.col("rid").alias("cid"), F.col("row.text").alias("text"))
                       .join(wanted, "cid"), "texts")


def _leftover_pairs(left: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components whose whole sets may reach the similarity.

    A pair of sizes a <= b needs an overlap of need = t / (1 + t) * (a + b); with its first
    common shingle at positions p and q of the common order, it has at most
    1 + min(a - p, b - q). Hence p lies in the first a - 2t / (1 + t) * a + 1 places and q in
    the first b - t * b + 1.
    """
    n, t = F.col("n"), percent
    freq = (shingles.groupBy("value").agg(F.count("*").alias("freq"), F.min("root").alias("lo"),
                                          F.max("root").alias("hi"))
            .where("lo <> hi").select("value", "freq"))
    room = n - F.ceil(n * t / 100) + 1 - F.col("own")
    early = (shingles.join(freq, "value").groupBy("cid")
             .agg(F.array_sort(F.collect_list(F.struct("freq", "value"))).alias("vs"))
             .join(left, "cid")
             .withColumn("own", n - F.size("vs")).where(room > 0)
             .withColumn("vs", F.transform(F.slice("vs", F.lit(1), F.greatest(
                 room, F.lit(0)).cast("int")), lambda e: e["value"]))
             .select("cid", "n", "root", "own", "vs", F.posexplode("vs").alias("i", "value"))
             .select("cid", "n", "root", "value", (F.col("own") + F.col("i") + 1).alias("place"),
                     F.slice("vs", F.greatest(F.col("i") + 1 - SEEN, F.lit(1)),
                             F.least(F.col("i"), F.lit(SEEN))).alias("seen")))
    early = materialise(early, "early")
    # members of a list's largest component (of two as large: the one with the larger root)
    # never meet, so they are dealt over blocks, which the other members visit; these meet each
    # other in blocks of their own number
    by_root = early.groupBy("value", "root").agg(F.count("*").alias("c"))
    main = materialise(by_root.groupBy("value").agg(
        F.max(F.struct("c", "root")).alias("m"), F.sum("c").alias("members"),
        F.count("*").alias("roots")).where("roots > 1").select(
        "value", F.col("m.root").alias("main"), F.ceil(F.col("m.c") / BLOCK).alias("blocks"),
        F.ceil((F.col("members") - F.col("m.c")) / BLOCK).alias("others")), "main")
    placed = early.join(main, "value").withColumn("minor", F.col("root") != F.col("main"))

    def lane(name: str, blocks: str, everywhere: bool):
        own = F.array(F.pmod(F.xxhash64("cid"), F.col(blocks)))
        at = F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1) if everywhere else own
        return F.transform(at, lambda x: F.struct(F.lit(name).alias("lane"), x.alias("block")))

    def dealt(of_main, of_minor):
        lanes = F.when(F.col("minor"), F.flatten(F.array(*of_minor))).otherwise(of_main)
        return placed.withColumn("at", F.explode(lanes)).select(
            "value", "at.lane", "at.block", "cid", "n", "root", "place", "seen")
    longer = dealt(lane("a", "blocks", False),
                   [lane("b", "blocks", True), lane("c", "others", False)])
    small = dealt(lane("b", "blocks", False),
                  [lane("a", "blocks", True), lane("c", "others", True)])
    small = small.where(F.col("place") <= n - F.ceil(n * 2 * t / (100 + t)) + 1).select(
        "value", "lane", "block", *[F.col(c).alias(f"{c}2") for c in ("cid", "n", "root", "place", "seen")])
    need = F.col("n") + F.col("n2")
    at_most = 1 + F.least(n - F.col("place"), F.col("n2") - F.col("place2"))
    # a pair is made at its first common value; where one of the values seen just before is common
    # too, it has been made already
    return (longer.join(small, ["value", "lane", "block"])
            .where((F.col("root") != F.col("root2"))
                   # of two as large either may be the small one: one of both orders is enough
                   & ((F.col("n2") < n) | ((F.col("n2") == n) & (F.col("cid2") < F.col("cid"))))
                   & (F.col("n2") * 100 >= n * t) & (at_most * (100 + t) >= need * t)
                   & ~F.arrays_overlap("seen", "seen2"))
            .select(F.greatest("cid", "cid2").alias("u"), F.least("cid", "cid2").alias("v"))
            .distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                    k: int = K) -> DataFrame:
    """Each row of ``docs`` (as struct ``row``) with n_shingles, component_id (smallest doc_id
    of its group of linked texts), kept (doc_id = component_id) and keeper (exactly one row of
    each group).

    Null or empty text, or white space only: no shingles, a group of its own. Rows that repeat
    a text share its group. A null doc_id counts as larger than any other. An empty table gives
    no rows. Texts are read whole.
    """
    spark = prepare(docs.sparkSession)
    kind = docs.select(as_row(docs)).schema["row"].dataType
    sets = materialise(docs.select(as_row(docs)).mapInArrow(
        _signature(shingle, k), fields(("rid", L), ("n", L), ("h1", L), ("h2", L),
                                       ("sketch", T.ArrayType(L)), ("row", kind))), "sets")
    key = ["n", "h1", "h2"]
    first = F.min(F.struct(F.col("row.doc_id").isNull().alias("no_id"),
                           F.col("row.doc_id").alias("doc_id"), F.col("rid").alias("rid")))
    classes = materialise(
        sets.where("n > 0").groupBy(*key).agg(F.min("rid").alias("cid"), first.alias("first"),
                                              F.any_value("sketch").alias("sketch")), "classes")

    # inverted lists of retained values, rarest first. A text so short that any partner's
    # sketch is whole must share the full percentage of its own shingles
    entries = classes.select("cid", "n", F.explode("sketch").alias("value"))
    often = entries.groupBy("value").agg(F.count("*").alias("freq")).where("freq > 1")
    size = F.least("n", F.lit(k))
    need = F.ceil(size * F.when(F.col("n") * 100 <= k * percent, percent).otherwise(SHARE) / 100)
    listed = (entries.join(often, "value").groupBy("cid", "n")
              .agg(F.array_sort(F.collect_list(F.struct("freq", "value"))).alias("vs"),
                   F.sum("freq").alias("weight"))
              # values of one class only are the rarest of all and take their places first
              .withColumn("room", size - need + 1 - (size - F.size("vs")))
              .where("room > 0")
              .select("cid", "n", "weight",
                      F.explode(F.slice("vs", F.lit(1), F.col("room").cast("int"))).alias("e"))
              .select("cid", "n", "weight", F.col("e.value").alias("value")))
    listed = materialise(listed, "lists")

    def near(a, b):
        """Sizes that allow the similarity."""
        return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)

    heads = listed.groupBy("value").agg(F.max(F.struct("weight", "cid", "n")).alias("head"),
                                        F.count("*").alias("members")).where("members > 1")
    starred = listed.join(heads, "value").where(F.col("cid") != F.col("head.cid"))
    texts = _texts(sets, listed.join(heads, "value"))
    links = _links(starred.where(near(F.col("n"), F.col("head.n")))
                   .select(F.col("cid").alias("u"), F.col("head.cid").alias("v")).distinct(),
                   classes, texts, k, shingle, percent)
    comps = connected_components(links)

    # what the stars left: members of one list in different components
    rest = (starred.where("members > 2").select("value", "cid", "n")
            .join(comps.withColumnRenamed("node", "cid"), "cid", "left")
            .withColumn("root", F.coalesce("root", "cid")))
    several = (rest.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
               .where("lo <> hi").select("value"))
    left = materialise(rest.join(several, "value").select("cid", "n", "root").distinct(), "left")
    shingles = materialise(texts.join(left.drop("n"), "cid").mapInArrow(
        _every(shingle), "cid long, root long, value long"), "shingles")
    # these pairs passed exact bounds over whole sets, which say more than sketches
    more = _links(_leftover_pairs(left, shingles, percent), classes, texts, k, shingle, percent,
                  estimate=False)
    if not more.isEmpty():
        comps = connected_components(links.unionAll(more))

    grouped = (classes.select(*key, "cid", "first")
               .join(comps.withColumnRenamed("node", "cid"), "cid", "left")
               .withColumn("root", F.coalesce("root", "cid")))
    best = grouped.groupBy("root").agg(F.min("first").alias("best"))
    decided = grouped.join(best, "root").select(*key, "best")
    joined = sets.drop("sketch").join(decided, key, "left")
    alone = F.col("n") == 0
    cid = F.when(alone, F.col("row.doc_id")).otherwise(F.col("best.doc_id"))
    return joined.select("row", F.col("n").alias("n_shingles"), cid.alias("component_id"),
                         F.col("row.doc_id").eqNullSafe(cid).alias("kept"),
                         (alone | (F.col("best.rid") == F.col("rid"))).alias("keeper"))
