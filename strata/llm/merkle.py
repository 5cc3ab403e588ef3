"""Merkle manifest of a document table by nested intervals.

Leaves are ranked inside their source. Every node carries the interval of leaf ranks that it covers,
so no node needs a pointer: a node's parent is the one node of the next level, in the bucket
``lo div fan**(level + 1)``, whose interval contains its own (a containment join by level), and its
siblings are what remains of the parent's interval without its own (to the left those that end
before it begins, to the right those that begin after it ends).

The digests go up level by level in groups of ``fan`` nodes. Paths come down the same way: a node
hands all that stands above it to its at most ``fan`` children, so a source with a third of all
rows is no hot key anywhere: join keys are (source, bucket), of at most ``fan`` rows. The subroots
of all sources, ranked by source, are the leaves of a tree of the same kind.

Ranks come from a range sort and prefix sums over one small row per task and source. Everything
is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import col, materialise, prepare

#: What a leaf hashes, in this order (fixed).
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
_PATH = "array<struct<left:string,right:string>>"


def sha256(*parts) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a row's five fields: ``-`` for null, else UTF-8 byte count, ``:`` and value.
    ``text`` stands in for the row's own text."""
    def part(value):
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                          F.lit("-"))
    return sha256(*[part(text if c == "text" and text is not None else col(c)) for c in FIELDS])


def _ranked(rows: DataFrame, name: str, tree: str, *order: str) -> DataFrame:
    """``rows`` with their rank (from 0) among those of the same ``tree`` in ascending order, and
    the number ``n`` of these. Rows that agree in all of ``order`` are dealt by their place."""
    by = [tree, *order, "spread"]
    rows = materialise(
        rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*by)
        .sortWithinPartitions(*by).drop("spread")
        .withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted")
    rows = rows.withColumn("task", F.shiftright("at", 33))  # the upper bits are the task's number
    runs = materialise(rows.groupBy(tree, "task").agg(
        F.min("at").alias("first"), F.count("*").alias("some")), f"{name}-runs")
    whole = Window.partitionBy(tree)
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(tree, "task", "first", F.sum("some").over(whole).alias("n"),
                       F.coalesce(F.sum("some").over(before), F.lit(0)).alias("base"))
    return rows.join(runs, [tree, "task"]).withColumn(
        "rank", F.col("base") + F.col("at") - F.col("first")).drop("at", "task", "first", "base")


def _bucket(level: int, fan: int) -> Column:
    return F.expr(f"lo div {fan ** (level + 1)}L")


@dataclass
class Tree:
    """The levels of all trees of one kind, leaves first: rows (tree, n, lo, hi, digest), from
    level 1 on with their ``members``, the (lo, hi, digest) of their children."""
    levels: list[DataFrame]
    fan: int

    def roots(self) -> DataFrame:
        """(tree, digest) of the last node of every tree."""
        ends = [f.where(F.col("n") <= self.fan ** k).select("tree", "digest") if k == 0 else
                f.where((F.col("lo") == 0) & (F.col("hi") == F.col("n"))).select("tree", "digest")
                for k, f in enumerate(self.levels)]
        out = ends[0]
        for e in ends[1:]:
            out = out.unionByName(e)
        return out

    def descend(self, tops: DataFrame) -> DataFrame:
        """Leaves with all that stands above them. ``tops`` has a row per tree: ``above`` (the
        steps from the tree's root on) and columns that every leaf of the tree is given."""
        given = [c for c in tops.columns if c not in ("tree", "above")]
        parents = None
        for level in range(len(self.levels) - 1, -1, -1):
            nodes = self.levels[level]
            # a tree's root is its first node that covers all ranks
            last = (F.col("n") > self.fan ** (level - 1)) if level else F.lit(True)
            is_root = (F.col("n") <= self.fan ** level) & last
            out = nodes.where(is_root).join(tops, "tree")
            if parents is not None:
                out = out.unionByName(self._attach(nodes.where(~is_root), parents, level, given))
            parents = out
        return parents

    def _attach(self, nodes: DataFrame, parents: DataFrame, level: int,
                given: list[str]) -> DataFrame:
        """The containment join of a level with the next one."""
        up = parents.select("tree", _bucket(level, self.fan).alias("bucket"),
                            F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"),
                            F.col("members").alias("run"), "above", *given)
        held = (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
        both = nodes.withColumn("bucket", _bucket(level, self.fan)).join(
            up, ["tree", "bucket"]).where(held)

        def side(keep):
            return F.array_join(F.transform(F.filter("run", keep), lambda m: m["digest"]), "")
        step = F.struct(side(lambda m: m["hi"] <= F.col("lo")).alias("left"),
                        side(lambda m: m["lo"] >= F.col("hi")).alias("right"))
        return both.withColumn("above", F.concat(F.array(step).cast(_PATH), "above")).drop(
            "bucket", "up_lo", "up_hi", "run")


def grow(leaves: DataFrame, name: str, fan: int = FAN) -> Tree:
    """Trees over ``leaves`` (tree, n, rank, digest and more): every ``fan`` consecutive nodes
    (the last run may be shorter, even one) become the digest of their digests, while a tree has
    more than one node."""
    size = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1}).drop("rank")]
    while size > fan ** (len(levels) - 1):
        level = len(levels) - 1
        runs = (levels[-1].where(F.col("n") > fan ** level)
                .groupBy("tree", _bucket(level, fan).alias("bucket"))
                .agg(F.max("n").alias("n"),
                     F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("members")))
        levels.append(materialise(runs.select(
            "tree", "n", F.element_at("members", 1)["lo"].alias("lo"),
            F.element_at("members", -1)["hi"].alias("hi"), "members",
            F.sha2(F.array_join("members.digest", ""), 256).alias("digest")), f"{name}-{level + 1}"))
    return Tree(levels, fan)


def manifest(docs: DataFrame, claim: Column | None = None, fan: int = FAN) -> DataFrame:
    """doc_id, source, leaf, claim, subroot, root and path of every document.

    ``path`` holds, from the leaf up to the root over all sources, the digests to the ``left`` and
    to the ``right`` of the node in its run, concatenated. ``claim`` is a digest of the row as
    somebody else has it (null: the leaf itself), which ``fold`` can check against the root.

    Leaves of a source ascend by doc_id, null first; rows with the same doc_id by their digest,
    and rows that are the same in all stand side by side, each a leaf of its own. Sources ascend,
    null first, as UTF-8 bytes; an empty source is a source. Null fields hash as ``-``; columns
    besides the five are ignored. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    claim = F.lit(None).cast("string") if claim is None else claim
    # a key that is never null, in the order of the sources
    tree = F.coalesce(F.concat(F.lit("1"), col("source")), F.lit("0"))
    rows = materialise(docs.select(col("doc_id").alias("doc_id"), tree.alias("tree"),
                                   leaf_digest().alias("digest"), claim.alias("claim")), "leaves")
    trees = grow(materialise(_ranked(rows, "leaves", "tree", "doc_id", "digest"), "ranked"),
                 "nodes", fan)
    subroots = trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    top = grow(materialise(_ranked(subroots, "sources", "tree", "source"), "subroots"), "tops", fan)
    ends = top.descend(top.roots().select("tree", F.col("digest").alias("root"),
                                          F.array().cast(_PATH).alias("above")))
    tops = materialise(ends.select(F.col("source").alias("tree"), "above",
                                   F.col("digest").alias("subroot"), "root"), "paths")
    return trees.descend(tops).select(
        "doc_id", F.when(F.col("tree") != "0", F.expr("substring(tree, 2)")).alias("source"),
        F.col("digest").alias("leaf"), "claim", "subroot", "root", F.col("above").alias("path"))


def fold(digest: Column, path: str = "path") -> Column:
    """The root that a leaf's digest leads to along its path."""
    return F.aggregate(path, digest, lambda d, s: sha256(s["left"], d, s["right"]))


def siblings(path: str = "path") -> Column:
    """All digests of a path, level by level, left to right, concatenated."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
