"""Connected components of an edge table, for any component shape."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

#: Up to this many edges (16 bytes each) one task finds the components; more take rounds of joins.
ONE_TASK_EDGES = 300_000


def _union_find(batches):
    """All edges of a bounded table -> (node, root)."""
    above: dict[int, int] = {}

    def root(x):
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = root(u), root(v)
            if a != c:
                above[max(a, c)] = min(a, c)
    nodes = np.array(list(above), np.int64)
    for i in range(0, len(nodes), 50_000):
        some = nodes[i:i + 50_000].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()),
                                          pa.array([root(x) for x in some], pa.int64())],
                                         names=["node", "root"])


def connected_components(edges: DataFrame, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """(u, v) edges of longs -> (node, root), root being the smallest node of its component.

    A small edge table is one task's work. A larger one takes large-star and small-star steps in
    turn until the edges stop changing, in about the logarithm of the longest path: each step is
    a min aggregate (combined map-side, so a hub is one row per task) and a join that AQE may
    split; each result is written to the shared folder. Null ends and loops are ignored; no edges
    give no rows. Both ways give the same rows.
    """
    e = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, before = materialise(e, "edges"), None
    if e.count() <= one_task_edges:
        return materialise(e.coalesce(1).mapInArrow(_union_find, "node long, root long"), "roots")
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        # large star: each larger neighbour of u hangs on the least around u
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v"))
        # small star: each node and its smaller neighbours hang on the least of those
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        e = materialise(small, "edges")
        state = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
