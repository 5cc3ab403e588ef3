"""Latest row per key.

``row_number() = 1`` over the key lets Spark plan a partial WindowGroupLimit
*before* the shuffle: every map task already keeps one row per key, so a key
that holds a third of all rows (a re-extracted hot entity) reaches the reducer
as one row per map task, not as a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.schemas import Entity


def latest_per_key(df: DataFrame, keys: Sequence[str],
                   order: Sequence[str] = ("updated_at", "_extracted_at")) -> DataFrame:
    """Keep one row per key: greatest ``order`` tuple, each column DESC NULLS LAST.

    All-NULL keys form one group (as GROUP BY / PARTITION BY treat NULL).
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def deduplicate(df: DataFrame, entity: Entity) -> DataFrame:
    order = [c for c in entity.order if c in df.columns]
    return latest_per_key(df, entity.keys, order)
