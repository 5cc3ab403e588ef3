"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(c: Column | str) -> Column:
    """``yyyyMMdd`` as INT, by integer arithmetic (no per-row string formatting)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
