"""Type casts applied when conforming a layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_boolean_columns(df: DataFrame, columns: list[str] | tuple[str, ...] | None = None
                         ) -> DataFrame:
    """Cast the listed columns (default ``is_deleted``) to BOOLEAN when present.

    0/1 integers and 'true'/'false' text both cast; one projection for all.
    """
    columns = ["is_deleted"] if columns is None else list(columns)
    present = {c: F.col(c).cast("boolean") for c in columns if c in df.columns}
    return df.withColumns(present) if present else df
