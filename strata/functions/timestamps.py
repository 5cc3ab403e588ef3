"""Timestamp text -> TIMESTAMP.

The source writes ``created_at``/``updated_at``/``order_ts`` as UTC text without an
offset and ``_extracted_at`` as ISO-8601 with an offset; the session zone is
pinned to UTC (``strata.session``) so both read as the same instant. Malformed
text becomes NULL instead of failing the job (ANSI ``to_timestamp`` raises), and
``malformed_counts`` reports how many values were lost that way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import TIMESTAMP_TEXT_COLUMNS


def parse_timestamp(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c)


TS_ERRORS = "_ts_errors"


def normalize_timestamps(df: DataFrame, columns=TIMESTAMP_TEXT_COLUMNS,
                         wall_clock: bool = False, count_errors: bool = False) -> DataFrame:
    """Parse the listed timestamp columns that exist and are still text.

    ``wall_clock=True`` returns ``TIMESTAMP_NTZ`` holding the UTC wall-clock time
    (the instant read in the pinned UTC session zone) instead of ``TIMESTAMP``.
    ``count_errors=True`` adds ``_ts_errors``: per row, how many of those fields
    held text that did not parse (and became NULL).
    """
    def conv(c: str) -> Column:
        ts = parse_timestamp(c)
        return ts.cast("timestamp_ntz") if wall_clock else ts
    text = [c for c in columns
            if c in df.columns and df.schema[c].dataType.typeName() == "string"]
    todo = {c: conv(c) for c in text}
    if count_errors:
        bad = [(F.col(c).isNotNull() & parse_timestamp(c).isNull()).cast("int") for c in text]
        errors = bad[0] if bad else F.lit(0)
        for b in bad[1:]:
            errors = errors + b
        df = df.withColumn(TS_ERRORS, errors)
    return df.withColumns(todo) if todo else df


def malformed_counts(raw: DataFrame, columns=TIMESTAMP_TEXT_COLUMNS) -> DataFrame:
    """One row: for each present text column, values that are set but do not parse."""
    cols = [c for c in columns if c in raw.columns]
    return raw.agg(*[
        F.count_if(F.col(c).isNotNull() & parse_timestamp(c).isNull()).alias(c) for c in cols
    ])
