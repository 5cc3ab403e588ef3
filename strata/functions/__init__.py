"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from strata.functions.casts import cast_boolean_columns
from strata.functions.dates import date_id
from strata.functions.money import money_sum
from strata.functions.timestamps import normalize_timestamps, parse_timestamp

__all__ = ["cast_boolean_columns", "date_id", "money_sum", "normalize_timestamps",
           "parse_timestamp"]
