"""Exact money arithmetic.

Money is DOUBLE in the tables. A plain double SUM depends on the order rows
arrive in, so the same query gives different last digits on different runs and
engines. Each amount is taken as the decimal number that its double stands for, to
8 places, and summed as DECIMAL: exact and order-independent, sub-cent amounts included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Type of one amount; a sum of them holds ten digits more before the point.
AMOUNT = "decimal(28,8)"


def amount(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(AMOUNT)


def money_sum(c: Column | str) -> Column:
    """SUM of a DOUBLE, exact; NULLs skipped, all-NULL -> NULL."""
    return F.sum(amount(c)).cast("double")


def money_sum_sql(c: str) -> str:
    """The same as SQL text."""
    return f"CAST(SUM(CAST({c} AS {AMOUNT})) AS DOUBLE)"
