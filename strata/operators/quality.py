"""Data-quality checks as fused Spark aggregations.

Every check returns a small result DataFrame in one long shape
``(table_name, check, column, n)`` (plus extras for freshness and profiles), so
results union, persist and compare like any other table; ``QualityReport``
turns them into a pass/fail gate. Each table is scanned once for all its
column-level counts (one ``agg`` with ``count_if`` per rule); only key
uniqueness needs its own keyed aggregation (partial aggregation before the
shuffle keeps a hot key to one row per map task).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import Constraint, Entity
from strata.session import scratch_path

RESULT_COLUMNS = ("table_name", "check", "column", "n")


def _long(table: str, agg_row: DataFrame, specs: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot a one-row aggregate ``agg_row`` into (table_name, check, column, n)."""
    stack = F.inline(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                 F.col(alias).cast("long").alias("n"))
        for alias, check, column in specs]))
    return agg_row.select(F.lit(table).alias("table_name"), stack)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, list(frames))


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``duplicate_keys``: keys (all-NULL keys form one group) seen more than once."""
    return (df.groupBy(*keys).count().filter(F.col("count") > 1)
              .agg(F.count(F.lit(1)).alias("duplicate_keys")))


def null_counts(table: str, df: DataFrame, columns: Sequence[str],
                with_rows: bool = False) -> DataFrame:
    """NULL count per column in one scan (+ optional row count)."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)]
    specs = [(f"_n{i}", "nulls", c) for i, c in enumerate(columns)]
    if with_rows:
        aggs.append(F.count(F.lit(1)).alias("_rows"))
        specs.append(("_rows", "rows", None))
    return _long(table, df.agg(*aggs), specs)


def pk_nulls(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Bronze gate: NULL primary keys per table (one scan per table)."""
    return _union(null_counts(name, df, keys) for name, (df, keys) in tables.items())


def key_checks(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicated keys, as (table_name, 'duplicate_keys', key, n)."""
    label = ",".join(keys)
    return duplicate_key_count(df, keys).select(
        F.lit(table).alias("table_name"), F.lit("duplicate_keys").alias("check"),
        F.lit(label).alias("column"), F.col("duplicate_keys").cast("long").alias("n"))


def duplicate_keys(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys seen more than once, as (table_name, key, n): all keys joined by commas, a NULL one
    as ``NULL``."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys]
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
              .select(F.lit(table).alias("table_name"), F.concat_ws(",", *parts).alias("key"), "n"))


def _keyed_checks(table: str, df: DataFrame, keys: Sequence[str], null_columns: Sequence[str],
                  flag: str | None = None) -> DataFrame:
    """Row, NULL, deleted and duplicate-key counts in one read of ``df``.

    One aggregation per key computes small counters (partial aggregation before the
    shuffle folds a hot key map-side); a second, global one sums them and counts the
    keys seen more than once. All-NULL keys form one group, as in GROUP BY.
    """
    per_key = [F.count(F.lit(1)).alias("_c")]
    per_key += [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(null_columns)]
    if flag:
        per_key.append(F.count_if(F.col(flag)).alias("_d"))
    g = df.groupBy(*keys).agg(*per_key)
    totals = [F.sum("_c").alias("_rows"), F.count_if(F.col("_c") > 1).alias("_dup")]
    totals += [F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(null_columns))]
    specs = [(f"_n{i}", "nulls", c) for i, c in enumerate(null_columns)]
    specs += [("_rows", "rows", None)]
    if flag:
        totals.append(F.sum("_d").alias("_deleted"))
        specs += [("_active", "active", None), ("_deleted", "deleted", None)]
    one = g.agg(*totals)
    # an empty table has no groups: sums are NULL, counts must read 0
    one = one.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in one.columns])
    if flag:
        one = one.withColumn("_active", F.col("_rows") - F.col("_deleted"))
    specs += [("_dup", "duplicate_keys", ",".join(keys))]
    return _long(table, one, specs)


def silver_quality(table: str, df: DataFrame, entity: Entity) -> DataFrame:
    """Silver checks: duplicate keys, NULLs per required column, rows, active, deleted.

    ``deleted`` counts rows whose flag is true; ``active`` is the rest (a NULL
    flag counts as active). One read of the table for all of them.
    """
    required = [c for c in entity.required if c in df.columns]
    return _keyed_checks(table, df, entity.keys, required, entity.delete_flag)


def gold_quality(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gold checks: duplicate keys, NULL keys, row count (one read)."""
    return _keyed_checks(table, df, keys, keys)


@dataclass(frozen=True)
class ForeignKey:
    fact_key: str
    dim_name: str
    dim_key: str
    rule_name: str | None = None

    @property
    def name(self) -> str:
        return self.rule_name or f"{self.fact_key}->{self.dim_name}.{self.dim_key}"


def fk_orphans(fact: DataFrame, dims: dict[str, DataFrame],
               rules: Sequence[ForeignKey]) -> DataFrame:
    """Fact rows per rule whose key has no dimension row (NULL keys count as orphans).

    The fact is read once and reduced to (rule, key, rows) with a partial aggregation before the
    shuffle: a hot key, or a third of all rows with a NULL one, is one row per map task. What moves
    is one row per key of each rule, never the fact; the keys are then anti-joined with all
    dimensions' keys at once, and the rows of those left are added up. Keys are compared as text,
    which is the same for equal numbers of any integer type.
    """
    def keyed(df: DataFrame, column: str, i: int) -> Column:
        c = F.col(column)
        if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            raise TypeError(f"{column}: keys are integers, texts, dates or timestamps")
        return F.struct(F.lit(i).alias("rule"), c.cast("string").alias("key"))
    held = fact.select(F.explode(F.array(*[
        keyed(fact, r.fact_key, i) for i, r in enumerate(rules)])).alias("k"))
    counts = held.groupBy("k.rule", "k.key").agg(F.count(F.lit(1)).alias("rows"))
    known = _union(dims[r.dim_name].select(keyed(dims[r.dim_name], r.dim_key, i).alias("k"))
                   .select("k.rule", "k.key") for i, r in enumerate(rules))
    lost = counts.join(known, ["rule", "key"], "left_anti").groupBy("rule").agg(
        F.sum("rows").alias("n"))
    # every rule has a row, also one without orphans
    one = lost.agg(*[F.coalesce(F.max(F.when(F.col("rule") == i, F.col("n"))), F.lit(0)).alias(f"_o{i}")
                     for i in range(len(rules))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule_name"), F.col(f"_o{i}").alias("orphans"))
        for i, r in enumerate(rules)])))


def metric_sanity(fact: DataFrame,
                  columns: Sequence[str] = ("quantity", "unit_price", "line_total")) -> DataFrame:
    """Rows where any listed metric is negative (gross margin may legitimately be)."""
    bad = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])
    return fact.agg(F.count_if(bad).alias("negative_rows"))


def constraint_violations(table: str, df: DataFrame, entity: Entity,
                          unique: Sequence[str] = ()) -> DataFrame:
    """Source constraints re-checked on data: NOT NULL, CHECK rules, UNIQUE columns.

    A CHECK rule fails only when it is false (NULL passes, as in SQL DDL).
    """
    rules: list[Constraint] = [c for c in entity.constraints if c.column in df.columns]
    required = [c for c in entity.required if c in df.columns]
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(required)]
    aggs += [F.count_if(~F.expr(r.expr)).alias(f"_ck{i}") for i, r in enumerate(rules)]
    specs = [(f"_nn{i}", "not_null", c) for i, c in enumerate(required)]
    specs += [(f"_ck{i}", r.name, r.column) for i, r in enumerate(rules)]
    out = _long(table, df.agg(*aggs), specs)
    for c in unique:
        dup = (df.filter(F.col(c).isNotNull()).groupBy(c).count()
               .filter(F.col("count") > 1).agg(F.sum("count").alias("n")))
        out = out.unionByName(dup.select(
            F.lit(table).alias("table_name"), F.lit("unique").alias("check"),
            F.lit(c).alias("column"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))
    return out


def freshness(tables: dict[str, DataFrame], as_of: str, max_age_hours: float,
              column: str = "updated_at") -> DataFrame:
    """Latest ``column`` per table against an as-of time; fresh when within the age."""
    as_of_ts = F.lit(as_of).cast("timestamp_ntz")
    out = []
    for name, df in tables.items():
        latest = df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("latest"))
        lag = (F.unix_micros(as_of_ts.cast("timestamp")) -
               F.unix_micros(F.col("latest").cast("timestamp"))) / F.lit(3.6e9)
        out.append(latest.select(F.lit(name).alias("table_name"), "latest",
                                 as_of_ts.alias("as_of"), lag.alias("lag_hours"),
                                 F.coalesce(lag <= F.lit(max_age_hours), F.lit(False))
                                 .alias("is_fresh")))
    return _union(out)


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, NULLs, exact distinct values, min and max (as text).

    The frame is written once to the shared scratch folder, so whatever makes it runs once. Then
    every column is read by itself and reduced by a typed ``groupBy(column)``: distinct values are
    its groups, NULLs the rows of the NULL group, min and max those of the groups, in the
    column's own ordering. A partial aggregation before each shuffle leaves one row per value
    and task, and nothing is cast to text but the two results.
    """
    columns = list(columns or df.columns)
    path = scratch_path(df.sparkSession, "profile")
    df.select(*columns).write.parquet(path)
    written = df.sparkSession.read.schema(df.select(*columns).schema).parquet(path)
    out = []
    for c in columns:
        kind = df.schema[c].dataType
        # -0.0 folds into 0.0, as GROUP BY has it
        value = F.col(c) + F.lit(0.0) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(c)
        groups = written.select(value.cast(kind).alias("v")).groupBy("v").agg(
            F.count(F.lit(1)).alias("n"))
        out.append(groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("distinct_values"), F.min("v").cast("string").alias("min_value"),
            F.max("v").cast("string").alias("max_value")).select(
            F.lit(c).alias("column_name"), F.lit(kind.simpleString()).alias("data_type"),
            "rows", "nulls", "distinct_values", "min_value", "max_value"))
    return _union(out)


@dataclass
class QualityReport:
    """Collects failed checks; ``gate`` raises once, after everything was checked."""

    failures: list[str] = field(default_factory=list)
    # informational counts (not gating), e.g. malformed timestamp text per table
    info: dict[str, int] = field(default_factory=dict)

    def require_zero(self, label: str, n: int | None) -> bool:
        if n:
            self.failures.append(f"{label}: {n}")
        return not n

    def add_results(self, results: DataFrame,
                    zero_checks: Sequence[str] = ("nulls", "duplicate_keys")) -> bool:
        """Collect a (small) long-format result; listed checks must be zero."""
        ok = True
        for r in results.filter(F.col("check").isin(*zero_checks)).collect():
            ok &= self.require_zero(f"{r['table_name']}.{r['column']} {r['check']}", r["n"])
        return ok

    def gate(self) -> None:
        if self.failures:
            raise RuntimeError("quality checks failed:\n" + "\n".join(self.failures))


def schema_drift(spark, actual: T.StructType, expected: T.StructType,
                 table: str = "") -> DataFrame:
    """Columns missing, unexpected or retyped against the registry schema.

    Metadata only (no data is read): one row per difference, empty when the
    schemas agree. Nullability is not compared (Parquet does not enforce it).
    """
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(table, c, want[c], None, "missing") for c in want if c not in have]
    rows += [(table, c, None, have[c], "unexpected") for c in have if c not in want]
    rows += [(table, c, want[c], have[c], "type_changed") for c in want
             if c in have and have[c] != want[c]]
    return spark.createDataFrame(rows, "table_name string, column string, expected string, "
                                       "actual string, issue string")
