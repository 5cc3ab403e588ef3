"""JSON-lines change batches: write one batch, read an entity folder, query files in SQL.

Layout: ``<landing>/<table>/batch=<batch_id>/part-*.json.gz``. A batch id is unique
per extraction (two runs in the same second never overwrite each other), and
the reader always gets an explicit schema, so no inference pass over all files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# microseconds survive the round trip (the default NTZ format keeps milliseconds)
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


#: Landed lines are compressed: they repeat every field's name, and stay for as long as the landing
#: folder does. A compressed file is read by one task, so its rows are bounded.
WRITE_OPTIONS = {"compression": "gzip", "zlib.compress.level": "FIVE", "maxRecordsPerFile": "500000"}


def batch_path(landing: str, table: str, batch_id: str) -> str:
    return f"{landing.rstrip('/')}/{table}/batch={batch_id}"


def write_batch(df: DataFrame, landing: str, table: str, batch_id: str) -> str:
    """Write one extracted batch as JSON lines; fails if the batch id exists."""
    path = batch_path(landing, table, batch_id)
    df.write.mode("errorifexists").options(**JSON_OPTIONS, **WRITE_OPTIONS).json(path)
    return path


def read_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All JSON lines under an entity folder (every batch and file name; Spark leaves out names
    that begin with ``_`` or ``.``), with an explicit schema."""
    return (spark.read.schema(schema).options(**JSON_OPTIONS)
            .option("recursiveFileLookup", "true").json(path))


def direct_file_query(spark: SparkSession, path: str, select_sql: str, alias: str = "src",
                      schema: T.StructType | None = None) -> DataFrame:
    """SQL straight over files: ``SELECT ... FROM json.`path` AS src ...``.

    ``select_sql`` is the statement with ``{src}`` where the file relation goes. With a ``schema``
    the relation is declared with it, and the files are read once; without one Spark infers it
    first, which reads them all.
    """
    rel = f"json.`{path}`"
    if schema is not None:
        rel = f"strata_files_{uuid.uuid4().hex[:12]}"
        read_source(spark, path, schema).createOrReplaceTempView(rel)
    return spark.sql(select_sql.format(src=f"{rel} AS {alias}"))


# --- lines that don't fit the schema ---------------------------------------------------------

#: The whole line where it is no JSON object; the fields that the schema has no place for, as JSON;
#: why a row is not to be used (NULL: it is).
CORRUPT, RESCUED, REJECTED = "_corrupt_record", "_rescued", "_rejected"
MALFORMED, UNCASTABLE = "malformed line", "uncastable: "
FIELDS = T.MapType(T.StringType(), T.StringType())


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The column ``value`` of JSON lines as rows of ``schema``, with nothing lost silently.

    * a line that is no JSON object: all columns NULL, the line in ``_corrupt_record``;
    * a value that its column's type can't hold (text in a number): the column NULL, the field in
      ``_rescued``, its name in ``_rejected``;
    * a field that the schema lacks: the field in ``_rescued``; the row is good.

    ``_rescued`` is a JSON object of such fields with their values as text. Blank lines are no rows.
    Of a field given twice the last value counts; a NULL or absent field is NULL.

    A line that the schema's own parse found nothing wrong with, and whose fields are all the schema's,
    each given once, has nothing to rescue: only the other lines are parsed once more, field by field.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {**JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def text(name: str) -> str:
        return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def typed(name: str) -> str:
        return "r.`" + name.replace("`", "``") + "`"
    names = [f.name for f in schema.fields]
    lost = ", ".join(f"IF(fields[{text(f.name)}] IS NOT NULL AND {typed(f.name)} IS NULL, {text(f.name)}, NULL)"
                     for f in schema.fields if not isinstance(f.dataType, T.StringType))
    known = f"array({', '.join(map(text, names))})"
    parsed = lines.filter("trim(value) != ''").select(
        "value", F.from_json("value", whole, options).alias("r"),
        F.expr("json_object_keys(value)").alias("given"))
    # the intersection has each name once: a repeated or an unknown one makes it shorter
    checked = parsed.selectExpr("value", "r", f"coalesce(r.{CORRUPT} IS NULL AND size(given) = "
                                f"size(array_intersect(given, {known})), FALSE) AS clean")
    rest = checked.selectExpr("r", "clean", "IF(clean, NULL, value) AS value")
    found = rest.withColumn("fields", F.from_json("value", FIELDS)).selectExpr(
        "*", f"IF(clean, NULL, array_compact(CAST(array({lost}) AS ARRAY<STRING>))) AS bad").selectExpr(
        "*", f"IF(clean, NULL, map_filter(fields, (k, v) -> NOT array_contains({known}, k) "
             "OR array_contains(bad, k))) AS lost")
    return found.selectExpr(
        *[f"{typed(n)} AS `{n.replace('`', '``')}`" for n in names],
        f"IF(fields IS NULL, value, NULL) AS {CORRUPT}",
        f"IF(size(lost) > 0, to_json(lost), NULL) AS {RESCUED}",
        f"CASE WHEN clean THEN NULL WHEN fields IS NULL THEN '{MALFORMED}' WHEN size(bad) > 0 "
        f"THEN '{UNCASTABLE}' || array_join(bad, ',') END AS {REJECTED}")


def read_rescued(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All JSON lines under an entity folder by ``parse_lines``."""
    return parse_lines(spark.read.option("recursiveFileLookup", "true").text(path), schema)


def rescued_fields(rows: DataFrame, schema: T.StructType, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, field, issue, rows): how often each field was rescued, ``unknown`` to the schema or
    ``uncastable`` to its type."""
    fields = F.explode(F.map_keys(F.from_json(RESCUED, FIELDS)))
    issue: Column = F.when(F.col("field").isin([f.name for f in schema.fields]), "uncastable") \
        .otherwise("unknown")
    return (rows.filter(F.col(RESCUED).isNotNull()).select(*by, fields.alias("field"))
            .groupBy(*by, "field", issue.alias("issue")).agg(F.count(F.lit(1)).alias("rows")))
