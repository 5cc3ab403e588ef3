"""Entity registry: schema, key, version, delete flag and checked columns.

Two families share the same column names, so every operator works on both:

* ``SOURCE_ENTITIES`` — the order-management source as it arrives in JSON
  change batches (string ids, timestamps as text, ``is_deleted`` as 0/1).
* ``FIXTURE_ENTITIES`` — the same four entities derived from the TPC-H style
  tables (bigint ids, ``TIMESTAMP_NTZ``); see ``strata.sources.fixtures``.

Names of the layers' namespaces also live here (never hard-coded in SQL).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LINEAGE_EXTRACTED_AT = "_extracted_at"
LINEAGE_SOURCE_TABLE = "_source_table"

# Fixed values of the source system (must match it for right results):
# allowed customer segments, allowed order statuses, the epoch used when no
# high-water mark exists yet, and the columns that carry timestamp text in the JSON batches.
SEGMENTS = ("retail", "wholesale", "online")
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled")
EPOCH = "1970-01-01T00:00:00"
TIMESTAMP_TEXT_COLUMNS = ("_extracted_at", "created_at", "updated_at", "order_ts")

# References of the fact (fixed): its column, the dimension, the dimension's key, the rule's name.
FK_RULES = (
    ("customer_id", "dim_customer", "customer_id", "customer_fk"),
    ("product_id", "dim_product", "product_id", "product_fk"),
    ("date_id", "dim_date", "date_id", "date_fk"),
)

# Default calendar of the date dimension (inclusive).
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"


@dataclass(frozen=True)
class Namespaces:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"


@dataclass(frozen=True)
class Constraint:
    """A row rule; ``expr`` is a SQL boolean that must hold (NULL = not checked)."""

    name: str
    column: str
    expr: str


@dataclass(frozen=True)
class Entity:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    version: str = "updated_at"
    delete_flag: str = "is_deleted"
    # Total order for "latest row": version, extraction time, then columns that
    # make ties deterministic. All descending, NULLs last.
    order: tuple[str, ...] = ("updated_at", LINEAGE_EXTRACTED_AT)
    # Columns that must never be NULL in the conformed (silver) layer.
    required: tuple[str, ...] = ()
    constraints: tuple[Constraint, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _s(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


_STR, _DBL, _LONG, _BOOL = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
_TS, _NTZ, _INT = T.TimestampType(), T.TimestampNTZType(), T.IntegerType()


def _in(col: str, values) -> str:
    return f"{col} IN ({', '.join(repr(v) for v in values)})"


def _source_constraints(entity: str) -> tuple[Constraint, ...]:
    rules = {
        "customers": [Constraint("segment_domain", "segment", _in("segment", SEGMENTS))],
        "products": [
            Constraint("unit_price_positive", "unit_price", "unit_price > 0"),
            Constraint("cost_price_positive", "cost_price", "cost_price > 0"),
        ],
        "orders": [
            Constraint("status_domain", "order_status", _in("order_status", ORDER_STATUSES)),
            Constraint("total_non_negative", "total_amount", "total_amount >= 0"),
        ],
        "order_items": [
            Constraint("quantity_positive", "quantity", "quantity > 0"),
            Constraint("unit_price_positive", "unit_price", "unit_price > 0"),
            Constraint("line_total_positive", "line_total", "line_total > 0"),
        ],
    }
    return tuple(rules[entity])


def _with_lineage(fields: list[T.StructField], ts: T.DataType) -> T.StructType:
    return T.StructType(fields + [_s(LINEAGE_EXTRACTED_AT, ts), _s(LINEAGE_SOURCE_TABLE, _STR)])


# --- JSON change batches as they land (timestamps still text) -------------------------
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _with_lineage(
        [_s(c, _STR) for c in ("customer_id", "first_name", "last_name", "email", "city",
                               "country", "segment", "created_at", "updated_at")]
        + [_s("is_deleted", _LONG)], _STR),
    "products": _with_lineage(
        [_s(c, _STR) for c in ("product_id", "name", "category", "subcategory")]
        + [_s("unit_price", _DBL), _s("cost_price", _DBL), _s("created_at", _STR),
           _s("updated_at", _STR), _s("is_deleted", _LONG)], _STR),
    "orders": _with_lineage(
        [_s(c, _STR) for c in ("order_id", "customer_id", "order_status", "order_ts")]
        + [_s("total_amount", _DBL), _s("shipping_city", _STR), _s("created_at", _STR),
           _s("updated_at", _STR), _s("is_deleted", _LONG)], _STR),
    "order_items": _with_lineage(
        [_s(c, _STR) for c in ("order_item_id", "order_id", "product_id")]
        + [_s("quantity", _LONG), _s("unit_price", _DBL), _s("line_total", _DBL),
           _s("created_at", _STR), _s("updated_at", _STR), _s("is_deleted", _LONG)], _STR),
}


def conformed_schema(raw: T.StructType) -> T.StructType:
    """Raw JSON schema -> typed schema: timestamp text to TIMESTAMP, flag to BOOLEAN."""
    out = []
    for f in raw.fields:
        if f.name in TIMESTAMP_TEXT_COLUMNS:
            out.append(_s(f.name, _TS))
        elif f.name == "is_deleted":
            out.append(_s(f.name, _BOOL))
        else:
            out.append(f)
    return T.StructType(out)


SOURCE_ENTITIES: dict[str, Entity] = {
    "customers": Entity("customers", conformed_schema(RAW_SCHEMAS["customers"]), ("customer_id",),
                        required=("customer_id", "email", "created_at"),
                        constraints=_source_constraints("customers")),
    "products": Entity("products", conformed_schema(RAW_SCHEMAS["products"]), ("product_id",),
                       # subcategory is nullable at the source, so it is not required
                       required=("product_id", "name", "cost_price", "unit_price", "category",
                                 "created_at"),
                       constraints=_source_constraints("products")),
    "orders": Entity("orders", conformed_schema(RAW_SCHEMAS["orders"]), ("order_id",),
                     required=("order_id", "customer_id", "order_ts", "order_status", "created_at"),
                     constraints=_source_constraints("orders")),
    "order_items": Entity("order_items", conformed_schema(RAW_SCHEMAS["order_items"]),
                          ("order_item_id",),
                          required=("order_item_id", "order_id", "product_id", "quantity",
                                    "unit_price"),
                          constraints=_source_constraints("order_items")),
}

# --- the same entities derived from the TPC-H style fixture tables ----------------------
FIXTURE_ENTITIES: dict[str, Entity] = {
    "customers": Entity(
        "customers",
        _with_lineage([_s("customer_id", _LONG), _s("first_name", _STR), _s("last_name", _STR),
                       _s("email", _STR), _s("city", _STR), _s("country", _STR),
                       _s("segment", _STR), _s("created_at", _NTZ), _s("updated_at", _NTZ),
                       _s("is_deleted", _BOOL)], _NTZ),
        ("customer_id",),
        required=("customer_id", "email", "created_at"),
        constraints=(Constraint("segment_domain", "segment",
                                _in("segment", ("AUTOMOBILE", "BUILDING", "FURNITURE",
                                                "HOUSEHOLD", "MACHINERY"))),),
    ),
    "products": Entity(
        "products",
        _with_lineage([_s("product_id", _LONG), _s("name", _STR), _s("category", _STR),
                       _s("subcategory", _STR), _s("unit_price", _DBL), _s("cost_price", _DBL),
                       _s("created_at", _NTZ), _s("updated_at", _NTZ), _s("is_deleted", _BOOL)],
                      _NTZ),
        ("product_id",),
        required=("product_id", "name", "cost_price", "unit_price", "category", "created_at"),
        constraints=_source_constraints("products"),
    ),
    "orders": Entity(
        "orders",
        _with_lineage([_s("order_id", _LONG), _s("customer_id", _LONG), _s("order_status", _STR),
                       _s("order_ts", _NTZ), _s("total_amount", _DBL), _s("shipping_city", _STR),
                       _s("created_at", _NTZ), _s("updated_at", _NTZ), _s("is_deleted", _BOOL)],
                      _NTZ),
        ("order_id",),
        required=("order_id", "customer_id", "order_ts", "order_status", "created_at"),
        constraints=_source_constraints("orders"),
    ),
    "order_items": Entity(
        "order_items",
        _with_lineage([_s("order_id", _LONG), _s("line_number", _INT), _s("product_id", _LONG),
                       _s("supplier_id", _LONG), _s("quantity", _LONG), _s("unit_price", _DBL),
                       _s("line_total", _DBL), _s("created_at", _NTZ), _s("updated_at", _NTZ),
                       _s("is_deleted", _BOOL)], _NTZ),
        ("order_id", "line_number"),
        # (key, ship date, part) is unique in the fixture; supplier closes any gap
        order=("updated_at", LINEAGE_EXTRACTED_AT, "product_id", "supplier_id"),
        required=("order_id", "line_number", "product_id", "quantity", "unit_price"),
        constraints=_source_constraints("order_items"),
    ),
}


def landed_schema(schema: T.StructType) -> T.StructType:
    """A typed schema as its rows land in JSON: timestamps as text, the delete flag as 0/1."""
    as_json = {T.TimestampNTZType: _STR, T.TimestampType: _STR, T.BooleanType: _LONG}
    return T.StructType([_s(f.name, as_json.get(type(f.dataType), f.dataType)) for f in schema.fields])


FIXTURE_RAW = {n: landed_schema(e.schema) for n, e in FIXTURE_ENTITIES.items()}
