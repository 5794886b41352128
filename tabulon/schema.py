"""Declared schemas, keys and helpers that look at schemas.

A declared schema is fixed: inferred once, reviewed by hand, then frozen.  Files
arrive as text; the declared types are what the master table stores.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (DataType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)


@dataclass(frozen=True)
class TableSpec:
    """A master table: declared schema plus its key.

    ``keys`` are case-insensitive column names (Spark's default resolution).
    ``buckets`` publishes the master as a table bucketed on the key, so each
    upsert reads it pre-partitioned and shuffles only the update set.
    ``null_keys`` is ``"fail"`` (the declared key is NOT NULL) or ``"insert"``
    (plain SQL MERGE semantics: a NULL key never matches, so it is inserted).
    """

    name: str
    schema: StructType
    keys: tuple[str, ...]
    null_keys: str = "fail"
    date_text_max: int = 10
    buckets: int | None = None
    options: dict = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return self.schema.names

    def fields_of(self, kind: type[DataType]) -> list[str]:
        return fields_by_type(self.schema, kind)


def fields_by_type(schema: StructType, kind: type[DataType] | DataType | str) -> list[str]:
    """Names of the fields of one type, in schema order (P5).

    ``kind`` may be a type class, an instance, or its simple string
    (``"date"``, ``"DateType()"``).
    """
    if isinstance(kind, str):
        wanted = kind.replace("()", "").lower().replace("type", "")
        return [f.name for f in schema.fields
                if f.dataType.simpleString() == wanted
                or type(f.dataType).__name__.lower().replace("type", "") == wanted]
    cls = kind if isinstance(kind, type) else type(kind)
    return [f.name for f in schema.fields if isinstance(f.dataType, cls)]


def schema_frame(spark: SparkSession, df_or_schema: DataFrame | StructType) -> DataFrame:
    """``df.schema`` as a DataFrame ``(position, name, type, nullable)``."""
    schema = df_or_schema.schema if isinstance(df_or_schema, DataFrame) else df_or_schema
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
                     for f in schema.fields)


def _s(name: str, kind: DataType, nullable: bool = True) -> StructField:
    return StructField(name, kind, nullable)


# --- fixed values: the grant-project master schema, in declared order -------------
# Column names, types and nullability must equal the declared master schema of
# the yearly project extracts so that files produced for it load unchanged.
PROJECTS_SCHEMA = StructType([
    _s("APPLICATION_ID", LongType(), False),
    _s("ACTIVITY", StringType()),
    _s("ADMINISTERING_IC", StringType()),
    _s("APPLICATION_TYPE", LongType()),
    _s("ARRA_FUNDED", DoubleType()),
    _s("AWARD_NOTICE_DATE", StringType()),
    _s("BUDGET_START", DateType()),
    _s("BUDGET_END", DateType()),
    _s("CFDA_CODE", DoubleType()),
    _s("CORE_PROJECT_NUM", StringType()),
    _s("ED_INST_TYPE", StringType()),
    _s("FOA_NUMBER", StringType()),
    _s("FULL_PROJECT_NUM", StringType()),
    _s("SUBPROJECT_ID", DoubleType()),
    _s("FUNDING_ICs", StringType()),
    _s("FY", StringType()),
    _s("IC_NAME", StringType()),
    _s("NIH_SPENDING_CATS", DoubleType()),
    _s("ORG_CITY", StringType()),
    _s("ORG_COUNTRY", StringType()),
    _s("ORG_DEPT", StringType()),
    _s("ORG_DISTRICT", DoubleType()),
    _s("ORG_DUNS", StringType()),
    _s("ORG_FIPS", StringType()),
    _s("ORG_NAME", StringType()),
    _s("ORG_STATE", StringType()),
    _s("ORG_ZIPCODE", StringType()),
    _s("PHR", DoubleType()),
    _s("PI_IDS", StringType()),
    _s("PI_NAMEs", StringType()),
    _s("PROGRAM_OFFICER_NAME", StringType()),
    _s("PROJECT_START", DateType()),
    _s("PROJECT_END", DateType()),
    _s("PROJECT_TERMS", StringType()),
    _s("PROJECT_TITLE", StringType()),
    _s("SERIAL_NUMBER", LongType()),
    _s("STUDY_SECTION", StringType()),
    _s("STUDY_SECTION_NAME", StringType()),
    _s("SUFFIX", StringType()),
    _s("SUPPORT_YEAR", StringType()),
    _s("TOTAL_COST", DoubleType()),
    _s("TOTAL_COST_SUB_PROJECT", DoubleType()),
])
PROJECTS = TableSpec("Projects", PROJECTS_SCHEMA, ("APPLICATION_ID",))
# ---------------------------------------------------------------------------------

# Declared schemas for extracts produced from the driver's test tables.
ORDERS_SCHEMA = StructType([
    _s("o_orderkey", LongType(), False),
    _s("o_custkey", LongType()),
    _s("o_orderstatus", StringType()),
    _s("o_totalprice", DoubleType()),
    _s("o_orderdate", DateType()),
    _s("o_orderpriority", StringType()),
])
ORDERS = TableSpec("orders_master", ORDERS_SCHEMA, ("o_orderkey",))

EVENTS_SCHEMA = StructType([
    _s("event_id", LongType()),
    _s("ts", TimestampNTZType()),
    _s("user_id", LongType(), False),
    _s("event_type", StringType()),
    _s("value", DoubleType()),
    _s("props", StringType()),
])
EVENTS_BY_USER = TableSpec("events_latest", EVENTS_SCHEMA, ("user_id",))

DOCUMENTS_SCHEMA = StructType([
    _s("doc_id", LongType(), False),
    _s("text", StringType()),
    _s("lang", StringType()),
    _s("source", StringType()),
    _s("n_chars", LongType()),
])
DOCUMENTS = TableSpec("documents", DOCUMENTS_SCHEMA, ("doc_id",))

LINEITEM_SCHEMA = StructType([
    _s("l_orderkey", LongType(), False),
    _s("l_partkey", LongType()),
    _s("l_suppkey", LongType()),
    _s("l_linenumber", IntegerType(), False),
    _s("l_quantity", DoubleType()),
    _s("l_extendedprice", DoubleType()),
    _s("l_discount", DoubleType()),
    _s("l_tax", DoubleType()),
    _s("l_returnflag", StringType()),
    _s("l_linestatus", StringType()),
    _s("l_shipdate", TimestampNTZType()),
])
LINEITEM = TableSpec("lineitem", LINEITEM_SCHEMA, ("l_orderkey", "l_linenumber"))
