"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query takes ``(spark, sf_dir)``, reads the whole tables below ``sf_dir``
(directly or through extracts Spark writes from them) and returns a DataFrame.
``ORACLE_SQL`` holds the independent SQL for the same answer; queries whose
answer is physical (file layout, reader quirks) have none.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.functions import (lenient_date, lenient_date_udf, single_format_date, strict_date,
                               strict_single_format_date)
from tabulon.functions.casts import is_reject, lenient_double, lenient_long, ntz_text
from tabulon.operators import profile, quality, sketches
from tabulon.operators.conform import conform, extra_columns
from tabulon.operators.merge import cardinality_violations, upsert
from tabulon.plans import fixtures
from tabulon.plans.ingest import ingest, pending_files, prepare, resume
from tabulon.schema import (DOCUMENTS_SCHEMA, EVENTS_BY_USER, LINEITEM_SCHEMA, ORDERS,
                            ORDERS_SCHEMA, PROJECTS, schema_frame)
from tabulon.session import scratch_path, stage
from tabulon.sinks.partitioned import PartitionedTable
from tabulon.sinks.tables import TableStore
from tabulon.sources.archives import expand_archives, nth_lines
from tabulon.sources.csv import (BLOCK, CSV_WRITE_OPTIONS, ROW, SEQ, SOURCE, header_groups,
                                 read_csv_inferred, read_csv_sources, read_csv_text, row_positions,
                                 scan_files)
from tabulon.sources.files import file_inventory, with_row_identity
from tabulon.sources.literals import literal_frame
from tabulon.sources.split_csv import read_csv_split

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

LI_KEYS = ["l_orderkey", "l_linenumber"]
# Row precedence for lineitem duplicates; unique within a key at every scale.
LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Extracts are written once per session and input folder, then shared.
_FIXTURES: dict[tuple, str] = {}


def _fixture(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _FIXTURES:
        root = scratch_path(spark, kind)
        build(root)
        _FIXTURES[key] = root
    return _FIXTURES[key]


def yearly_orders(spark: SparkSession, sf_dir: str) -> str:
    return _fixture(spark, sf_dir, "yearly-orders",
                    lambda root: fixtures.write_yearly_orders(table(spark, sf_dir, "orders"), root))


def daily_events(spark: SparkSession, sf_dir: str) -> str:
    return _fixture(spark, sf_dir, "daily-events",
                    lambda root: fixtures.write_daily_events(table(spark, sf_dir, "events"), root))


def order_archives(spark: SparkSession, sf_dir: str) -> str:
    csv_root = yearly_orders(spark, sf_dir)
    return _fixture(spark, sf_dir, "order-archives",
                    lambda root: fixtures.write_order_archives(spark, csv_root, root))


def _orders_sql_date() -> str:
    return "CAST(o_orderdate AS DATE)"


ORDERS_AS_DECLARED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_orders_sql_date()} AS o_orderdate,
       o_orderpriority
FROM orders"""

# --- S1, S2, S4, P1-P3, W1, A1 --------------------------------------------------------


@register("csv_quoted_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_quoted_roundtrip(spark, sf_dir):
    root = _fixture(spark, sf_dir, "documents-csv",
                    lambda r: fixtures.write_documents(table(spark, sf_dir, "documents"), r))
    return conform(read_csv_text(spark, root), DOCUMENTS_SCHEMA)


def one_file_csv(spark: SparkSession, sf_dir: str) -> str:
    """``documents`` as one multi-line CSV file, or one for each ``fixtures.PART_BYTES`` of text."""
    def build(root):
        docs = table(spark, sf_dir, "documents")
        fixtures.in_large_parts(docs).write.options(**CSV_WRITE_OPTIONS).csv(root)
    return _fixture(spark, sf_dir, "documents-one-csv", build)


@register("csv_split_multiline", "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def csv_split_multiline(spark, sf_dir):
    """S1 at scale: large files of multi-line records, each read in as many tasks as it has splits."""
    root = one_file_csv(spark, sf_dir)
    raw = read_csv_split(spark, scan_files(file_inventory(spark, root), root))
    return conform(raw, DOCUMENTS_SCHEMA)


@register("csv_pages_roundtrip", "SELECT page_id, url, html FROM pages")
def csv_pages_roundtrip(spark, sf_dir):
    root = _fixture(spark, sf_dir, "pages-csv",
                    lambda r: fixtures.write_documents(table(spark, sf_dir, "pages"), r))
    text = read_csv_text(spark, root)
    return text.select(lenient_long("page_id").alias("page_id"), "url", "html")


@register("csv_yearly_conform", ORDERS_AS_DECLARED)
def csv_yearly_conform(spark, sf_dir):
    return prepare(spark, yearly_orders(spark, sf_dir), ORDERS).rows


@register("csv_extra_columns", """
SELECT DISTINCT 'FY=' || CAST(year(o_orderdate) AS VARCHAR) AS source, 'o_extra' AS extra_column
FROM orders WHERE year(o_orderdate) % 3 = 2""")
def csv_extra_columns(spark, sf_dir):
    root = yearly_orders(spark, sf_dir)
    headers, _ = header_groups(file_inventory(spark, root))
    return extra_columns(headers, ORDERS_SCHEMA).select("source", "extra_column").distinct()


@register("csv_inferred_types", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""")
def csv_inferred_types(spark, sf_dir):
    def build(root):
        orders = table(spark, sf_dir, "orders").withColumn(
            "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
        orders.write.options(**CSV_WRITE_OPTIONS).csv(root)
    root = _fixture(spark, sf_dir, "orders-flat-csv", build)
    return read_csv_inferred(spark, root)


@register("csv_inferred_drift", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
       CASE year(o_orderdate) % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                                  WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                                  ELSE strftime(o_orderdate, '%m/%d/%Y') END AS o_orderdate,
       o_orderpriority, CASE WHEN year(o_orderdate) % 3 = 2 THEN 'x' || CAST(o_orderkey AS VARCHAR) END AS o_extra,
       'bigint,bigint,string,double,string,string,string' AS types
FROM orders""")
def csv_inferred_drift(spark, sf_dir):
    """S2 over files whose headers differ in order, case and width, and whose dates have three formats."""
    df = read_csv_inferred(spark, yearly_orders(spark, sf_dir))
    names = [*fixtures.ORDER_COLUMNS, "o_extra"]
    kinds = {c.lower(): kind for c, kind in df.dtypes}
    return df.select(*[F.col(c).alias(c) for c in names], F.lit(",".join(kinds[c] for c in names)).alias("types"))


@register("row_order_in_file", """
SELECT 'FY=' || CAST(year(o_orderdate) AS VARCHAR) AS source, o_orderkey,
       row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS row_pos
FROM orders""")
def row_order_in_file(spark, sf_dir):
    root = yearly_orders(spark, sf_dir)
    raw = read_csv_sources(spark, scan_files(file_inventory(spark, root), root))
    keyed = raw.select(SOURCE, SEQ, BLOCK, ROW, lenient_long("o_orderkey").alias("o_orderkey"))
    return row_positions(stage(keyed, "keyed-rows")).select(F.col(SOURCE).alias("source"), "o_orderkey", "row_pos")


@register("file_row_counts", """
SELECT 'FY=' || CAST(y AS VARCHAR) AS source, count(*) AS n_rows,
       CAST(CASE WHEN y % 3 = 2 THEN 7 ELSE 6 END AS BIGINT) AS n_columns
FROM (SELECT year(o_orderdate) AS y FROM orders) GROUP BY y""")
def file_row_counts(spark, sf_dir):
    root = yearly_orders(spark, sf_dir)
    files_set = scan_files(file_inventory(spark, root), root)
    counts = profile.rows_per_group(read_csv_sources(spark, files_set), SOURCE)
    widths = files_set.headers(spark).groupBy(F.col("source").alias(SOURCE)).agg(
        F.max(F.size("header")).cast("bigint").alias("n_columns"))
    return counts.join(widths, SOURCE).select(F.col(SOURCE).alias("source"), "n_rows", "n_columns")


# --- S3, S5, S6, Q4 -------------------------------------------------------------------

@register("archive_expand", """
SELECT 'FY=' || CAST(y AS VARCHAR) AS source,
       CASE y % 4 WHEN 1 THEN 'skipped' WHEN 2 THEN 'rejected' ELSE 'extracted' END AS status,
       CAST(CASE WHEN y % 4 IN (1, 2) THEN 0 ELSE count(*) END AS BIGINT) AS extracted_rows
FROM (SELECT year(o_orderdate) AS y FROM orders) GROUP BY y
UNION ALL SELECT 'broken', 'corrupt', 0""")
def archive_expand(spark, sf_dir):
    zips = order_archives(spark, sf_dir)
    out = scratch_path(spark, "unzipped")
    report = expand_archives(spark, zips, out)
    per_source = report.groupBy("source", "status").agg(F.count(F.lit(1)).alias("n_archives"))
    if report.where(F.col("status") == "extracted").isEmpty():
        return per_source.select("source", "status", F.lit(0).cast("bigint").alias("extracted_rows"))
    rows = (read_csv_text(spark, out, recursiveFileLookup="true")
            .select(F.regexp_extract("_metadata.file_path", r"/(FY=\d+)/", 1).alias("source"))
            .groupBy("source").agg(F.count(F.lit(1)).alias("extracted_rows")))
    return (per_source.join(rows, "source", "left")
            .select("source", "status",
                    F.coalesce("extracted_rows", F.lit(0)).cast("bigint").alias("extracted_rows")))


_HEADERS = {layout: ",".join(fixtures.yearly_layout(layout)) for layout in (0, 1, 2)}


@register("archive_nth_line", f"""
SELECT DISTINCT 'FY=' || CAST(y AS VARCHAR) AS source,
       CASE y % 3 WHEN 0 THEN '{_HEADERS[0]}' WHEN 1 THEN '{_HEADERS[1]}' ELSE '{_HEADERS[2]}' END AS line
FROM (SELECT year(o_orderdate) AS y FROM orders) WHERE y % 4 NOT IN (1, 2)""")
def archive_nth_line(spark, sf_dir):
    lines = nth_lines(spark, order_archives(spark, sf_dir), n=0)
    return lines.where(F.col("status") == "extracted").select("source", "line").distinct()


@register("archive_first_row", """
SELECT 'FY=' || CAST(y AS VARCHAR) AS source, first_key FROM (
  SELECT year(o_orderdate) AS y, min(o_orderkey) AS first_key FROM orders GROUP BY year(o_orderdate))
WHERE y % 4 NOT IN (1, 2)""")
def archive_first_row(spark, sf_dir):
    """S6 with n > 0: line 1 of every archive, its key found by the archive's own header (line 0)."""
    zips = order_archives(spark, sf_dir)
    head = nth_lines(spark, zips, n=0).where("line is not null").select("archive", F.split("line", ",").alias("names"))
    rows = nth_lines(spark, zips, n=1).where("line is not null").select("archive", "source", "line")
    key = F.get(F.split("line", ","), (F.array_position("names", "o_orderkey") - 1).cast("int"))
    return (rows.join(head, "archive").select("source", lenient_long(key).alias("key"))
            .groupBy("source").agg(F.min("key").alias("first_key")))


# --- P2, F1-F7, U1, A7, Q2 -------------------------------------------------------------

@register("cast_lenient", """
SELECT o_orderkey,
       CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) || '.0'
                           WHEN 1 THEN CAST(o_orderkey AS VARCHAR) || '.5'
                           WHEN 2 THEN 'x' || CAST(o_orderkey AS VARCHAR)
                           WHEN 3 THEN lpad(CAST(o_orderkey AS VARCHAR), 9, '0')
                           ELSE CAST(o_orderkey AS VARCHAR) END AS key_text,
       CASE WHEN o_orderkey % 5 IN (1, 2) THEN NULL ELSE o_orderkey END AS key_value,
       CASE WHEN o_orderkey % 4 IN (0, 1) THEN NULL ELSE o_totalprice END AS price_value,
       o_orderkey % 5 IN (1, 2) AS key_rejected,
       o_orderkey % 4 IN (0, 1) AS price_rejected
FROM orders""")
def cast_lenient(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ks = k.cast("string")
    key_text = (F.when(k % 5 == 0, F.concat(ks, F.lit(".0")))
                 .when(k % 5 == 1, F.concat(ks, F.lit(".5")))
                 .when(k % 5 == 2, F.concat(F.lit("x"), ks))
                 .when(k % 5 == 3, F.lpad(ks, 9, "0"))
                 .otherwise(ks))
    price_text = (F.when(k % 4 == 0, F.lit("NaN")).when(k % 4 == 1, F.lit("n/a"))
                   .otherwise(F.col("o_totalprice").cast("string")))
    text = o.select("o_orderkey", key_text.alias("key_text"), price_text.alias("price_text"))
    return text.select(
        "o_orderkey", "key_text",
        lenient_long("key_text").alias("key_value"),
        lenient_double("price_text").alias("price_value"),
        is_reject("key_text", lenient_long("key_text")).alias("key_rejected"),
        is_reject("price_text", lenient_double("price_text")).alias("price_rejected"))


def _mixed_date_text() -> F.Column:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 8
    return (F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
             .when(k == 1, F.date_format(d, "yyyy-M-d"))
             .when(k == 2, F.date_format(d, "MM/dd/yyyy"))
             .when(k == 3, F.date_format(d, "M/d/yyyy"))
             .when(k == 4, F.concat(F.lit("3012-"), F.date_format(d, "MM-dd")))
             .when(k == 5, F.concat(F.lit("13/"), F.date_format(d, "dd/yyyy")))
             .when(k == 6, F.date_format(d, "yyyyMMdd")))


MIXED_DATE_SQL = """
SELECT o_orderkey, date_text, CAST(length(date_text) AS BIGINT) AS text_length,
       CASE WHEN o_orderkey % 8 < 4 THEN CAST(o_orderdate AS DATE) END AS parsed
FROM (SELECT o_orderkey, o_orderdate,
             CASE o_orderkey % 8 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                                 WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d')
                                 WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
                                 WHEN 3 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                                 WHEN 4 THEN '3012-' || strftime(o_orderdate, '%m-%d')
                                 WHEN 5 THEN '13/' || strftime(o_orderdate, '%d/%Y')
                                 WHEN 6 THEN strftime(o_orderdate, '%Y%m%d') END AS date_text
      FROM orders)"""


def _mixed_dates(spark, sf_dir, parse) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", _mixed_date_text().alias("date_text"))
    return o.select("o_orderkey", "date_text",
                    F.length("date_text").cast("bigint").alias("text_length"),
                    parse(F.col("date_text")).alias("parsed"))


@register("date_mixed_formats", MIXED_DATE_SQL)
def date_mixed_formats(spark, sf_dir):
    return _mixed_dates(spark, sf_dir, lenient_date)


@register("date_mixed_udf", MIXED_DATE_SQL)
def date_mixed_udf(spark, sf_dir):
    from tabulon.session import ship_package

    ship_package(spark)
    return _mixed_dates(spark, sf_dir, lenient_date_udf)


@register("date_mixed_sql", MIXED_DATE_SQL)
def date_mixed_sql(spark, sf_dir):
    """U1 for SQL users: the rule as a registered SQL function inside ``spark.sql``."""
    from tabulon.functions.sql import register_sql_functions

    register_sql_functions(spark)
    view = f"mixed_dates_{uuid.uuid4().hex[:10]}"
    table(spark, sf_dir, "orders").select(
        "o_orderkey", _mixed_date_text().alias("date_text")).createOrReplaceTempView(view)
    return spark.sql(f"SELECT o_orderkey, date_text, CAST(length(date_text) AS BIGINT) AS text_length, "
                     f"tabulon_lenient_date(date_text) AS parsed FROM {view}")


@register("date_strict_us", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 2 = 0 OR (month(o_orderdate) >= 10 AND day(o_orderdate) >= 10)
            THEN CAST(o_orderdate AS DATE) END AS parsed
FROM orders""")
def date_strict_us(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")) \
            .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    return o.select("o_orderkey", single_format_date(text, "MM/dd/yyyy").alias("parsed"))


@register("date_strict_raising", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d_us, CAST(o_orderdate AS DATE) AS d_mixed
FROM orders""")
def date_strict_raising(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    us = F.date_format("o_orderdate", "M/d/yyyy")
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")) \
             .otherwise(us)
    texts = o.select("o_orderkey", us.alias("us_text"), mixed.alias("mixed_text"))
    return texts.withColumns({
        "d_us": strict_single_format_date("us_text", "us_text"),
        "d_mixed": strict_date("mixed_text", "mixed_text"),
    }).select("o_orderkey", "d_us", "d_mixed")


DATE_GATE_COLUMNS = {"ORDER_DATE_ISO": ("yyyy-MM-dd", "%Y-%m-%d"),
                     "ORDER_DATE_US": ("M/d/yyyy", "%-m/%-d/%Y"),
                     "ORDER_TS": ("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M")}


@register("date_length_gate", " UNION ALL ".join(
    f"""SELECT 'date_text_length' AS gate, 'orders' AS subject, '{name}' AS column_name,
       CAST(max(length(strftime(o_orderdate, '{sql_fmt}'))) AS BIGINT) AS value,
       max(length(strftime(o_orderdate, '{sql_fmt}'))) <= 10 AS passed FROM orders"""
    for name, (_, sql_fmt) in DATE_GATE_COLUMNS.items()))
def date_length_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    texts = o.select(*[F.date_format("o_orderdate", fmt).alias(name)
                       for name, (fmt, _) in DATE_GATE_COLUMNS.items()])
    return quality.length_gate(texts, list(DATE_GATE_COLUMNS), 10, "orders")


# --- A3-A6, A10, Q1-Q5 -------------------------------------------------------------------

@register("key_uniqueness", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
       CAST(sum(n - 1) AS BIGINT) AS n_excess_rows,
       count(*) FILTER (WHERE n > 1) = 0 AS is_unique
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def key_uniqueness(spark, sf_dir):
    return quality.uniqueness_summary(table(spark, sf_dir, "lineitem"), LI_KEYS)


@register("composite_key_unique", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
       CAST(sum(n - 1) AS BIGINT) AS n_excess_rows,
       count(*) FILTER (WHERE n > 1) = 0 AS is_unique
FROM (SELECT conv_id, turn, count(*) AS n FROM conversations GROUP BY conv_id, turn)""")
def composite_key_unique(spark, sf_dir):
    return quality.uniqueness_summary(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])


@register("duplicate_key_report", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) > 1""")
def duplicate_key_report(spark, sf_dir):
    li, identity = with_row_identity(table(spark, sf_dir, "lineitem"))
    li = li.select(*LI_KEYS, *LI_ORDER, *identity)
    return quality.duplicate_rows(li, LI_KEYS, LI_ORDER, identity).select(*LI_KEYS, *LI_ORDER)


@register("dedupe_keep_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""")
def dedupe_keep_last(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LI_KEYS, *LI_ORDER, "l_returnflag")
    return quality.keep_last(li, LI_KEYS, LI_ORDER)


@register("flag_count", """
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (WHERE rn > 1) AS n_flagged
FROM (SELECT l_returnflag, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                              ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
      FROM lineitem)
GROUP BY l_returnflag""")
def flag_count(spark, sf_dir):
    li, identity = with_row_identity(table(spark, sf_dir, "lineitem"))
    li = li.select(*LI_KEYS, *LI_ORDER, "l_returnflag", *identity)
    flagged = quality.flag_duplicates(li, LI_KEYS, LI_ORDER, "is_duplicate", identity)
    return profile.count_flags(flagged, "is_duplicate", ["l_returnflag"])


LI_DUP = [*LI_KEYS, *LI_ORDER]


@register("duplicate_rows_exact", f"""
SELECT {', '.join(LI_DUP)} FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) > 1""")
def duplicate_rows_exact(spark, sf_dir):
    """A6 where every row is there twice: of exact duplicates all but one are reported."""
    li = table(spark, sf_dir, "lineitem").select(*LI_DUP)
    return quality.duplicate_rows(li.unionByName(li), LI_KEYS, LI_ORDER)


@register("flag_count_exact", """
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (WHERE rn > 1) AS n_flagged
FROM (SELECT l_returnflag, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag) AS rn
      FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem))
GROUP BY l_returnflag""")
def flag_count_exact(spark, sf_dir):
    """A10 by position alone: no order is given."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEYS, "l_returnflag")
    flagged = quality.flag_duplicates(li.unionByName(li), [*LI_KEYS, "l_returnflag"])
    return profile.count_flags(flagged, "is_duplicate", ["l_returnflag"])


@register("drop_duplicates_count", """
SELECT count(*) AS n_rows FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def drop_duplicates_count(spark, sf_dir):
    """A3: one row per key (which one is not determined, so it is counted)."""
    li = table(spark, sf_dir, "lineitem")
    return quality.drop_duplicates(li.unionByName(li), LI_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))


_LI_DECLARED_MISSING = 6  # declared lineitem columns absent from the gated projection


@register("gate_report", f"""
SELECT 'key_unique' AS gate, 'orders' AS subject, 'o_orderkey' AS column_name,
       CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS value, count(*) FILTER (WHERE n > 1) = 0 AS passed
FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey)
UNION ALL SELECT 'non_empty', 'orders', '*', count(*), count(*) > 0 FROM orders
UNION ALL SELECT 'column_set', 'orders', '*', 0, true
UNION ALL SELECT 'date_text_length', 'orders', 'o_orderdate',
       max(length(strftime(o_orderdate, '%Y-%m-%d'))), max(length(strftime(o_orderdate, '%Y-%m-%d'))) <= 10
FROM orders
UNION ALL
SELECT 'key_unique', 'lineitem', 'l_orderkey,l_linenumber',
       CAST(count(*) FILTER (WHERE n > 1) AS BIGINT), count(*) FILTER (WHERE n > 1) = 0
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'non_empty', 'lineitem', '*', count(*), count(*) > 0 FROM lineitem
UNION ALL SELECT 'column_set', 'lineitem', '*', {_LI_DECLARED_MISSING}, false
UNION ALL SELECT 'date_text_length', 'lineitem', 'l_shipdate',
       max(length(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))),
       max(length(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))) <= 10
FROM lineitem""")
def gate_report(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"))
    passing = quality.gate_rows(o, ["o_orderkey"], ORDERS_SCHEMA.names, ["o_orderdate"], "orders")
    failing = quality.gate_rows(li, LI_KEYS, LINEITEM_SCHEMA.names, ["l_shipdate"], "lineitem")
    return passing.unionByName(failing)


# --- J1-J5, S7, P10 ----------------------------------------------------------------------

def _orders_typed(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _update_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Target: orders with key % 3 != 0.  Source: key % 3 == 1 repriced x2 (updates)
    plus key % 3 == 0 repriced x2 (inserts)."""
    o = _orders_typed(spark, sf_dir)
    k = F.col("o_orderkey") % 3
    target = o.where(k != 0)
    source = o.where(k != 2).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return target, source


UPSERT_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders"""


@register("upsert_update_insert", UPSERT_SQL)
def upsert_update_insert(spark, sf_dir):
    target, source = _update_sides(spark, sf_dir)
    return upsert(target, source, ["o_orderkey"])


@register("upsert_delete_missing", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 3 <> 2""")
def upsert_delete_missing(spark, sf_dir):
    target, source = _update_sides(spark, sf_dir)
    return upsert(target, source, ["o_orderkey"], delete_missing=True)


@register("upsert_partitioned", """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
                  o_orderpriority, (SELECT max(o_orderkey) FROM orders) AS top FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey > top // 2 AND o_orderkey <= top // 2 + top // 100 + 1 THEN o_totalprice * 2
            ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM t
UNION ALL
SELECT o_orderkey + top, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority
FROM t WHERE o_orderkey > top // 2 AND o_orderkey <= top // 2 + top // 100 + 1""")
def upsert_partitioned(spark, sf_dir):
    """J1 into a master partitioned by ranges of the key: an update of neighbouring keys and new keys touches
    the few partitions that hold them."""
    orders = _orders_typed(spark, sf_dir)
    key = F.col("o_orderkey")
    top = orders.agg(F.max(key)).first()[0] or 0
    master = PartitionedTable(spark, f"orders_parts_{uuid.uuid4().hex[:10]}", orders.schema, ["o_orderkey"],
                              f"o_orderkey div {top // 64 + 1}")
    master.upsert(orders, check=False)
    band = stage(orders.where((key > top // 2) & (key <= top // 2 + top // 100 + 1))
                 .withColumn("o_totalprice", F.col("o_totalprice") * 2), "band")
    master.upsert(band.unionByName(band.withColumn("o_orderkey", key + F.lit(top))))
    return master.read()


@register("upsert_narrowing", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""")
def upsert_narrowing(spark, sf_dir):
    target, source = _update_sides(spark, sf_dir)
    return upsert(target.withColumn("o_orderkey", F.col("o_orderkey").cast("int")), source,
                  ["o_orderkey"])


@register("upsert_null_keys", """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
           FROM orders WHERE o_orderkey % 3 <> 0),
     s AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
                  o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
                  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
           FROM orders WHERE o_orderkey % 3 <> 2)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s""")
def upsert_null_keys(spark, sf_dir):
    target, source = _update_sides(spark, sf_dir)
    k = F.col("o_orderkey")
    source = source.withColumn("o_orderkey", F.when(k % 5 != 0, k))
    return upsert(target, source, ["o_orderkey"])


@register("upsert_violations", """
SELECT l_orderkey AS o_orderkey, count(*) AS n_source_rows FROM lineitem
WHERE l_orderkey IS NOT NULL
GROUP BY l_orderkey
HAVING count(*) > 1 AND l_orderkey IN (SELECT o_orderkey FROM orders)""")
def upsert_violations(spark, sf_dir):
    target = table(spark, sf_dir, "orders")
    source = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return cardinality_violations(target, source, ["o_orderkey"])


@register("literal_upsert", """
SELECT CAST(c_custkey AS INTEGER) AS cust, c_acctbal AS balance,
       CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE upper(c_name) END AS label
FROM customer""")
def literal_upsert(spark, sf_dir):
    target = literal_frame(spark, [], "a INT NOT NULL, b DOUBLE, c STRING", ["cust", "balance", "label"])
    c = table(spark, sf_dir, "customer")
    even = c.where(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_acctbal", "c_name")
    odd = c.where(F.col("c_custkey") % 2 == 1).select("c_custkey", "c_acctbal", F.upper("c_name"))
    names = ["cust", "balance", "label"]
    return upsert(upsert(target, even.toDF(*names), ["cust"]), odd.toDF(*names), ["cust"])


# --- X1-X3, S4, L3, T1-T7 ---------------------------------------------------------------

EVENTS_LATEST_SQL = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def _events_out(df: DataFrame) -> DataFrame:
    return df.select("event_id", ntz_text("ts").alias("ts"),
                     "user_id", "event_type", "value", "props")


@register("ingest_many_latest", EVENTS_LATEST_SQL)
def ingest_many_latest(spark, sf_dir):
    root = daily_events(spark, sf_dir)
    return _events_out(prepare(spark, root, EVENTS_BY_USER, on_duplicate="keep_last").rows)


@register("ingest_resume", EVENTS_LATEST_SQL)
def ingest_resume(spark, sf_dir):
    root = daily_events(spark, sf_dir)
    store = TableStore(spark, register=False)
    sources = sorted(r["source"] for r in
                     file_inventory(spark, root).select("source").distinct().collect())
    first_half = file_inventory(spark, root).where(F.col("source").isin(sources[: len(sources) // 2]))
    ingest(store, EVENTS_BY_USER, root, files=first_half, on_duplicate="keep_last")
    resume(store, EVENTS_BY_USER, root, on_duplicate="keep_last")
    if not pending_files(store, EVENTS_BY_USER, root).isEmpty():
        raise RuntimeError("resume left files behind")
    return _events_out(store.read(EVENTS_BY_USER.name))


@register("ingest_resume_watermark", EVENTS_LATEST_SQL)
def ingest_resume_watermark(spark, sf_dir):
    """The second half of the extracts is delivered later; the listing leaves out what is older than the ledger."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    middle = first + (last - first) / 2
    root = scratch_path(spark, "late-events")
    store = TableStore(spark, register=False)
    for half in (F.to_date("ts") <= F.lit(middle), F.to_date("ts") > F.lit(middle)):
        fixtures.write_daily_events(events.where(half), root, "append")
        # files of both halves may bear the same second
        resume(store, EVENTS_BY_USER, root, lookback=dt.timedelta(minutes=1), on_duplicate="keep_last")
    if not pending_files(store, EVENTS_BY_USER, root).isEmpty():
        raise RuntimeError("resume left files behind")
    return _events_out(store.read(EVENTS_BY_USER.name))


@register("stream_ingest_latest", EVENTS_LATEST_SQL)
def stream_ingest_latest(spark, sf_dir):
    from tabulon.streaming import start_arrivals

    root = daily_events(spark, sf_dir)
    store = TableStore(spark, register=False)
    query = start_arrivals(spark, EVENTS_BY_USER, root, store, on_duplicate="keep_last",
                           checkpoint=scratch_path(spark, "arrivals-checkpoint"))
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return _events_out(store.read(EVENTS_BY_USER.name))


@register("gate_key_unique_extract", """
SELECT 'FY=' || CAST(year(o_orderdate) AS VARCHAR) AS source, o_orderkey, CAST(2 AS BIGINT) AS n
FROM orders WHERE o_orderkey % 10 = 0""")
def gate_key_unique_extract(spark, sf_dir):
    """Q1 over the extract: keys that a year's other part files repeat."""
    def build(root):
        o = table(spark, sf_dir, "orders")
        fixtures.write_yearly_orders(o, root)
        fixtures.write_yearly_orders(o.where(F.col("o_orderkey") % 10 == 0), root)

    root = _fixture(spark, sf_dir, "repeated-orders", build)
    raw = read_csv_sources(spark, scan_files(file_inventory(spark, root), root))
    keyed = raw.select(SOURCE, lenient_long("o_orderkey").alias("o_orderkey"))
    return quality.repeated_keys(keyed, SOURCE, ["o_orderkey"]).select(
        F.col(SOURCE).alias("source"), "o_orderkey", "n")


@register("ingest_redelivered", """
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) % 2 = 0 THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""")
def ingest_redelivered(spark, sf_dir):
    """Every other year is delivered again, corrected, under the same file names; the second delivery wins."""
    root = scratch_path(spark, "redelivered")
    o = table(spark, sf_dir, "orders")
    fixtures.deliver_yearly_orders(spark, o, root)
    store = TableStore(spark, register=False)
    ingest(store, ORDERS, root)
    again = o.where(F.year("o_orderdate") % 2 == 0).withColumn("o_orderstatus", F.lit("R"))
    fixtures.deliver_yearly_orders(spark, again, root)
    resume(store, ORDERS, root)
    if not pending_files(store, ORDERS, root).isEmpty():
        raise RuntimeError("resume left files behind")
    return store.read(ORDERS.name)


@register("ingest_one_year", ORDERS_AS_DECLARED)
def ingest_one_year(spark, sf_dir):
    """One yearly extract merged into a master holding every other year."""
    root = yearly_orders(spark, sf_dir)
    inventory = file_inventory(spark, root)
    one = sorted(r["source"] for r in inventory.select("source").distinct().collect())[1]
    store = TableStore(spark, register=False)
    others = _orders_typed(spark, sf_dir).where(
        F.concat(F.lit("FY="), F.year("o_orderdate").cast("string")) != one)
    store.publish(ORDERS.name, others, bucket_keys=list(ORDERS.keys), buckets=8)
    ingest(store, ORDERS, root, files=inventory.where(F.col("source") == one))
    return store.read(ORDERS.name)


@register("file_inventory_order", """
SELECT 'FY=' || CAST(y AS VARCHAR) AS source, CAST(dense_rank() OVER (ORDER BY y) AS BIGINT) AS seq
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""")
def file_inventory_order(spark, sf_dir):
    """Extracts in processing (name) order, one row per extract of the listing."""
    sources = file_inventory(spark, yearly_orders(spark, sf_dir)).select("source").distinct()
    seq = F.row_number().over(Window.orderBy("source")).cast("bigint")
    return sources.select("source", seq.alias("seq")).orderBy("source")


def yearly_projects(spark: SparkSession, sf_dir: str) -> str:
    return _fixture(spark, sf_dir, "yearly-projects", lambda root: fixtures.write_yearly_projects(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), root, PROJECTS.names))


@register("projects_ingest", fixtures.projects_expected_sql(PROJECTS.names))
def projects_ingest(spark, sf_dir):
    """X1/X2 on the declared 42-column master: yearly extracts with header drift,
    mixed date formats, a year-3012 typo, quoted and multi-line text."""
    store = TableStore(spark, register=False)
    ingest(store, PROJECTS, yearly_projects(spark, sf_dir))
    return store.read(PROJECTS.name)


_PROJECT_TYPED = [f.name for f in PROJECTS.schema.fields if f.dataType.simpleString() != "string"]


@register("projects_rejects", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE o_orderkey % 50 = 0) AS rejects FROM orders"
    if c == "PROJECT_END" else f"SELECT '{c}' AS column_name, CAST(0 AS BIGINT) AS rejects"
    for c in _PROJECT_TYPED))
def projects_rejects(spark, sf_dir):
    """Values present as text that did not convert, per typed column."""
    prep = prepare(spark, yearly_projects(spark, sf_dir), PROJECTS)
    return prep.reject_report(spark)


@register("projects_reject_sample", """
SELECT source, column_name, text, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, text) AS rank FROM (
    SELECT 'FYEAR=' || CAST(year(o_orderdate) AS VARCHAR) AS source, 'PROJECT_END' AS column_name,
           '3012-' || strftime(o_orderdate, '%m-%d') AS text, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 50 = 0 GROUP BY ALL))
WHERE rank <= 20""")
def projects_reject_sample(spark, sf_dir):
    """The texts that did not convert, not only their number."""
    prep = prepare(spark, yearly_projects(spark, sf_dir), PROJECTS)
    sample = prep.reject_sample(20, by=SOURCE)
    return sample.select(F.col(SOURCE).alias("source"), "column_name", "text", "n", F.col("rank").cast("long").alias("rank"))


@register("ingest_dry_run", ORDERS_AS_DECLARED)
def ingest_dry_run(spark, sf_dir):
    root = yearly_orders(spark, sf_dir)
    prep = prepare(spark, root, ORDERS)
    return prep.rows.transform(lambda df: df.select(*ORDERS_SCHEMA.names))


@register("table_lifecycle", """
SELECT 1 AS step, 'create_if_absent' AS action, CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 2, 'create_if_absent', 0
UNION ALL SELECT 3, 'load', count(*) FROM orders
UNION ALL SELECT 4, 'create_if_absent', count(*) FROM orders
UNION ALL SELECT 5, 'replace', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders
UNION ALL SELECT 6, 'sql_scan', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders
UNION ALL SELECT 7, 'reset', 0
UNION ALL SELECT 8, 'temp_view_merge', count(*) FROM orders
UNION ALL SELECT 9, 'drop', 0
UNION ALL SELECT 10, 'create_if_absent', 0
UNION ALL SELECT 11, 'load', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders""")
def table_lifecycle(spark, sf_dir):
    store = TableStore(spark)
    name = f"lifecycle_{uuid.uuid4().hex[:10]}"
    o = _orders_typed(spark, sf_dir)
    steps = []
    store.create_if_absent(name, ORDERS_SCHEMA)
    steps.append((1, "create_if_absent", store.read(name).count()))
    store.create_if_absent(name, ORDERS_SCHEMA)
    steps.append((2, "create_if_absent", store.read(name).count()))
    store.publish(name, upsert(store.read(name), o, ["o_orderkey"], check=False))
    steps.append((3, "load", store.read(name).count()))
    store.create_if_absent(name, ORDERS_SCHEMA)
    steps.append((4, "create_if_absent", store.read(name).count()))
    store.replace(name, store.read(name).where(F.col("o_orderstatus") == "F"))
    steps.append((5, "replace", store.read(name).count()))
    steps.append((6, "sql_scan", spark.sql(f"SELECT count(*) AS n FROM {name}").first()["n"]))
    store.reset(name)
    steps.append((7, "reset", store.read(name).count()))
    # An update set exposed to SQL as a temp view, merged by name.
    view = f"v_{name}"
    o.createOrReplaceTempView(view)
    store.publish(name, upsert(store.read(name), spark.table(view), ["o_orderkey"], check=False))
    steps.append((8, "temp_view_merge", spark.sql(f"SELECT count(*) AS n FROM {name}").first()["n"]))
    spark.catalog.dropTempView(view)
    store.drop(name)
    steps.append((9, "drop", int(store.exists(name)) + int(spark.catalog.tableExists(name))))
    store.create_if_absent(name, ORDERS_SCHEMA)
    steps.append((10, "create_if_absent", spark.sql(f"SELECT count(*) AS n FROM {name}").first()["n"]))
    store.publish(name, upsert(store.read(name), o.where("o_orderstatus = 'F'"), ["o_orderkey"], check=False))
    steps.append((11, "load", spark.sql(f"SELECT count(*) AS n FROM {name}").first()["n"]))
    store.drop(name)
    return spark.createDataFrame(steps, "step int, action string, n_rows long")


@register("snapshot_asof", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE year(o_orderdate) <= 1998""")
def snapshot_asof(spark, sf_dir):
    store = TableStore(spark, register=False)
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("fy"))
    for upto, label in ((1996, "2024-01-01"), (1998, "2024-06-01"), (9999, "2025-01-01")):
        store.publish("orders_snap", o.where(F.col("fy") <= upto), label=label)
    return store.as_of("orders_snap", "2024-07-15").select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("table_detail", """
SELECT 'parquet' AS format, CAST(0 AS BIGINT) AS version, 6 AS num_columns, true AS has_files,
       (SELECT count(*) FROM orders) > 0 AS has_bytes, 6 AS described_columns""")
def table_detail(spark, sf_dir):
    store = TableStore(spark)
    name = f"detail_{uuid.uuid4().hex[:10]}"
    store.publish(name, _orders_typed(spark, sf_dir), bucket_keys=["o_orderkey"])
    columns = store.describe(name).where("data_type <> ''").select("col_name")
    described = columns.where(F.col("col_name").isin(ORDERS_SCHEMA.names)).distinct().count()
    return store.detail(name).select(
        "format", "version", "num_columns", (F.col("num_files") > 0).alias("has_files"),
        (F.col("size_in_bytes") > 0).alias("has_bytes"), F.lit(described).alias("described_columns"))


@register("schema_report", " UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS name, '{t}' AS type, true AS nullable, count({n}) AS n_nonnull FROM orders"
    for i, (n, t) in enumerate([("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                                ("o_orderstatus", "string"), ("o_totalprice", "double"),
                                ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")])))
def schema_report(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    counts = o.agg(*[F.count(c).alias(c) for c in o.columns]).unpivot(
        [], o.columns, "name", "n_nonnull")
    return schema_frame(spark, o).join(counts, "name").select(
        "position", "name", "type", "nullable", "n_nonnull")


# --- A1, A2, A8, A9, L1, L2, L4, P7, P8, Q6 ------------------------------------------------

@register("distinct_values", """
SELECT DISTINCT 'event_type' AS column_name, event_type AS value FROM events
UNION SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders""")
def distinct_values(spark, sf_dir):
    ev = profile.distinct_values(table(spark, sf_dir, "events"), ["event_type"])
    od = profile.distinct_values(table(spark, sf_dir, "orders"), ["o_orderpriority"])
    return ev.unionByName(od)


@register("distinct_lengths", "SELECT DISTINCT CAST(length(p_name) AS BIGINT) AS length FROM part")
def distinct_lengths(spark, sf_dir):
    return profile.distinct_lengths(table(spark, sf_dir, "part"), "p_name").select(
        F.col("length").cast("bigint").alias("length"))


PART_TEXT = ["p_name", "p_brand", "p_type"]


@register("extreme_lengths", """
WITH u AS (""" + " UNION ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM part WHERE {c} IS NOT NULL"
    for c in PART_TEXT) + """),
r AS (SELECT column_name, value, CAST(length(value) AS BIGINT) AS length,
             row_number() OVER (PARTITION BY column_name ORDER BY length(value), value) AS rs,
             row_number() OVER (PARTITION BY column_name ORDER BY length(value) DESC, value) AS rl
      FROM u)
SELECT column_name, 'shortest' AS side, rs AS rank, value, length FROM r WHERE rs <= 10
UNION ALL
SELECT column_name, 'longest' AS side, rl AS rank, value, length FROM r WHERE rl <= 10""")
def extreme_lengths(spark, sf_dir):
    out = profile.extreme_lengths(table(spark, sf_dir, "part"), PART_TEXT, 10)
    return out.select("column_name", F.col("end").alias("side"), F.col("rank").cast("bigint").alias("rank"),
                      "value", F.col("length").cast("bigint").alias("length"))


LONG_TEXT = 2000


@register("long_value_filter", f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS text_length FROM documents WHERE length(text) > {LONG_TEXT}""")
def long_value_filter(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return profile.long_values(d, "text", LONG_TEXT).select(
        "doc_id", F.length("text").cast("bigint").alias("text_length"))


@register("not_null_filter", """
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL""")
def not_null_filter(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return profile.not_null(d.join(lab, "doc_id", "left"), "quality").select("doc_id", "quality")


CUSTOMER_COLS = [("c_custkey", False), ("c_name", True), ("c_nationkey", False),
                 ("c_acctbal", False), ("c_mktsegment", True)]


@register("column_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls,
       count(DISTINCT {c}) AS n_distinct,
       {f'CAST(min(length({c})) AS BIGINT)' if s else 'CAST(NULL AS BIGINT)'} AS min_length,
       {f'CAST(max(length({c})) AS BIGINT)' if s else 'CAST(NULL AS BIGINT)'} AS max_length
       FROM customer""" for c, s in CUSTOMER_COLS))
def column_profile(spark, sf_dir):
    out = profile.column_profile(table(spark, sf_dir, "customer"), [c for c, _ in CUSTOMER_COLS])
    return out.select("column_name", "n_rows", "n_nulls", "n_distinct",
                      F.col("min_length").cast("bigint").alias("min_length"),
                      F.col("max_length").cast("bigint").alias("max_length"))


SAMPLE_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@register("column_samples", """
WITH u AS (""" + " UNION ".join(
    f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM customer WHERE {c} IS NOT NULL"
    for c in SAMPLE_COLS) + """)
SELECT column_name, value, rank FROM (
  SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY value) AS rank FROM u)
WHERE rank <= 10""")
def column_samples(spark, sf_dir):
    out = profile.column_samples(table(spark, sf_dir, "customer"), SAMPLE_COLS, 10)
    return out.select("column_name", "value", F.col("rank").cast("bigint").alias("rank"))


PROFILED = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


@register("profile_sketch", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
       {f"CAST(min({c}) AS DOUBLE)" if c in PROFILED[:3] else "CAST(NULL AS DOUBLE)"} AS min_value,
       {f"CAST(max({c}) AS DOUBLE)" if c in PROFILED[:3] else "CAST(NULL AS DOUBLE)"} AS max_value,
       true AS distinct_close, true AS median_close
FROM orders""" for c in PROFILED))
def profile_sketch(spark, sf_dir):
    """A9/A2 by mergeable sketches: one per yearly source, stored, united, and held against exact counts."""
    orders = _orders_typed(spark, sf_dir).withColumn("fy", F.year("o_orderdate"))
    united = sketches.profile(sketches.unite(stage(sketches.sketch(orders, PROFILED, by=["fy"]), "sketches")))
    exact = profile.column_profile(orders, PROFILED).select("column_name", "n_distinct")
    medians = {r.column_name: r.median for r in united.select("column_name", "median").collect()}  # a row per column
    shares = orders.agg(*[F.avg((F.col(c) <= medians[c]).cast("double")).alias(c) for c in PROFILED[:3]
                          if medians.get(c) is not None] or [F.lit(None).alias("none")])
    ranks = shares.unpivot([], shares.columns, "column_name", "share")
    return (united.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", "min_value", "max_value",
        (F.abs(F.col("n_distinct_estimate") - F.col("n_distinct")) <= 0.03 * F.col("n_distinct")).alias("distinct_close"),
        F.coalesce(F.abs(F.col("share") - 0.5) < 0.05, F.lit(True)).alias("median_close")))


@register("reader_parity", """
SELECT CAST(length(text) AS INTEGER) AS length, count(*) AS n_quote_aware
FROM documents WHERE text IS NOT NULL GROUP BY length(text)""")
def reader_parity(spark, sf_dir):
    """Q6: text-length histograms of one CSV under naive and quote-aware options; the quote-aware
    counts are those of the source (the naive ones depend on where lines break)."""
    root = _fixture(spark, sf_dir, "documents-csv",
                    lambda r: fixtures.write_documents(table(spark, sf_dir, "documents"), r))
    naive = spark.read.option("header", "true").csv(root)
    aware = read_csv_text(spark, root)
    both = quality.length_histograms(naive, aware, "text", ("naive", "quote_aware"))
    return both.where("n_quote_aware > 0 and length is not null").select("length", "n_quote_aware")


@register("reader_parity_content", """
WITH per AS (SELECT source, count(*) AS n, bool_and(text NOT LIKE '%"%' AND text NOT LIKE '%' || chr(10) || '%') AS plain
             FROM documents GROUP BY source)
SELECT source, reader, CAST(n AS BIGINT) AS n_rows, CASE reader WHEN 'naive' THEN plain ELSE true END AS equal
FROM per, (VALUES ('naive'), ('quote_aware'), ('split')) AS r(reader)""")
def reader_parity_content(spark, sf_dir):
    """Q6: whether each reader gives the rows of each source's files, proven by order-free fingerprints.  A naive
    reader differs wherever a text holds a quote or a line break."""
    docs = table(spark, sf_dir, "documents")
    def build(root):
        fixtures.in_large_parts(docs).write.options(**CSV_WRITE_OPTIONS).partitionBy("source").csv(root)
    root = _fixture(spark, sf_dir, "documents-by-source-csv", build)
    files = scan_files(file_inventory(spark, root), root)
    columns = ["doc_id", "text", "lang", "n_chars"]
    plain = spark.read.option("header", "true").option("recursiveFileLookup", "true").csv(root).select(
        *columns, F.regexp_extract("_metadata.file_path", "/source=([^/]*)/", 1).alias("source"))
    by_source = lambda df: df.select(*columns, F.regexp_extract(SOURCE, "source=(.*)", 1).alias("source"))
    reads = {"naive": plain, "quote_aware": by_source(read_csv_sources(spark, files)),
             "split": by_source(read_csv_split(spark, files))}
    text = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.nullif("text", F.lit("")).alias("text"), "lang",
                       F.col("n_chars").cast("string").alias("n_chars"), "source")
    out = None
    for reader, read in reads.items():
        part = quality.same_content(text, read, columns, ["source"]).select(
            "source", F.lit(reader).alias("reader"), F.col("n_left").alias("n_rows"), "equal")
        out = part if out is None else out.unionByName(part)
    return out


@register("values_desc", """
SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels WHERE quality IS NOT NULL""")
def values_desc(spark, sf_dir):
    return profile.values_desc(table(spark, sf_dir, "labels"), "quality", tie=["doc_id"])


@register("values_desc_ranked", """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       row_number() OVER (ORDER BY o_custkey DESC, o_orderkey) AS rank
FROM orders WHERE o_custkey IS NOT NULL""")
def values_desc_ranked(spark, sf_dir):
    """L4 with its order checked: the place of each value, counted over range partitions."""
    return profile.values_ranked(table(spark, sf_dir, "orders"), "o_custkey", tie=["o_orderkey"])


@register("preview", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10""")
def preview(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return profile.preview(o, ["o_orderkey"], 10)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated ingest of yearly project extracts into a fresh, dated master."""
    store = TableStore(spark, register=False)
    ingest(store, PROJECTS, yearly_projects(spark, sf_dir), label=dt.date.today().isoformat())
    return store.read(PROJECTS.name)
