"""Extract-shaped inputs derived from the driver's tables.

The library's inputs are folders of delimited extracts; the test tables are
Parquet.  These builders write the tables out as such extracts, in parallel, in
the shared scratch area, so every query below exercises the real read path and
its work grows with the tables.

Yearly order extracts vary by fiscal year (``FY % 3``) like real yearly files:

* layout 0: declared column order, dates ``yyyy-MM-dd``;
* layout 1: reversed column order, dates ``M/d/yyyy``;
* layout 2: declared order, an extra column ``o_extra`` after ``o_custkey``, the
  status column spelled ``O_ORDERSTATUS``, dates ``MM/dd/yyyy``.

Each year is a folder ``FY=<year>`` of part files; part files are range
partitioned on the key and sorted, so (file name, row) order is key order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.casts import ntz_text
from tabulon.session import child_names, hadoop_path, qualified, scratch_path, stage
from tabulon.sources.archives import write_archives
from tabulon.sources.csv import write_csv
from tabulon.sources.files import file_inventory, write_file_atomic

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority"]
DATE_PATTERNS = {0: "yyyy-MM-dd", 1: "M/d/yyyy", 2: "MM/dd/yyyy"}


ROWS_PER_PART = 1_000_000
MIN_ROWS_PER_PART = 10_000


def _parts(df: DataFrame) -> int:
    """Part files for an extract: about a million rows each, and at least two per
    task slot (for load balance) as long as each holds ``MIN_ROWS_PER_PART`` rows.

    Multi-line CSV is read one file per task, so the file count is the read
    parallelism.  ``count()`` of a Parquet table is answered from file footers,
    so sizing the output costs no scan.
    """
    rows = df.count()
    slots = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-rows // ROWS_PER_PART), min(2 * slots, -(-rows // MIN_ROWS_PER_PART)))


#: Bytes of text in a part file of a multi-line extract, about: several splits, and not too much for the task that writes it.
PART_BYTES = 256 << 20


def in_large_parts(df: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``df`` in one partition for each ``part_bytes`` of its text, for extracts of few, large files; nothing is shuffled."""
    widths = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) if kind == "string" else F.lit(8) for c, kind in df.dtypes]
    total = df.select(sum(widths, F.lit(0)).cast("long").alias("n")).agg(F.sum("n")).first()[0] or 0
    return df.coalesce(max(1, -(-total // part_bytes)))


def yearly_layout(layout: int) -> list[str]:
    cols = list(ORDER_COLUMNS)
    if layout == 1:
        return cols[::-1]
    if layout == 2:
        cols = ["O_ORDERSTATUS" if c == "o_orderstatus" else c for c in cols]
        cols.insert(cols.index("o_custkey") + 1, "o_extra")
    return cols


def write_yearly_orders(orders: DataFrame, root: str) -> str:
    """Write ``orders`` as yearly extracts below ``root`` (one job per layout)."""
    fy = F.year("o_orderdate")
    parts = _parts(orders)
    for layout, pattern in DATE_PATTERNS.items():
        cols = yearly_layout(layout)
        exprs = {
            "o_orderdate": F.date_format("o_orderdate", pattern).alias("o_orderdate"),
            "O_ORDERSTATUS": F.col("o_orderstatus").alias("O_ORDERSTATUS"),
            "o_extra": F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("o_extra"),
        }
        part = (orders.where(F.pmod(fy, F.lit(3)) == layout)
                .select(fy.alias("FY"), *[exprs.get(c, F.col(c)) for c in cols])
                .repartitionByRange(parts, "FY", "o_orderkey")
                .sortWithinPartitions("FY", "o_orderkey"))
        write_csv(part, root, mode="append", partition_by=["FY"])
    return root


def deliver_yearly_orders(spark: SparkSession, orders: DataFrame, root: str) -> str:
    """Yearly order extracts whose file names do not change from one delivery to the next."""
    written = write_yearly_orders(orders, scratch_path(spark, "delivery"))
    for year in child_names(spark, written):
        if not year.startswith("FY="):
            continue
        parts = [n for n in child_names(spark, f"{written}/{year}") if n.endswith(".csv")]
        fs, folder = hadoop_path(spark, f"{root}/{year}")
        fs.mkdirs(folder)
        for i, part in enumerate(parts):
            target = hadoop_path(spark, f"{root}/{year}/orders-{i:05d}.csv")[1]
            fs.delete(target, False)
            fs.rename(hadoop_path(spark, f"{written}/{year}/{part}")[1], target)
    return root


def write_daily_events(events: DataFrame, root: str, mode: str = "errorifexists") -> str:
    """``events`` as one extract folder per day, rows in (ts, event_id) order."""
    day = F.substring(ntz_text("ts"), 1, 10)
    out = (events.select(day.alias("day"), "event_id",
                         ntz_text("ts").alias("ts"),
                         "user_id", "event_type", "value", "props")
           .repartitionByRange(_parts(events), "day", "ts", "event_id")
           .sortWithinPartitions("day", "ts", "event_id"))
    write_csv(out, root, mode, partition_by=["day"])
    return root


def write_documents(documents: DataFrame, root: str) -> str:
    """``documents`` as quoted, multi-line CSV."""
    write_csv(documents, root)
    return root


def archive_plan(inventory: DataFrame) -> DataFrame:
    """Which members go into the archive made from each yearly part file.

    By fiscal year: ``FY % 4 == 1`` two members (skipped), ``== 2`` none
    (rejected), ``== 3`` the data plus a hidden ``.DS_Store`` (extracted),
    otherwise the data alone (extracted).
    """
    year = F.regexp_extract("source", r"(\d{4})", 1).cast("int")
    stem = F.regexp_extract("file_name", r"([^/]+)\.csv$", 1)
    data = F.struct(F.concat(stem, F.lit(".csv")).alias("name"), F.lit("data").alias("kind"))
    copy = F.struct(F.concat(stem, F.lit("-copy.csv")).alias("name"), F.lit("data").alias("kind"))
    hidden = F.struct(F.lit(".DS_Store").alias("name"), F.lit("hidden").alias("kind"))
    members = (F.when(year % 4 == 1, F.array(data, copy))
                .when(year % 4 == 2, F.array().cast("array<struct<name:string,kind:string>>"))
                .when(year % 4 == 3, F.array(data, hidden))
                .otherwise(F.array(data)))
    return inventory.select("path", F.concat_ws("/", "source", F.concat(stem, F.lit(".zip"))).alias("archive"),
                            members.alias("members"))


def write_order_archives(spark: SparkSession, csv_root: str, zip_root: str) -> str:
    """One zip per yearly part file, following ``archive_plan``, and one that cannot be read; runs now."""
    write_file_atomic(qualified(spark, f"{zip_root}/broken/cut.zip"), [b"PK\x03\x04 cut short"])
    plan = archive_plan(file_inventory(spark, csv_root, "*.csv"))
    write_archives(plan, zip_root).write.format("noop").mode("overwrite").save()
    return zip_root


# --- yearly grant-project extracts in the declared 42-column master layout ----------
def _project_text():
    """Text written to the extract for each declared column (None: empty field)."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    fy = F.year(d)
    iso, us = F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "M/d/yyyy")
    plus = lambda n: F.date_add(d.cast("date"), n)
    return {
        "APPLICATION_ID": k.cast("string"),
        "ACTIVITY": F.col("o_orderpriority"),
        "ADMINISTERING_IC": F.col("o_orderstatus"),
        "APPLICATION_TYPE": (k % 9).cast("string"),
        "ARRA_FUNDED": None,
        "AWARD_NOTICE_DATE": F.substring(ntz_text(d), 1, 19),
        "BUDGET_START": F.when(k % 2 == 0, iso).otherwise(us),
        "BUDGET_END": F.date_format(plus(364), "M/d/yyyy"),
        "CFDA_CODE": F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")),
        "CORE_PROJECT_NUM": F.concat(F.lit("P"), k.cast("string")),
        "ED_INST_TYPE": F.col("c_mktsegment"),
        "FOA_NUMBER": None,
        "FULL_PROJECT_NUM": F.concat(F.lit("1P"), k.cast("string"), F.lit("-"), fy.cast("string")),
        "SUBPROJECT_ID": None,
        "FUNDING_ICs": F.concat(F.col("c_mktsegment"), F.lit(";")),
        "FY": fy.cast("string"),
        "IC_NAME": F.col("c_name"),
        "NIH_SPENDING_CATS": None,
        "ORG_CITY": None,
        "ORG_COUNTRY": F.lit("UNITED STATES"),
        "ORG_DEPT": None,
        "ORG_DISTRICT": F.col("c_nationkey").cast("string"),
        "ORG_DUNS": F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
        "ORG_FIPS": None,
        "ORG_NAME": F.col("c_name"),
        "ORG_STATE": None,
        "ORG_ZIPCODE": None,
        "PHR": None,
        "PI_IDS": F.concat(F.col("o_custkey").cast("string"), F.lit(";")),
        "PI_NAMEs": F.concat(F.col("c_name"), F.lit(', "PI"')),
        "PROGRAM_OFFICER_NAME": None,
        "PROJECT_START": F.date_format(d, "MM/dd/yyyy"),
        "PROJECT_END": F.when(k % 50 == 0, F.concat(F.lit("3012-"), F.date_format(d, "MM-dd")))
                         .otherwise(F.date_format(plus(730), "yyyy-MM-dd")),
        "PROJECT_TERMS": F.concat(F.col("c_mktsegment"), F.lit("\n"), F.col("o_orderpriority")),
        "PROJECT_TITLE": F.concat(F.lit("Project "), k.cast("string")),
        "SERIAL_NUMBER": F.concat(F.col("o_custkey").cast("string"), F.lit(".0")),
        "STUDY_SECTION": None,
        "STUDY_SECTION_NAME": None,
        "SUFFIX": None,
        "SUPPORT_YEAR": (fy - 1994).cast("string"),
        "TOTAL_COST": F.col("o_totalprice").cast("string"),
        "TOTAL_COST_SUB_PROJECT": None,
    }


# Expected typed value of each declared column, in SQL over
# ``orders o JOIN customer c ON o.o_custkey = c.c_custkey``.
PROJECT_EXPECTED_SQL = {
    "APPLICATION_ID": "o.o_orderkey",
    "ACTIVITY": "o.o_orderpriority",
    "ADMINISTERING_IC": "o.o_orderstatus",
    "APPLICATION_TYPE": "o.o_orderkey % 9",
    "ARRA_FUNDED": "CAST(NULL AS DOUBLE)",
    "AWARD_NOTICE_DATE": "strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "BUDGET_START": "CAST(o.o_orderdate AS DATE)",
    "BUDGET_END": "CAST(o.o_orderdate AS DATE) + 364",
    "CFDA_CODE": "CAST(c.c_nationkey AS DOUBLE)",
    "CORE_PROJECT_NUM": "'P' || CAST(o.o_orderkey AS VARCHAR)",
    "ED_INST_TYPE": "c.c_mktsegment",
    "FOA_NUMBER": "CAST(NULL AS VARCHAR)",
    "FULL_PROJECT_NUM": "'1P' || CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(year(o.o_orderdate) AS VARCHAR)",
    "SUBPROJECT_ID": "CAST(NULL AS DOUBLE)",
    "FUNDING_ICs": "c.c_mktsegment || ';'",
    "FY": "CAST(year(o.o_orderdate) AS VARCHAR)",
    "IC_NAME": "c.c_name",
    "NIH_SPENDING_CATS": "CAST(NULL AS DOUBLE)",
    "ORG_CITY": "CAST(NULL AS VARCHAR)",
    "ORG_COUNTRY": "'UNITED STATES'",
    "ORG_DEPT": "CAST(NULL AS VARCHAR)",
    "ORG_DISTRICT": "CAST(c.c_nationkey AS DOUBLE)",
    "ORG_DUNS": "lpad(CAST(o.o_custkey AS VARCHAR), 9, '0')",
    "ORG_FIPS": "CAST(NULL AS VARCHAR)",
    "ORG_NAME": "c.c_name",
    "ORG_STATE": "CAST(NULL AS VARCHAR)",
    "ORG_ZIPCODE": "CAST(NULL AS VARCHAR)",
    "PHR": "CAST(NULL AS DOUBLE)",
    "PI_IDS": "CAST(o.o_custkey AS VARCHAR) || ';'",
    "PI_NAMEs": "c.c_name || ', \"PI\"'",
    "PROGRAM_OFFICER_NAME": "CAST(NULL AS VARCHAR)",
    "PROJECT_START": "CAST(o.o_orderdate AS DATE)",
    "PROJECT_END": "CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) + 730 END",
    "PROJECT_TERMS": "c.c_mktsegment || chr(10) || o.o_orderpriority",
    "PROJECT_TITLE": "'Project ' || CAST(o.o_orderkey AS VARCHAR)",
    "SERIAL_NUMBER": "o.o_custkey",
    "STUDY_SECTION": "CAST(NULL AS VARCHAR)",
    "STUDY_SECTION_NAME": "CAST(NULL AS VARCHAR)",
    "SUFFIX": "CAST(NULL AS VARCHAR)",
    "SUPPORT_YEAR": "CAST(year(o.o_orderdate) - 1994 AS VARCHAR)",
    "TOTAL_COST": "o.o_totalprice",
    "TOTAL_COST_SUB_PROJECT": "CAST(NULL AS DOUBLE)",
}


# Columns that appear in later yearly files only (fiscal years from 2000 on).
PROJECT_EXTRAS = ["FUNDING_MECHANISM", "ORG_IPF_CODE", "DIRECT_COST_AMT", "INDIRECT_COST_AMT"]


def projects_expected_sql(schema_names: list[str]) -> str:
    select = ",\n       ".join(f"{PROJECT_EXPECTED_SQL[n]} AS {n}" for n in schema_names)
    return f"SELECT {select}\nFROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"


def write_yearly_projects(orders: DataFrame, customer: DataFrame, root: str,
                          schema_names: list[str]) -> str:
    """Yearly project extracts: declared order before 2000 (odd years reversed),
    the four extra columns appended from 2000 on."""
    parts = _parts(orders)
    joined = (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
              .join(customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")))
    joined = stage(joined, "orders-with-customers")  # joined once for all layouts
    text = {n: (expr if expr is not None else F.lit(None).cast("string")).alias(n)
            for n, expr in _project_text().items()}
    extras = {
        "FUNDING_MECHANISM": F.lit("Research Grants"),
        "ORG_IPF_CODE": F.col("c_custkey").cast("string"),
        "DIRECT_COST_AMT": F.round(F.col("o_totalprice") * 0.7, 2).cast("string"),
        "INDIRECT_COST_AMT": F.round(F.col("o_totalprice") * 0.3, 2).cast("string"),
    }
    fy = F.year("o_orderdate")
    layouts = {
        "early_even": ((fy < 2000) & (fy % 2 == 0), list(schema_names)),
        "early_odd": ((fy < 2000) & (fy % 2 == 1), list(reversed(schema_names))),
        "late": (fy >= 2000, list(schema_names) + PROJECT_EXTRAS),
    }
    for cond, names in layouts.values():
        exprs = [text[n] if n in text else extras[n].alias(n) for n in names]
        # the narrow rows are dealt and sorted; the text of 42 columns is made of them while it is written
        part = (joined.where(cond).withColumn("FYEAR", fy)
                .repartitionByRange(parts, "FYEAR", "o_orderkey")
                .sortWithinPartitions("FYEAR", "o_orderkey"))
        write_csv(part.select("FYEAR", *exprs), root, mode="append", partition_by=["FYEAR"])
    return root
