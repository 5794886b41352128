"""Versioned tables without a transactional table format.

Layout below the store root (a folder in the shared checkpoint area by default):

    <name>/v=<n>/          immutable Parquet data of version n
    <name>/_versions/      one small Parquet file per publish, label or drop: version, label, path,
                           bucketing, key, NOT NULL columns, status
    <name>/_ledger/        files ingested per run: file_name, size, modified, version, run

Publishing writes a new version folder, then records it and points the catalog
table ``<name>`` at it (``ALTER TABLE ... SET LOCATION``).  The number of a version
is the next free one past every logged version and every folder, and its folder
is created, never replaced, so a failure mid-write or another writer leaves all
versions intact.  NOT NULL columns (the key among them) are kept in the log and
observed while a version is written; a version that breaks them is not published.
A drop is recorded too: later readers and loads start from nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabulon.schema import ddl
from tabulon.session import child_names, path_exists, qualified, remove_path, scratch_path

VERSIONS_SCHEMA = ("version long, label date, path string, created timestamp, "
                   "bucket_keys string, buckets int, entry long, status string, keys string, not_null string")
LEDGER_SCHEMA = "file_name string, size long, version long, run long, modified timestamp"
LIVE, DROPPED = "live", "dropped"


class NullViolation(ValueError):
    """A version holds NULL in a NOT NULL column."""


def declared_properties(schema: StructType, keys=None) -> dict[str, str]:
    """The key and the columns that may not be NULL (the declared ones and the key)."""
    required = [f.name for f in schema.fields if not f.nullable]
    required += [k for k in keys or [] if k.lower() not in {r.lower() for r in required}]
    return {"not_null": ",".join(required), "keys": ",".join(keys or [])}


def _props_sql(properties: dict[str, str]) -> str:
    return ", ".join(f"'tabulon.{k}' = '{v}'" for k, v in properties.items() if v)


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None, register: bool = True):
        self.spark = spark
        self.root = qualified(spark, root or scratch_path(spark, "tables")).rstrip("/")
        self.register = register
        # Log entries by table, with the names of the log files they were read from.
        self._log: dict[str, tuple[list[str], list[dict]]] = {}

    # -- paths and bookkeeping -------------------------------------------------
    def _dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read_log(self, folder: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def versions(self, name: str) -> DataFrame:
        return self._read_log(f"{self._dir(name)}/_versions", VERSIONS_SCHEMA)

    def _entries(self, name: str) -> list[dict]:
        """All log entries in order; read again whenever the log has other files than before."""
        files = child_names(self.spark, f"{self._dir(name)}/_versions")
        if self._log.get(name, (None, []))[0] != files:
            rows = [r.asDict() for r in self.versions(name).collect()]
            self._log[name] = files, sorted(rows, key=lambda e: (e["entry"] or 0, e["created"]))
        return self._log[name][1]

    def _live(self, name: str) -> list[dict]:
        """Entries since the table was last dropped."""
        entries = self._entries(name)
        dropped = [i for i, e in enumerate(entries) if e["status"] == DROPPED]
        return entries[dropped[-1] + 1:] if dropped else entries

    def current_version(self, name: str) -> int | None:
        versions = [e["version"] for e in self._live(name)]
        return max(versions) if versions else None

    def _next_version(self, name: str) -> int:
        logged = [e["version"] for e in self._entries(name)]
        written = [int(n[2:]) for n in child_names(self.spark, self._dir(name)) if n[:2] == "v=" and n[2:].isdigit()]
        return max([-1, *logged, *written]) + 1

    def declared(self, name: str) -> dict[str, str]:
        """``not_null`` and ``keys`` of the current table, as comma-separated names."""
        rows = [e for e in self._live(name) if e["not_null"] is not None]
        return {k: rows[-1][k] or "" for k in ("not_null", "keys")} if rows else {"not_null": "", "keys": ""}

    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    def _catalog_point(self, name: str, path: str, schema: StructType,
                       bucket_keys: list[str] | None = None, buckets: int | None = None,
                       properties: dict[str, str] | None = None) -> None:
        if not self.register:
            return
        if self.spark.catalog.tableExists(name):
            same_shape = (self.spark.table(name).schema == schema
                          and self._catalog_buckets(name) == (bucket_keys or None, buckets if bucket_keys else None))
            if same_shape:
                # Readers see the old or the new version, never no table.
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                if sql := _props_sql(properties or {}):
                    self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({sql})")
                self.spark.catalog.refreshTable(name)
                return
            self.spark.sql(f"DROP TABLE {name}")
        self.spark.sql(self._create_sql(name, path, schema, bucket_keys, buckets, properties))

    def _catalog_buckets(self, name: str) -> tuple:
        rows = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        if "Num Buckets" not in rows:
            return (None, None)
        cols = rows.get("Bucket Columns", "").strip("[]").replace("`", "")
        return ([c.strip() for c in cols.split(",") if c.strip()], int(rows["Num Buckets"]))

    @staticmethod
    def _create_sql(name, path, schema, bucket_keys=None, buckets=None, properties=None) -> str:
        clustered = ""
        if bucket_keys:
            cols = ", ".join(f"`{k}`" for k in bucket_keys)
            clustered = f" CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {buckets} BUCKETS"
        props = f" TBLPROPERTIES ({sql})" if (sql := _props_sql(properties or {})) else ""
        return (f"CREATE TABLE {name} ({ddl(schema)}) USING parquet{clustered} "
                f"LOCATION '{path}'{props}")

    # -- lifecycle ---------------------------------------------------------------
    def publish(self, name: str, df: DataFrame, label: dt.date | str | None = None,
                bucket_keys: list[str] | None = None, buckets: int | None = None,
                properties: dict[str, str] | None = None) -> int:
        """Write ``df`` as the next version and make it current; returns its number.

        With ``bucket_keys`` the version is written as a bucketed table
        (``bucketBy(buckets, *keys)``): a later join or upsert on the key reads it
        already hash-partitioned, so only the other side is shuffled.
        """
        version = self._next_version(name)
        path = f"{self._dir(name)}/v={version}"
        declared = properties or self.declared(name)
        have = {c.lower(): c for c in df.columns}
        required = [have[c.lower()] for c in declared["not_null"].split(",") if c.lower() in have]
        nulls = Observation()
        checked = df
        if required:
            checked = df.observe(nulls, *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        table = self._version_table(name, version)
        if bucket_keys:
            buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            (checked.write.format("parquet").mode("errorifexists")
             .bucketBy(buckets, *bucket_keys).sortBy(*bucket_keys)
             .option("path", path).saveAsTable(table))
        else:
            checked.write.mode("errorifexists").parquet(path)
        broken = {c: n for c, n in nulls.get.items() if n} if required else {}
        if broken:
            if bucket_keys:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove_path(self.spark, path)
            raise NullViolation(f"{name}: NULL in NOT NULL columns {broken}")
        self._log_version(name, version, label, path, bucket_keys, buckets, declared=declared)
        self._catalog_point(name, path, df.schema, bucket_keys, buckets, declared)
        return version

    def _version_table(self, name: str, version: int) -> str:
        """Catalog name of one bucketed version, unique per store root."""
        import hashlib

        tag = hashlib.sha1(self.root.encode()).hexdigest()[:10]
        return f"{name}__{tag}__v{version}"

    def _log_version(self, name, version, label, path, bucket_keys=None, buckets=None, status=LIVE,
                     declared=None) -> None:
        if isinstance(label, str):
            label = dt.date.fromisoformat(label)
        entry = (version, label, path, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                 ",".join(bucket_keys) if bucket_keys else None, buckets if bucket_keys else None,
                 len(self._entries(name)), status, *((declared["keys"], declared["not_null"]) if declared
                                                     else (None, None)))
        record = self.spark.createDataFrame([entry], VERSIONS_SCHEMA)
        record.coalesce(1).write.mode("append").parquet(f"{self._dir(name)}/_versions")

    def bucketing(self, name: str, version: int | None = None) -> tuple[list[str], int] | None:
        """``(keys, buckets)`` of a version written bucketed, else None."""
        version = self.current_version(name) if version is None else version
        rows = [e for e in self._live(name) if e["version"] == version]
        if not rows or not rows[-1]["bucket_keys"]:
            return None
        return rows[-1]["bucket_keys"].split(","), int(rows[-1]["buckets"])

    def create_if_absent(self, name: str, schema: StructType | str,
                         keys: list[str] | tuple[str, ...] | None = None, **publish_options) -> bool:
        """An empty, typed table unless one exists; existing data is untouched.

        The key and the declared NOT NULL columns are kept in the version log and
        as table properties (Parquet files do not keep NOT NULL); every later
        publish is checked against them.
        """
        if self.exists(name):
            return False
        empty = self.spark.createDataFrame([], schema)
        self.publish(name, empty, properties=declared_properties(empty.schema, keys), **publish_options)
        return True

    def read(self, name: str, version: int | None = None) -> DataFrame:
        version = self.current_version(name) if version is None else version
        if version is None:
            raise KeyError(f"table {name!r} has no version")
        path = f"{self._dir(name)}/v={version}"
        spec = self.bucketing(name, version)
        if spec is None:
            return self.spark.read.parquet(path)
        table = self._version_table(name, version)
        if not self.spark.catalog.tableExists(table):
            schema = self.spark.read.parquet(path).schema
            self.spark.sql(self._create_sql(table, path, schema, spec[0], spec[1]))
        return self.spark.table(table)

    def replace(self, name: str, df: DataFrame) -> int:
        """Create-or-replace from a query (safe even when ``df`` reads ``name``)."""
        return self.publish(name, df)

    def reset(self, name: str) -> int:
        """Delete all rows, keeping schema, bucketing and history."""
        spec = self.bucketing(name)
        return self.publish(name, self.spark.createDataFrame([], self.read(name).schema),
                            bucket_keys=spec[0] if spec else None, buckets=spec[1] if spec else None)

    def drop(self, name: str) -> None:
        """The table is gone; its versions, labels and ledger are retired, its files are left alone."""
        version = self.current_version(name)
        if version is not None:
            self._log_version(name, version, None, f"{self._dir(name)}/v={version}", status=DROPPED)
        if self.register:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    # -- snapshots ---------------------------------------------------------------
    def label(self, name: str, version: int, label: dt.date | str) -> None:
        """Give an existing version a dated label (a new bookkeeping row)."""
        spec = self.bucketing(name, version)
        self._log_version(name, version, label, f"{self._dir(name)}/v={version}",
                          spec[0] if spec else None, spec[1] if spec else None)

    def as_of(self, name: str, when: dt.date | str) -> DataFrame:
        """The version carrying the greatest label on or before ``when``."""
        if isinstance(when, str):
            when = dt.date.fromisoformat(when)
        labelled = [e for e in self._live(name) if e["label"] is not None and e["label"] <= when]
        if not labelled:
            raise KeyError(f"table {name!r} has no snapshot on or before {when}")
        best = max(labelled, key=lambda e: (e["label"], e["version"]))
        return self.read(name, int(best["version"]))

    # -- inspection ----------------------------------------------------------------
    def detail(self, name: str) -> DataFrame:
        """T4: format, location, version, files, bytes, columns of the current version."""
        version = self.current_version(name)
        path = f"{self._dir(name)}/v={version}"
        files = (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .load(path).select("length"))
        n_cols = len(self.read(name, version).columns)
        return files.agg(F.count(F.lit(1)).alias("num_files"),
                         F.coalesce(F.sum("length"), F.lit(0)).alias("size_in_bytes")).select(
            F.lit(name).alias("name"), F.lit("parquet").alias("format"),
            F.lit(path).alias("location"), F.lit(version).cast("long").alias("version"),
            "num_files", "size_in_bytes", F.lit(n_cols).alias("num_columns"))

    def describe(self, name: str) -> DataFrame:
        """T5: ``DESCRIBE TABLE EXTENDED`` of the catalog table."""
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")

    # -- ingest ledger (replaces a manual start index) -----------------------------
    def ledger(self, name: str) -> DataFrame:
        """Files ingested since the table was last dropped."""
        retired = max([e["version"] for e in self._entries(name) if e["status"] == DROPPED], default=-1)
        return self._read_log(f"{self._dir(name)}/_ledger", LEDGER_SCHEMA).where(F.col("version") > retired)

    def record_files(self, name: str, files: DataFrame, version: int, run: int) -> None:
        """``files`` has ``file_name, size, modified``."""
        (files.select("file_name", "size", F.lit(version).cast("long").alias("version"),
                      F.lit(run).cast("long").alias("run"), "modified")
         .write.mode("append").parquet(f"{self._dir(name)}/_ledger"))
