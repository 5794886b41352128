"""The ingest pipeline.

``prepare`` (dry run, X3) turns a folder of extracts into one conformed,
de-duplicated update set; ``ingest`` (X1/X2) upserts it into the master and
publishes a version; ``resume`` ingests only files the ledger has not seen.

Sequential per-file MERGEs in file-name order equal one consolidated MERGE of
"the last row per key over all files" because ``UPDATE SET *`` replaces whole
rows: only the last file holding a key matters.  So the whole folder is one job:

    one CSV parse -> staged Parquet (gates observed on the way)
                  -> per repeated key the place of its last row (file, block, row): a map-side maximum
                  -> anti join + union against the master -> new version

instead of N merges that each rewrite the master.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tabulon.functions.dates import no_separator
from tabulon.operators.conform import check_columns, conform, extra_columns
from tabulon.operators.merge import upsert
from tabulon.operators.quality import GateFailed, repeated_keys
from tabulon.schema import TableSpec
from tabulon.session import remove_path, scratch_path, stage_to
from tabulon.sinks.tables import TableStore
from tabulon.sources.csv import (BLOCK, CORRUPT, FILE, ROW, SEQ, SOURCE, FileSet, read_csv_sources,
                                 scan_files)
from tabulon.sources.files import empty_files, file_inventory
from tabulon.sources.split_csv import read_csv_split


REJECTS = "_rejects"  # (column_name, text) of the values of a row that did not convert, else NULL


@dataclass
class Prepared:
    rows: DataFrame        # one row per key (NULL keys kept as SQL would insert them)
    typed: DataFrame       # every conformed row with _source, _file, _seq, _block, _row (staged)
    headers: DataFrame     # per file: path, header, source, file_name
    extras: DataFrame      # P3: (source, file_name, extra_column)
    inventory: DataFrame   # lazy listing (re-lists when evaluated)
    metrics: dict
    files: FileSet         # exactly the files that were read
    staging: str | None = None  # folder ``typed`` reads; ``ingest`` removes it when done
    empty: list[str] = field(default_factory=list)  # files without bytes: nothing to read, but delivered
    keys: DataFrame | None = None  # every key of ``typed`` once (staged below ``staging``)

    def reject_report(self, spark: SparkSession) -> DataFrame:
        """Per typed column, non-empty texts that did not convert.

        The counts were observed during the staging write; no extra pass.
        """
        rows = [(k[len("rejects_"):], int(v)) for k, v in sorted(self.metrics.items())
                if k.startswith("rejects_")]
        return spark.createDataFrame(rows, "column_name string, rejects long")

    def reject_sample(self, k: int = 20, by: str = FILE) -> DataFrame:
        """The ``k`` commonest texts that did not convert, per file (or ``by`` source) and column, with their number.

        Read from the stage, where only rows with rejects have any; counted map-side, and
        cut to ``k`` before they are ranked.
        """
        found = (self.typed.where(F.col(REJECTS).isNotNull()).select(by, F.explode(REJECTS).alias("r"))
                 .groupBy(by, "r.column_name", "r.text").agg(F.count(F.lit(1)).alias("n")))
        place = F.row_number().over(Window.partitionBy(by, "column_name").orderBy(F.desc("n"), "text"))
        return found.withColumn("rank", place).where(F.col("rank") <= k)


def prepare(spark: SparkSession, root: str, spec: TableSpec, *, pattern: str = "*.csv",
            files: DataFrame | None = None, on_duplicate: str = "fail",
            conform_mode: str = "report", on_cast_error: str = "null",
            on_malformed: str = "count", multi_line: bool | str = True) -> Prepared:
    """Read, gate, conform and de-duplicate; publish nothing.

    The input is parsed once and staged; all gates are observed on that write or
    read the stage.

    ``on_duplicate``: ``"fail"`` (a key repeated inside one extract, in whatever
    part files, aborts, Q1) or ``"keep_last"`` (the later row wins, A5).  Across
    extracts the later file name always wins.  ``on_malformed``: records with more or
    fewer fields than the header are counted in ``metrics["malformed"]``
    (``"count"``) or abort (``"fail"``).  ``multi_line=False`` reads large
    single-line extracts in parallel splits; a quoted line break leaves malformed
    fragments there, so any malformed record then aborts.  ``multi_line="split"`` reads multi-line extracts in
    parallel splits, too, at the price of one more pass that counts quotes.  Row order is kept in every case.
    """
    keys = list(spec.keys)
    inventory = files if files is not None else file_inventory(spark, root, pattern)
    files_set = scan_files(inventory, root)
    for header, paths in files_set.groups():
        check_columns(header, spec.schema, conform_mode, where=paths[0])
    empty = empty_files(spark, root, pattern, {f["file_name"] for f in files_set.files}) if files is None else []
    if multi_line == "split":
        raw = read_csv_split(spark, files_set)
    else:
        raw = read_csv_sources(spark, files_set, multiLine=str(multi_line).lower())

    # Q2 and row counts are observed during the staging write: no extra pass.
    date_cols = spec.fields_of(DateType)
    resolved = {c.lower(): c for c in raw.columns}
    obs = Observation("ingest_gates")
    observed = raw.observe(
        obs, F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"),
        *[F.max(F.length(F.col(resolved[d.lower()]))).alias(f"len_{d}") for d in date_cols],
        *[F.count_if(no_separator(F.col(resolved[d.lower()]))).alias(f"no_separator_{d}") for d in date_cols])
    rejects = Observation("ingest_rejects")
    typed = conform(observed, spec.schema, mode=conform_mode, on_cast_error=on_cast_error,
                    keep=[SOURCE, FILE, SEQ, BLOCK, ROW], observation=rejects, rejects=REJECTS)
    no_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key_obs = Observation("ingest_keys")
    staging = scratch_path(spark, "ingest-stage")
    typed = stage_to(typed.observe(key_obs, F.count_if(~no_null).alias("null_keys")), f"{staging}/rows")
    metrics = {**obs.get, **rejects.get, **key_obs.get, "empty_files": len(empty)}
    try:
        _check_date_lengths(metrics, spec.date_text_max)
        if metrics["malformed"] and (on_malformed == "fail" or not multi_line):
            raise GateFailed(f"{metrics['malformed']} records do not have their header's fields")
        if spec.null_keys == "fail" and metrics["null_keys"]:
            # Observed during staging; the sample is only looked up when there is one.
            bad = typed.where(~no_null).select(FILE, BLOCK, ROW).limit(5).collect()
            raise GateFailed(f"NULL key {keys} in {[tuple(r) for r in bad]}")
        distinct_keys, repeated, places = _per_key(typed, no_null, keys, f"{staging}/keys")
        if on_duplicate == "fail" and repeated:
            dup = repeated_keys(typed.where(no_null), SOURCE, keys).limit(20).collect()
            raise GateFailed(f"key {keys} not unique within an extract: {[tuple(r) for r in dup]}")
    except GateFailed:
        # A failed gate publishes nothing, so its staged copy is not kept either.
        remove_path(spark, staging)
        raise

    rows = typed
    if places is not None:
        # only places travel besides the rows; a place is unique, so there is no hot key here
        rows = typed.where(no_null).join(places[0], [SEQ, BLOCK, ROW], places[1])
        if metrics["null_keys"]:
            rows = rows.unionByName(typed.where(~no_null).select(*rows.columns))
    headers = files_set.headers(spark)
    return Prepared(rows.select(*spec.names), typed, headers, extra_columns(headers, spec.schema), inventory, metrics,
                    files_set, staging, empty, distinct_keys)


def _per_key(typed: DataFrame, no_null: Column, keys: list[str], path: str) -> tuple[DataFrame, int, tuple[DataFrame, str] | None]:
    """Q1, the keys and the winners from aggregates over the staged narrow columns, stored below ``path``.

    The keys; the number of them that an extract repeats (a key has more rows than extracts); and where a key has several
    rows, a table of places with the join that leaves the last row of each key.  Keys are first counted, by hash; places and
    extracts are gathered only for rows of repeated keys, or for all where these are most.
    """
    place = [SEQ, BLOCK, ROW]
    rows = typed.where(no_null).select(*keys, SOURCE, *place)
    seen = Observation("ingest_per_key")
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).observe(
        seen, F.count_if(F.col("n") > 1).alias("keys"), F.sum("n").alias("rows"),
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("repeated"))
    per_key = stage_to(counted, f"{path}/counts")
    found = seen.get
    if not found["keys"]:
        return per_key.select(*keys), 0, None

    few = 2 * found["repeated"] < found["rows"]
    if few:
        rows = rows.join(per_key.where("n > 1").select(*keys), keys, "left_semi")
    sources = Observation("ingest_sources")
    last = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.size(F.collect_set(SOURCE)).alias("sources"),
                                   F.max(F.struct(*place)).alias("last"))
    last = stage_to(last.observe(sources, F.count_if(F.col("n") > F.col("sources")).alias("repeated")), f"{path}/last")
    if few:
        earlier = rows.join(last.select(*keys, "last"), keys).where(F.struct(*place) < F.col("last")).select(*place)
        places = stage_to(earlier, f"{path}/earlier"), "left_anti"
    else:
        places = last.select(*[F.col(f"last.{c}").alias(c) for c in place]), "left_semi"
    return per_key.select(*keys), sources.get["repeated"], places


def _check_date_lengths(metrics: dict, limit: int) -> None:
    """Q2: no date text longer than ``limit``; an all-NULL column passes."""
    too_long = {k: v for k, v in metrics.items()
                if k.startswith("len_") and v is not None and v > limit}
    if too_long:
        raise GateFailed(f"date text longer than {limit}: {too_long}")


def ingest(store: TableStore, spec: TableSpec, root: str, *, files: DataFrame | None = None,
           label: str | None = None, run: int | None = None, **options) -> int:
    """Upsert every file below ``root`` (or ``files``) into the master."""
    spark = store.spark
    keys = list(spec.keys)
    # an existing bucketed master stays as it is bucketed, unless the spec says otherwise
    buckets = spec.buckets or (store.bucketing(spec.name) or (None, None))[1]
    bucket_keys = keys if buckets else None
    store.create_if_absent(spec.name, spec.schema, keys if spec.null_keys == "fail" else None,
                           bucket_keys=bucket_keys, buckets=buckets)
    prep = prepare(spark, root, spec, files=files, **options)
    try:
        master = store.read(spec.name)
        merged = upsert(master, prep.rows, keys, check=False, partitions=buckets,
                        key_side=prep.keys)
        version = store.publish(spec.name, merged, label=label, bucket_keys=bucket_keys, buckets=buckets)
        run = version if run is None else run
        # The ledger records the files actually read, not a fresh listing.
        store.record_files(spec.name, prep.files.listing(spark), version, run)
    finally:
        # The staged copy of the input is read by nothing once the version is written.
        if prep.staging:
            remove_path(spark, prep.staging)
    return version


def watermark(store: TableStore, spec: TableSpec, lookback: timedelta) -> datetime | None:
    """The youngest file in the ledger, less ``lookback``; None where no file is recorded.

    The ledger is aggregated in Spark; one number reaches the driver.
    """
    last = store.ledger(spec.name).agg(F.unix_seconds(F.max("modified"))).first()[0]
    return None if last is None else datetime.fromtimestamp(last, timezone.utc) - lookback


def pending_files(store: TableStore, spec: TableSpec, root: str, pattern: str = "*.csv",
                  lookback: timedelta | None = None) -> DataFrame:
    """S4 resume: files below ``root`` that the ledger has not recorded as they are now.

    A file delivered again under its name, with another size or time, is pending again.
    Without ``lookback`` every file is compared.  With it, only files younger than the youngest recorded one
    less ``lookback`` are listed and compared with the ledger's rows of that time, so a run costs what is new and
    not what was ever delivered.  A file that arrives with an older time (copied with its time kept, say) is not
    seen then; a call without ``lookback``, now and then, finds it.
    """
    after = None if lookback is None else watermark(store, spec, lookback)
    inventory = file_inventory(store.spark, root, pattern, after)
    done = store.ledger(spec.name).select("file_name", "size", "modified")
    if after is not None:
        done = done.where(F.col("modified") > F.timestamp_seconds(F.lit(int(after.timestamp()))))
    return inventory.join(done, ["file_name", "size", "modified"], "left_anti")


def resume(store: TableStore, spec: TableSpec, root: str, pattern: str = "*.csv",
           lookback: timedelta | None = None, **options) -> int | None:
    """Ingest only the files not yet in the ledger; returns the new version.  ``lookback``: see ``pending_files``."""
    todo = pending_files(store, spec, root, pattern, lookback)
    if todo.isEmpty():
        return store.current_version(spec.name)
    return ingest(store, spec, root, files=todo, **options)
