"""Ingest files as they arrive, with Structured Streaming.

The stream carries only the file listing (``binaryFile`` with ``path``,
``length``, ``modificationTime`` selected, so contents are not read by the
stream).  Each micro-batch hands its new files to the batch ``ingest``: one
reader per header, gates, keep-last, upsert, new table version, ledger rows.
This replaces the manual start index of a notebook loop.

Order: the file source delivers files by modification time; inside a
micro-batch files are applied in name order, across micro-batches in arrival
order (a late file wins over an earlier one, as when a loop processes it later).
A retried micro-batch re-applies the same upsert, which is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabulon.plans.ingest import ingest
from tabulon.schema import TableSpec
from tabulon.sinks.tables import TableStore
from tabulon.sources.files import inventory_from_listing


LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def start_arrivals(spark: SparkSession, spec: TableSpec, root: str, store: TableStore, *,
                   checkpoint: str, pattern: str = "*.csv", available_now: bool = True, files_per_batch: int | None = None,
                   interval: str = "1 minute", **ingest_options) -> StreamingQuery:
    """Start the arrival stream; ``available_now`` drains what exists and stops.

    ``checkpoint`` is a lasting folder of this stream: a restart goes on where it stopped.  Files
    that the table's ledger already has, as they are, are passed over even without it.
    """
    reader = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA)
              .option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    listing = reader.load(root).select("path", "length", "modificationTime",
                                       F.col("_metadata.file_path").alias("path_key"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        files = inventory_from_listing(batch, root).join(
            store.ledger(spec.name).select("file_name", "size", "modified"),
            ["file_name", "size", "modified"], "left_anti")
        if files.isEmpty():
            return
        ingest(store, spec, root, files=files, run=batch_id, **ingest_options)

    writer = (listing.writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
