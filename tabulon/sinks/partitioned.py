"""A keyed table whose upserts read and write only the partitions that they touch (J1, X1 at scale).

The master is a catalog table partitioned by a number derived from the key.  An upsert finds
the partitions its rows fall into, merges them with those partitions alone, writes the result to a
new folder, and then moves just these partitions there: Spark's catalog keeps a location for each partition
(``ALTER TABLE ... PARTITION ... SET LOCATION``), so there is no log of our own and
untouched partitions keep their files.

Which expression of the key to take decides the cost of a small update.  A range of the key (``k div 1000000``) or
a date lets updates that are close in key touch few partitions.  A hash of the key
(``pmod(xxhash64(k), 256)``, the default form) spreads them: once an update has more rows than there
are partitions it touches nearly all of them, and costs a rewrite of the table, as ``TableStore.publish`` does.

Data is complete in its folder before any partition moves.  Partitions move one by one: a reader in
between may see some moved and some not, and a run that fails there is repeated (merging the same
rows twice gives the same table).  One writer at a time.  Folders left behind are not removed,
as readers may still be in them.  The table lives as long as the session's catalog does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabulon.operators.conform import conform_to_target
from tabulon.operators.merge import upsert
from tabulon.schema import ddl
from tabulon.session import qualified, scratch_path

PART = "_part"
# More partitions than this in one update set are an error: the expression is too fine.
MAX_PARTITIONS = 100_000
_NAMES_PER_COMMAND = 500


def hashed(keys: list[str], partitions: int) -> str:
    """The partition expression that spreads any keys evenly."""
    return f"pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {partitions})"


class PartitionedTable:
    """``name`` in the session's catalog; ``part`` is a SQL expression over the key columns."""

    def __init__(self, spark: SparkSession, name: str, schema: StructType, keys: list[str], part: str,
                 root: str | None = None):
        self.spark, self.name, self.keys, self.part = spark, name, list(keys), part
        self.schema = StructType([f for f in schema.fields if f.name.lower() != PART])
        self.root = qualified(spark, root or scratch_path(spark, name)).rstrip("/")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(self.schema)}, {PART} BIGINT) USING parquet "
                  f"PARTITIONED BY ({PART}) LOCATION '{self.root}/table'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(PART)

    def partitions(self) -> set[int]:
        """Numbers of the partitions that the catalog knows (metadata only)."""
        return {int(r[0].split("=", 1)[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def part_of(self) -> Column:
        """The partition number of a row; rows whose expression is NULL share number -1."""
        return F.coalesce(F.expr(self.part).cast("bigint"), F.lit(-1))

    def upsert(self, source: DataFrame, check: bool = True) -> list[int]:
        """J1 into the touched partitions; returns their numbers.  ``source`` is read several times: stage a costly one."""
        rows = conform_to_target(source, self.schema).withColumn(PART, self.part_of())
        touched = sorted(r[0] for r in rows.select(PART).distinct().limit(MAX_PARTITIONS + 1).collect())
        if len(touched) > MAX_PARTITIONS:
            raise ValueError(f"an update of {self.name} touches more than {MAX_PARTITIONS} partitions by {self.part}")
        if not touched:
            return []
        # a filter of literals on the partition column: the other partitions are not listed, let alone read
        target = self.spark.table(self.name).where(F.col(PART).isin(touched))
        merged = upsert(target, rows, [*self.keys], check=check)
        self._write(merged, touched)
        return touched

    def _write(self, rows: DataFrame, touched: list[int]) -> None:
        folder = f"{self.root}/update-{uuid.uuid4().hex[:12]}"
        # AQE deals rows by partition: large partitions are split over tasks, small ones share one
        rows.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)
        known = self.partitions()
        at = lambda i: f"PARTITION ({PART}={i})"
        added = [i for i in touched if i not in known]
        for lo in range(0, len(added), _NAMES_PER_COMMAND):
            self.spark.sql(f"ALTER TABLE {self.name} ADD " + " ".join(
                f"{at(i)} LOCATION '{folder}/{PART}={i}'" for i in added[lo:lo + _NAMES_PER_COMMAND]))
        for i in touched:
            if i in known:
                self.spark.sql(f"ALTER TABLE {self.name} {at(i)} SET LOCATION '{folder}/{PART}={i}'")
        self.spark.catalog.refreshTable(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
