"""Session construction and the shared scratch area.

All intermediate files (staged Parquet, generated CSV, extracted archives,
published table versions in tests) live under the folder the cluster names in
``spark.checkpoint.dir``.  That folder is shared by every executor; a
machine-local temporary folder would not survive the loss of the machine that
wrote it.  Only when the setting is absent (a laptop or a unit test) do we
create one.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", app: str = "tabulon",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session configured the way the library expects.

    ``spark.sql.adaptive.*`` stays on so AQE can coalesce small shuffles, split
    skewed join partitions and switch a join to broadcast when the measured
    (not estimated) size of one side is small.
    """
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tabulon`` importable in Python workers (once per SparkContext).

    Python code that runs in tasks (``mapInPandas``, pandas UDFs) refers to this
    package's functions; ``addPyFile`` distributes a zip of it with the job.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tabulon-pkg-"), "tabulon.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch data.

    Read from the session; set our own only when the cluster names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tabulon-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_RECORDERS: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    path = f"{checkpoint_root(spark)}/tabulon/{label}-{uuid.uuid4().hex[:12]}"
    for paths in _RECORDERS:
        paths.append(path)
    return path


@contextlib.contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """Collects the scratch folders named within, so that the caller can remove them once done."""
    paths: list[str] = []
    _RECORDERS.append(paths)
    try:
        yield paths
    finally:
        _RECORDERS.remove(paths)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    This cuts lineage (a lost executor re-reads the file instead of re-running
    the whole plan) and lets one expensive scan feed several consumers, with
    column pruning and filter pushdown on the re-read.
    """
    return stage_to(df, scratch_path(df.sparkSession, label))


def stage_to(df: DataFrame, path: str) -> DataFrame:
    """``stage`` into a given folder (the caller removes it when done)."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` as Spark itself resolves ``path``: ``fs.defaultFS`` where it has no scheme."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, so that tasks resolve it as the driver does."""
    return hadoop_path(spark, path)[1].toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    fs, target = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on the cluster's file system (HDFS/S3/ABFS or local)."""
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)
