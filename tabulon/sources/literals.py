"""DataFrames from literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def literal_frame(spark: SparkSession, rows: list, schema: StructType | str | None = None,
                  names: list[str] | None = None) -> DataFrame:
    """Rows plus an optional DDL / StructType schema, optionally renamed by position.

    ``literal_frame(spark, [], "code SMALLINT NOT NULL, label STRING", ["id", "city"])``
    gives the typed empty frame ``id SMALLINT NOT NULL, city STRING``.
    """
    df = spark.createDataFrame(rows, schema) if schema is not None else spark.createDataFrame(rows)
    return df.toDF(*names) if names else df
