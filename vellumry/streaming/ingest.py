"""Resumable ingestion: each file of a growing folder is read once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_json(spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str) -> None:
    """Read the JSON files that are new since the last call into a Parquet table, then stop."""
    new = spark.readStream.schema(schema).option("multiLine", True).json(folder)
    q = new.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def wanted_but_missing(wanted: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Batch form: the keys that are still to be fetched."""
    return wanted.join(there, key, "left_anti")
