"""Shorthand of the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from vellumry.plans.registry import query  # noqa: F401
from vellumry.session import table  # noqa: F401


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]
