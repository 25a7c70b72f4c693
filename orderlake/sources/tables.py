"""Parquet tables: full refresh, month-partitioned refresh, and counts taken on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .buckets import BUCKET, pointer, read_buckets
from .files import exists, partition_values, remove


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are filled in by whatever job runs it: no second pass."""
    observation = Observation()
    return df.observe(observation, *(c.alias(n) for n, c in metrics.items())), observation


def read_table(spark: SparkSession, location: str) -> DataFrame:
    """A table as last written, whether in buckets or as plain files."""
    now = pointer(spark, location)
    return read_buckets(spark, location, at=now).drop(BUCKET) if now else spark.read.parquet(location)


def table_exists(spark: SparkSession, location: str) -> bool:
    return exists(spark, location)


def write_table(df: DataFrame, location: str) -> int:
    """Replace a table; returns its row count."""
    watched, metrics = observed(df, rows=F.count(F.lit(1)))
    watched.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(location)
    return metrics.get["rows"]


def write_months(df: DataFrame, location: str, month: str, whole: bool) -> None:
    """Replace a month-partitioned table, or (``whole`` false) only the months ``df`` has."""
    mode = "static" if whole else "dynamic"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(month).parquet(location)


def mart_months(spark: SparkSession, location: str, month: str) -> list[str]:
    return partition_values(spark, location, month)


def remove_months(spark: SparkSession, location: str, month: str, values: list[str]) -> None:
    for value in values:
        remove(spark, f"{location}/{month}={value}")
