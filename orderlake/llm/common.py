"""What the operators share: reading tables, session settings, ASCII words."""

from __future__ import annotations

import gc
import sys
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import durable, shared_directory

__all__ = ["KEPT", "ROW", "ascii_lower", "durable", "forget", "read", "release", "settings", "shared_directory", "word_list"]

#: Name of the struct in which an operator carries a caller's whole row past its own columns.
ROW = "__row"

#: A Python worker gets batches of so many rows and so many bytes: long texts stay a bounded batch.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

#: Name of the module in which a Python worker keeps the encoders that serve several of its tasks.
KEPT = "_piece_ids"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def settings(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more, instead of at some later collection.

    The first collection frees the plans, the second one what they held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def forget() -> None:
    """Called in a task: its worker, which Spark uses again, lets go of the encoders that an earlier operator left in it."""
    sys.modules.pop(KEPT, None)


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return settings(spark).read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null stays null."""
    return F.translate(text, UPPER, UPPER.lower())


def word_list(text: Column, pattern: str = r"[^\x20\x09-\x0D]+") -> Column:
    """All matches of ``pattern`` in order; a null text has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))
