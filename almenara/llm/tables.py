"""Row keys, intermediate tables and other helpers that the operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.session import scratch_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, lost executors cost nothing."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text_col: str) -> Column:
    """A text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")


def row_key(id_col: str, text_col: str) -> Column:
    """Key of a row by its id and text: rows that repeat share it, rows that differ in either do not."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def same_row(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``_id`` (null equals null) and ``_key``; the right side's key columns go."""
    right = right.withColumnsRenamed({"_id": "_id_r", "_key": "_key_r"})
    on = left["_key"].eqNullSafe(right["_key_r"]) & left["_id"].eqNullSafe(right["_id_r"])
    return left.join(right, on, how).drop("_id_r", "_key_r")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Lets go of what finished steps left in the driver.

    Python's references to plans go first; with them collected in the JVM,
    Spark's cleaner drops the shuffle files and broadcasts of these plans.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
