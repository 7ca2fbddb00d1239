"""Parquet tables and frames handed over by the caller."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almenara.schema import AGGREGATE_TABLES, aggregate_schema


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_totals(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A stored totals table, group keys first.

    The schema is given, so partition values keep their types: a key written
    as the text ``1`` comes back as text.
    """
    keys = list(AGGREGATE_TABLES[name][1])
    return read_parquet(spark, path, aggregate_schema(name)).select(*keys, "TOTAL")


def as_spark_frame(spark: SparkSession, df: pd.DataFrame | DataFrame) -> DataFrame:
    """A Spark frame as it is; a pandas frame as an all-text Spark frame."""
    if isinstance(df, DataFrame):
        return df
    if not isinstance(df, pd.DataFrame):
        raise TypeError("expected a pandas or Spark DataFrame")
    schema = T.StructType([T.StructField(str(c), T.StringType()) for c in df.columns])
    texts = df.astype(object).map(lambda v: None if pd.isna(v) else str(v))
    return spark.createDataFrame(texts.where(texts.notna(), None), schema)


def _from_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table whose plain minima, maxima and counts come from the footers of its files.

    It belongs to a session of its own, as the two settings behind it must not
    change how the caller's tables are read.
    """
    footers = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        footers.conf.set(key, spark.conf.get(key))
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers.read.parquet(path)


def stored_bounds(spark: SparkSession, path: str, column: str = "FECHA") -> DataFrame:
    """``FECHA_MIN``, ``FECHA_MAX`` and ``FILAS`` of a stored table.

    Without nulls in the column, which the footers tell, scan and aggregate are
    one node of the plan and no column is read. A row group of nulls has no
    bounds in its footer, so with nulls the one column is scanned. The counts
    are read at the call.
    """
    table = _from_footers(spark, path)
    rows, values = table.agg(F.count(F.lit(1)), F.count(F.col(f"`{column}`"))).first()
    if not rows or rows > values:
        table = read_parquet(spark, path, table.schema)
    return table.agg(F.min(F.col(f"`{column}`")).alias("FECHA_MIN"), F.max(F.col(f"`{column}`")).alias("FECHA_MAX"), F.count(F.lit(1)).alias("FILAS"))
