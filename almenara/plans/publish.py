"""Safe replacement of all tables of a run: written beside the old ones, then published.

Every run writes its tables to a folder of its own. Once all are written, one
row is appended to a small log table; that one commit makes the run the current
one. A run that fails midway leaves no row in the log, so readers go on with
the tables of the run before, which nothing has touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.plans.tables import folder_of, write_tables

_LOG = "NUMERO bigint, VERSION string, TABLA string, CARPETA string"


def _log_folder(config: Mapping[str, str]) -> str:
    return f"{folder_of(config, 'data_dashboard')}/_versiones"


def published(spark: SparkSession, config: Mapping[str, str]) -> DataFrame:
    """The log: one row per run and table, with the number of the run and the table's folder."""
    try:
        return spark.read.schema(_LOG).parquet(_log_folder(config))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def current_paths(spark: SparkSession, config: Mapping[str, str]) -> dict[str, str]:
    """Table -> folder of the last run that was published; none before the first.

    Of two runs that were published under one number at the same time, the one
    with the greater version name counts, for all tables alike.
    """
    log = published(spark, config)
    last = log.orderBy(F.desc("NUMERO"), F.desc("VERSION")).limit(1).select("VERSION")
    return {r.TABLA: r.CARPETA for r in log.join(last, "VERSION", "left_semi").collect()}


def publish_tables(spark: SparkSession, df: pd.DataFrame | DataFrame, config: Mapping[str, str], **options) -> dict[str, str]:
    """``write_tables`` to new folders, published together at the end; returns table -> path.

    ``options`` are those of ``write_tables``, but for modes and resets: each
    run replaces all tables. Older versions stay until ``retired`` ones are
    deleted by whoever owns the folders.
    """
    version = uuid.uuid4().hex
    own = {
        **config,
        "data_procesada": f"{folder_of(config, 'data_procesada')}/version={version}",
        "data_dashboard": f"{folder_of(config, 'data_dashboard')}/version={version}",
    }
    paths = write_tables(spark, df, own, **options)
    number = published(spark, config).agg(F.coalesce(F.max("NUMERO"), F.lit(0))).first()[0] + 1
    rows = [(number, version, name, path) for name, path in paths.items()]
    # one file and one commit: readers see all tables of the run or none
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").parquet(_log_folder(config))
    return paths


def retired(spark: SparkSession, config: Mapping[str, str], keep: int = 2) -> DataFrame:
    """Folders of published runs older than the last ``keep``, by the log: what may be deleted."""
    log = published(spark, config)
    kept = log.select("NUMERO", "VERSION").distinct().orderBy(F.desc("NUMERO"), F.desc("VERSION")).limit(keep).select("VERSION")
    return log.join(kept, "VERSION", "left_anti").select("VERSION", "TABLA", "CARPETA")
