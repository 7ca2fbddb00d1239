"""From raw files to the general table and the stored totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.functions.codes import lenient_int
from almenara.functions.dates import safe_date
from almenara.operators.aggregates import merged_totals, one_set, totals_together
from almenara.operators.joins import map_totals
from almenara.operators.sinks import compact, write_clustered, write_parquet, write_partitioned
from almenara.operators.standardize import rejects, standardize
from almenara.schema import AGGREGATE_TABLES, DAY_FIRST_COLUMN
from almenara.session import scratch_folder
from almenara.sources.csv_folder import read_csv_folder
from almenara.sources.geojson import read_localities
from almenara.sources.tables import as_spark_frame, read_parquet, read_totals

#: fixed values: configuration keys and their default folders below ``base_path``
FOLDERS = {
    "data_cruda": "data/cruda",
    "data_procesada": "data/procesada",
    "data_dashboard": "data/dashboard",
    "data_complementaria": "data/complementaria",
}


def folder_of(config: Mapping[str, str], key: str) -> str:
    """Folder for a configuration key; absolute paths and URIs stay as they are."""
    folder = config.get(key) or FOLDERS[key]
    if folder.startswith("/") or "://" in folder:
        return folder.rstrip("/")
    if not config.get("base_path"):
        raise ValueError("the configuration lacks 'base_path'")
    return f"{config['base_path'].rstrip('/')}/{folder.strip('/')}"


class RawTables(NamedTuple):
    """What the raw folder holds: together every cell of it."""

    records: DataFrame
    #: one row per cell of ``records`` that holds something unreadable
    rejects: DataFrame
    #: records with more fields than their header, as they stand in the file
    malformed: DataFrame


def load_raw(spark: SparkSession, config: Mapping[str, str]) -> RawTables:
    """Raw incident table, its unreadable cells and the malformed records.

    ``records`` has a column more, ``DAY_FIRST_COLUMN``: the order of day and
    month of the row's file.
    """
    folder = read_csv_folder(spark, folder_of(config, "data_cruda"), day_first_column=DAY_FIRST_COLUMN)
    return RawTables(folder.records, rejects(folder.records), folder.malformed)


def retype(df: DataFrame) -> DataFrame:
    """``FECHA`` to date, ``HORA`` and ``EDAD`` to int, where present and not so yet."""
    wanted = {"FECHA": ("date", safe_date), "HORA": ("int", lenient_int), "EDAD": ("int", lenient_int)}
    have = dict(df.dtypes)
    casts = {c: read(c) for c, (kind, read) in wanted.items() if c in have and have[c] != kind}
    return df.withColumns(casts) if casts else df


def write_tables(
    spark: SparkSession,
    df: pd.DataFrame | DataFrame,
    config: Mapping[str, str],
    mode: str = "overwrite",
    reset_processed: bool = True,
    reset_dashboard: bool = True,
    general_folder: str = "incidentes",
    partition_by: Mapping[str, Sequence[str]] | None = None,
    cluster_by: str | None = None,
    lookup: Mapping[str, int] | None = None,
) -> dict[str, str]:
    """Write the general table and the five totals; returns table -> path.

    Resetting an output means replacing its tables, whatever ``mode`` is;
    other files in those folders are left alone. Totals that are replaced are
    made from the general table as written; totals that are appended to an
    older table count the new rows only, so that its parts add up. The source
    is read once, and so are the key columns of what was written, for all totals
    together. A totals table is partitioned by all its keys, one small file per
    group, unless ``partition_by`` names fewer for it.

    ``cluster_by`` sorts the general table over its files by that column, hot
    values split, so that filters on it skip most row groups; ``lookup`` is that
    of ``write_clustered``. The one shuffle it costs pays where the table is
    read often, by date as a rule.
    """
    processed = f"{folder_of(config, 'data_procesada')}/{general_folder}"
    dashboard = folder_of(config, "data_dashboard")
    typed = retype(as_spark_frame(spark, df))
    total_mode = "overwrite" if reset_dashboard else mode
    if total_mode == "append" and not reset_processed:
        typed = read_parquet(spark, write_parquet(typed, scratch_folder(spark, "new-rows")), typed.schema)
    general_mode = "overwrite" if reset_processed else mode
    if cluster_by:
        paths = {"general": write_clustered(typed, processed, cluster_by, general_mode, lookup=lookup)}
    else:
        paths = {"general": write_parquet(typed, processed, general_mode)}
    # what was just written, or the new rows alone
    stored = typed if total_mode == "append" and not reset_processed else read_parquet(spark, processed, typed.schema)
    together = totals_together(stored, [keys for _, keys in AGGREGATE_TABLES.values()])
    together = read_parquet(spark, write_parquet(together, scratch_folder(spark, "totals")), together.schema)
    for name, (folder, keys) in AGGREGATE_TABLES.items():
        path = f"{dashboard}/{folder}"
        columns = list((partition_by or {}).get(name, keys))
        table = one_set(together, *keys)
        if columns:
            width = int(spark.conf.get("spark.sql.shuffle.partitions"))
            write_partitioned(table, path, columns, total_mode, tasks=width)
        else:
            write_parquet(compact(table), path, total_mode)
        paths[name] = path
    return paths


def merge_appended(spark: SparkSession, name: str, path: str, partition_by: Sequence[str] | None = None) -> str:
    """Folds what runs appended to a totals table into one row per key.

    ``partition_by`` is what the table was written with; only partitions that
    hold a key more than once are written again. The sums go to the scratch
    folder first, as a table cannot be read and replaced in one step.
    """
    keys = list(AGGREGATE_TABLES[name][1])
    folders = keys if partition_by is None else list(partition_by)
    table = read_totals(spark, name, path)
    repeated = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("PARTES")).where("PARTES > 1")
    if repeated.isEmpty():
        return path
    if folders:
        again = repeated.select(*(F.col(f).alias(f"{f}_r") for f in folders)).distinct()
        table = table.join(again, reduce(and_, [F.col(f).eqNullSafe(F.col(f"{f}_r")) for f in folders]), "left_semi")
    merged = merged_totals(table, keys)
    merged = read_parquet(spark, write_parquet(merged, scratch_folder(spark, "merged")), merged.schema)
    if not folders:
        return write_parquet(compact(merged), path)
    return write_partitioned(merged, path, folders, refresh_only=True, tasks=int(spark.conf.get("spark.sql.shuffle.partitions")))


def locality_map(
    spark: SparkSession,
    incidents: DataFrame,
    config: Mapping[str, str],
    filename: str = "localidades_xy.geojson",
    **options,
) -> DataFrame:
    """``map_totals`` against a GeoJSON file of the configured folder."""
    points = read_localities(spark, f"{folder_of(config, 'data_complementaria')}/{filename}")
    return map_totals(incidents, points, **options)


def build(spark: SparkSession, config: Mapping[str, str], mode: str = "overwrite") -> dict[str, str]:
    """Raw folder to all six tables, and what could not be read: unreadable cells and malformed records."""
    raw = load_raw(spark, config)
    paths = write_tables(spark, standardize(raw.records), config, mode)
    processed = folder_of(config, "data_procesada")
    paths["rejects"] = write_parquet(raw.rejects, f"{processed}/rechazos", "overwrite")
    paths["malformed"] = write_parquet(raw.malformed, f"{processed}/malformados", "overwrite")
    return paths
