"""Parquet sinks and their file layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, partitions: int, *columns: str, ways: int = 1) -> DataFrame:
    """Repartition by ``columns``; ``ways`` > 1 splits each key over that many tasks.

    With one third of the rows under one key, ``ways`` bounds the largest task
    at a third divided by it.
    """
    keys = [F.col(c) for c in columns]
    if ways > 1:
        rest = [c for c in df.columns if c not in columns]
        keys.append(F.pmod(F.xxhash64(*(rest or columns)), F.lit(ways)))
    return df.repartition(partitions, *keys)


def compact(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fewer output files: a fixed number, or as many as the data size asks for."""
    return df.coalesce(partitions) if partitions else df.hint("rebalance")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_clustered(
    df: DataFrame,
    path: str,
    column: str = "FECHA",
    mode: str = "overwrite",
    partitions: int | None = None,
    lookup: Mapping[str, int] | None = None,
    row_group_bytes: int | None = None,
) -> str:
    """Files and row groups that each hold a narrow range of ``column``.

    Readers that filter on the column skip the other row groups by their
    statistics. Rows are range-shuffled by the column and, within one value, by
    a hash of the others, so a value with many rows fills several tasks.
    ``lookup`` names columns that will be asked for by single values, with the
    number of distinct values a row group may hold: they get Bloom filters,
    which tell that a row group lacks a value whatever the order of its rows.
    """
    rest = [c for c in df.columns if c != column]
    keys = [F.col(f"`{column}`"), F.xxhash64(*[F.col(f"`{c}`") for c in rest or [column]])]
    rows = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    writer = rows.sortWithinPartitions(F.col(f"`{column}`")).write.mode(mode)
    for name, distinct in (lookup or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return path


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str],
    mode: str = "overwrite",
    refresh_only: bool = False,
    tasks: int | None = None,
) -> str:
    """One directory per key combination.

    Rows are first gathered by key, so a directory gets few files. By default
    adaptive execution sizes the writing tasks: it merges small keys and splits
    keys too big for one task. That suits many rows; for few rows over many
    directories, where creating files is the work, ``tasks`` sets how many
    tasks share the directories out. ``refresh_only`` overwrites only the
    directories the new rows fall into.
    """
    if tasks:
        # hashed keys: on the plain keys of a grouped table the optimizer would
        # drop this exchange and merge the directories into one task
        rows = df.repartition(tasks, F.xxhash64(*partition_columns))
    else:
        rows = df.hint("rebalance", *partition_columns)
    writer = rows.write.mode(mode).partitionBy(*partition_columns)
    if refresh_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path
