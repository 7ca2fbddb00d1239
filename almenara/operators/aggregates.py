"""Totals, top lists, hierarchy and domains.

Every total takes ``weight``: None counts rows, a column name sums that column,
so the same operators work on rows and on counts made earlier.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almenara.fixed_values import WEEKDAYS_ES
from almenara.functions.dates import weekday_position
from almenara.operators.filters import not_null


def row_count(weight: str | None = None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")


def totals(df: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    """``keys, TOTAL``; a null key is a group of its own."""
    return df.groupBy(*keys).agg(row_count(weight).alias("TOTAL"))


def grouping_number(columns: Sequence[str], keys: Sequence[str]) -> int:
    """``grouping_id`` of the set ``keys`` among ``columns``: a bit for each column that is not in it."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)


def totals_together(df: DataFrame, sets: Sequence[Sequence[str]], weight: str | None = None) -> DataFrame:
    """Totals by each of several sets of keys, from one scan: ``CONJUNTO`` (``grouping_number``), all keys, ``TOTAL``.

    Rows are expanded to one per set within the task and counted there first, so
    a task sends on one row for each group it has seen.
    """
    columns = list(dict.fromkeys(k for keys in sets for k in keys))
    grouped = df.groupingSets([[F.col(k) for k in keys] for keys in sets], *columns)
    return grouped.agg(F.grouping_id().alias("CONJUNTO"), row_count(weight).alias("TOTAL"))


def one_set(together: DataFrame, *keys: str) -> DataFrame:
    """``totals`` by ``keys`` out of ``totals_together``."""
    columns = [c for c in together.columns if c not in ("CONJUNTO", "TOTAL")]
    return together.where(F.col("CONJUNTO") == grouping_number(columns, keys)).select(*keys, "TOTAL")


def merged_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals whose rows were appended run by run, added up to one row per key."""
    return totals(df, *keys, weight="TOTAL")


def daily_totals(df: DataFrame, weight: str | None = None) -> DataFrame:
    return totals(df, "FECHA", weight=weight)


def daily_trend(df: DataFrame, weight: str | None = None) -> DataFrame:
    return daily_totals(df, weight).orderBy("FECHA")


def weekday_hour_totals(
    df: DataFrame, weight: str | None = None, keep_nulls: bool = True
) -> DataFrame:
    """Stored form keeps null keys; the report form (``keep_nulls=False``) drops them."""
    df = df if keep_nulls else not_null(df, "DIA_SEMANA", "HORA")
    return totals(df, "DIA_SEMANA", "HORA", weight=weight)


def weekday_hour_matrix(cells: DataFrame, hours: Sequence[int] = range(24)) -> DataFrame:
    """Weekday rows, Monday first, and one column ``H00`` … per hour.

    ``cells`` is a weekday-hour total, at most 7 x 24 rows, so the pivot never
    sees the incidents themselves.
    """
    names = {h: f"H{h:02d}" for h in hours}
    wide = (
        cells.where(F.col("DIA_SEMANA").isin(*WEEKDAYS_ES))
        .groupBy("DIA_SEMANA")
        .pivot("HORA", list(names))
        .agg(F.sum("TOTAL"))
    )
    filled = [F.coalesce(F.col(f"`{h}`"), F.lit(0)).cast("bigint").alias(n) for h, n in names.items()]
    return wide.orderBy(weekday_position("DIA_SEMANA")).select("DIA_SEMANA", *filled)


def locality_totals(df: DataFrame, weight: str | None = None) -> DataFrame:
    return totals(df, "LOCALIDAD", weight=weight)


def type_totals(df: DataFrame, weight: str | None = None) -> DataFrame:
    return totals(df, "TIPO_INCIDENTE", weight=weight)


def priority_type_totals(
    df: DataFrame, weight: str | None = None, keep_nulls: bool = True
) -> DataFrame:
    df = df if keep_nulls else not_null(df, "PRIORIDAD_FINAL", "TIPO_INCIDENTE")
    return totals(df, "PRIORIDAD_FINAL", "TIPO_INCIDENTE", weight=weight)


def top_totals(df: DataFrame, key: str, n: int = 10, weight: str | None = None) -> DataFrame:
    """The ``n`` largest groups; ties go to the smaller key."""
    return totals(df, key, weight=weight).orderBy(F.desc("TOTAL"), F.asc(key)).limit(n)


def top_totals_many(df: DataFrame, key: str, n: int = 10, buckets: int = 1 << 16) -> DataFrame:
    """``top_totals`` for keys with very many values, without a shuffle of every key.

    Keys are hashed into ``buckets``; a bucket's total bounds the total of each
    key in it from above and takes one row per bucket and task to count. The
    keys of the ``n`` fullest buckets are counted, and the ``n``-th of them is a
    bound from below. Only buckets that reach it can hold a key of the list, so
    only their keys are counted, all of them: the list is exact, whatever the
    data. With a few keys far above the rest nearly all rows stay where they
    are; with keys of equal size every bucket counts and it is ``top_totals``
    after two looks at one column.
    """
    keyed = df.select(F.col(f"`{key}`").alias(key), F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int").alias("_bucket"))
    full = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    fullest = full.orderBy(F.desc("_rows"), "_bucket").limit(n).select("_bucket")
    # broadcast sides hold one number a bucket: n, and below at most ``buckets``
    some = totals(keyed.join(F.broadcast(fullest), "_bucket", "left_semi"), key).orderBy(F.desc("TOTAL")).limit(n)
    # fewer than n keys bound nothing from below
    least = some.agg(F.when(F.count(F.lit(1)) == n, F.min("TOTAL")).otherwise(F.lit(0)))
    able = full.where(F.col("_rows") >= least.scalar()).select("_bucket")
    return totals(keyed.join(F.broadcast(able), "_bucket", "left_semi"), key).orderBy(F.desc("TOTAL"), F.asc(key)).limit(n)


def hierarchy_totals(leaves: DataFrame) -> DataFrame:
    """Priority and type totals with their parents.

    ``NIVEL``: 0 a leaf, 1 a priority (sum of its types), 3 the grand total.
    ``leaves`` is a priority-type total, so the roll-up expands one row per
    group, not per incident.
    """
    return leaves.rollup("PRIORIDAD_FINAL", "TIPO_INCIDENTE").agg(
        F.grouping_id().cast("int").alias("NIVEL"), F.sum("TOTAL").alias("TOTAL")
    )


def date_bounds(df: DataFrame, column: str = "FECHA") -> DataFrame:
    return df.agg(F.min(column).alias("FECHA_MIN"), F.max(column).alias("FECHA_MAX"))


def domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order; no rows if there is no such column."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{column}` string")
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
