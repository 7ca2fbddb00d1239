"""Row filters of the report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.fixed_values import ALL_VALUES


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def in_date_range(
    df: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    column: str = "FECHA",
) -> DataFrame:
    """Dates from ``start`` to ``end``, both included; null dates drop out.

    A missing bound stands for the data's own minimum or maximum, which no
    date lies beyond, so it needs no look at the data.
    """
    kept = df.where(F.col(column).isNotNull())
    if start:
        kept = kept.where(F.col(column) >= F.lit(start).cast("date"))
    if end:
        kept = kept.where(F.col(column) <= F.lit(end).cast("date"))
    return kept


def equals_or_all(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Rows with that value; ``TODAS``, empty or None keep every row."""
    if not value or value == ALL_VALUES:
        return df
    return df.where(F.col(column) == F.lit(value))


def in_list(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows with one of the values; an empty or non-list value keeps every row."""
    if not isinstance(values, (list, tuple)) or not values:
        return df
    return df.where(F.col(column).isin(*values))


def is_empty(df: DataFrame) -> DataFrame:
    """One row ``VACIO``: whether there are no rows. ``df.isEmpty()`` as a table."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("VACIO"))


@dataclass(frozen=True)
class ReportFilter:
    """What a report request selects.

    The report screen starts with every known type selected, which leaves out
    rows without a type; pass that list to get the same. ``types=None`` keeps
    rows without a type.
    """

    start: dt.date | str | None = None
    end: dt.date | str | None = None
    locality: str | None = ALL_VALUES
    types: Sequence[str] | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        df = in_date_range(df, self.start, self.end)
        df = equals_or_all(df, "LOCALIDAD", self.locality)
        return in_list(df, "TIPO_INCIDENTE", self.types)
