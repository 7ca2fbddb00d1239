"""Typed, standardised incident table from the raw text table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almenara.fixed_values import DECLARED_MISSING, LABELS
from almenara.functions.codes import lenient_int, map_label, map_priority, standard_code
from almenara.functions.dates import TIMESTAMP_FORMATS, parse_ordered_timestamp, parse_timestamp, weekday_en, weekday_es
from almenara.functions.text import (
    repair_columns,
    repair_text,
    standard_columns,
    standard_text,
    string_columns,
)
from almenara.schema import CLEAN_SCHEMA, DAY_FIRST_COLUMN, LABEL_COLUMNS, REQUIRED_COLUMNS, TIMESTAMP_COLUMN


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def _standard_texts(raw: DataFrame) -> DataFrame:
    """Upper-cased, stripped and repaired texts (second repair pass)."""
    require_columns(raw, REQUIRED_COLUMNS)
    texts = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return repair_columns(standard_columns(texts))


def _read_timestamp(df: DataFrame, c: Column | str, formats: Sequence[tuple[str, str | None]]) -> Column:
    """By the order of each row's file, where the table tells it."""
    if DAY_FIRST_COLUMN not in df.columns:
        return parse_timestamp(c, formats)
    return parse_ordered_timestamp(c, F.col(DAY_FIRST_COLUMN) == "1", formats)


def standardize(
    raw: DataFrame,
    labels: Mapping[str, str | None] = LABELS,
    formats: Sequence[tuple[str, str | None]] = TIMESTAMP_FORMATS,
) -> DataFrame:
    """Incident table in ``CLEAN_SCHEMA`` (columns the input has).

    Row-local throughout: no shuffle, no Python, one pass over the input. Rows
    with "1" in ``DAY_FIRST_COLUMN``, if there is one, have the day before the
    month where a date allows both.
    """
    df = _standard_texts(raw)
    mapped = {c: map_label(c, labels) for c in LABEL_COLUMNS}
    df = df.withColumns(
        {**mapped, "CODIGO_LOCALIDAD": standard_code("CODIGO_LOCALIDAD"), "EDAD": lenient_int("EDAD")}
    )
    df = df.withColumn("PRIORIDAD_FINAL", map_priority("PRIORIDAD_FINAL"))
    df = df.withColumns({c: repair_text(c) for c in string_columns(df)})
    df = df.withColumn(TIMESTAMP_COLUMN, _read_timestamp(df, TIMESTAMP_COLUMN, formats))
    df = df.withColumns(
        {
            "FECHA": F.to_date(TIMESTAMP_COLUMN),
            "HORA": F.hour(TIMESTAMP_COLUMN),
            "DIA_SEMANA_EN": weekday_en(TIMESTAMP_COLUMN),
            "DIA_SEMANA": weekday_es(TIMESTAMP_COLUMN),
        }
    )
    return df.select(*[c for c in CLEAN_SCHEMA.fieldNames() if c in df.columns])


def rejects(
    raw: DataFrame, formats: Sequence[tuple[str, str | None]] = TIMESTAMP_FORMATS
) -> DataFrame:
    """Raw rows with a code, age or date that holds a value nothing can read.

    One row per such cell: the raw columns as given, and ``MOTIVO``, the name
    of the column at fault.
    """
    require_columns(raw, REQUIRED_COLUMNS)
    readers = {
        "CODIGO_LOCALIDAD": standard_code,
        "EDAD": lenient_int,
        TIMESTAMP_COLUMN: lambda c: _read_timestamp(raw, c, formats),
    }
    texts = raw.withColumns({f"__{c}": standard_text(F.col(c).cast("string")) for c in readers})
    texts = texts.withColumns({f"__{c}": repair_text(f"__{c}") for c in readers})
    # dates are read after the third repair pass
    texts = texts.withColumn(f"__{TIMESTAMP_COLUMN}", repair_text(f"__{TIMESTAMP_COLUMN}"))
    faults = [
        F.when(~F.col(f"__{c}").isin(*DECLARED_MISSING) & read(F.col(f"__{c}")).isNull(), F.lit(c))
        for c, read in readers.items()
    ]
    # a generator, so that the null test below is not pushed into the texts'
    # projections, where every reading would be worked out again
    given = [c for c in raw.columns if c != DAY_FIRST_COLUMN]
    cells = texts.select(*given, F.stack(F.lit(len(faults)), *faults).alias("MOTIVO"))
    return cells.where(F.col("MOTIVO").isNotNull())
