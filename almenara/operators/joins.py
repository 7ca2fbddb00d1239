"""Joins of incident counts to the locality dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almenara.functions.codes import normalized_code
from almenara.operators.aggregates import row_count

#: accepted spellings of the four join kinds
JOIN_KINDS = {
    "inner": "inner",
    "left": "left", "leftouter": "left", "left_outer": "left",
    "right": "right", "rightouter": "right", "right_outer": "right",
    "full": "full", "outer": "full", "fullouter": "full", "full_outer": "full",
}

def join_small(large: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a large table to one that is small as a rule.

    No hint: adaptive execution broadcasts a side that it has measured to be
    under its threshold, and shuffles both where it is not.
    """
    return large.join(small, on, how)


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _keys(df: DataFrame, code: str, dim: DataFrame, dim_code: str) -> tuple[Column, Column]:
    """Join keys of one type: numbers where both sides are, else text."""
    if _is_text(df, code) or _is_text(dim, dim_code):
        return F.col(code).cast("string"), F.col(dim_code).cast("string")
    return F.col(code).cast("bigint"), F.col(dim_code).cast("bigint")


def _per_code(df: DataFrame, code: Column, count: Column, label: str) -> DataFrame:
    """One row per code, with its smallest label.

    Codes are counted with their labels first: that is a hash aggregation over
    the incidents, which a smallest text is not. Counting first also makes a
    code with most of the rows harmless.
    """
    per_label = df.groupBy(code.alias("codigo"), F.col(label).alias("etiqueta")).agg(count.alias("n"))
    return per_label.groupBy("codigo").agg(F.sum("n").alias("TOTAL"), F.min("etiqueta").alias("LOCALIDAD"))


def map_points(
    incidents: DataFrame,
    localities: DataFrame,
    code: str = "CODIGO_LOCALIDAD",
    label: str = "LOCALIDAD",
    weight: str | None = None,
) -> DataFrame:
    """Incidents per code with the code's point; codes without a point stay.

    ``CODIGO_LOCALIDAD, TOTAL, LOCALIDAD, X, Y``. Text codes are normalised
    first. The label is the smallest one of the code.
    """
    dim_key = F.col("Codigo_Localidad")
    key = F.col(code)
    if _is_text(incidents, code):
        key, dim_key = normalized_code(code), dim_key.cast("string")
    counts = _per_code(incidents, key, row_count(weight), label).where("codigo is not null")
    points = localities.select(dim_key.alias("codigo_punto"), "X", "Y")
    joined = join_small(counts, points, F.col("codigo") == F.col("codigo_punto"), "left")
    return joined.select(F.col("codigo").alias("CODIGO_LOCALIDAD"), "TOTAL", "LOCALIDAD", "X", "Y")


def map_totals(
    incidents: DataFrame,
    localities: DataFrame,
    code: str = "CODIGO_LOCALIDAD",
    incident: str = "NUMERO_INCIDENTE",
    label: str = "LOCALIDAD",
    how: str = "left",
    keep_dimension: bool = False,
) -> DataFrame:
    """Localities joined to incidents, then totals per incident code.

    ``CODIGO_LOCALIDAD, TOTAL, X, Y, LOCALIDAD``. The localities are the left
    side of the join; TOTAL counts non-null incident numbers and X, Y are
    averages over the group. With ``left``, localities without incidents share
    one group with a null code; ``keep_dimension`` gives each its own row.

    The incidents are counted per code before the join. Every incident of a
    code meets the same localities, so summing those counts afterwards gives
    what joining the incidents themselves would give.
    """
    kind = JOIN_KINDS.get(how.lower())
    if kind is None:
        raise ValueError(f"join kind {how!r} is none of inner, left, right, full")
    key, dim_key = _keys(incidents, code, localities, "Codigo_Localidad")
    counts = _per_code(incidents, key, F.count(incident), label)
    points = localities.select(dim_key.alias("codigo_punto"), "X", "Y")
    joined = points.join(counts, F.col("codigo_punto") == F.col("codigo"), kind)
    group = F.coalesce("codigo", "codigo_punto") if keep_dimension else F.col("codigo")
    return joined.groupBy(group.alias("CODIGO_LOCALIDAD")).agg(
        F.coalesce(F.sum("TOTAL"), F.lit(0)).cast("bigint").alias("TOTAL"),
        F.avg("X").alias("X"),
        F.avg("Y").alias("Y"),
        F.min("LOCALIDAD").alias("LOCALIDAD"),
    )


def map_has_points(points: DataFrame) -> DataFrame:
    """One row ``TIENE_XY``: whether any row has an X and any row a Y."""
    return points.agg(((F.count("X") > 0) & (F.count("Y") > 0)).alias("TIENE_XY"))
