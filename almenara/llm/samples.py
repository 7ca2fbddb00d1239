"""Bounded samples of labelled rows, and the split into learning and held-out rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_code(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def labelled_ids(labels: DataFrame, id_col: str, label_col: str, per_class: int) -> DataFrame:
    """``_label_id``, ``_label``: at most ``per_class`` ids of each label 0 and 1, the first by a fixed hash.

    Null ids and labels are left out; an id with both labels counts as 1.
    """
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_label_id")).agg(F.max(label_col).alias("_label"))
    parts = [one.where(F.col("_label") == v).orderBy(F.xxhash64("_label_id"), "_label_id").limit(per_class) for v in (0, 1)]
    return reduce(DataFrame.union, parts)
