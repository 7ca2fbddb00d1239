"""Cleaning of raw text tables: synonyms, blanks, projection, concatenation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almenara.fixed_values import COLUMN_SYNONYMS, EXPECTED_COLUMNS
from almenara.functions.text import blank_to_null, null_tokens, quoted_name, repair_text


def quoted(name: str) -> Column:
    """Column by exact name, dots included."""
    return F.col(quoted_name(name))


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop columns that had no header of their own."""
    return df.select(*[quoted(c) for c in df.columns if c.strip() and not c.startswith("Unnamed")])


def project_expected(df: DataFrame, expected: Sequence[str] = EXPECTED_COLUMNS) -> DataFrame:
    """Keep the expected columns that exist, in the expected order."""
    return df.select(*[c for c in expected if c in df.columns])


def clean_cells(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """First cell cleaning: missing-value tokens, text repair, blanks."""
    names = list(df.columns if columns is None else columns)
    for step in (lambda c: null_tokens(quoted(c)), repair_text, lambda c: blank_to_null(quoted(c))):
        df = df.select(*[step(c).alias(c) if c in names else quoted(c) for c in df.columns])
    return df


def unify_synonyms(
    df: DataFrame, synonyms: Mapping[str, Sequence[str]] = COLUMN_SYNONYMS
) -> DataFrame:
    """One column per synonym group, filled from the synonyms in their order.

    Names are compared exactly, case included, so run this with distinct
    column names or with case-sensitive resolution on.
    """
    present = {canon: [n for n in names if n in df.columns] for canon, names in synonyms.items()}
    used = {n for names in present.values() for n in names}
    rest = [quoted(c) for c in df.columns if c not in used]
    merged = [
        F.coalesce(*[quoted(n) for n in names]).alias(canon)
        for canon, names in present.items()
        if names
    ]
    return df.select(*rest, *merged)


def concat_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns a table lacks are null."""
    if not tables:
        raise ValueError("no tables to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
