"""Numbers and codes held as text, and label dictionaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from almenara.fixed_values import (
    LABELS,
    LOCALITY_CODES,
    LOCALITY_CORRECTIONS,
    PRIORITIES,
)
from almenara.functions.text import as_column, literal_map, null_words, strip


def map_label(c: Column | str, labels: Mapping[str, str | None] = LABELS) -> Column:
    """Exact-match dictionary lookup; other values stay, ``None`` gives null."""
    c = as_column(c)
    known = {k: v for k, v in labels.items() if v is not None}
    missing = [k for k, v in labels.items() if v is None]
    mapped = F.coalesce(literal_map(known)[c], c) if known else c
    return F.when(~c.isin(*missing), mapped) if missing else mapped


def map_priority(c: Column | str) -> Column:
    return map_label(c, PRIORITIES)


def lenient_int(c: Column | str) -> Column:
    """Integer from ``25``, ``25.0`` or ``25,5`` (truncated); null otherwise."""
    s = F.replace(F.trim(as_column(c).cast("string")), F.lit(","), F.lit("."))
    whole = F.split_part(s, F.lit("."), F.lit(1))
    return F.when(s.rlike(r"^\d+(\.\d+)?$"), whole.try_cast("int"))


def standard_code(
    c: Column | str,
    codes: Mapping[str, int] = LOCALITY_CODES,
    corrections: Mapping[str, str] = LOCALITY_CORRECTIONS,
) -> Column:
    """Locality code: digits as they are, else looked up by (corrected) name."""
    names = {**codes, **{wrong: codes[right] for wrong, right in corrections.items()}}
    s = F.upper(strip(as_column(c).cast("string")))
    digits = F.split_part(s, F.lit("."), F.lit(1)).try_cast("bigint")
    return F.when(s.rlike(r"^\d+(\.0+)?$"), digits).otherwise(
        literal_map(names)[s].cast("bigint")
    )


def normalized_code(c: Column | str) -> Column:
    """Code text for the map join: null words to null, one ``.0`` removed."""
    return F.regexp_replace(null_words(c), r"\.0$", "")
