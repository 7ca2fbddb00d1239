"""Date and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from almenara.fixed_values import TIMESTAMP_NULL_WORDS, WEEKDAYS_EN, WEEKDAYS_ES
from almenara.functions.text import as_column, null_words, sql_text

#: (guard, pattern) in order of preference; pattern None is Spark's ISO reading.
#: A guard keeps texts of another shape away from a parser that would only
#: throw and catch an exception for each of them.
_MONTH_FIRST = r"^(0?[1-9]|1[0-2])[/-]\d{1,2}[/-]\d{4}"
_DAY_FIRST = r"^(1[3-9]|2\d|3[01])[/-]\d{1,2}[/-]\d{4}"
_TIMES = ((r" \d{1,2}:\d\d(:\d\d)?$", " H:mm[:ss]"), (r" \d{1,2}:\d\d(:\d\d)? [AaPp][Mm]$", " h:mm[:ss] a"), (r" \d{1,2}:\d\d:\d\d\.\d{1,6}$", " H:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]"), (r"$", ""))


def timestamp_formats(day_first: bool = False) -> tuple[tuple[str, str | None], ...]:
    """Formats with slashes or dashes, with a time of 12 or 24 hours, fractions or none.

    ``day_first`` reads the first part of a date as the day where both orders
    are possible; else it is the month.
    """
    orders = [("d{0}M{0}yyyy", r"^(0?[1-9]|[12]\d|3[01])[/-](0?[1-9]|1[0-2])[/-]\d{4}"), ("M{0}d{0}yyyy", _MONTH_FIRST)] if day_first else [("M{0}d{0}yyyy", _MONTH_FIRST), ("d{0}M{0}yyyy", _DAY_FIRST)]
    found: list[tuple[str, str | None]] = [(r"^\d{4}(-|$)", None)]
    for pattern, guard in orders:
        for mark in "/-":
            found += [(guard.replace("[/-]", mark) + end, pattern.format(mark) + time) for end, time in _TIMES]
    return (*found, *((r"^\d{4}/\d{1,2}/\d{1,2}" + end, "yyyy/M/d" + time) for end, time in _TIMES))


TIMESTAMP_FORMATS = timestamp_formats()


def parse_timestamp(
    c: Column | str, formats: Sequence[tuple[str, str | None]] = TIMESTAMP_FORMATS
) -> Column:
    """Timestamp from text by the first format that reads it, else null."""
    c = F.trim(as_column(c))
    tries = []
    for guard, pattern in formats:
        parsed = F.try_to_timestamp(c, F.lit(pattern)) if pattern else F.try_to_timestamp(c)
        tries.append(F.when(c.rlike(guard), parsed))
    return F.coalesce(*tries)


def date_order_evidence(line: Column | str, delimiter: str = ";") -> tuple[Column, Column]:
    """1 where the line's first date of this shape can only begin with the day, or only with the month; else 0.

    Dates like ``05/02/2024`` fit both orders and tell nothing.
    """
    pattern = rf'(?:^|{delimiter})"?\s*(\d{{1,2}})[/-](\d{{1,2}})[/-]\d{{4}}(?!\d)'
    first, second = (F.regexp_extract(as_column(line), pattern, k).try_cast("int") for k in (1, 2))

    def only(large: Column, small: Column) -> Column:
        return F.coalesce((large.between(13, 31) & small.between(1, 12)).cast("int"), F.lit(0))

    return only(first, second), only(second, first)


def parse_ordered_timestamp(c: Column | str, day_first: Column, formats: Sequence[tuple[str, str | None]] = TIMESTAMP_FORMATS) -> Column:
    """``parse_timestamp``, with the day before the month in rows where ``day_first`` is true."""
    return F.when(day_first, parse_timestamp(c, timestamp_formats(True))).otherwise(parse_timestamp(c, formats))


def safe_timestamp(c: Column | str) -> Column:
    """Timestamp from text in Spark's own reading; null words give null."""
    return F.try_to_timestamp(null_words(c, TIMESTAMP_NULL_WORDS))


def safe_date(c: Column | str) -> Column:
    """Date from a date, timestamp or text; null where the text is none."""
    return as_column(c).try_cast("date")


def _constant_array(values: Sequence[str]) -> Column:
    return F.expr(f"array({', '.join(sql_text(v) for v in values)})")


def _weekday_label(d: Column | str, monday_first: Sequence[str]) -> Column:
    return F.get(_constant_array(monday_first), F.weekday(as_column(d)))


def weekday_es(d: Column | str) -> Column:
    return _weekday_label(d, WEEKDAYS_ES)


def weekday_en(d: Column | str) -> Column:
    return _weekday_label(d, WEEKDAYS_EN)


def weekday_position(label: Column | str) -> Column:
    """1 for Monday to 7 for Sunday, from the Spanish label."""
    return F.array_position(_constant_array(WEEKDAYS_ES), as_column(label))
