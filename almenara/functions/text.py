"""Text expressions: repair of broken encodings, trimming, null words."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almenara.fixed_values import CSV_NULL_TOKENS, NULL_WORDS, TEXT_REPAIR

#: every character that counts as white space when a cell is stripped
WHITE_SPACE = "".join(
    [chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680)]
    + [chr(c) for c in range(0x2000, 0x200B)]
    + [chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)

NO_BREAK_SPACE = "\u00a0"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted_name(name: str) -> str:
    """SQL identifier for an exact column name, dots included."""
    return "`" + name.replace("`", "``") + "`"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(as_column(c), F.lit(WHITE_SPACE))


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(table: Mapping[str, object]) -> Column:
    """Constant map, as SQL text: one call to the JVM, not one per entry."""
    items = [sql_text(x) if isinstance(x, str) else str(x) for x in chain.from_iterable(table.items())]
    return F.expr(f"map({', '.join(items)})")


def _ascii_repair(x: str, table: Mapping[str, str]) -> str:
    """SQL that applies the table's ASCII keys one after the other."""
    keys = [k for k in table if k.isascii()]
    if any(len(k) > 1 for k in keys) or any(table[k] in keys for k in keys):
        raise ValueError("ASCII keys must be single characters that give no other key")
    for k in keys:
        x = f"replace({x}, {sql_text(k)}, {sql_text(table[k])})"
    return x


def _repair_steps(table: Mapping[str, str]) -> list[str]:
    """Steps, as SQL over ``x``, that together replace as one left-to-right
    pass would.

    Single characters go first, so what a sequence turns into is never
    replaced again; one that can also end a sequence is left alone where the
    text before it makes it part of that sequence. Then the sequences follow,
    grouped by their first character.
    """
    sequences = [k for k in table if len(k) > 1]
    singles = [k for k in table if len(k) == 1]
    leads = list(dict.fromkeys(q[0] for q in sequences))
    ordered = [q for lead in leads for q in sequences if q[0] == lead]
    _check_order(table, singles, ordered)
    behind = {s: [q[: q.index(s)] for q in sequences if s in q] for s in singles}
    shared = [s for s in singles if behind[s]]
    free = [s for s in singles if not behind[s]]

    steps = []
    if shared:
        changed = "x"
        for s in shared:
            prefix = "|".join(re.escape(p) for p in behind[s])
            pattern = sql_text(f"(?<!{prefix}){re.escape(s)}")
            changed = f"regexp_replace({changed}, {pattern}, {sql_text(table[s])})"
        any_shared = sql_text(f"[{re.escape(''.join(shared))}]")
        steps.append(f"if(x rlike {any_shared}, {changed}, x)")
    if free:
        given, wanted = "".join(free), "".join(table[s] for s in free)
        steps.append(f"translate(x, {sql_text(given)}, {sql_text(wanted)})")
    for lead in leads:
        changed = "x"
        for q in ordered:
            if q[0] == lead:
                changed = f"replace({changed}, {sql_text(q)}, {sql_text(table[q])})"
        steps.append(f"if(contains(x, {sql_text(lead)}), {changed}, x)")
    return steps


def _check_order(table: Mapping[str, str], singles: list[str], ordered: list[str]) -> None:
    """Raise where the steps could differ from a single pass."""
    starts = {q[0] for q in ordered}
    tails = {ch for q in ordered for ch in q[1:]}
    if starts & (tails | set(singles)):
        raise ValueError("sequences may overlap or start like a single character")
    for k, v in table.items():
        if len(v) != 1 or v in starts or (len(k) == 1 and v in tails):
            raise ValueError(f"{k!r} -> {v!r} could become part of a sequence")
    for i, q in enumerate(ordered):
        for later in ordered[i + 1 :]:
            if table[q] in later[1:]:
                raise ValueError(f"{q!r} must come after {later!r}")


def repair_text(c: Column | str, table: Mapping[str, str] = TEXT_REPAIR) -> Column:
    """One repair pass: at each place the first key of the table that fits is
    replaced, and what it turns into is not looked at again.

    Pure ASCII cells, the bulk of any file, and cells without a character that
    starts a key skip most of the work. The steps run over a one-element array:
    a chain of some fifty calls per column, inlined for every column, gives
    generated methods too long for the JVM to compile.
    """
    def over(x: str) -> str:
        starts = re.escape("".join(dict.fromkeys(k[0] for k in table)))
        cell = f"array({x})"
        for step in _repair_steps(table):
            cell = f"transform({cell}, x -> {step})"
        return (
            f"CASE WHEN octet_length({x}) = length({x}) THEN {_ascii_repair(x, table)} "
            f"WHEN NOT {x} rlike {sql_text(f'[{starts}]')} THEN {x} ELSE get({cell}, 0) END"
        )

    if isinstance(c, str):
        return F.expr(over(quoted_name(c)))
    cells = F.call_function("transform", F.array(c), F.expr(f"cell -> {over('cell')}"))
    return F.get(cells, F.lit(0))


def repair_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One repair pass over the given (default: all) text columns."""
    names = string_columns(df) if columns is None else list(columns)
    return df.withColumns({n: repair_text(n) for n in names})


def standard_text(c: Column | str) -> Column:
    """No-break spaces become spaces; then strip and upper-case."""
    return F.upper(strip(F.replace(as_column(c), F.lit(NO_BREAK_SPACE), F.lit(" "))))


def standard_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    names = string_columns(df) if columns is None else list(columns)
    return df.withColumns({n: standard_text(F.col(f"`{n}`")) for n in names})


def null_tokens(c: Column | str, tokens: Iterable[str] = CSV_NULL_TOKENS) -> Column:
    """Null for a cell that equals one of the missing-value tokens."""
    c = as_column(c)
    return F.when(~c.isin(*tokens), c)


def not_blank(c: Column | str) -> Column:
    """True for a text with any character that is not white space."""
    return F.ltrim(as_column(c), F.lit(WHITE_SPACE)) != ""


def blank_to_null(c: Column | str) -> Column:
    """Null for an empty or white-space-only cell."""
    c = as_column(c)
    return F.when(not_blank(c), c)


def null_words(c: Column | str, words: Iterable[str] = NULL_WORDS) -> Column:
    """Trimmed text, or null where it is a null-like word in any case."""
    s = F.trim(as_column(c).cast("string"))
    return F.when(~F.lower(s).isin(*words), s)
