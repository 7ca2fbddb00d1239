"""Folder of delimited files with drifting headers and mixed encodings.

Two scans. The first profiles every file: is all of it valid UTF-8, what is
its header line, can a quoted field run over a line end. The second parses the
files grouped by (header, encoding, line mode), each group with an explicit
schema. Only one profile row per file reaches the driver, no more than the
file listing Spark keeps there anyway.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almenara.fixed_values import COLUMN_SYNONYMS, EXPECTED_COLUMNS
from almenara.functions.dates import date_order_evidence
from almenara.functions.text import not_blank
from almenara.operators.clean import clean_cells, concat_tables, project_expected, unify_synonyms
from almenara.sources.long_records import read_long_records

DELIMITER = ";"

#: a line that, read from a record start, ends inside an open quoted field
OPEN_QUOTE = (
    r'^(?:(?:[^";][^;]*+)?;|"[^"]*+(?:""[^"]*+)*+"[^;]*+;)*+'
    r'"[^"]*+(?:""[^"]*+)*+$'
)


class CsvFolder(NamedTuple):
    """Lazy results of a folder scan."""

    records: DataFrame
    malformed: DataFrame


class FileGroup(NamedTuple):
    """Files that one scan can read together."""

    header: tuple[str, ...]
    encoding: str
    mode: str
    #: dates begin with the day
    day_first: bool = False


#: no field runs over a line end: any file splits over tasks, line by line
LINES = "lines"
#: some do, or blank lines come first: the lines are put together to records, over all splits
JOINED = "joined"


def known_names(
    expected: Iterable[str] = EXPECTED_COLUMNS,
    synonyms: Mapping[str, Sequence[str]] = COLUMN_SYNONYMS,
) -> list[str]:
    return list(dict.fromkeys([*expected, *(n for names in synonyms.values() for n in names)]))


def header_names(line: str | None) -> tuple[str, ...]:
    """Column names of a header line, made distinct.

    A repeated name gets ``.1``, ``.2`` …; an empty one ``Unnamed: <position>``.
    """
    names = next(csv.reader([line], delimiter=DELIMITER)) if line else []
    taken = {n for n in names if n}
    result: list[str] = []
    for i, name in enumerate(names):
        unique = name or f"Unnamed: {i}"
        k = 0
        while unique in result or (k and unique in taken):
            k += 1
            unique = f"{name}.{k}"
        result.append(unique)
    return tuple(result)


def _escape_glob(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def folder_pattern(folder: str) -> str:
    """Glob for the ``.csv`` files (any case) directly inside ``folder``."""
    return _escape_glob(folder.rstrip("/")) + "/*.[cC][sS][vV]"


def _may_be_header(value: Column, names: Sequence[str]) -> Column:
    """True where some field of the line is exactly one of ``names``.

    Plain substring tests come first; few lines of data reach the pattern.
    """
    parts = [n for n in names if not any(m != n and m in n for m in names)]
    contained = reduce(or_, [F.contains(value, F.lit(n)) for n in parts])
    words = "|".join(re.escape(n) for n in names)
    return contained & value.rlike(f'(?:^|{DELIMITER})"?(?:{words})"?(?:{DELIMITER}|$)')


def profile_files(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per file: ``path, header, utf8, joined, day_first``.

    ``lines`` is a text scan. The header is the first line of the file that is
    not blank, in whatever block. The header candidate is a grouping key and
    all aggregates have fixed width, so this is a hash aggregation with
    map-side combining: what is shuffled is about one row per block and task.
    Dates begin with the day where more lines allow that order alone than allow
    the other alone.
    """
    line = F.col("value")
    day, month = date_order_evidence(line, DELIMITER)
    seen = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.when(_may_be_header(line, names), line).alias("header"),
        F.monotonically_increasing_id().alias("any"),
        F.when(not_blank(line), F.monotonically_increasing_id()).alias("position"),
        F.is_valid_utf8(line).alias("utf8"),
        (F.contains(line, F.lit('"')) & line.rlike(OPEN_QUOTE)).alias("open_quote"),
        (day - month).alias("day_lead"),
    )
    flags = [F.bool_and("utf8").alias("utf8"), F.bool_or("open_quote").alias("open_quote"), F.sum("day_lead").alias("day_lead")]
    per_header = seen.groupBy("path", "block", "header").agg(F.min("position").alias("position"), F.min("any").alias("any"), *flags)
    place = F.when(F.col("position").isNotNull(), F.struct("block", "position"))
    per_file = per_header.groupBy("path").agg(
        F.min(place).alias("position"),
        F.min(F.struct("block", "any")).alias("start"),
        F.min_by("header", place).alias("header"),
        *flags,
    )
    latin = F.decode(F.col("header").cast("binary"), "ISO-8859-1")
    return per_file.where("position is not null").select(
        "path",
        F.when(F.col("utf8"), F.col("header")).otherwise(latin).alias("header"),
        "utf8",
        # the line reader knows a header on the first line of a file only
        (F.col("open_quote") | (F.col("position.block") != F.col("start.block")) | (F.col("position.position") != F.col("start.any"))).alias("joined"),
        (F.col("day_lead") > 0).alias("day_first"),
    )


def group_files(profile: DataFrame) -> dict[FileGroup, list[str]]:
    """Paths per (header, encoding, reading mode, order of dates), from the profile rows."""
    groups: dict[FileGroup, list[str]] = defaultdict(list)
    for row in profile.toLocalIterator():
        mode = JOINED if row.joined else LINES
        if row.header and re.search(OPEN_QUOTE, row.header):
            raise ValueError(f"the header of {row.path} runs over more than one line")
        encoding = "UTF-8" if row.utf8 else "ISO-8859-1"
        groups[FileGroup(header_names(row.header), encoding, mode, row.day_first)].append(
            _escape_glob(unquote(row.path))
        )
    return {k: sorted(v) for k, v in sorted(groups.items())}


def _fields(group: FileGroup) -> list[str]:
    """Positional column names; the real names may repeat or differ in case only."""
    return [f"c{i}" for i in range(max(len(group.header), 1))]


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_FORMAT = {"sep": DELIMITER, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _reader(spark: SparkSession, group: FileGroup, names: Sequence[str]):
    return (
        spark.read.schema(_text_schema(names))
        .options(**_FORMAT)
        .option("header", True)
        .option("encoding", group.encoding)
    )


def _scan(
    spark: SparkSession, group: FileGroup, paths: list[str], texts: DataFrame | None
) -> DataFrame:
    """Parsed fields; from the record ``texts`` where a JOINED group has them."""
    if texts is None:
        return _reader(spark, group, _fields(group)).csv(paths)
    columns = ", ".join(f"{n} string" for n in _fields(group))
    parsed = F.from_csv("value", columns, _FORMAT)
    return texts.select(parsed.alias("r")).select("r.*")


def _records(
    scan: DataFrame,
    group: FileGroup,
    expected: Sequence[str],
    synonyms: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Cleaned expected columns of one file group; others are never parsed."""
    wanted = set(known_names(expected, synonyms))
    safe = {n: f"c{i}" for i, n in enumerate(group.header) if n in wanted}
    cells = clean_cells(scan.select(*safe.values()))
    merged = {canon: [safe[n] for n in names if n in safe] for canon, names in synonyms.items()}
    single = {n: [safe[n]] for n in expected if n in safe and n not in merged}
    return project_expected(unify_synonyms(cells, {**merged, **single}), expected)


def _malformed(
    spark: SparkSession, group: FileGroup, paths: list[str], texts: DataFrame | None
) -> DataFrame:
    """Records with more fields than their header; the surplus is not in records."""
    names = _fields(group)
    if texts is not None:
        scan = texts.select("path", F.col("value").alias("malformed"))
    else:
        scan = (
            _reader(spark, group, [*names, "malformed"])
            .option("columnNameOfCorruptRecord", "malformed")
            .option("columnPruning", False)
            .csv(paths)
            # the reader only tells malformed records when all fields are asked for
            .where(F.length(F.concat_ws("", *names)) >= 0)
            .select(F.col("_metadata.file_path").alias("path"), "malformed")
        )
    bare = F.regexp_replace("malformed", r'"[^"]*+(?:""[^"]*+)*+"', "")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(DELIMITER), F.lit("")))
    return scan.where(surplus >= len(names)).select(
        F.col("path").alias("ARCHIVO"), F.col("malformed").alias("REGISTRO")
    )


def _empty(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    expected: Sequence[str] = EXPECTED_COLUMNS,
    synonyms: Mapping[str, Sequence[str]] = COLUMN_SYNONYMS,
    day_first_column: str | None = None,
) -> CsvFolder:
    """All records of the ``.csv`` files directly inside ``folder``.

    ``records`` has the expected columns found in any file, all text, cleaned
    cell by cell and with synonyms unified. A folder without such files gives
    no rows. Profiling runs at once, parsing when the result is used. With
    ``day_first_column`` they have that column too: "1" in rows of files whose
    dates begin with the day, "0" in others.

    Files of any size are split over tasks. Those whose fields run over line
    ends have their lines written once, to be put together to records; a field
    that is still open at the end of a file raises ``ValueError``. Blank lines
    between records, of spaces too, are no records.
    """
    columns = [*expected, day_first_column] if day_first_column else expected
    try:
        lines = spark.read.text(folder_pattern(folder))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.read.option("recursiveFileLookup", True).text(_escape_glob(folder))  # must exist
        return CsvFolder(_empty(spark, columns), _empty(spark, ["ARCHIVO", "REGISTRO"]))
    groups = group_files(profile_files(lines, known_names(expected, synonyms)))
    if not groups:
        return CsvFolder(_empty(spark, columns), _empty(spark, ["ARCHIVO", "REGISTRO"]))
    found, malformed = [], []
    for group, paths in groups.items():
        texts = None
        if group.mode == JOINED:
            texts = read_long_records(spark, paths, group.encoding, OPEN_QUOTE)
        found.append(_records(_scan(spark, group, paths, texts), group, expected, synonyms))
        malformed.append(_malformed(spark, group, paths, texts))
    if day_first_column:
        found = [df.withColumn(day_first_column, F.lit("1" if g.day_first else "0")) for df, g in zip(found, groups, strict=True)]
    records = project_expected(concat_tables(found), columns)
    return CsvFolder(records, concat_tables(malformed))
