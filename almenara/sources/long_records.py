"""Records with line ends inside quotes, read from files split over many tasks.

Spark's multi-line CSV mode gives a whole file to one task. For a file too
large for that the lines are read in blocks, as any text. Whether a block
starts inside a quoted field depends on all blocks before it, so each line and
then each block is described by what it does to either state; chaining the
blocks of a file, one small row each, gives every block its start.

The running state within a block is worked out by the task that reads the
block, in numpy: a window would send all text through a shuffle. So only lines
of records over several lines are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almenara.functions.text import not_blank
from almenara.session import scratch_folder

QUOTE = '"'
#: blocks, one small row each, that every task may hold
MOST_BLOCKS = 1_000_000


def _chained(if_out: Column, if_in: Column, window) -> tuple[Column, Column]:
    """State after each row, for either state before the first row.

    A row sets the state, flips it or leaves it. What counts is the last
    setting, if any, and the number of flips since.
    """
    sets = F.when(if_out == if_in, if_out)
    flips = F.sum((if_out & ~if_in).cast("long")).over(window)
    setting = F.last(sets, ignorenulls=True).over(window)
    # the flips up to the last setting: counts only grow, so the largest is it
    before = F.coalesce(F.max(F.when(sets.isNotNull(), F.col("flips"))).over(window), F.lit(0))
    odd = (F.col("flips") - before) % 2 == 1
    return flips, F.struct(
        (F.coalesce(setting, F.lit(False)) != odd).alias("from_out"),
        (F.coalesce(setting, F.lit(True)) != odd).alias("from_in"),
    )


def _with_states(df: DataFrame, if_out: Column, if_in: Column, keys: list[str], order: str) -> DataFrame:
    """Add ``before`` and ``after``: structs of the state for both starts."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    flips, after = _chained(if_out, if_in, upto)
    start = F.struct(F.lit(False).alias("from_out"), F.lit(True).alias("from_in"))
    previous = F.lag("after").over(Window.partitionBy(*keys).orderBy(order))
    return (
        df.withColumn("flips", flips)
        .withColumn("after", after)
        .withColumn("before", F.coalesce(previous, start))
        .drop("flips")
    )


def _line_effects(lines: DataFrame, open_quote: str) -> DataFrame:
    """What each line does to the state outside and inside a quoted field."""
    value = F.col("value")
    quoted = F.contains(value, F.lit(QUOTE))
    return lines.withColumns(
        {
            "if_out": quoted & value.rlike(open_quote),
            # inside a field a line goes on as if the quote stood before it
            "if_in": ~quoted | F.concat(F.lit(QUOTE), value).rlike(open_quote),
        }
    )


def _traced(lines: DataFrame) -> DataFrame:
    """Lines with the state before and after each, and where its record starts, for either state at the block's start.

    ``before_out`` is the state before the line if the block starts outside a
    field, ``before_in`` if inside, and so on; ``start_*`` is the position of
    the line that the record starts with, -1 if that is in an earlier block.
    The lines of a block are in one task and in order.
    """
    added = "before_out boolean, after_out boolean, start_out bigint, before_in boolean, after_in boolean, start_in bigint"

    # all inside one function: it is sent to the tasks, which need no copy of this package
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["before_out", "after_out", "start_out", "before_in", "after_in", "start_in"]
        key, states = None, []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            path = batch["path"].dictionary_encode()
            code, block, position = path.indices.to_numpy(), batch["block"].to_numpy(), batch["position"].to_numpy()
            if_out, if_in = (batch[c].to_numpy(zero_copy_only=False) for c in ("if_out", "if_in"))
            cuts = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (block[1:] != block[:-1]), [True]]))
            parts: list[list[np.ndarray]] = [[] for _ in names]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                here = (path.dictionary[int(code[a])].as_py(), int(block[a]))
                if here != key:
                    key, states = here, [(False, -1), (True, -1)]
                sets, to = if_out[a:b] == if_in[a:b], if_out[a:b]
                flips = np.cumsum(to & ~if_in[a:b])
                last = np.maximum.accumulate(np.where(sets, np.arange(b - a), -1))
                odd = (flips - np.where(last >= 0, flips[last], 0)) % 2 == 1
                for k, (state, start) in enumerate(states):
                    after = np.where(last >= 0, to[last], state) ^ odd
                    before = np.concatenate([[state], after[:-1]])
                    begin = np.maximum.accumulate(np.where(before, start, position[a:b]))
                    states[k] = bool(after[-1]), int(begin[-1])
                    for column, values in zip(parts[3 * k : 3 * k + 3], (before, after, begin), strict=True):
                        column.append(values)
            kept = [c for c in batch.schema.names if c not in ("if_out", "if_in")]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *(pa.array(np.concatenate(p)) for p in parts)], names=[*kept, *names])

    return lines.mapInArrow(run, f"path string, block bigint, position bigint, value string, filled boolean, {added}")


def read_long_records(
    spark: SparkSession, paths: list[str], encoding: str, open_quote: str
) -> DataFrame:
    """``path, value``: one row per record, without header and blank lines.

    The lines are written once to the scratch folder: blocks and lines have to
    agree on where a split begins, which two scans need not.
    """
    value = F.col("value")
    if encoding != "UTF-8":
        value = F.decode(value.cast("binary"), encoding)
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        value.alias("value"),
    )
    lines = _line_effects(lines, open_quote).withColumn("filled", not_blank("value"))
    folder = scratch_folder(spark, "lines")
    traced = _traced(lines.select("path", "block", "position", "value", "filled", "if_out", "if_in"))
    traced.write.parquet(folder)
    stored = spark.read.schema(traced.schema).parquet(folder)

    keys = ["path", "block"]

    def last_open(start: str) -> Column:
        return F.max(F.when(~F.col(f"before_{start}"), F.col("position")))

    blocks = stored.groupBy(*keys).agg(
        F.max_by(F.struct(F.col("after_out").alias("from_out"), F.col("after_in").alias("from_in")), "position").alias("end"),
        last_open("out").alias("open_out"),
        last_open("in").alias("open_in"),
        F.min(F.when(F.col("filled"), F.col("position"))).alias("first_line"),  # of the block
    )
    blocks = _with_states(blocks, F.col("end.from_out"), F.col("end.from_in"), ["path"], "block")
    inside = F.col("before.from_out")
    opened = F.when(inside, F.col("open_in")).otherwise(F.col("open_out"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    anchor = F.struct(F.col("block").alias("block"), opened.alias("position"))
    blocks = blocks.select(
        *keys,
        inside.alias("inside"),
        F.col("after.from_out").alias("inside_at_end"),
        F.last(F.when(opened.isNotNull(), anchor), ignorenulls=True).over(earlier).alias("carried"),
        F.when(F.count("first_line").over(earlier) == 0, F.col("first_line")).alias("header"),
    )
    # small, and needed twice: by the check now and by the records later
    block_folder = scratch_folder(spark, "blocks")
    blocks.write.parquet(block_folder)
    blocks = spark.read.schema(blocks.schema).parquet(block_folder)
    _check_closed(blocks)
    if blocks.count() <= MOST_BLOCKS:
        blocks = F.broadcast(blocks)

    def state(column: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{column}_in")).otherwise(F.col(f"{column}_out"))

    placed = stored.join(blocks, keys).select(
        *keys,
        "position",
        "value",
        "filled",
        "carried",
        (~state("before")).alias("opens"),
        (~state("after")).alias("closes"),
        state("start").alias("in_block"),
        F.coalesce(F.col("position") == F.col("header"), F.lit(False)).alias("is_header"),
    )
    whole = placed.where("opens and closes and not is_header and filled")
    pieces = placed.where("not (opens and closes)")
    start = F.coalesce(
        F.when(F.col("in_block") >= 0, F.struct(F.col("block").alias("block"), F.col("in_block").alias("position"))),
        F.col("carried"),
    )
    part = F.struct("block", "position", "value")
    joined = (
        pieces.withColumn("start", start)
        .groupBy("path", "start")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"), F.bool_or("is_header").alias("is_header"))
        .where("not is_header")
        .select("path", F.array_join(F.col("parts.value"), "\n").alias("value"))
    )
    return whole.select("path", "value").unionByName(joined)


def _check_closed(blocks: DataFrame) -> None:
    """A field left open at the end of a file would swallow the rest of it."""
    ends = blocks.groupBy("path").agg(F.max_by("inside_at_end", "block").alias("open"))
    broken = ends.where("open")
    files = [r.path for r in broken.limit(10).collect()]
    if files:
        more = broken.count() - len(files)
        raise ValueError(f"quoted field not closed at the end of {files}" + (f" and {more} more files" if more else ""))
