"""Mixing sources to target weights: weighted fair queueing in DataFrame operations.

Every source's documents are put in a fixed random order. A copy's virtual
finish time is the running total of its source's words up to and with it,
divided by the source's target. Copies are range-sorted by finish time over
all sources, and the mix ends where the running total reaches the budget.

Running totals over all rows, or over a source that holds a third of them, are
taken in two steps: within fine buckets of the order, then over the bucket
sums. No task holds more than one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almenara.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, pattern: list[int], max_repeats: int) -> DataFrame:
    """Per source: ``_source_size``, ``_weight`` and ``_target``.

    Sources in order of code point (null last) weigh as ``pattern`` repeats.
    The sum of all sizes is shared by weight; a target stops at
    ``max_repeats`` times the source's size and the excess goes to the others
    by weight, until none is above. With sources in order of cap over weight,
    those that stop form a beginning of that order, and the level per unit of
    weight left to the others is largest for the right beginning. One row per
    source is all that meets here, never documents.
    """
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(order) - 1, F.lit(len(pattern))).cast("int") + 1
    weight = F.element_at(F.array(*[F.lit(w) for w in pattern]), nth).cast("bigint")
    everything = Window.partitionBy(F.lit(1))
    earlier = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumns({"_weight": weight, "_cap": F.col("_source_size") * max_repeats, "_total": F.sum("_source_size").over(everything)})
        .withColumns({
            "_left": F.col("_total") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0)),
            "_weights": F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0)),
        })
        .withColumn("_level", F.max(F.col("_left") / F.col("_weights")).over(everything))
        .withColumn("_target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")))
        .select("_source", "_source_size", "_weight", "_total", "_target")
    )


def running_total(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Inclusive running total of ``value`` per group, over buckets and then ``order`` within them."""
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    before = over.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(g).alias(f"{g}_o") for g in group], F.col(bucket).alias("_b_o"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn(out, F.sum(value).over(within))
    on = local[bucket] == offsets["_b_o"]
    for g in group:
        on = on & local[g].eqNullSafe(offsets[f"{g}_o"])
    return local.join(offsets, on).withColumn(out, F.col(out) + F.col("_before")).drop("_b_o", "_before", *[f"{g}_o" for g in group])


def split_slots(rows: DataFrame, slots: int = 4096, least: int = 1000) -> DataFrame:
    """``rows`` with the slots cut up that one repeated id, or null, has filled.

    Slots of distinct ids fill evenly; one with over four times the mean holds
    an id that many rows share. Its rows are counted per code and size, and cut
    in that order into parts of at most the mean; rows equal in code and size
    are interchangeable, so where they alone are more than a part they are
    dealt by row number. A part's name sorts as its rows do.
    """
    per_slot = rows.groupBy("_source", "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    mean = F.greatest(F.lit(least), F.floor(per_slot.agg(F.sum("_rows") / slots).scalar()))
    per_slot = stored(per_slot.withColumn("_mean", mean), "mix-slots").where("_rows > 4 * _mean")
    hot = per_slot.select(F.col("_source").alias("_source_h"), F.col("_slot").alias("_slot_h"), "_mean")
    # at most ``slots`` / 4 slots can be over four times the mean
    marked = rows.join(F.broadcast(hot), F.col("_source").eqNullSafe(F.col("_source_h")) & (F.col("_slot") == F.col("_slot_h")), "left").drop("_source_h", "_slot_h")
    cell = ["_source", "_slot", "_shuffle", "_size"]
    full = stored(marked.where("_mean IS NOT NULL"), "mix-full-slots")
    before = Window.partitionBy("_source", "_slot").orderBy("_shuffle", "_size").rowsBetween(Window.unboundedPreceding, -1)
    cells = full.groupBy(*cell).agg(F.count(F.lit(1)).alias("_equal"), F.first("_mean").alias("_part_rows"))
    cells = cells.withColumn("_part_no", F.floor(F.coalesce(F.sum("_equal").over(before), F.lit(0)) / F.col("_part_rows")))
    cells = stored(cells, "mix-cells").withColumnsRenamed({c: f"{c}_c" for c in cell})
    same = F.col("_source").eqNullSafe(F.col("_source_c"))
    for c in cell[1:]:
        same = same & (F.col(c) == F.col(f"{c}_c"))
    share = F.pmod("_row", F.ceil(F.col("_equal") / F.col("_part_rows")))
    name = F.concat_ws(".", "_slot", F.lpad(F.col("_part_no").cast("string"), 12, "0"), F.when(F.col("_equal") > F.col("_part_rows"), F.lpad(share.cast("string"), 12, "0")))
    parts = full.join(cells, same).withColumn("_slot", name)
    return marked.where("_mean IS NULL").select(rows.columns).unionByName(parts.select(rows.columns))


def mix_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", pattern: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, budget: int | None = None, buckets: int = 4096) -> DataFrame:
    """One row per document and repeat (``_epoch``), with ``_finish`` and the words taken (``_taken``).

    Columns: ``_id``, ``_source``, ``_shuffle``, ``_nth`` (its place in
    its slot of the source's order), ``_size``, ``_source_size``, ``_target``, ``_epoch``,
    ``_finish``, ``_taken``. The copy that crosses its source's target is cut
    there, and the copy that crosses ``budget`` (default: the sum of all sizes)
    is cut there, so both are met to the word.

    A null text has size 0 and is taken 0 times; a null source is a source of
    its own; rows that repeat are documents of their own; rows of one id, or
    without one, are ordered by their size. An empty table gives no rows.
    """
    code = F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.lit("|mix")))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{source_col}`").alias("_source"),
        word_count(text_col).alias("_size"),
        code.alias("_shuffle"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_slot", F.substring("_shuffle", 1, 3))
    order = [F.col("_shuffle"), F.col("_size"), F.col("_id")]
    ties = Window.partitionBy("_source", "_slot").orderBy(*order, "_upto")
    rows = stored(rows, "mix-rows")
    ordered = running_total(split_slots(rows), ["_source"], "_slot", order, "_size", "_upto").withColumn("_nth", F.row_number().over(ties))
    targets = source_targets(rows.groupBy("_source").agg(F.sum("_size").alias("_source_size")), list(pattern), max_repeats).withColumnRenamed("_source", "_source_t")
    timed = ordered.join(targets, ordered["_source"].eqNullSafe(targets["_source_t"])).drop("_source_t")
    copies = timed.withColumn("_epoch", F.explode(F.array(*[F.lit(e) for e in range(max_repeats)])))
    end = F.col("_epoch") * F.col("_source_size") + F.col("_upto")
    room = F.round("_target").cast("bigint") - (end - F.col("_size"))
    copies = copies.withColumns({
        "_finish": F.when(F.col("_target") > 0, end / F.col("_target")).otherwise(F.lit(0.0)),
        "_part": F.greatest(F.least(F.col("_size"), room), F.lit(0)),
    }).withColumn("_band", F.least(F.floor(F.col("_finish") * (buckets // 2)), F.lit(buckets)).cast("int"))
    copies = stored(copies, "mix-copies")
    waiting = copies.where("_part > 0")  # the others, past their source's target, would all end up in the last band
    queued = running_total(waiting.repartitionByRange("_band"), [], "_band", [F.col("_finish"), *order, F.col("_epoch"), F.col("_nth")], "_part", "_mixed")
    limit = F.lit(budget) if budget is not None else F.col("_total")
    taken = F.greatest(F.least(F.col("_part"), limit - (F.col("_mixed") - F.col("_part"))), F.lit(0))
    columns = ["_id", "_source", "_slot", "_shuffle", "_nth", "_size", "_source_size", "_target", "_epoch", "_finish", "_taken"]
    idle = copies.where("_part = 0").withColumn("_taken", F.lit(0).cast("bigint"))
    return queued.withColumn("_taken", taken).select(columns).unionByName(idle.select(columns))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``_id``, ``_source``, ``_size``, ``_source_size``, ``_target``, ``_taken``."""
    keys = ["_source", "_slot", "_nth"]
    return mix_copies(docs, **options).groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("_id", "_size", "_source_size", "_target")], F.sum("_taken").alias("_taken")
    ).select("_id", "_source", "_size", "_source_size", "_target", "_taken")
