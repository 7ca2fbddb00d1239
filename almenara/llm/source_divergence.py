"""Divergence of each source's terms from its language's other sources.

Terms are counted in tasks, in buckets by length: a term of up to 8 bytes is
one unsigned 64-bit number, one of up to 16 bytes two, and these are sorted by
radix and counted by runs; longer terms are sorted as byte strings, one bucket
for each length. Spark adds the counts up.

All later arithmetic is in whole numbers. A pair of sources needs a sum over
every term that its language keeps, most of which at least one of the two does
not have. Such a term's value depends on the other source's share alone, and a
source has at most some 45,000 different shares, as they are whole numbers
that sum to about 10**9. So terms in one source are added by share, terms in
none by their number, and only terms in both are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almenara.llm.arrays import PIECE, column_bytes, document_blocks, lower_table, pieces, words_of
from almenara.llm.tables import stored, text_bytes

#: shares are parts of this number
UNIT = 1_000_000_000
MIN_DOCS, TOP = 3, 200
#: elements of one block of compared shares
_BLOCK = 1 << 20


def gap_table() -> np.ndarray:
    """Bytes that belong to no term: ASCII other than letters."""
    table = np.zeros(256, dtype=bool)
    table[:128] = True
    table[65:91] = table[97:123] = False
    return table


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int) -> np.ndarray:
    """Bytes ``at`` to ``at`` + 8 of each term as one number, zeros behind the term's end; it sorts as the bytes do.

    ``data`` has 16 bytes behind the last term; each term is longer than ``at``.
    """
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)[starts + at]
    spare = (8 * np.maximum(at + 8 - lengths, 0)).astype(np.uint64)
    return np.ascontiguousarray(eight).view(">u8")[:, 0].astype(np.uint64) >> spare << spare


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by several numbers, the first counting most: counting passes over 16 bits, lowest first."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def count_runs(order: np.ndarray, keys: list[np.ndarray], document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row of each run of equal keys, the run's length, and its number of documents; equal keys lie in document order."""
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for key in keys:
        sorted_key = key[order]
        fresh[1:] |= sorted_key[1:] != sorted_key[:-1]
    firsts = np.flatnonzero(fresh)
    held_by = document[order]
    fresh[1:] |= held_by[1:] != held_by[:-1]
    return order[firsts], np.diff(np.append(firsts, len(order))), np.add.reduceat(fresh, firsts, dtype=np.int64)


def count_terms(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents of every term of every group of some documents."""
    data = lower_table()[data]
    starts, ends = words_of(data, offsets, gap_table())
    lengths = ends - starts
    document = np.searchsorted(offsets, starts, side="right") - 1
    of = group[document].astype(np.uint64)
    data = np.concatenate([data, np.zeros(16, np.uint8)])
    groups, texts, counts, documents = [], [], [], []
    for low, high in ((0, 8), (8, 16)):
        rows = np.flatnonzero((lengths > low) & (lengths <= high))
        if not len(rows):
            continue
        keys = [of[rows]] + [packed(data, starts[rows], lengths[rows], at) for at in range(0, high, 8)]
        one, n, docs = count_runs(radix_order(keys), keys, document[rows])
        size = lengths[rows[one]]
        ends_at = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(starts[rows[one]] - ends_at[:-1], size) + np.arange(ends_at[-1])
        texts.append(pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(ends_at.astype(np.int32)), pa.py_buffer(data[at])]))
        groups.append(of[rows[one]])
        counts.append(n)
        documents.append(docs)
    for size in np.unique(lengths[lengths > 16]):
        rows = np.flatnonzero(lengths == size)
        term = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, int(size))[starts[rows]]).view(f"S{size}")[:, 0]
        order = np.argsort(term, kind="stable")
        order = order[np.argsort(of[rows][order], kind="stable")]
        one, n, docs = count_runs(order, [of[rows], term], document[rows])
        texts.append(pa.array([bytes(t) for t in term[one]], pa.binary()))
        groups.append(of[rows[one]])
        counts.append(n)
        documents.append(docs)
    if not texts:
        return np.zeros(0, np.int64), pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(groups).astype(np.int64), pa.concat_arrays(texts), np.concatenate(counts), np.concatenate(documents)


def _count_long(data: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """``count_terms`` of one long document, in pieces; a term counts one document however many pieces hold it."""
    parts = [count_terms(data[a:b], np.array([0, b - a]), group) for a, b in pieces(data, PIECE, gap_table())]
    table = pa.table({"term": pa.concat_arrays([p[1] for p in parts]), "n": np.concatenate([p[2] for p in parts])})
    merged = table.group_by("term").aggregate([("n", "sum")])
    term = merged["term"].combine_chunks()
    return np.repeat(group, len(term)), term, merged["n_sum"].to_numpy(), np.ones(len(term), np.int64)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``_lang``, ``_source``, ``_term``, ``_count``, ``_docs``: occurrences and documents of each term in each group.

    Null languages and sources are ''. Each group has a row for the term ''
    besides, which no text holds, so that groups without terms are there too.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    rows = docs.select(plain(lang_col).alias("_lang"), plain(source_col).alias("_source"), text_bytes(text_col).alias("_text"))
    names = ["_lang", "_source", "_term", "_count", "_docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = batch["_lang"].dictionary_encode(), batch["_source"].dictionary_encode()
            width = max(len(source.dictionary), 1)
            code = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
            seen, group = np.unique(code, return_inverse=True)
            data, offsets = column_bytes(batch["_text"])
            tables = [(np.arange(len(seen)), pa.array([b""] * len(seen), pa.binary()), np.zeros(len(seen), np.int64), np.zeros(len(seen), np.int64))]
            for first, last in document_blocks(offsets, PIECE):
                lo, hi = int(offsets[first]), int(offsets[last])
                long = hi - lo > 2 * PIECE
                tables.append(_count_long(data[lo:hi], group[first:last]) if long else count_terms(data[lo:hi], offsets[first : last + 1] - lo, group[first:last]))
            for of, term, n, held in tables:
                columns = [lang.dictionary.take(pa.array(seen[of] // width)), source.dictionary.take(pa.array(seen[of] % width)), term, pa.array(n, pa.int64()), pa.array(held, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    counted = rows.mapInArrow(run, "_lang string, _source string, _term binary, _count bigint, _docs bigint")
    summed = counted.groupBy("_lang", "_source", "_term").agg(F.sum("_count").alias("_count"), F.sum("_docs").alias("_docs"))
    return summed.withColumn("_term", F.col("_term").cast("string"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total), by long division in three steps, so that no product leaves 64 bits."""
    rest, out = count + F.lit(1), F.lit(0).cast("bigint")
    for _ in range(3):
        out = out * 1000 + _div(rest * 1000, total)
        rest = (rest * 1000) % total
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q); shares are at most UNIT + 1, so the square fits 64 bits."""
    return _div((p - q) * (p - q), q)


def shared_terms(held: DataFrame) -> DataFrame:
    """``_a``, ``_b``, ``_value``: what terms in both sources of a pair add to the pair, beyond what each adds alone.

    ``held`` has one row for each term of a language with the list ``_held`` of
    its groups, shares, and shares of a term they do not have. Lists are
    compared in blocks of bounded size and summed per batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["_held"]
            offsets = lists.offsets.to_numpy().astype(np.int64)
            entries = lists.values
            group, p, zero = (entries.field(n).to_numpy() for n in ("_group", "_p", "_zero"))
            size = np.diff(offsets)
            for k in np.unique(size[size > 1]):
                rows = offsets[:-1][size == k]
                wide = max(_BLOCK // int(k * k), 1)
                deep = max(_BLOCK // int(k), 1)
                for a in range(0, len(rows), wide):
                    at = rows[a : a + wide, None] + np.arange(k)
                    for b in range(0, int(k), deep):
                        yield _compare(group, p, zero, at[:, b : b + deep], at)

    return held.select("_held").mapInArrow(run, "_a bigint, _b bigint, _value bigint")


def _compare(group: np.ndarray, p: np.ndarray, zero: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """Sums over terms for all pairs of a left and a right entry of the same term."""

    def value(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x[left][:, :, None] - y[right][:, None, :]) ** 2 // y[right][:, None, :]

    shape = (*left.shape, right.shape[1])
    total = (value(p, p) - value(p, zero) - value(zero, p) + value(zero, zero)).ravel()
    a = np.broadcast_to(group[left][:, :, None], shape).ravel()
    b = np.broadcast_to(group[right][:, None, :], shape).ravel()
    other = a != b
    a, b, total = a[other], b[other], total[other]
    order = np.lexsort((b, a))
    a, b, total = a[order], b[order], total[order]
    firsts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    sums = np.add.reduceat(total, firsts) if len(a) else total
    return pa.RecordBatch.from_arrays([pa.array(a[firsts]), pa.array(b[firsts]), pa.array(sums)], names=["_a", "_b", "_value"])


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
) -> DataFrame:
    """``_lang``, ``_source``, ``_part``, ``_item``, ``_value``, ``_rank``: how each source of a language differs.

    A language keeps the terms of at least ``min_docs`` of its documents. Part
    ``pair``: the sum over kept terms against each other source of the language.
    Part ``term``: the ``top`` terms that the source holds more than the
    language does. Ties go to the smaller item by bytes.

    Null text, language and source count as ''; repeated rows are documents of
    their own; a source without terms has pairs only, and values are 0 where the
    language keeps no term. No rows, no result. Other columns make no difference.
    Sums are exact while a language keeps fewer than 10**9 terms.
    """
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    by_term = counts.where("_term <> ''").groupBy("_lang", "_term").agg(
        F.sum("_docs").alias("_docs"), F.sum("_count").alias("_total"), F.collect_list(F.struct("_source", "_count")).alias("_held")
    )
    kept = stored(by_term.where(F.col("_docs") >= min_docs).drop("_docs"), "kept-terms")
    flat = kept.select("_lang", "_term", "_total", F.inline("_held"))
    of_lang = kept.groupBy("_lang").agg(F.count("*").alias("_v"), F.sum("_total").alias("_n_lang"))
    of_group = flat.groupBy("_lang", "_source").agg(F.sum("_count").alias("_n"), F.count("*").alias("_terms"))
    groups = counts.where("_term = ''").select("_lang", "_source")
    sizes = groups.join(of_lang, "_lang", "left").join(of_group, ["_lang", "_source"], "left").na.fill(0, ["_v", "_n_lang", "_n", "_terms"])
    sizes = stored(
        sizes.withColumn("_group", F.xxhash64("_lang", "_source")).withColumn("_zero", F.when(F.col("_v") > 0, share(F.lit(0).cast("bigint"), F.col("_n") + F.col("_v")))),
        "group-sizes",
    )
    shares = flat.join(sizes, ["_lang", "_source"]).select(
        "_lang", "_source", "_term", "_group", "_zero",
        share(F.col("_count"), F.col("_n") + F.col("_v")).alias("_p"),
        share(F.col("_total"), F.col("_n_lang") + F.col("_v")).alias("_q"),
    )
    shares = stored(shares, "term-shares")
    by_value = Window.partitionBy("_lang", "_source").orderBy(F.col("_value").desc(), "_item")
    terms = shares.where("_p > _q").select("_lang", "_source", F.col("_term").alias("_item"), divergence(F.col("_p"), F.col("_q")).alias("_value"))
    terms = terms.withColumn("_rank", F.row_number().over(by_value)).where(F.col("_rank") <= top)
    pairs = _pairs(shares, sizes).withColumn("_rank", F.row_number().over(by_value))
    columns = ["_lang", "_source", "_part", "_item", "_value", "_rank"]
    return pairs.withColumn("_part", F.lit("pair")).select(columns).union(terms.withColumn("_part", F.lit("term")).select(columns))


def _pairs(shares: DataFrame, sizes: DataFrame) -> DataFrame:
    """``_lang``, ``_source``, ``_item``, ``_value``: the divergence of each source from each other one of its language."""
    exact = "decimal(38,0)"
    other = sizes.select("_lang", F.col("_source").alias("_item"), F.col("_group").alias("_b"), F.col("_zero").alias("_other_zero"), F.col("_terms").alias("_other_terms"))
    lists = shares.groupBy("_lang", "_term").agg(F.collect_list(F.struct("_group", "_p", "_zero")).alias("_held")).where(F.size("_held") > 1)
    both = shared_terms(lists).select("_a", "_b", F.col("_value").cast(exact).alias("_value"))
    by_share = shares.groupBy("_lang", F.col("_group").alias("_a"), "_p").agg(F.count("*").cast("decimal(19,0)").alias("_n"))
    against = by_share.join(other, "_lang").where("_a <> _b")

    def times(value: Column) -> Column:
        return (F.col("_n") * value.cast("decimal(19,0)")).cast(exact)

    there = F.struct(F.col("_a"), F.col("_b"), times(divergence(F.col("_p"), F.col("_other_zero"))).alias("_value"))
    back = F.struct(F.col("_b").alias("_a"), F.col("_a").alias("_b"), times(divergence(F.col("_other_zero"), F.col("_p"))).alias("_value"))
    alone = against.select(F.inline(F.array(there, back)))
    added = both.union(alone).groupBy("_a", "_b").agg(F.sum("_value").alias("_added"))
    names = sizes.withColumnRenamed("_group", "_a").join(other, "_lang").where("_a <> _b")
    neither = (F.col("_v") - F.col("_terms") - F.col("_other_terms")).cast("decimal(19,0)") * divergence(F.col("_zero"), F.col("_other_zero")).cast("decimal(19,0)")
    value = F.coalesce(neither.cast(exact), F.lit(0)) + F.coalesce(F.col("_added"), F.lit(0))
    return names.join(added, ["_a", "_b"], "left").select("_lang", "_source", "_item", value.cast("bigint").alias("_value"))
