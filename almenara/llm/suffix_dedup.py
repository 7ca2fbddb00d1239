"""Removal of repeated byte strings by blockwise suffix sorting with cover-sample ranks.

Every window of ``length`` bytes picks one sampled position inside it, that of
its smallest k-gram hash. The choice depends on the window's bytes alone, so
equal windows pick the same position: the sample is a difference cover that
follows the content. About one position in ``length`` / 2 is sampled.

1. Cover sample: per sampled position its class (k-gram hash) and its rank (a
   hash of all bytes of the windows that picked it, and of where it lies in
   them). Positions of equal class and rank stand for runs of windows that are
   equal throughout; these long ties are settled by rank, and no suffix of
   theirs is sorted.
2. Suffix buckets: where a class has several ranks, the windows of one
   occurrence of each rank are sorted, one class at a time in the memory of
   one task. Windows of different classes cannot be equal.
3. A class with more ranks than a bucket may hold is split over buckets; each
   sends the distinct windows that it could not settle on, and a plain count
   over all buckets settles these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.llm.arrays import PIECE, column_bytes, document_blocks, list_column, mix, prefix_hashes, seeds, span_hashes
from almenara.llm.tables import row_key, same_row, stored, text_bytes

LENGTH = 400
_GRAM = 48
_LOW = np.uint64((1 << 24) - 1)
#: ranks of one class in one bucket
BUCKET = 4096


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbouring values, in time that does not depend on the width."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def cover_sample(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Sampled positions of a piece of text: document, class, rank, first window, width, offset.

    ``width``: how many windows beside the first picked the position;
    ``offset``: from the first window's start to the position.
    """
    gram = min(_GRAM, length)
    nothing = (np.zeros(0, np.int64),) * 6
    if len(data) < length:
        return nothing
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    grams = mix(span_hashes(prefix, at, at + gram))
    picked = (sliding_minimum((grams & ~_LOW) | at.astype(np.uint64), length - gram + 1) & _LOW).astype(np.int64)
    start = np.arange(len(picked))
    doc = np.searchsorted(offsets, start, side="right") - 1
    inside = start + length <= offsets[doc + 1]
    start, picked, doc = start[inside], picked[inside], doc[inside]
    if not len(start):
        return nothing
    opens = np.concatenate([[True], (picked[1:] != picked[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(start)) - 1
    s0, s1, anchor = start[first], start[last], picked[first]
    offset = anchor - s0
    rank = span_hashes(prefix, s0, s1 + length) + seeds(1, 5) * offset.astype(np.uint64) + seeds(1, 6) * (s1 - s0).astype(np.uint64)
    return doc[first], grams[anchor].view(np.int64), mix(rank).view(np.int64), s0, s1 - s0, offset


def _sampled(rows: DataFrame, length: int) -> DataFrame:
    id_type = rows.schema["_id"].dataType.simpleString()

    def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for first, last in document_blocks(offsets):
            lo, hi = int(offsets[first]), int(offsets[last])
            if hi - lo <= 2 * PIECE:
                doc, *rest = cover_sample(data[lo:hi], offsets[first : last + 1] - lo, length)
                if len(doc):
                    rest[2] = rest[2] - (offsets[first + doc] - lo)
                    yield (doc + first, *rest)
                continue
            for a in range(0, hi - lo - length + 1, PIECE):  # one long text, in pieces that share length - 1 bytes
                part = data[lo + a : min(lo + a + PIECE + length - 1, hi)]
                doc, *rest = cover_sample(part, np.array([0, len(part)]), length)
                if len(doc):
                    rest[2] = rest[2] + a
                    yield (doc + first, *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in pieces(*column_bytes(batch["_text"])):
                doc, kind, rank, start, width, offset = found
                order = np.lexsort((start, rank, kind, doc))
                doc, kind, rank, start, width, offset = (x[order] for x in (doc, kind, rank, start, width, offset))
                opens = np.concatenate([[True], (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1]) | (rank[1:] != rank[:-1])])
                at = np.flatnonzero(opens)
                rows_of = pa.array(doc[at])
                yield pa.RecordBatch.from_arrays(
                    [batch["_id"].take(rows_of), batch["_key"].take(rows_of), pa.array(kind[at]), pa.array(rank[at]), pa.array(width[at]), pa.array(offset[at]), list_column(start, np.diff(np.append(at, len(start))), pa.int64())],
                    names=["_id", "_key", "_class", "_rank", "_width", "_offset", "_starts"],
                )

    return rows.mapInArrow(run, f"_id {id_type}, _key bigint, _class bigint, _rank bigint, _width bigint, _offset bigint, _starts array<bigint>")


def _ranges(sorted_values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of consecutive numbers."""
    if len(sorted_values):
        cuts = np.flatnonzero(np.diff(sorted_values) > 1)
        yield from zip(sorted_values[np.append(0, cuts + 1)].tolist(), sorted_values[np.append(cuts, len(sorted_values) - 1)].tolist(), strict=True)


def _sort_buckets(suffixes: DataFrame, length: int) -> DataFrame:
    """Windows of each bucket sorted.

    ``suffixes``: ``_class``, ``_rank``, ``_n`` (occurrences), ``_salt``,
    ``_salts``, ``_bytes``. Rows with ``_first``/``_last`` are settled: these
    windows of a rank that occurs once repeat elsewhere. Rows with ``_window``
    are to be counted over all buckets of a class.
    """

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        data, offsets = column_bytes(rows["_bytes"])
        count = np.diff(offsets) - length + 1
        owner = np.repeat(np.arange(len(count)), count)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        begin = offsets[owner] + inner
        window = mix(span_hashes(prefix_hashes(data), begin, begin + length))
        order = np.argsort(window)
        ordered = window[order]
        opens = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        at = np.flatnonzero(opens)
        size = np.diff(np.append(at, len(ordered)))
        twice = np.zeros(len(window), bool)
        twice[order] = (size > 1)[np.cumsum(opens) - 1]
        once = rows["_n"].to_numpy() == 1
        kind, rank = rows["_class"].to_numpy(), rows["_rank"].to_numpy()
        base = np.cumsum(count) - count
        repeated = twice & once[owner]
        found = [(i, *r) for i in np.unique(owner[repeated]) for r in _ranges(np.flatnonzero(repeated[base[i] : base[i] + count[i]]))]
        who, low, high = np.array(found, np.int64).reshape(-1, 3).T
        yield windows(kind[who], rank[who], low, high)
        if rows["_salts"][0].as_py() > 1:
            single = ~twice & once[owner]
            who = owner[single]
            yield windows(kind[who], rank[who], inner[single], inner[single], window[single])
            seen = order[at]
            yield windows(window=window[seen[~single[seen]]])

    def windows(kind=None, rank=None, low=None, high=None, window=None) -> pa.RecordBatch:
        size = len(kind) if kind is not None else len(window)
        columns = [kind, rank, low, high, window.view(np.int64) if window is not None else None]
        return pa.RecordBatch.from_arrays([pa.nulls(size, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns], names=["_class", "_rank", "_first", "_last", "_window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not len(batch):
                continue
            kind, salt = batch["_class"].to_numpy(), batch["_salt"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((kind[1:] != kind[:-1]) | (salt[1:] != salt[:-1])) + 1, [len(kind)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = (kind[a], salt[a])
                if now is not None and key != now:
                    yield from settle(pa.Table.from_batches(held).combine_chunks())
                    held = []
                now = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from settle(pa.Table.from_batches(held).combine_chunks())

    dealt = suffixes.repartition("_class", "_salt").sortWithinPartitions("_class", "_salt")
    return dealt.mapInArrow(run, "_class bigint, _rank bigint, _first bigint, _last bigint, _window bigint")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, bucket: int = BUCKET) -> DataFrame:
    """Byte spans of each document whose windows start elsewhere too: ``_id``, ``_key``, ``_spans``.

    ``_spans``: list of (``starts``, ``size``): from each start ``size`` bytes.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), text_bytes(text_col).alias("_text"))
    sample = stored(_sampled(rows, length), "cover-sample")
    ranks = sample.groupBy("_class", "_rank").agg(F.sum(F.size("_starts")).alias("_n"), F.min("_key").alias("_owner"))
    classes = ranks.groupBy("_class").agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_ranks")).where("_all > 1").drop("_all")
    classes = stored(classes, "classes")
    known = stored(ranks.join(classes, "_class"), "ranks")
    placed = stored(sample.join(known, ["_class", "_rank"]).where("_n > 1 OR _ranks > 1"), "placed")

    owners = placed.where("_ranks > 1 AND _key = _owner").dropDuplicates(["_class", "_rank"])
    wanted = owners.groupBy("_id", "_key").agg(F.collect_list(F.struct("_class", "_rank", "_n", "_ranks", F.element_at("_starts", 1).alias("_start"), "_width")).alias("_cut"))
    texts = same_row(rows, wanted).dropDuplicates(["_id", "_key"]).select("_text", F.explode("_cut").alias("_c"))
    salts = F.ceil(F.col("_c._ranks") / bucket).cast("int")
    suffixes = texts.select(
        F.col("_c._class").alias("_class"),
        F.col("_c._rank").alias("_rank"),
        F.col("_c._n").alias("_n"),
        F.pmod(F.col("_c._rank"), salts).cast("int").alias("_salt"),
        salts.alias("_salts"),
        F.substring(F.col("_text"), (F.col("_c._start") + 1).cast("int"), (F.col("_c._width") + length).cast("int")).alias("_bytes"),
    )
    sorted_ = stored(_sort_buckets(suffixes, length), "suffixes")
    settled = sorted_.where("_window IS NULL").select("_class", "_rank", "_first", "_last")
    loose = sorted_.where("_window IS NOT NULL")
    many = stored(loose.groupBy("_window").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_window"), "windows")
    settled = settled.unionByName(loose.where("_class IS NOT NULL").join(many, "_window").select("_class", "_rank", "_first", "_last"))

    once = placed.where("_n = 1").join(settled, ["_class", "_rank"])
    spans = placed.where("_n > 1").select("_id", "_key", "_starts", (F.col("_width") + length).alias("_size")).unionByName(
        once.select("_id", "_key", F.transform("_starts", lambda s: s + F.col("_first")).alias("_starts"), (F.col("_last") - F.col("_first") + length).alias("_size"))
    )
    return spans.groupBy("_id", "_key").agg(F.collect_set(F.struct(F.col("_starts").alias("starts"), F.col("_size").alias("size"))).alias("_spans"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, bucket: int = BUCKET, with_bytes: bool = True) -> DataFrame:
    """Per document ``_id``, ``_n_bytes``, ``_n_removed``, ``_n_spans``, ``_kept_sha256`` and ``_kept`` (bytes).

    A text is its UTF-8 bytes (null: empty). Every byte is removed that lies
    in a string of ``length`` bytes that also starts anywhere else, in the same
    or any other document; strings may overlap and never cross documents.
    ``_n_spans``: longest runs of removed bytes. The rest may end inside a
    character, hence bytes; ``_kept`` is null unless ``with_bytes``. Rows that
    repeat are documents of their own, so texts of ``length`` bytes or more
    lose everything. Ids may be null. An empty table gives no rows. Strings
    are told apart by 64-bit hashes.
    """
    spans = repeated_spans(docs, id_col, text_col, length, bucket)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), text_bytes(text_col).alias("_text"))
    joined = same_row(rows, spans, "left").select("_id", "_text", "_spans")
    id_type = rows.schema["_id"].dataType.simpleString()

    def cut(text: bytes, spans: list | None) -> tuple[bytes, int]:
        if not spans:
            return text, 0
        step = np.zeros(len(text) + 1, np.int32)
        for span in spans:
            starts = np.asarray(span["starts"])
            np.add.at(step, starts, 1)
            np.add.at(step, starts + span["size"], -1)
        gone = np.cumsum(step[:-1]) > 0
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        return np.frombuffer(text, np.uint8)[~gone].tobytes(), runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, digests, left = [], [], [], [], []
            for text, found in zip(batch["_text"], batch["_spans"], strict=True):
                whole = text.as_py()
                rest, n = cut(whole, found.as_py())
                sizes.append(len(whole))
                removed.append(len(whole) - len(rest))
                runs.append(n)
                digests.append(hashlib.sha256(rest).hexdigest())
                left.append(rest if with_bytes else None)
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string()), pa.array(left, pa.binary())], names=["_id", "_n_bytes", "_n_removed", "_n_spans", "_kept_sha256", "_kept"])

    return joined.mapInArrow(run, f"_id {id_type}, _n_bytes bigint, _n_removed bigint, _n_spans bigint, _kept_sha256 string, _kept binary")
