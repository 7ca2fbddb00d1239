"""Runs of repeating words, found by joining suffix classes in the order of falling common prefixes.

Suffixes of a text's words are sorted and joined by Kruskal's rule: neighbours
in suffix order are united, longest common prefix first. At length l the
classes are the sets of positions where the same l words begin. A class keeps
its positions in order; when two are united, the smaller one's positions are
put into the larger one, and each meets its new neighbours. Two neighbours at a
distance d within the common prefix begin a repetition of period d, the seed
of a run, which is then extended to both sides.

A run of at least three periods is always seeded by its first position s: at
length l, the number of words in which the texts from s and from s + q agree,
both are in one class, and no position between them can be, as the run would
have a shorter period. Seeds whose distance is a multiple of the period, found
between unions at one length, extend to the same run; the smallest is kept.

Runs are short stretches of few texts, so only the stretches are sorted that
can hold one. In a run of period q each group of three words after the first q
occurs at most q words before, and there are at least (e - 1) q - 2 such
places side by side, for runs of at least e periods. Maximal stretches of
places that repeat within that distance, extended by it to the left, hold
every run entirely.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.llm.arrays import PIECE, column_bytes, document_blocks, join_words, ngram_hashes, pieces, powers, span_hashes, word_hashes, words_of
from almenara.llm.tables import row_key, text_bytes

MIN_WORDS, MIN_PERIODS = 6, 4
_GRAM = 3
#: positions in one part of an ordered set
_PART = 512


class PositionSet:
    """Positions in order, in parts of bounded size, so that an insertion moves few of them."""

    __slots__ = ("parts", "lasts", "size")

    def __init__(self, position: int) -> None:
        self.parts, self.lasts, self.size = [[position]], [position], 1

    def add(self, x: int) -> tuple[int, int]:
        """Inserts ``x``; its neighbours, -1 where there is none."""
        lasts = self.lasts
        k = bisect_left(lasts, x)
        if k == len(lasts):
            part = self.parts[-1]
            before, after = part[-1], -1
            part.append(x)
            k -= 1
            lasts[k] = x
        else:
            part = self.parts[k]
            i = bisect_left(part, x)
            after = part[i]
            before = part[i - 1] if i else lasts[k - 1] if k else -1
            part.insert(i, x)
        self.size += 1
        if len(part) > _PART:
            half = len(part) // 2
            self.parts[k : k + 1] = [part[:half], part[half:]]
            lasts[k : k + 1] = [part[half - 1], part[-1]]
        return before, after


def seeds_of(order: list[int], lengths: list[int], min_periods: int) -> tuple[list[int], list[int]]:
    """Positions and distances of all neighbours that are united within their common prefix.

    ``order`` holds positions in suffix order, ``lengths`` the common prefix of
    each with the one before; pairs of length 0 are not united. A distance
    counts if the prefix is at least ``min_periods`` - 1 times as long.
    """
    parent = list(range(len(order)))
    sets: list[PositionSet | None] = [None] * len(order)
    times = min_periods - 1
    at, far = [], []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k in sorted((k for k in range(1, len(order)) if lengths[k]), key=lengths.__getitem__, reverse=True):
        limit = lengths[k] // times
        a, b = root(k - 1), root(k)
        large, small = sets[a] or PositionSet(order[a]), sets[b] or PositionSet(order[b])
        if small.size > large.size:
            a, b, large, small = b, a, small, large
        for part in small.parts:
            for x in part:
                before, after = large.add(x)
                if before >= 0 and x - before <= limit:
                    at.append(before)
                    far.append(x - before)
                if after >= 0 and after - x <= limit:
                    at.append(x)
                    far.append(after - x)
        parent[b], sets[a], sets[b] = a, large, None
    return at, far


def stretches(words: np.ndarray, edges: np.ndarray, min_periods: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the stretches that can hold a run; none overlaps another."""
    none = np.zeros(0, np.int64)
    grams = ngram_hashes(words, _GRAM)
    if not len(grams):
        return none, none
    order = np.argsort(grams, kind="stable")
    document = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    distance = np.zeros(len(words), np.int64)
    again = (grams[order[1:]] == grams[order[:-1]]) & (document[order[1:]] == document[order[:-1]])
    distance[order[1:][again]] = (order[1:] - order[:-1])[again]
    inside = np.zeros(len(words), bool)
    inside[: len(grams)] = document[_GRAM - 1 :] == document[: len(grams)]
    near = (distance > 0) & inside
    while True:
        change = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]]).astype(np.int8)))
        first, last = change[::2], change[1::2]
        widest = (last - first + _GRAM - 1) // (min_periods - 1)
        kept = near.copy()
        kept[near] = distance[near] <= np.repeat(widest, last - first)
        if kept.sum() == near.sum():
            break
        near = kept
    if not len(first):
        return none, none
    start, end = np.maximum(first - widest, edges[document[first]]), last + _GRAM - 1
    by = np.argsort(start, kind="stable")  # a wide stretch may begin before a narrow one to its left
    start, end = start[by], end[by]
    joined = np.concatenate([[True], start[1:] >= np.maximum.accumulate(end)[:-1]])
    return start[joined], np.maximum.reduceat(end, np.flatnonzero(joined))


def suffix_order(values: np.ndarray, stretch: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes within a stretch, by doubling; stretches lie one after the other."""
    n = len(values)

    def ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
        fresh = np.zeros(n, np.int64)
        for key in keys:
            fresh[1:] |= key[order[1:]] != key[order[:-1]]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(fresh)
        return out

    order = np.lexsort((values, stretch))
    rank = ranks(order, stretch, values)
    step, places = 1, np.arange(n)
    while rank[order[-1]] < n - 1:
        then = np.zeros(n, np.int64)
        more = places + step < ends
        then[more] = rank[places[more] + step] + 1
        key = rank * (n + 1) + then
        order = np.argsort(key, kind="stable")
        rank = ranks(order, key)
        step *= 2
    return order


def common_length(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
    """Number of equal words from (or, ``back``, up to) ``a`` and ``b``, at most ``limit``, by halving."""
    low, high = np.zeros_like(limit), limit.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        if back:
            same = span_hashes(prefix, a - middle, a) == span_hashes(prefix, b - middle, b)
        else:
            same = span_hashes(prefix, a, a + middle) == span_hashes(prefix, b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def runs_of(words: np.ndarray, edges: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows of first word, length and period of every run, by first word and period; ``edges`` cuts ``words`` into documents."""
    if min_periods < 3 or min_words * (min_periods - 1) < _GRAM * min_periods:
        raise ValueError(f"runs of fewer than 3 periods or {_GRAM} words after the first period are not found by this method")
    first, last = stretches(words, edges, min_periods)
    if not len(first):
        return np.zeros((0, 3), np.int64)
    size = last - first
    opens = np.cumsum(size) - size
    stretch = np.repeat(np.arange(len(first)), size)
    moved = first[stretch] - opens[stretch]
    values = words[np.arange(len(stretch)) + moved]
    begins, ends = opens[stretch], (opens + size)[stretch]
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=prefix[1:])
    order = suffix_order(values, stretch, ends)
    a, b = order[:-1], order[1:]
    limit = np.where(stretch[a] == stretch[b], np.minimum(ends[a] - a, ends[b] - b), 0)
    length = common_length(prefix, a, b, limit)
    # what follows a run's first period has at least so many words
    length[length * min_periods < min_words * (min_periods - 1)] = 0
    at, far = (np.array(x, np.int64) for x in seeds_of(order.tolist(), [0, *length.tolist()], min_periods))
    end = at + far + common_length(prefix, at, at + far, ends[at] - at - far if len(at) else at)
    start = at - common_length(prefix, at, at + far, at - begins[at] if len(at) else at, back=True)
    by = np.lexsort((far, end, start))
    start, end, far = start[by], end[by], far[by]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    kept = fresh & (end - start >= np.maximum(min_words, min_periods * far))
    start, end, far = start[kept], end[kept], far[kept]
    by = np.lexsort((far, start))
    return np.stack([start + moved[start] if len(start) else start, end - start, far], axis=1)[by]


def _block(data: np.ndarray, offsets: np.ndarray, min_words: int, min_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of some documents (first word counted in each), runs per document, bytes and offsets without repeats."""
    hashes, edges = word_hashes(data, offsets, lower=False)
    runs = runs_of(hashes, edges, min_words, min_periods)
    document = np.searchsorted(edges, runs[:, 0], side="right") - 1
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    chosen = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    if len(offsets) == 2:
        spans = [(a + np.stack(words_of(data[a:b], np.array([0, b - a])))) for a, b in pieces(data, PIECE)]
        starts, ends = np.concatenate(spans, axis=1) if spans else np.zeros((2, 0), np.int64)
    else:
        starts, ends = words_of(data, offsets)
    text, cuts = join_words(data, starts, ends, chosen, np.searchsorted(chosen, edges))
    runs[:, 0] -= edges[document]
    return runs, np.bincount(document, minlength=len(offsets) - 1), text, cuts


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``_id``, ``_key``, ``_runs``, ``_collapsed`` per row of ``docs``.

    ``_runs`` lists ``start``, ``length`` and ``period`` in words, by start and
    period, of every maximal stretch of words of at least ``min_words`` words
    and ``min_periods`` times its smallest period. ``_collapsed`` is the text,
    words joined by one blank, without what runs hold after their first period.

    Words are longest runs of bytes other than ASCII blanks and compared as
    written. Null, empty and blank texts have no runs and an empty text; rows
    that repeat, and null ids, are worked on like others; other columns make no
    difference. No shuffle. A long text is hashed in pieces; its words take some
    80 bytes of memory each, those of stretches that can hold runs some 400.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), text_bytes(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch["_text"])
            for first, last in document_blocks(offsets, PIECE):
                lo, hi = int(offsets[first]), int(offsets[last])
                runs, counts, text, cuts = _block(data[lo:hi], offsets[first : last + 1] - lo, min_words, min_periods)
                flat = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in runs.T], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), flat)
                texts = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(text)])
                here = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([here["_id"], here["_key"], lists, texts], names=["_id", "_key", "_runs", "_collapsed"])

    kind = f"_id {id_type}, _key bigint, _runs array<struct<start:bigint,length:bigint,period:bigint>>, _collapsed binary"
    return rows.mapInArrow(run, kind).withColumn("_collapsed", F.col("_collapsed").cast("string"))
