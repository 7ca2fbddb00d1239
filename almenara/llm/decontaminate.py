"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words, vectors of their hashed words weighted by TF
and IDF. One pass over all documents counts passage frequencies and sketches
the passage matrix: every task adds A'(A W) for its passages A and a fixed
random W, a table of bounded size. With the IDF weights D the sketch of the
weighted matrix A D under the test matrix W / D is D A'A W, so counting and
sketching need no second pass. A Nystroem step turns the sketch into singular
values and right singular vectors, the randomised SVD.

A second pass projects short windows of every text and of the benchmark items
and compares them by cosine. Where an item's windows, taken in order, agree
with the text's on average, the text may be a paraphrase: the longest common
subsequence of words may then be short, if it holds the item's last words, where
the answer is. Copies that keep more of the item's words in order count at any
cosine; they are looked for wherever the text has so many of the item's rare
words that so long a subsequence is not ruled out, which loses none of them.

The benchmark is worked through in blocks of items, each held by every task
while one pass over the documents lasts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from almenara.llm.arrays import PIECE, column_bytes, document_blocks, mix, seeds, word_hashes
from almenara.llm.tables import free_name, row_key
from almenara.session import scratch_folder

TERM_BITS, RANK, EXTRA = 15, 48, 16
#: leading directions that are not compared: they tell languages apart
SKIP = 4
#: words of a passage in the matrix, where passages lie side by side
PASSAGE = 32
#: words of a step and of a compared window; windows begin at every step
STEP, WINDOW = 8, 16
_PART = 1024  # terms in one row of partial sums
_KINDS = np.int8, np.int16, np.float32  # of numbers in partial sums; rows of zeros are left out
#: items that tasks hold at a time
BLOCK = 4096


def test_matrix() -> np.ndarray:
    """Fixed random signs, terms by rank."""
    n, k = 1 << TERM_BITS, RANK + EXTRA
    h = mix(np.arange(n * k, dtype=np.uint64) + np.uint64(1 << 33))
    return np.where(h & np.uint64(1), 1.0, -1.0).astype(np.float32).reshape(n, k)


def lower_text(text_col: str) -> Column:
    """A text in lower case, letters beyond ASCII too; null is empty."""
    return F.coalesce(F.lower(F.col(f"`{text_col}`").cast("string")), F.lit(""))


def terms(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def _segments(batch_column: pa.Array, overlap: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """First document, word hashes and edges of runs of documents, and words before the run in a long text."""
    data, offsets = column_bytes(batch_column)
    for first, last in document_blocks(offsets, PIECE):
        lo, hi = offsets[first], offsets[last]
        words, edges = word_hashes(data[lo:hi], offsets[first : last + 1] - lo)
        most = 1 << 18
        if last - first > 1 or len(words) <= most:
            yield first, words, edges, 0
            continue
        for at in range(0, len(words), most):  # one long text
            part = words[at : at + most + overlap]
            yield first, part, np.array([0, len(part)]), at


def _steps(words: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each step, and the document of each; steps do not cross documents."""
    counts = -(-np.diff(edges) // STEP)
    doc = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return edges[doc] + inner * STEP, doc


def row_sums(table: np.ndarray, index: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int, rows: int = 512) -> np.ndarray:
    """Sum of ``table[index]`` over runs of at most ``most`` entries, one place in the runs at a time; ``rows`` runs in one step."""
    out = np.empty((len(begin), table.shape[1]), table.dtype)
    for at in range(0, len(begin), rows):
        first, n = begin[at : at + rows], size[at : at + rows]
        sums = table.take(index[first], axis=0)
        for k in range(1, most):
            on = n > k
            if on.all():
                sums += table.take(index[first + k], axis=0)
            else:
                sums[on] += table.take(index[first[on] + k], axis=0)
        out[at : at + rows] = sums
    return out


def sketch_block(words: np.ndarray, edges: np.ndarray, test: np.ndarray, frequency: np.ndarray, sketch: np.ndarray) -> int:
    """Adds one run of documents; its passages lie side by side. Returns their number.

    Terms that are frequent in the run are multiplied as a dense matrix; the
    others are added in rounds, the n-th occurrence of each in the n-th.
    """
    if not len(words):
        return 0
    term = terms(words)
    counts = -(-np.diff(edges) // PASSAGE)
    doc = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = edges[doc] + inner * PASSAGE
    size = np.diff(np.append(begin, len(words)))
    passage = np.repeat(np.arange(len(begin)), size)
    projected = row_sums(test.astype(np.int8), term, begin, size, PASSAGE).astype(np.float32)  # signs: no sum is over PASSAGE
    order = np.argsort(term.astype(np.uint16), kind="stable")  # a radix sort
    t, p = term[order], passage[order]
    firsts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    times = np.diff(np.append(firsts, len(t)))
    once = np.concatenate([[True], (t[1:] != t[:-1]) | (p[1:] != p[:-1])])  # a term counts once in a passage
    frequency += np.bincount(t[once], minlength=len(frequency))
    many = np.flatnonzero(times > 16)
    column = np.full(len(frequency), -1)
    column[t[firsts[many]]] = np.arange(len(many))
    for at in range(0, len(begin), 1024):
        lo, hi = begin[at], len(words) if at + 1024 >= len(begin) else begin[at + 1024]
        c, q = column[term[lo:hi]], passage[lo:hi] - at
        n = min(1024, len(begin) - at)
        dense = np.bincount((c * n + q)[c >= 0], minlength=len(many) * n).astype(np.float32).reshape(len(many), n)
        sketch[t[firsts[many]]] += dense @ projected[at : at + n]
    few = np.flatnonzero(times <= 16)
    for k in range(16):
        few = few[times[few] > k]
        at = firsts[few] + k
        sketch[t[at]] += projected[p[at]]
    return len(begin)


@dataclass
class Space:
    """Latent space: IDF of each term, right singular vectors (terms by rank), singular values."""

    idf: np.ndarray
    vectors: np.ndarray
    values: np.ndarray

    def project(self) -> np.ndarray:
        """Latent vector of each term, all directions weighing the same."""
        used = self.values > 1e-6 * self.values.max(initial=0)
        used[:SKIP] = used.sum() <= 2 * SKIP  # in tiny tables all directions count
        return np.ascontiguousarray(self.idf[:, None] * self.vectors[:, used] / self.values[used], np.float32)  # rows are gathered


def solve(n: int, frequency: np.ndarray, sketch: np.ndarray, test: np.ndarray) -> Space:
    """Nystroem approximation of the weighted Gram matrix from its sketch."""
    idf = np.where(frequency > 0, np.log((n + 1) / np.maximum(frequency, 1)), 0.0)
    seen = idf > 0
    y, w = idf[:, None] * sketch, np.where(seen, 1 / np.where(seen, idf, 1), 0)[:, None].astype(np.float32) * test
    shift = 1e-6 * np.sqrt(np.einsum("ij,ij->", y, y)) + 1e-12
    small = np.zeros((y.shape[1],) * 2)
    for at in range(0, len(y), _PART):  # parts, so that no second table in double precision is made
        y[at : at + _PART] += shift * w[at : at + _PART]
        small += w[at : at + _PART].T @ y[at : at + _PART]
    del w
    values, basis = np.linalg.eigh((small + small.T) / 2)
    keep = values > values.max(initial=0) * 1e-10
    half = y @ (basis[:, keep] / np.sqrt(values[keep]))
    del y
    # singular vectors by way of the small Gram matrix, largest first
    squares, turn = np.linalg.eigh(half.T @ half)
    squares, turn = np.maximum(squares[::-1][:RANK], 0), turn[:, ::-1][:, :RANK]
    turn /= np.sqrt(np.where(squares > 1e-14 * squares.max(initial=0), squares, np.inf))
    left = half @ turn
    return Space(idf, left, np.sqrt(np.maximum(squares - shift, 0)))


def pack(sums: np.ndarray) -> bytes:
    """Rows of whole numbers, each in the narrowest of four kinds that holds it; single precision is the widest."""
    most = np.abs(sums).max(axis=1, initial=0)
    kind = np.searchsorted([0, 127, 32767], most).astype(np.uint8)
    return kind.tobytes() + b"".join(sums[kind == k].astype(t).tobytes() for k, t in enumerate(_KINDS, 1))


def unpack(value: bytes, width: int) -> np.ndarray:
    """Rows of ``pack`` in double precision."""
    kind = np.frombuffer(value, np.uint8, _PART)
    out, at = np.zeros((_PART, width)), _PART
    for k, t in enumerate(_KINDS, 1):
        rows = np.flatnonzero(kind == k)
        out[rows] = np.frombuffer(value, t, len(rows) * width, at).reshape(-1, width)
        at += len(rows) * width * np.dtype(t).itemsize
    return out


def latent_space(docs: DataFrame, text_col: str = "text") -> Space:
    """Randomised SVD of the TF-IDF passages of all documents.

    Sums of a task are 2**15 terms by 64 whole numbers at most; they are combined
    in two steps over parts of the terms. Terms that the task has not seen are not
    sent, small numbers in one or two bytes.
    """
    width = RANK + EXTRA + 1
    kind = "part int, sums binary"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = test_matrix()
        sketch, n = np.zeros(test.shape, np.float32), 0
        frequency = np.zeros(1 << TERM_BITS)
        for batch in batches:
            for _, words, edges, _ in _segments(batch["_text"], 0):
                n += sketch_block(words, edges, test, frequency, sketch)
        sums = np.concatenate([sketch, frequency[:, None]], axis=1)
        yield rows({**{i: sums[i * _PART : (i + 1) * _PART] for i in range(len(sums) // _PART) if n}, -1: np.array([[float(n)]])})

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, value in zip(batch["part"].to_pylist(), batch["sums"], strict=True):
                x = np.frombuffer(value.as_py(), np.float64).reshape(1, 1) if part < 0 else unpack(value.as_py(), width)
                held[part] = held[part] + x if part in held else x
        yield rows(held)

    def rows(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        packed = [x.tobytes() if i < 0 else pack(x) for i, x in parts.items()]
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(packed, pa.binary())], names=["part", "sums"])

    partial = docs.select(lower_text(text_col).cast("binary").alias("_text")).mapInArrow(gather, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    got = partial.repartition("part", "salt").select("part", "sums").mapInArrow(combine, kind).repartition("part").mapInArrow(combine, kind).toArrow()
    sums, n = np.zeros((1 << TERM_BITS, width), np.float32), 0
    for part, value in zip(got["part"].to_pylist(), got["sums"], strict=True):
        if part < 0:
            n = int(np.frombuffer(value.as_py(), np.float64)[0])
        else:
            sums[part * _PART : (part + 1) * _PART] = unpack(value.as_py(), width)
    del got
    return solve(n, sums[:, -1].astype(np.float64), sums[:, :-1], test_matrix())


@dataclass
class Items:
    """Benchmark items with words, and the unit vectors of their windows."""

    ids: list
    words: list[np.ndarray]
    #: windows of each item, and the vectors of all items' k-th windows
    windows: np.ndarray
    vectors: list[tuple[np.ndarray, np.ndarray]]
    #: rare words in order; of each the first of its items in ``holders``; how many an item needs at its place
    rare: np.ndarray
    firsts: np.ndarray
    holders: np.ndarray
    needs: np.ndarray
    #: terms of the rare words
    rare_terms: np.ndarray


def unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1)


def least_words(n: int, share: float) -> int:
    """Words that the subsequence must have for an item of ``n`` words; under five all."""
    return n if n < 5 else next(k for k in range(max(0, int(share * n) - 1), n + 2) if k / n >= share)


def rare_words(words: np.ndarray, chance: np.ndarray, share: float) -> tuple[np.ndarray, int]:
    """An item's rarest words, and how many of their occurrences a text must have at its place.

    A subsequence leaves out at most so many of the item's words; of any set of
    more of them the rest is in it. The fewest words are taken that a random
    text has so often with a chance (Chernoff's bound) of under exp(-14).
    """
    lost = len(words) - least_words(len(words), share)
    if lost < 0:  # no text can reach such a share
        return words[:0], 1
    p = chance[terms(words)]
    order = np.argsort(p, kind="stable")
    sums = (len(words) + 2 * STEP) * np.cumsum(p[order])[lost:] + 1e-9
    needs = np.arange(1, len(sums) + 1)
    bound = np.where(needs > sums, needs - sums - needs * np.log(needs / sums), 0.0)
    enough = np.flatnonzero(bound < -14)
    take = int(enough[0] if len(enough) else np.argmin(bound))
    return np.unique(words[order[: lost + take + 1]]), take + 1


def benchmark_items(ids: list, texts: list[str | None], term_vectors: np.ndarray, chance: np.ndarray, share: float) -> Items:
    """Items with at least one word; ``chance``: of each term, that a word is that term."""
    kept, words = [], []
    for id_, text in zip(ids, texts, strict=True):
        data = np.frombuffer((text or "").encode(), np.uint8)
        w, _ = word_hashes(data, np.array([0, len(data)]))
        if len(w):
            kept.append(id_)
            words.append(w)
    windows = np.array([max(1, len(w) // WINDOW) for w in words], np.int64)
    vectors = []
    for k in range(windows.max(initial=0)):
        who = np.flatnonzero(windows > k)
        vectors.append((who, unit(np.array([term_vectors[terms(words[i][k * WINDOW : (k + 1) * WINDOW])].sum(axis=0) for i in who], np.float32))))
    picked = [rare_words(w, chance, share) for w in words]
    hashes = np.concatenate([np.zeros(0, np.uint64), *(r for r, _ in picked)])
    holders = np.repeat(np.arange(len(words)), [len(r) for r, _ in picked])
    order = np.argsort(hashes, kind="stable")
    rare, firsts = np.unique(hashes[order], return_index=True)
    rare_terms = np.zeros(1 << TERM_BITS, bool)
    rare_terms[terms(rare)] = True
    return Items(kept, words, windows, vectors, rare, np.append(firsts, len(hashes)), holders[order], np.array([k for _, k in picked], np.int64), rare_terms)


def candidates(windows: np.ndarray, bench: Items, cosine: float, rows: int = 1024) -> tuple[np.ndarray, ...]:
    """Window, item and average cosine where an item's windows, side by side, agree with the text's."""
    found = []
    apart = WINDOW // STEP
    reach = apart * (len(bench.vectors) - 1)
    order = np.argsort(-bench.windows, kind="stable")  # the items with a k-th window come first
    sides = []
    for who, vectors in bench.vectors:
        held = order[: len(who)]
        sides.append(np.ascontiguousarray(vectors[np.searchsorted(who, held)].T))
    share = bench.windows[order].astype(np.float32)
    for at in range(0, len(windows), rows):
        part = windows[at : at + rows + reach]
        n = min(rows, len(part))
        total = part[:n] @ sides[0]
        for k, vectors in enumerate(sides[1:], 1):
            here = part[apart * k : apart * k + n]
            total[: len(here), : vectors.shape[1]] += here @ vectors
        total /= share
        at_once = np.flatnonzero(total >= cosine)
        w, i = at_once // len(order), at_once % len(order)
        found.append((w + at, order[i], total.ravel()[at_once]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def places(words: np.ndarray, term: np.ndarray, edges: np.ndarray, bench: Items) -> tuple[np.ndarray, np.ndarray]:
    """Window and item wherever the words around the window do not rule out the subsequence."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(bench.rare_terms[term])
    if not len(at):
        return none
    k = np.minimum(np.searchsorted(bench.rare, words[at]), len(bench.rare) - 1)
    same = bench.rare[k] == words[at]
    at, k = at[same], k[same]
    times = bench.firsts[k + 1] - bench.firsts[k]
    inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    item, at = bench.holders[np.repeat(bench.firsts[k], times) + inner], np.repeat(at, times)
    order = np.argsort(item, kind="stable")  # positions stay in order
    item, at = item[order], at[order]
    doc = np.searchsorted(edges, at, side="right") - 1
    # from each occurrence to that which makes enough
    last = np.arange(len(at)) + bench.needs[item] - 1
    a = np.flatnonzero(last < len(at))
    b = last[a]
    size = np.array([len(w) for w in bench.words], np.int64)[item[a]]
    on = (item[a] == item[b]) & (doc[a] == doc[b]) & (at[b] - at[a] < size + 2 * STEP)
    a, b, size = a[on], b[on], size[on]
    if not len(a):
        return none
    # the windows whose surroundings, as in the check, hold both
    counts = -(-np.diff(edges) // STEP)
    steps, start = (np.cumsum(counts) - counts)[doc[a]], edges[doc[a]]
    low = np.maximum((at[b] - start - size - STEP) // STEP + 1, 0)
    high = np.minimum((at[a] - start + STEP) // STEP, counts[doc[a]] - 1)
    times = np.maximum(high - low + 1, 0)
    inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    window = np.repeat(steps + low, times) + inner
    both = np.unique(np.repeat(item[a], times) * counts.sum() + window)
    return both % counts.sum(), both // counts.sum()


def agreement(windows: np.ndarray, window: np.ndarray, i: int, bench: Items) -> np.ndarray:
    """Average cosine of an item's windows with the text's from each of ``window`` on."""
    total = np.zeros(len(window), np.float32)
    for k, (who, vectors) in enumerate(bench.vectors[: bench.windows[i]]):
        here = window + WINDOW // STEP * k
        on = here < len(windows)
        total[on] += windows[here[on]] @ vectors[np.searchsorted(who, i)]
    return total / bench.windows[i]


def word_places(pattern: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The pattern's words, sorted, and of each the places where it stands, as bits."""
    known, word = np.unique(pattern, return_inverse=True)
    bits = [0] * len(known)
    for j, w in enumerate(word.tolist()):
        bits[w] |= 1 << j
    return known, bits


def marked(places: tuple[np.ndarray, list[int]], text: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Of each word of ``text`` its places in a pattern of at most 63 words; none where ``inside`` is false."""
    known, bits = places
    place = np.minimum(np.searchsorted(known, text), len(known) - 1)
    return np.where(inside & (known[place] == text), np.array(bits, np.uint64)[place], np.uint64(0))


def matched(marks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest common subsequence of each row of ``marks`` with its own pattern of ``sizes`` words: length, words in the last fifth."""
    sizes = sizes.astype(np.uint64)
    full = (np.uint64(1) << sizes) - np.uint64(1)
    row = full.copy()
    for mark in np.ascontiguousarray(marks.T):
        u = row & mark
        row = (row + u) | (row - u)
    held = ~row & full
    tail = np.maximum(np.uint64(1), sizes // np.uint64(5))
    return np.bitwise_count(held).astype(np.int64), np.bitwise_count(held >> (sizes - tail)).astype(np.int64)


def matched_long(pattern: np.ndarray, text: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for one pattern of any length, in Python's long integers."""
    known, bits = word_places(pattern)
    place = np.minimum(np.searchsorted(known, text), len(known) - 1)
    hits = inside & (known[place] == text)
    full = (1 << len(pattern)) - 1
    tail = max(1, len(pattern) // 5)
    lengths, tails = [], []
    for words, hit in zip(place, hits, strict=True):
        row = full
        for p in words[hit]:
            u = row & bits[p]
            row = ((row + u) | (row - u)) & full
        lengths.append((~row & full).bit_count())
        tails.append(((~row & full) >> (len(pattern) - tail)).bit_count())
    return np.array(lengths, np.int64), np.array(tails, np.int64)


def common_subsequence(pattern: np.ndarray, text: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest common subsequence of ``pattern`` with every row of ``text``; ``inside`` marks its words.

    Returns the length, and how many of its words are in the pattern's last
    fifth. Bit-parallel: a set bit is a pattern word that does not lengthen the
    subsequence.
    """
    if len(pattern) > 63:
        return matched_long(pattern, text, inside)
    return matched(marked(word_places(pattern), text, inside), np.full(len(text), len(pattern)))


def longest_run(pattern: np.ndarray, text: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Longest run of words that ``pattern`` has in common with every row of ``text``; ``inside`` marks its words."""
    best = np.zeros(len(text), np.int64)
    now = np.zeros((len(text), len(pattern) + 1), np.int64)
    for t in range(text.shape[1]):
        now[:, 1:] = np.where((text[:, t, None] == pattern) & inside[:, t, None], now[:, :-1] + 1, 0)
        best = np.maximum(best, now.max(axis=1))
    return best


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    cosine: float = 0.7,
    share: float = 0.6,
    answer_share: float = 0.4,
    whole_share: float = 0.8,
    loose_share: float = 0.4,
    loose_answer: float = 0.6,
    block: int = BLOCK,
) -> DataFrame:
    """Documents that hold a benchmark item, whole or reworded, one row per document and item.

    ``_id``, ``_key``, ``_item``, ``_cosine`` (average over the item's windows at
    the best place), ``_share`` (of the item's words in the longest common
    subsequence with the text there), ``_answer`` (share of its last fifth),
    ``_word`` (that place, in words). A pair counts in either of two ways:

    - ``_share`` reaches ``share`` and any of these holds: ``_share`` reaches
      ``whole_share``; a run of words that the text has word for word reaches
      ``share`` of the item; ``_answer`` reaches ``answer_share``.
    - A paraphrase: the windows' average cosine reaches ``cosine``, ``_share``
      ``loose_share`` and ``_answer`` ``loose_answer``.

    Tasks hold ``block`` items at a time; each block is one pass over ``docs``,
    whose pairs are stored. Null or blank texts and items are in no pair. Rows
    that repeat give the same pairs each. Items of under five words count only
    with all their words.
    """
    space = latent_space(docs, text_col)
    table = items.select(F.col(f"`{item_col}`"), lower_text(item_text_col).alias("_text"))
    source = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), lower_text(text_col).cast("binary").alias("_text"))
    limits = cosine, share, answer_share, whole_share, loose_share, loose_answer
    chance = np.where(space.idf > 0, np.exp(-space.idf) / PASSAGE, 0)
    vectors = space.project()
    if table.isEmpty():
        return _leaks_of(source, benchmark_items([], [], vectors, chance, share), vectors, items.schema[item_col].dataType, limits)[0]
    path = scratch_folder(docs.sparkSession, "leaks")
    rows = table.toLocalIterator()
    while held := list(islice(rows, block)):
        bench = benchmark_items([r[0] for r in held], [r[1] for r in held], vectors, chance, share)
        pairs, shared = _leaks_of(source, bench, vectors, items.schema[item_col].dataType, limits)
        pairs.write.mode("append").parquet(path)
        shared.destroy()
    return docs.sparkSession.read.schema(pairs.schema).parquet(path)


def _leaks_of(source: DataFrame, found: Items, vectors: np.ndarray, item_kind: DataType, limits: tuple[float, ...]) -> tuple[DataFrame, Broadcast]:
    """Pairs of documents and one block of items, and what the tasks hold of it: arrays only, so that no task needs this package."""
    cosine, share, answer_share, whole_share, loose_share, loose_answer = limits
    shared = source.sparkSession.sparkContext.broadcast((vectors, astuple(found)))
    overlap = max([WINDOW, *(len(w) for w in found.words)]) + 2 * STEP
    id_type = source.schema["_id"].dataType.simpleString()
    ids = pa.array(found.ids, to_arrow_type(item_kind))

    def search(words: np.ndarray, edges: np.ndarray, bench: Items) -> Iterator[tuple]:
        table = shared.value[0]
        if not len(words) or not bench.ids:
            return
        begin, doc = _steps(words, edges)
        term = terms(words)
        steps = row_sums(table, term, begin, np.minimum(edges[doc + 1] - begin, STEP), STEP)
        ends = np.searchsorted(doc, np.arange(len(edges)), side="left")
        windows = steps.copy()
        for k in range(1, WINDOW // STEP):
            at = np.flatnonzero(np.arange(len(doc)) + k < ends[doc + 1])
            windows[at] += steps[at + k]
        windows = unit(windows)
        window, item, _ = candidates(windows, bench, cosine)
        more, of = places(words, term, edges, bench)
        alike = np.unique(item * len(doc) + window)
        both = np.union1d(alike, of * len(doc) + more)
        item, window, near = both // len(doc), both % len(doc), np.isin(both, alike, assume_unique=True)
        waiting, rows = [], 0
        for i in np.unique(item):
            a, b = np.searchsorted(item, [i, i + 1])
            for part in around(words, term, edges, begin, doc, window[a:b], near[a:b], int(i), bench):
                waiting.append(part)
                rows += len(part[1])
            if rows > 8192:
                yield from check(words, edges, begin, doc, windows, waiting, bench)
                waiting, rows = [], 0
        yield from check(words, edges, begin, doc, windows, waiting, bench)

    def around(words, term, edges, begin, doc, window, near, i, bench) -> Iterator[tuple]:
        """Item, windows, whether by cosine, words around them and which are the document's, where enough are the item's."""
        pattern = bench.words[i]
        known = np.zeros(1 << TERM_BITS, bool)
        known[terms(pattern)] = True
        for at in range(0, len(window), 8192):
            w, alike = window[at : at + 8192], near[at : at + 8192]
            place = begin[w][:, None] + np.arange(-STEP, len(pattern) + STEP)
            inside = (place >= edges[doc[w]][:, None]) & (place < edges[doc[w] + 1][:, None])
            place = np.clip(place, 0, len(words) - 1)
            # no subsequence is longer than the number of the pattern's words there
            enough = (known[term[place]] & inside).sum(axis=1) >= np.where(alike, loose_share, share) * len(pattern)
            if enough.any():
                yield i, w[enough], alike[enough], words[place[enough]], inside[enough]

    def subsequences(waiting: list[tuple], bench: Items) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each part length and words of the last fifth; patterns of at most 63 words all at once."""
        out = [matched_long(bench.words[i], text, inside) if len(bench.words[i]) > 63 else None for i, _, _, text, inside in waiting]
        short = [k for k, done in enumerate(out) if done is None]
        if short:
            upto = np.cumsum([0, *(len(waiting[k][1]) for k in short)])
            marks = np.zeros((upto[-1], max(waiting[k][3].shape[1] for k in short)), np.uint64)
            for k, a, b in zip(short, upto[:-1], upto[1:], strict=True):
                i, _, _, text, inside = waiting[k]
                marks[a:b, : text.shape[1]] = marked(word_places(bench.words[i]), text, inside)
            sizes = np.repeat([len(bench.words[waiting[k][0]]) for k in short], np.diff(upto))
            length, tail = matched(marks, sizes)
            for k, a, b in zip(short, upto[:-1], upto[1:], strict=True):
                out[k] = length[a:b], tail[a:b]
        return out

    def check(words, edges, begin, doc, windows, waiting, bench) -> Iterator[tuple]:
        for (i, w, alike, text, inside), (length, tail) in zip(waiting, subsequences(waiting, bench), strict=True):
            pattern = bench.words[i]
            whole, answer = length / len(pattern), tail / max(1, len(pattern) // 5)
            good = whole >= (share if len(pattern) >= 5 else 1.0)
            sure = (answer >= answer_share) | (whole >= whole_share)
            rest = np.flatnonzero(good & ~sure)
            for k in range(0, len(rest), 64):
                part = rest[k : k + 64]
                sure[part] = longest_run(pattern, text[part], inside[part]) >= share * len(pattern)
            reworded = alike & (whole >= loose_share) & (answer >= loose_answer) & (len(pattern) >= 5)
            held = np.flatnonzero((good & sure) | reworded)
            if not len(held):
                continue
            score = dict(zip(held, agreement(windows, w[held], i, bench), strict=True))
            for k in held:
                d = int(doc[w[k]])
                yield d, i, float(score[k]), float(whole[k]), float(answer[k]), int(begin[w[k]] - edges[d])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Items(*shared.value[1])
        for batch in batches:
            pairs: dict[tuple[int, int], tuple] = {}
            for first, words, edges, before in _segments(batch["_text"], overlap):
                for d, i, c, s, a, w in search(words, edges, bench):
                    key, got = (first + d, i), (s, a, c, w + before)
                    pairs[key] = max(pairs.get(key, got), got)
            at = pa.array([k[0] for k in pairs], pa.int64())
            item = ids.take(pa.array([k[1] for k in pairs], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch["_id"].take(at), batch["_key"].take(at), item, *(pa.array([v[j] for v in pairs.values()], t) for j, t in ((2, pa.float64()), (0, pa.float64()), (1, pa.float64()), (3, pa.int64())))],
                names=["_id", "_key", "_item", "_cosine", "_share", "_answer", "_word"],
            )

    return source.mapInArrow(run, f"_id {id_type}, _key bigint, _item {item_kind.simpleString()}, _cosine double, _share double, _answer double, _word bigint"), shared


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    key = free_name(docs, "_leak")
    leaks = find_leaks(docs, items, id_col, text_col, **options).select(F.col("_key").alias(key)).distinct()
    return docs.join(leaks, row_key(id_col, text_col) == F.col(key), "left_anti")
