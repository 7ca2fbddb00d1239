"""Quality rules: how much of a text repeats, by rolling hashes in numpy.

One pass over the rows, no shuffle. Word hashes of a batch come from one
rolling hash over its bytes; windows of several lengths are combined from word
hashes, and repeats are found by sorting (document, window hash) within a
piece of about a megabyte. A longer text is read in pieces cut at any byte:
words and lines over a cut are put together from the hashes of their parts.
Its words are kept, as hash and length, and its windows sorted in parts by
hash, some 30 bytes a word in all; windows that are all equal, as of one word
without end, are one part and take some 80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.llm.arrays import PIECE, PRIME, column_bytes, document_blocks, mix, ngram_hashes, prefix_hashes, seeds, space_table, span_hashes, words_of
from almenara.llm.tables import free_name, text_bytes

#: largest share of a text's word characters inside windows of n words that
#: repeat an earlier one, and inside lines that do
NGRAM_LIMITS = {2: 0.5, 3: 0.45, 5: 0.3, 8: 0.25, 10: 0.25}
LINE_LIMIT = 0.5
SYMBOL_LIMIT = 0.3
_SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")


def _repeats(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item: is there an equal one in the same document; is there an earlier one."""
    if not len(doc):
        return np.zeros(0, bool), np.zeros(0, bool)
    bits = max(1, int(doc[-1]).bit_length())  # the document in the high bits of one sort key
    key = (doc.astype(np.uint64) << np.uint64(64 - bits)) | (hashes >> np.uint64(bits))
    order = np.argsort(key)
    key = key[order]
    opens = np.concatenate([[True], key[1:] != key[:-1]])
    at = np.flatnonzero(opens)
    many = np.diff(np.append(at, len(key))) > 1
    found, earlier = np.zeros(len(order), bool), np.zeros(len(order), bool)
    group = np.cumsum(opens) - 1
    found[order] = many[group]
    earlier[:] = found
    earlier[np.minimum.reduceat(order, at)] = False  # the first in the text
    return found, earlier


def _covered(windows: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside the marked windows of n words."""
    steps = np.zeros(size + 1, np.int32)
    at = np.flatnonzero(windows)  # each place once, so plain indexing adds up
    steps[at] += 1
    steps[at + n] -= 1
    return np.cumsum(steps, out=steps)[:size] > 0


def _per_doc(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def measure(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The counts of one piece of whole documents; offsets begin at 0."""
    n_docs = len(offsets) - 1
    prefix = prefix_hashes(data)
    starts, ends = words_of(data, offsets)
    words = mix(span_hashes(prefix, starts, ends))
    edges = np.searchsorted(starts, offsets, side="left")
    doc = np.repeat(np.arange(n_docs), np.diff(edges))
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    word_chars = chars[ends] - chars[starts]
    symbol = np.zeros(256, bool)
    symbol[list(_SYMBOLS)] = True
    out = {"n_words": np.diff(edges), "word_chars": _per_doc(word_chars, edges), "n_symbols": _per_doc(symbol[data], offsets)}
    for n in sorted({5, *lengths}):
        windows = ngram_hashes(words, n)
        inside = np.flatnonzero(doc[: len(windows)] == doc[n - 1 :]) if len(windows) else np.zeros(0, np.int64)
        found, earlier = _repeats(doc[inside], windows[inside])
        if n == 5:
            marked = np.zeros(len(words), bool)
            marked[inside[found]] = True
            out["n_repeat_words"] = _per_doc(_covered(marked, n, len(words)), edges)
        if n in lengths:
            marked = np.zeros(len(words), bool)
            marked[inside[earlier]] = True
            out[f"dup_{n}"] = _per_doc(_covered(marked, n, len(words)) * word_chars, edges)
    # lines: between line feeds and document ends
    feeds = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    end = np.sort(np.concatenate([offsets[1:], feeds]))
    inner = np.concatenate([[0], np.cumsum(~space_table()[data])])
    holds = inner[end] > inner[begin]
    begin, end = begin[holds], end[holds]
    line_doc = np.searchsorted(offsets, begin, side="right") - 1
    _, earlier = _repeats(line_doc, mix(span_hashes(prefix, begin, end) + seeds(1, 3) * (end - begin).astype(np.uint64)))
    line_edges = np.searchsorted(line_doc, np.arange(n_docs + 1), side="left")
    out["n_dup_lines"] = _per_doc(earlier, line_edges)
    first, last = np.searchsorted(starts, begin, side="left"), np.searchsorted(starts, end, side="left")
    so_far = np.concatenate([[0], np.cumsum(word_chars)])
    out["dup_line_chars"] = _per_doc(earlier * (so_far[last] - so_far[first]), line_edges)
    return out


class _Spans:
    """Words or lines of a text that comes in pieces: hash, bytes and code points of each."""

    def __init__(self) -> None:
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.open: tuple[int, int, int] | None = None

    def add(self, hashes: np.ndarray, sizes: np.ndarray, chars: np.ndarray, joins: bool, opens: bool) -> None:
        """One piece's spans; its first goes on from the piece before (``joins``), its last goes on behind it (``opens``)."""
        if self.open is not None and joins:
            h, size, n = self.open
            hashes[0] = (h + int(hashes[0]) * pow(PRIME, size, 1 << 64)) % (1 << 64)
            sizes[0] += size
            chars[0] += n
            self.open = None
        self.close()
        if opens:
            self.open = int(hashes[-1]), int(sizes[-1]), int(chars[-1])
            hashes, sizes, chars = hashes[:-1], sizes[:-1], chars[:-1]
        self.rows.append((hashes, sizes, chars))

    def close(self) -> None:
        if self.open is not None:
            h, size, n = self.open
            self.rows.append((np.array([h], np.uint64), np.array([size], np.int32), np.array([n], np.int32)))
            self.open = None

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.close()
        hashes, sizes, chars = (np.concatenate(x) for x in zip(*self.rows, strict=True))
        self.rows = []
        return hashes, sizes, chars


def _repeats_by_part(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_repeats`` of one document, so many hashes at a time as a piece has bytes; equal hashes come together."""
    bits = max(0, int(len(hashes) // PIECE).bit_length())
    found, earlier = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    for k in range(1 << bits):
        at = np.flatnonzero(hashes >> np.uint64(64 - bits) == k) if bits else np.arange(len(hashes))
        found[at], earlier[at] = _repeats(np.zeros(len(at), np.int64), hashes[at])
    return found, earlier


def measure_long(data: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """As ``measure`` for one document of any length."""
    space, symbol, n_symbols = space_table(), np.zeros(256, bool), 0
    symbol[list(_SYMBOLS)] = True
    words, lines = _Spans(), _Spans()
    for a in range(0, len(data), PIECE):
        part = data[a : a + PIECE]
        prefix = prefix_hashes(part)
        n_symbols += int(symbol[part].sum())
        chars = np.concatenate([[0], np.cumsum(~space[part] & ((part & 0xC0) != 0x80), dtype=np.int32)])
        starts, ends = words_of(part, np.array([0, len(part)]))
        feeds = np.flatnonzero(part == 10)
        begin, end = np.append(0, feeds + 1), np.append(feeds, len(part))
        for spans, b, e, joins, opens in (
            (words, starts, ends, len(starts) > 0 and starts[0] == 0, len(ends) > 0 and ends[-1] == len(part)),
            (lines, begin, end, True, True),
        ):
            spans.add(span_hashes(prefix, b, e), (e - b).astype(np.int32), chars[e] - chars[b], joins, opens)
    hashes, _, chars = words.all()
    hashes = mix(hashes)
    one = lambda x: np.array([int(x)], np.int64)
    out = {"n_words": one(len(hashes)), "word_chars": one(chars.sum(dtype=np.int64)), "n_symbols": one(n_symbols)}
    for n in sorted({5, *lengths}):
        found, earlier = _repeats_by_part(ngram_hashes(hashes, n))
        if n == 5:
            out["n_repeat_words"] = one(_covered(found, n, len(hashes)).sum())
        if n in lengths:
            out[f"dup_{n}"] = one(chars[_covered(earlier, n, len(hashes))].sum(dtype=np.int64))
    del hashes, chars
    line, size, inner = lines.all()
    line, size, inner = line[inner > 0], size[inner > 0], inner[inner > 0]
    _, earlier = _repeats_by_part(mix(line + seeds(1, 3) * size.astype(np.uint64)))
    return out | {"n_dup_lines": one(earlier.sum()), "dup_line_chars": one(inner[earlier].sum(dtype=np.int64))}


def quality_measures(docs: DataFrame, text_col: str = "text", lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> DataFrame:
    """The columns of ``docs`` and one struct ``_quality`` of counts per row.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word, equal to an earlier line of the text),
    ``n_repeat_words`` (words in 5-word windows found more than once, the first
    included), ``dup_line_chars`` (word characters of such lines), and
    ``dup_<n>`` (word characters in windows of n words that repeat an earlier
    one). A null or empty text has zeros. Rows are judged one by one, so rows
    that repeat make no difference. A column ``_quality`` of ``docs`` is replaced.
    """
    names = [*COUNTS, *(f"dup_{n}" for n in lengths)]
    kind = ", ".join(f"{n}: bigint" for n in names)
    docs = docs.drop("_quality")
    columns, raw = docs.columns, free_name(docs, "_bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch[raw])
            parts: dict[str, list[np.ndarray]] = {n: [np.zeros(0, np.int64)] for n in names}
            for first, last in document_blocks(offsets, PIECE):
                lo, hi = offsets[first], offsets[last]
                if last - first == 1 and hi - lo > 2 * PIECE:
                    got = measure_long(data[lo:hi], lengths)
                else:
                    got = measure(data[lo:hi], offsets[first : last + 1] - lo, lengths)
                for n in names:
                    parts[n].append(got[n])
            counts = pa.StructArray.from_arrays([pa.array(np.concatenate(parts[n]).astype(np.int64)) for n in names], names)
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in columns), counts], names=[*columns, "_quality"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.withColumn(raw, text_bytes(text_col)).mapInArrow(run, f"{fields}, _quality struct<{kind}>")


def quality_rules(docs: DataFrame, text_col: str = "text", min_words: int = 10, max_repeat_pct: int = 20, ngram_limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, symbol_limit: float = SYMBOL_LIMIT) -> DataFrame:
    """``docs`` with ``_quality``, ``_base_failed`` and ``_kept``.

    The base rules fail texts of under ``min_words`` words or with more than
    ``max_repeat_pct`` percent of words in repeated 5-word windows. A text that
    passes them is kept unless repeated windows of some length, repeated lines
    or symbols hold more than their share of its word characters. Columns of
    ``docs`` of these three names are replaced.
    """
    limits = NGRAM_LIMITS if ngram_limits is None else ngram_limits
    q = lambda name: F.col(f"_quality.{name}")
    failed = (q("n_words") < min_words) | (100 * q("n_repeat_words") > max_repeat_pct * q("n_words"))
    bad = (q("dup_line_chars") > line_limit * q("word_chars")) | (q("n_symbols") > symbol_limit * q("word_chars"))
    for n, limit in limits.items():
        bad = bad | (q(f"dup_{n}") > limit * q("word_chars"))
    measured = quality_measures(docs.drop("_base_failed", "_kept"), text_col, tuple(limits))
    return measured.withColumn("_base_failed", failed).withColumn("_kept", ~F.col("_base_failed") & ~bad)
