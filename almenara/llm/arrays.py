"""Words and hashes of Arrow text columns, in numpy.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 that
is the pattern ``[^\\x20\\x09-\\x0D]+``. Hashes are 64-bit and depend on bytes
only, so they agree on every executor and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: texts are worked on in pieces of about so many bytes, whatever their length
PIECE = 1 << 20
#: base of the rolling hashes
PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(PRIME) + np.uint64(seed)
    return mix(x) | np.uint64(1)


def space_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def lower_table() -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and their inverses modulo 2**64, at least ``n``."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, PIECE + 4096)
        inverse = pow(PRIME, -1, 1 << 64)
        for name, base in (("up", PRIME), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i], times the inverse power of i, the hash of data[i:j]."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(seeds(256, 7)[data] * up[: len(data)], out=out[1:])
    return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary or string column without nulls; no copy of the bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def document_blocks(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of at most ``limit`` bytes; a longer document is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def words_of(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; documents end words. ``gaps`` marks the bytes between words, blanks by default."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~(space_table() if gaps is None else gaps)[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    opens[cuts] |= inside[cuts]
    closes[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return (prefix[ends] - prefix[starts]) * down[starts]


def pieces(data: np.ndarray, limit: int, gaps: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Cuts of one long text between words."""
    space = space_table() if gaps is None else gaps
    at, n = 0, len(data)
    while at < n:
        end = min(at + limit, n)
        while end < n:
            found = np.flatnonzero(space[data[end : end + limit]])
            if len(found):
                end += int(found[0])
                break
            end = min(end + limit, n)
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words before each document (one more entry than documents)."""
    hashes, counts = [], [np.zeros(1, np.int64)]
    before = 0
    for first, last in document_blocks(offsets):
        lo, hi = int(offsets[first]), int(offsets[last])
        local = offsets[first : last + 1] - lo
        whole = hi - lo <= 2 * PIECE
        spans = [(0, hi - lo)] if whole else list(pieces(data[lo:hi], PIECE))
        for a, b in spans:
            part = data[lo + a : lo + b]
            if lower:
                part = lower_table()[part]
            cuts = local if whole else np.array([0, b - a])
            starts, ends = words_of(part, cuts)
            hashes.append(mix(span_hashes(prefix_hashes(part), starts, ends)))
            if whole:
                counts.append(before + np.searchsorted(starts, local[1:], side="left"))
            before += len(starts)
        if not whole:
            counts.append(np.array([before]))
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return words, np.concatenate(counts).astype(np.int64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` words; windows over a document's end are the caller's to skip."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = words[:size].copy()
    for k in range(1, n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k : k + size]
    return mix(out)


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and the count per row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def byte_classes() -> np.ndarray:
    """0 for blanks, 1 for letters, digits and all bytes of non-ASCII characters, 2 for the rest."""
    table = np.full(256, 2, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    table[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    return table


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and class of the longest runs of one class; blanks are no tokens, documents end tokens."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    kind = byte_classes()[data]
    opens = np.concatenate([[True], kind[1:] != kind[:-1]])
    opens[offsets[(offsets > 0) & (offsets < len(data))]] = True
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(data))
    held = kind[starts] > 0
    return starts[held], ends[held], kind[starts[held]]


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chosen: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of documents made of ``chosen`` words with one blank between two; ``edges`` cuts ``chosen`` into documents."""
    sizes = (ends - starts)[chosen] + 1
    sizes[edges[1:][edges[1:] > edges[:-1]] - 1] -= 1
    upto = np.concatenate([[0], np.cumsum(sizes)])
    data = np.append(data, np.uint8(0x20))
    out = np.empty(upto[-1], np.uint8)
    for a in range(0, len(chosen), 1 << 16):
        b = min(a + (1 << 16), len(chosen))
        at = np.repeat(starts[chosen[a:b]] - upto[a:b], sizes[a:b]) + np.arange(upto[a], upto[b])
        out[upto[a] : upto[b]] = data[at]
    behind = np.flatnonzero(sizes > (ends - starts)[chosen])
    out[upto[behind + 1] - 1] = 0x20
    return out, upto[edges]
