"""MinHash near-duplicates by a multi-index Hamming join.

A document's set of word shingles becomes a signature of b-bit minhash
symbols. For each chunk of the indexed symbols all choices of erroneous symbols
are left out in turn, and what remains is an exact join key. By pigeonhole two
signatures that differ in at most CHUNKS * (ERRORS + 1) - 1 = 23 of the 48
indexed symbols meet under some key. That is no guarantee for all pairs within
MAX_DISTANCE of 128: for independent symbols a pair at a similarity of 0.8
meets under no key with a probability of 1.2e-9. Pairs are checked on whole
signatures, then on full shingle sets.

Copies never become pairs: equal sets are one node. Under each key every node
meets the smallest node only; the links that hold give components. Keys whose
nodes are in several components get a leader of their own each, and what is
then still open is compared in blocks, only across components, so that no link
between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.llm.arrays import column_bytes, document_blocks, mix, ngram_hashes, seeds, word_hashes
from almenara.llm.graph import components
from almenara.llm.tables import free_name, row_key, stored, text_bytes

#: symbols of a signature, and the share of 2**32 that a symbol keeps
SYMBOLS, BITS = 128, 16
#: the first so many are indexed, in chunks that may hold so many errors
INDEXED, CHUNKS, ERRORS = 48, 12, 1
#: signatures at a greater distance are not compared on their sets. At a
#: similarity of 0.8 the distance is 25.6 on average with a deviation of 4.5;
#: one pair in about 10**12 is further off
MAX_DISTANCE = 60
#: bits of the sketch that bounds the difference of two sets from below
SKETCH_BITS = 2048
#: nodes compared in one step under a key
BLOCK = 512


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; of the whole sequence if it is shorter."""
    if not len(words):
        return np.zeros(0, np.uint64)
    hashes = ngram_hashes(words, n) if len(words) >= n else ngram_hashes(words, len(words)) + np.uint64(len(words))
    hashes.sort()
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def text_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Shingle sets of a column of texts, in order."""
    data, offsets = column_bytes(column)
    for first, last in document_blocks(offsets):
        lo, hi = offsets[first], offsets[last]
        words, edges = word_hashes(data[lo:hi], offsets[first : last + 1] - lo)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield shingle_set(words[a:b], n)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minhash symbols per non-empty set."""
    edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    factors, shifts = seeds(SYMBOLS, 11).astype(np.uint32) | np.uint32(1), seeds(SYMBOLS, 13).astype(np.uint32)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat(low * factors[k] + shifts[k], edges[:-1])
        out[:, k] = (mix(least.astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.uint16)
    return out


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """Join keys of each signature: per chunk, one for each choice of erroneous symbols left out."""
    size = INDEXED // CHUNKS
    keys = []
    wide = symbols.astype(np.uint64)
    for chunk in range(CHUNKS):
        for number, out in enumerate(combinations(range(size), ERRORS)):
            key = np.full(len(symbols), chunk * 64 + number + 1, np.uint64)
            for j in range(size):
                if j not in out:
                    key = mix(key * np.uint64(0xD6E8FEB86659FD93) + wide[:, chunk * size + j])
            keys.append(key)
    return np.stack(keys, axis=1)


def shared_choices(equal: np.ndarray) -> np.ndarray:
    """For pairs, given which symbols are equal: which keys they share, in the order of ``index_keys``."""
    size = INDEXED // CHUNKS
    kept = [[c * size + j for j in range(size) if j not in out] for c in range(CHUNKS) for out in combinations(range(size), ERRORS)]
    return equal[:, np.array(kept)].all(axis=2)


def _signed(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), text_bytes(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes, rows_of, held, size = [], [], [], [], 0
            symbols: list[bytes | None] = [None] * len(batch)

            def sign(rows_of: list[int], held: list[np.ndarray], symbols: list[bytes | None]) -> None:
                for i, row in zip(rows_of, signatures(held) if held else (), strict=True):
                    symbols[i] = row.tobytes()

            for i, found in enumerate(text_sets(batch["_text"], n)):
                counts.append(len(found))
                nodes.append(xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63) if len(found) else None)
                if len(found):
                    rows_of.append(i)
                    held.append(found)
                    size += len(found)
                if size > 200_000:
                    sign(rows_of, held, symbols)
                    rows_of, held, size = [], [], 0
            sign(rows_of, held, symbols)
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_key"], pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(symbols, pa.binary())], names=["_id", "_key", "_n", "_node", "_sig"])

    return rows.mapInArrow(run, f"_id {id_type}, _key bigint, _n bigint, _node bigint, _sig binary")


def _sig_matrix(column: pa.Array) -> np.ndarray:
    data, _ = column_bytes(column)
    return data.view(np.uint16).reshape(-1, SYMBOLS)


def _keyed(nodes: DataFrame) -> DataFrame:
    """``_node``, ``_choice``, ``_index``: every node under each of its keys, and the key's place among these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = index_keys(_sig_matrix(batch["_sig"])).view(np.int64)
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch["_node"], lists], names=["_node", "_keys"])

    return nodes.select("_node", "_sig").mapInArrow(run, "_node bigint, _keys array<bigint>").select("_node", F.posexplode("_keys").alias("_choice", "_index"))


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose signatures are within the distance and whose set sizes allow the similarity."""
    side = lambda s: nodes.select(F.col("_node").alias(s), F.col("_sig").alias(f"sig_{s}"), F.col("_n").alias(f"n_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    joined = joined.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = (_sig_matrix(batch["sig_a"]) != _sig_matrix(batch["sig_b"])).sum(axis=1) <= MAX_DISTANCE
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint")


def _linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    side = lambda s: texts.select(F.col("_node").alias(s), F.col("_text").alias(f"t_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                near = []
                for x, y in zip(text_sets(part["t_a"], n), text_sets(part["t_b"], n), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    near.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return joined.select("a", "b", "t_a", "t_b").mapInArrow(run, "a bigint, b bigint")


def _across(members: DataFrame, percent: int, flags_only: bool) -> DataFrame:
    """Nodes under one key compared across components, block against block.

    ``members``: ``_index``, ``_choice``, ``_node``, ``_root``, ``_n``, ``_sig`` and, but
    for ``flags_only``, ``_sketch``. Returns pairs ``a``, ``b`` that their sketches
    allow, or with ``flags_only`` the nodes near any other by signature. A pair is
    looked at under the first key that it shares, whatever the number of keys.
    """
    sizes = stored(members.groupBy("_index").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks")), "blocks")
    placed = members.join(sizes, "_index").withColumn("_mine", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    placed = placed.select("_index", "_choice", F.least("_mine", "_other").alias("_low"), F.greatest("_mine", "_other").alias("_high"), "_mine", "_node", "_root", "_n", "_sig", *([] if flags_only else ["_sketch"]))
    step = ["_index", "_low", "_high"]

    flagged: list[np.ndarray] = []

    def flags() -> pa.RecordBatch:
        found = np.unique(np.concatenate(flagged)) if flagged else np.zeros(0, np.int64)
        flagged.clear()
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["_node"])

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sig = _sig_matrix(rows["_sig"])
        here = rows["_choice"][0].as_py()
        node, root, n, mine = (rows[c].to_numpy() for c in ("_node", "_root", "_n", "_mine"))
        bits = None if flags_only else column_bytes(rows["_sketch"])[0].view(np.uint64).reshape(len(node), -1)
        left, right = [], []
        same_block = rows["_low"][0] == rows["_high"][0]
        for i in range(len(node) - 1):
            j = slice(i + 1, None)
            ok = (root[j] != root[i]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            if not same_block:
                ok &= mine[j] != mine[i]
            at = np.flatnonzero(ok) + i + 1
            if len(at):
                at = at[(sig[at] != sig[i]).sum(axis=1) <= MAX_DISTANCE]
            if len(at) and bits is not None:
                at = at[may_link(bits[i], bits[at], n[i], n[at], percent)]
            if len(at):
                at = at[np.argmax(shared_choices(sig[at] == sig[i]), axis=1) == here]
                left.append(np.full(len(at), node[i]))
                right.append(node[at])
        a = np.concatenate(left) if left else np.zeros(0, np.int64)
        b = np.concatenate(right) if right else np.zeros(0, np.int64)
        if flags_only:
            flagged.append(np.unique(np.concatenate([a, b])))
            if sum(map(len, flagged)) > 200_000:
                flagged[:] = [np.unique(np.concatenate(flagged))]
                if len(flagged[0]) > 100_000:
                    yield flags()
        else:
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch[c].to_numpy().astype(np.int64) for c in step], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = tuple(keys[a])
                if now is not None and key != now:
                    yield from compare(pa.Table.from_batches(held).combine_chunks())
                    held = []
                now = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from compare(pa.Table.from_batches(held).combine_chunks())
        if flags_only:
            yield flags()

    kind = "_node bigint" if flags_only else "a bigint, b bigint"
    return placed.repartition(*step).sortWithinPartitions(*step).mapInArrow(run, kind).distinct()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Per hash bucket, whether an odd number of shingles falls into it, as words of 64 bits.

    Two sets differ in at least as many shingles as their sketches in bits.
    """
    buckets = (mix(shingles) >> np.uint64(32)).astype(np.int64) % SKETCH_BITS
    return np.packbits(np.bincount(buckets, minlength=SKETCH_BITS) & 1).view(np.uint64)


def may_link(bits: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    """False where sketches differ in more bits than sets of these sizes may in shingles."""
    differ = np.bitwise_count(others ^ bits).sum(axis=1, dtype=np.int64)
    return (100 + percent) * differ <= (100 - percent) * (n + sizes)


def _sketched(texts: DataFrame, n: int) -> DataFrame:
    """``_node`` and ``_sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [sketch(found).tobytes() for found in text_sets(batch["_text"], n)]
            yield pa.RecordBatch.from_arrays([batch["_node"], pa.array(bits, pa.binary())], names=["_node", "_sketch"])

    return texts.select("_node", "_text").mapInArrow(run, "_node bigint, _sketch binary")


def _open_members(keyed: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes under keys whose nodes are in several components, with root, size and signature."""
    placed = keyed.join(roots.withColumnsRenamed({"node": "_node", "root": "_root"}), "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    open_keys = stored(placed.groupBy("_index").agg(F.min("_root").alias("lo"), F.max("_root").alias("hi")).where("lo <> hi").select("_index"), "open")
    return stored(placed.join(open_keys, "_index").select("_index", "_choice", "_node", "_root").join(nodes.select("_node", "_n", "_sig"), "_node"), "open-keys")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``_id``, ``_key``, ``_n`` (shingles), ``_group`` and ``_component``.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z
    lower-cased. Documents are linked if their sets of distinct
    ``shingle_words``-word shingles (the whole sequence, if shorter) have an
    intersection of at least ``percent`` hundredths of their union.
    ``_component`` is the smallest id reachable over links, ``_group`` the same
    number for all documents of a component. A null, empty or
    blank text has an empty set, is linked with nothing and is its own
    component. Null ids are larger than all others: a component of null ids
    only is null. Rows that repeat are linked with each other. An empty table
    gives no rows. Sets are told apart by 64-bit hashes.
    """
    signed = stored(_signed(docs, id_col, text_col, shingle_words), "signed")
    nodes = stored(signed.where("_n > 0").groupBy("_node").agg(F.first("_n").alias("_n"), F.first("_sig").alias("_sig"), F.min("_key").alias("_key")), "nodes")
    keyed = _keyed(nodes)
    leaders = stored(keyed.groupBy("_index").agg(F.min("_node").alias("_lead"), F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c"), "leaders")
    shared = stored(keyed.join(leaders, "_index"), "shared")  # nodes under keys that others have too
    # texts of nodes that share a key, one each
    wanted = shared.select("_node").distinct().join(nodes.select("_node", "_key"), "_node")
    rows = docs.select(row_key(id_col, text_col).alias("_key"), text_bytes(text_col).alias("_text"))
    texts = stored(rows.join(wanted, "_key").dropDuplicates(["_node"]).select("_node", "_text"), "texts")

    stars = shared.where("_node <> _lead").select(F.col("_lead").alias("a"), F.col("_node").alias("b")).distinct()
    links = stored(_linked(_close(stars, nodes, percent), texts, shingle_words, percent), "star-links")
    roots = components(links)
    members = _open_members(shared, nodes, roots)
    # keys that are still open get leaders of their own, another under every key
    own_leads = stored(members.groupBy("_index").agg(F.min(F.struct(F.xxhash64("_node", "_index").alias("h"), F.col("_node").alias("n"), F.col("_root").alias("r"))).alias("_l")), "own-leads")
    across = members.join(own_leads, "_index").where("_root <> _l.r").select(F.least("_node", "_l.n").alias("a"), F.greatest("_node", "_l.n").alias("b")).distinct()
    # every node's link to its root stands for the links found so far
    held = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(held.union(_linked(_close(across, nodes, percent), texts, shingle_words, percent)))
    members = _open_members(members.drop("_root", "_n", "_sig"), nodes, roots)
    flagged = stored(_across(members, percent, flags_only=True), "flagged")
    sketches = stored(_sketched(texts.join(flagged, "_node"), shingle_words), "sketches")
    more = _linked(_across(members.join(sketches, "_node"), percent, flags_only=False), texts, shingle_words, percent)
    rooted = more.join(roots.withColumnsRenamed({"node": "a", "root": "ra"}), "a", "left").join(roots.withColumnsRenamed({"node": "b", "root": "rb"}), "b", "left")
    merged = components(rooted.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    return _resolve(signed, roots, merged)


def _resolve(signed: DataFrame, roots: DataFrame, merged: DataFrame) -> DataFrame:
    """Components of all rows from the first roots and the components of these."""
    first = roots.withColumnsRenamed({"node": "_node", "root": "_r1"})
    second = merged.withColumnsRenamed({"node": "_r1", "root": "_r2"})
    named = signed.select("_id", "_key", "_n", "_node").join(first, "_node", "left").withColumn("_r1", F.coalesce("_r1", "_node"))
    named = named.join(second, "_r1", "left").withColumn("_root", F.coalesce("_r2", "_r1"))
    smallest = named.where(F.col("_root").isNotNull()).groupBy("_root").agg(F.min("_id").alias("_least"))
    smallest = stored(smallest, "smallest-ids")  # so that the join's hot keys can be split
    out = named.join(smallest, "_root", "left")
    component = F.when(F.col("_n") == 0, F.col("_id")).otherwise(F.col("_least"))
    return out.select("_id", "_key", "_n", F.coalesce("_root", "_key").alias("_group"), component.alias("_component"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that with the smallest id (null last).

    Texts without words all stay, but for rows that repeat.
    """
    found = near_duplicates(docs, id_col, text_col, shingle_words, percent)
    first = F.min(F.struct(F.col("_id").isNull().alias("z"), F.col("_id").alias("i"), F.col("_key").alias("k"))).alias("_first")
    key, keep = free_name(docs, "_row_key"), free_name(docs, "_keep")
    kept = found.groupBy("_group").agg(first).select(F.col("_first.k").alias(keep)).distinct()
    rows = docs.withColumn(key, row_key(id_col, text_col))
    return rows.join(kept, F.col(key) == F.col(keep)).dropDuplicates([key]).select(*(F.col(f"`{c}`") for c in docs.columns))
