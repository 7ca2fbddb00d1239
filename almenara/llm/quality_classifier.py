"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Random indexing: every token has a fixed sparse random index vector; a token's
word vector is the sum of the index vectors of its neighbours over all
documents. Tokens fall into a bounded number of buckets, so the sums of a task
and the whole table have a fixed size. Sums are combined in two steps over the
buckets. A document's features are mean and spread of its tokens' vectors; the
network learns on a bounded sample of labelled documents, and a temperature
fitted on rows it has not seen calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.llm.arrays import PIECE, column_bytes, document_blocks, mix, pieces, prefix_hashes, seeds, span_hashes, tokens_of
from almenara.llm.samples import labelled_ids
from almenara.llm.tables import row_key, stored, text_bytes

BUCKET_BITS, DIMENSIONS, WINDOW, ENTRIES = 15, 32, 2, 4
FEATURES = 2 * DIMENSIONS + 1
_ROWS = 1024  # buckets in one row of partial sums


def index_vectors() -> np.ndarray:
    """Sparse random vector of each bucket, and a zero vector for gaps."""
    n = 1 << BUCKET_BITS
    out = np.zeros((n + 1, DIMENSIONS), np.float32)
    for k in range(ENTRIES):
        h = mix(np.arange(n, dtype=np.uint64) * np.uint64(ENTRIES) + np.uint64(k + 1))
        out[np.arange(n), (h >> np.uint64(40)) % np.uint64(DIMENSIONS)] += np.where(h & np.uint64(1), 1, -1)
    return out


def token_buckets(data: np.ndarray, offsets: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each token, document edges, and the last token's hash.

    A token equal to the word before it becomes one common token; ``before`` is
    the hash of the token that stands before ``data``, if any does.
    """
    starts, ends, kind = tokens_of(data, offsets)
    h = mix(span_hashes(prefix_hashes(data), starts, ends))
    last = h[-1:].copy() if len(h) else np.zeros(0, np.uint64) if before is None else before
    edges = np.searchsorted(starts, offsets, side="left")
    if len(h):
        same = np.concatenate([[False], h[1:] == h[:-1]]) & (kind == 1)
        same[edges[:-1][edges[:-1] < len(h)]] = False
        if before is not None and len(before):
            same[0] = h[0] == before[0] and kind[0] == 1
        h[same] = seeds(1, 23)[0]
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), edges, last


def _long_blocks(data: np.ndarray) -> Iterator[tuple[np.ndarray, slice, bool]]:
    """Token buckets of one long text in pieces cut at blanks, with the neighbours on either side.

    The slice is the piece without them; the flag tells that more of it follows.
    """
    halo, held, last = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for a, b in pieces(data, PIECE // 4):
        buckets, _, last = token_buckets(data[a:b], np.array([0, b - a]), last)
        if len(held) >= WINDOW and len(buckets) >= WINDOW:
            yield np.concatenate([halo, held, buckets[:WINDOW]]), slice(len(halo), len(halo) + len(held)), True
            halo, held = held[-WINDOW:], buckets
        else:
            held = np.concatenate([held, buckets])
    yield np.concatenate([halo, held]), slice(len(halo), len(halo) + len(held)), False


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int, slice, bool]]:
    """Token buckets and edges of runs of documents; of a long text in pieces the slice leaves out the neighbours, and more follow where the flag says so."""
    data, offsets = column_bytes(batch["_text"])
    for first, last in document_blocks(offsets, PIECE // 4):
        lo, hi = int(offsets[first]), int(offsets[last])
        if last - first > 1 or hi - lo <= PIECE:
            buckets, edges, _ = token_buckets(data[lo:hi], offsets[first : last + 1] - lo)
            yield buckets, edges, last - first, slice(0, len(buckets)), False
            continue
        for buckets, inner, more in _long_blocks(data[lo:hi]):
            yield buckets, np.array([0, len(buckets)]), 1, inner, more


def add_contexts(sums: np.ndarray, index: np.ndarray, buckets: np.ndarray, edges: np.ndarray, inner: slice = slice(None)) -> None:
    """Adds the neighbours' index vectors of each token in ``inner`` to its bucket; neighbours are of the same document."""
    gap = len(index) - 1
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    spaced = np.full(len(buckets) + WINDOW * (len(edges) + 1), gap)
    at = np.arange(len(buckets)) + WINDOW * (doc + 1)
    spaced[at] = buckets
    at, buckets = at[inner], buckets[inner]
    if not len(buckets):
        return
    vectors = index[spaced]
    context = sum(vectors[at + k] for k in (*range(-WINDOW, 0), *range(1, WINDOW + 1)))
    order = np.argsort(buckets, kind="stable")
    ordered = buckets[order]
    firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sums[ordered[firsts]] += np.add.reduceat(context[order], firsts, axis=0)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit word vector of each bucket, from all documents: a table of 2**15 x 32 numbers."""
    spread = 16

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, index = np.zeros((1 << BUCKET_BITS, DIMENSIONS)), index_vectors()
        for batch in batches:
            for buckets, edges, _, inner, _ in _blocks(batch):
                add_contexts(sums, index, buckets, edges, inner)
        yield rows_of({i: sums[i * _ROWS : (i + 1) * _ROWS] for i in range(len(sums) // _ROWS)}, np.float32)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch["part"].to_pylist(), batch["sums"], strict=True):
                x = np.frombuffer(values.as_py(), np.float32).reshape(_ROWS, DIMENSIONS)
                held[part] = held[part] + x if part in held else x.astype(np.float64)
        yield rows_of(held, np.float32)

    def rows_of(parts: dict[int, np.ndarray], kind: type) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([x.astype(kind).tobytes() for x in parts.values()], pa.binary())], names=["part", "sums"])

    kind = "part int, sums binary"
    partial = docs.select(text_bytes(text_col).alias("_text")).mapInArrow(gather, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(spread)))
    some = partial.repartition("part", "salt").select("part", "sums").mapInArrow(combine, kind)
    got = some.repartition("part").mapInArrow(combine, kind).toArrow()
    out = np.zeros((1 << BUCKET_BITS, DIMENSIONS))
    for part, values in zip(got["part"].to_pylist(), got["sums"].to_pylist(), strict=True):
        out[part * _ROWS : (part + 1) * _ROWS] = np.frombuffer(values, np.float32).reshape(_ROWS, DIMENSIONS)
    length = np.sqrt((out**2).sum(axis=1, keepdims=True))
    return (out / np.where(length > 0, length, 1)).astype(np.float32)


def document_features(docs: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_key``, ``_features``: mean and spread of the tokens' vectors and the log of their number.

    A null, empty or blank text has zeros.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), text_bytes(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            out = [np.zeros((0, FEATURES), np.float32)]
            carried = np.zeros((1, 2 * DIMENSIONS + 1))
            for buckets, edges, n, inner, more in _blocks(batch):
                if n == 1:
                    buckets = buckets[inner]
                    edges = np.array([0, len(buckets)])
                total = np.zeros((n, 2 * DIMENSIONS + 1))
                count = np.diff(edges)
                held = np.flatnonzero(count)
                if len(held):
                    x = table[buckets]
                    total[held, :DIMENSIONS] = np.add.reduceat(x, edges[held], axis=0)
                    total[held, DIMENSIONS:-1] = np.add.reduceat(x * x, edges[held], axis=0)
                    total[:, -1] = count
                if n == 1:
                    total = total + carried
                    carried = total if more else np.zeros_like(carried)
                if not more:
                    size = np.maximum(total[:, -1:], 1)
                    mean = total[:, :DIMENSIONS] / size
                    spread = np.sqrt(np.maximum(total[:, DIMENSIONS:-1] / size - mean**2, 0))
                    out.append(np.concatenate([mean, spread, np.log1p(total[:, -1:])], axis=1).astype(np.float32))
            features = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_key"], pa.array([x.tobytes() for x in features], pa.binary())], names=["_id", "_key", "_features"])

    return rows.mapInArrow(run, f"_id {id_type}, _key bigint, _features binary")


@dataclass
class Network:
    """tanh layer and logistic layer on standardised features; ``temperature`` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    constant: float | None = None

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = 16, epochs: int = 60, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Mini-batch Adam; every fifth row is kept aside to fit the temperature."""
    random = np.random.default_rng(5)
    centre, scale = x.mean(axis=0) if len(x) else np.zeros(FEATURES), x.std(axis=0) + 1e-6 if len(x) else np.ones(FEATURES)
    net = Network(centre, scale, random.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, hidden**-0.5, hidden), 0.0)
    if len(y) == 0 or y.min() == y.max():
        net.constant = float((y.sum() + 0.5) / (len(y) + 1))
        return net
    aside = np.arange(len(y)) % 5 == 4
    learn = ~aside if len(np.unique(y[~aside])) == 2 else np.ones(len(y), bool)
    z, t = (x[learn] - centre) / scale, y[learn].astype(float)
    weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean())) ** 0.5
    state = [net.w1, net.b1, net.w2, np.array(net.b2)]
    m, v = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(t))
        for at in range(0, len(t), 256):
            i = order[at : at + 256]
            h = np.tanh(z[i] @ state[0] + state[1])
            p = 1 / (1 + np.exp(-np.clip(h @ state[2] + state[3], -40, 40)))
            d = weight[i] * (p - t[i]) / len(i)
            back = np.outer(d, state[2]) * (1 - h**2)
            grads = [z[i].T @ back + decay * state[0], back.sum(axis=0), h.T @ d + decay * state[2], np.array(d.sum())]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                state[k] = state[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = state[0], state[1], state[2], float(state[3])
    if aside.any():
        logit, truth = net.logit(x[aside]), y[aside]
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, np.where(truth == 1, -logit, logit) / g)) for g in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def fit_quality(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", per_class: int = 8000) -> Network:
    """Network from at most ``per_class`` labelled documents of each label; ``labels`` holds the rows to learn from."""
    chosen = F.broadcast(labelled_ids(labels, id_col, label_col, per_class))  # at most 2 * per_class numbers
    labelled = features.join(chosen, F.col("_id") == F.col("_label_id"))
    one_each = labelled.groupBy("_id").agg(F.min(F.struct("_key", "_label", "_features")).alias("_one"))  # an id may repeat
    got = one_each.select("_one.*").toArrow().sort_by([("_key", "ascending")])
    x = np.array([np.frombuffer(f, np.float32) for f in got["_features"].to_pylist()], np.float64).reshape(-1, FEATURES)
    return train_network(x, np.array(got["_label"].to_pylist(), np.int64))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 8000) -> DataFrame:
    """``_id``, ``_key``, ``_score`` per document: the probability of label 1.

    Word vectors come from all of ``docs``, labels from ``labels`` alone.
    Without labelled rows of both labels every score is the share of label 1.
    Null ids are scored like others.
    """
    features = stored(document_features(docs, word_vectors(docs, text_col), id_col, text_col), "quality-features")
    net = fit_quality(features, labels, id_col, label_col, per_class)
    id_type = features.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _ = column_bytes(batch["_features"])
            score = net.probability(data.view(np.float32).reshape(-1, FEATURES).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_key"], pa.array(score, pa.float64())], names=["_id", "_key", "_score"])

    return features.mapInArrow(run, f"_id {id_type}, _key bigint, _score double")
