"""Toxicity by multiple-instance learning: documents carry labels, sentences carry scores.

A sentence's probability is logistic in its hashed words and word beginnings.
A document is toxic if any sentence is: noisy-or combines the sentences. The
weights are trained from document labels through the noisy-or, on a bounded
sample of labelled rows, and then point to the sentences themselves. Scoring
is one pass over the rows without a shuffle; weights are 2**18 numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almenara.llm.arrays import PIECE, column_bytes, document_blocks, lower_table, mix, pieces, prefix_hashes, seeds, span_hashes, tokens_of
from almenara.llm.samples import labelled_ids
from almenara.llm.tables import free_name, text_bytes

WEIGHT_BITS = 18
_BEGINNINGS = (4, 5)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    #: score of every document where the sample had no row of one class
    constant: float | None = None


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sentences of a piece of documents: hashed features, their edges per sentence, and document, start and end of each.

    Sentences end at ``.``, ``!``, ``?``, line feeds and document ends. Every
    document has at least one, which may be empty.
    """
    stop = np.isin(data, np.frombuffer(b".!?\n", np.uint8))
    breaks = np.flatnonzero(stop) + 1
    begin = np.unique(np.concatenate([offsets[:-1], breaks[breaks < len(data)]]))
    doc = np.searchsorted(offsets, begin, side="right") - 1
    begin, doc = begin[doc < len(offsets) - 1], doc[doc < len(offsets) - 1]
    missing = np.setdiff1d(np.arange(len(offsets) - 1), doc)  # empty documents
    begin, doc = np.concatenate([begin, offsets[missing]]), np.concatenate([doc, missing])
    order = np.lexsort((begin, doc))
    begin, doc = begin[order], doc[order]
    end = np.append(begin[1:], len(data))
    end = np.minimum(end, offsets[doc + 1])
    low = lower_table()[data]
    starts, ends, kind = tokens_of(low, offsets)
    starts, ends = starts[kind == 1], ends[kind == 1]
    prefix = prefix_hashes(low)
    parts, places = [mix(span_hashes(prefix, starts, ends))], [starts]
    for n, salt in zip(_BEGINNINGS, seeds(len(_BEGINNINGS), 17), strict=True):
        long = starts[ends - starts >= n]
        parts.append(mix(span_hashes(prefix, long, long + n) + salt))
        places.append(long)
    place = np.concatenate(places)
    order = np.argsort(place, kind="stable")
    feature = (np.concatenate(parts)[order] >> np.uint64(64 - WEIGHT_BITS)).astype(np.int32)
    edges = np.append(np.searchsorted(place[order], begin, side="left"), len(feature))
    return feature, edges, doc, begin, end


def sentence_pieces(data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cuts of one long text behind the first end of a sentence after each ``limit`` bytes."""
    stop = np.zeros(256, bool)
    stop[list(b".!?\n")] = True
    at = 0
    for _, end in pieces(data, limit, stop):
        if end >= at:
            yield at, min(end + 1, len(data))
            at = min(end + 1, len(data))
    if at < len(data):
        yield at, len(data)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[edges[1:]] - total[edges[:-1]]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def noisy_or(p: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return -np.expm1(_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), edges))


def train(feature: np.ndarray, edges: np.ndarray, doc_edges: np.ndarray, label: np.ndarray, steps: int = 100, rate: float = 0.1, sparsity: float = 1e-3) -> Model:
    """Full-batch Adam on the likelihood of document labels under the noisy-or.

    A weight leaves zero only where its slope exceeds ``sparsity``: features of
    one or two documents are not learned by heart.
    """
    n, positive = len(label), int(label.sum())
    weights = np.zeros(1 << WEIGHT_BITS)
    if positive in (0, n):
        return Model(weights, 0.0, (positive + 0.5) / (n + 1))
    per_doc = (len(edges) - 1) / n
    bias = float(np.log(0.2 / per_doc))
    first, second = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    length = np.diff(edges)
    sentences_of = np.diff(doc_edges)
    balance = np.where(label == 1, 0.5 * n / positive, 0.5 * n / (n - positive)) ** 0.75
    for step in range(1, steps + 1):
        p = sigmoid(_sums(weights[feature], edges) + bias)
        whole = np.clip(noisy_or(p, doc_edges), 1e-9, 1)
        pull = balance * np.where(label == 1, (1 - whole) / whole, -1.0)
        slope = np.repeat(pull, sentences_of) * p / n
        pulls = np.bincount(feature, np.repeat(slope, length), minlength=len(weights))
        soft = np.where(weights != 0, pulls - sparsity * np.sign(weights), np.sign(pulls) * np.maximum(np.abs(pulls) - sparsity, 0))
        grad = np.append(soft, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights += move[:-1]
        bias += float(move[-1])
    return Model(weights, bias)


def score(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document scores, and document, start, end and probability of each sentence."""
    n = len(offsets) - 1
    feature, edges, doc, begin, end = sentences(data, offsets)
    p = sigmoid(_sums(model.weights[feature], edges) + model.bias)
    if model.constant is not None:
        return np.full(n, model.constant), doc, begin, end, np.zeros(len(p))
    return noisy_or(p, np.searchsorted(doc, np.arange(n + 1), side="left")), doc, begin, end, p


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 3000, max_bytes: int = 200_000, total_bytes: int = 1 << 26) -> Model:
    """Model from at most ``per_class`` labelled documents of each label with texts of at most ``max_bytes``.

    Together they have at most ``total_bytes`` of each label, the first by a
    hash of the id; of rows with the same id one counts. ``labels`` holds the
    rows to learn from. Without rows of both labels every score is the share of
    label 1.
    """
    chosen = F.broadcast(labelled_ids(labels, id_col, label_col, per_class))  # at most 2 * per_class numbers
    rows = docs.select(F.col(f"`{id_col}`").alias("_label_id"), text_bytes(text_col).alias("_text")).where(F.octet_length("_text") <= max_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch["_text"])
            for first, last in document_blocks(offsets):
                lo, hi = offsets[first], offsets[last]
                feature, edges, doc, _, _ = sentences(data[lo:hi], offsets[first : last + 1] - lo)
                for i in range(last - first):
                    a, b = np.searchsorted(doc, [i, i + 1])
                    yield pa.RecordBatch.from_arrays([batch["_label"].slice(first + i, 1), pa.array([feature[edges[a] : edges[b]].tobytes()]), pa.array([np.diff(edges[a : b + 1]).astype(np.int32).tobytes()])], names=["label", "feature", "counts"])

    one_each = rows.join(chosen, "_label_id").groupBy("_label_id", "_label").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("t"))).alias("_one"))
    sizes = one_each.select("_label_id", "_label", F.octet_length("_one.t").alias("_size"))  # at most 2 * per_class rows
    so_far = Window.partitionBy("_label").orderBy(F.xxhash64("_label_id"), "_label_id").rowsBetween(Window.unboundedPreceding, 0)
    held = F.broadcast(sizes.withColumn("_upto", F.sum("_size").over(so_far)).where(F.col("_upto") <= total_bytes).select("_label_id"))
    learned = one_each.join(held, "_label_id").select("_label", F.col("_one.t").alias("_text"))
    got = learned.mapInArrow(run, f"label {dict(labels.dtypes)[label_col]}, feature binary, counts binary").toArrow()
    features = [np.frombuffer(x, np.int32) for x in got["feature"].to_pylist()]
    counts = [np.frombuffer(x, np.int32) for x in got["counts"].to_pylist()]
    label = np.array(got["label"].to_pylist(), np.int64)
    order = sorted(range(len(label)), key=lambda i: (label[i], features[i].tobytes()))  # the same sum in every run
    edges = np.concatenate([[0], np.cumsum(np.concatenate([counts[i] for i in order]))]) if order else np.zeros(1, np.int64)
    doc_edges = np.concatenate([[0], np.cumsum([len(counts[i]) for i in order])]).astype(np.int64)
    return train(np.concatenate([features[i] for i in order]) if order else np.zeros(0, np.int32), edges, doc_edges, label[order])


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The columns of ``docs``, ``_score`` and ``_offending``.

    ``_offending``: first byte, end and probability of the sentences that reach
    ``threshold``; of the likeliest one where only the document reaches it. A
    null or empty text is one empty sentence. Long texts are scored in pieces
    of whole sentences, which noisy-or combines. Columns of ``docs`` of these
    two names are replaced.
    """
    docs = docs.drop("_score", "_offending")
    names, raw = docs.columns, free_name(docs, "_bytes")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    # arrays and numbers only, so that no task needs this package
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.constant))

    def one(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple]]]:
        n = len(offsets) - 1
        if n > 1 or offsets[-1] <= 2 * PIECE:
            parts = [(0, score(model, data, offsets))]
        else:
            parts = [(a, score(model, data[a:b], np.array([0, b - a]))) for a, b in sentence_pieces(data, PIECE)]
        clean = np.prod([1 - p[0] for _, p in parts], axis=0) if len(parts) > 1 else 1 - parts[0][1][0]
        total = 1 - clean if model.constant is None else parts[0][1][0]
        found: list[list[tuple]] = [[] for _ in range(n)]
        for at, (_, doc, begin, end, p) in parts:
            for s in np.flatnonzero(p >= threshold):
                found[doc[s]].append((int(begin[s] + at - offsets[doc[s]]), int(end[s] + at - offsets[doc[s]]), float(p[s])))
        for i in np.flatnonzero(total >= threshold):
            if not found[i] and model.constant is None:
                best = max(((float(p[s]), int(begin[s] + at - offsets[i]), int(end[s] + at - offsets[i])) for at, (_, doc, begin, end, p) in parts for s in np.flatnonzero(doc == i)))
                found[i].append((best[1], best[2], best[0]))
        return total, found

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            data, offsets = column_bytes(batch[raw])
            scores, spans = [np.zeros(0)], []
            for first, last in document_blocks(offsets):
                lo, hi = offsets[first], offsets[last]
                total, found = one(model, data[lo:hi], offsets[first : last + 1] - lo)
                scores.append(total)
                spans += [[{"start": a, "end": b, "probability": p} for a, b, p in x] for x in found]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(np.concatenate(scores)), pa.array(spans, kind)], names=[*names, "_score", "_offending"])

    return docs.withColumn(raw, text_bytes(text_col)).mapInArrow(run, f"{fields}, _score double, _offending array<struct<start: bigint, end: bigint, probability: double>>")
