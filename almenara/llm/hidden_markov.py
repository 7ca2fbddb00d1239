"""Language scores by a hidden Markov model, beside a plain count of words.

A token is a word with A-Z lower-cased, or the end that every text has. Latent
states emit classes of words, a class its words: the probability of a word in
a state is that of its class in the state, times the word's share of its class
in the learning texts. Classes are 2**15 hash values and the end, so the tables
that Baum-Welch learns have a fixed size whatever the vocabulary; the counts of
words grow with it and stay distributed.

1. Texts are encoded once, in blocks of whole documents with a dictionary each,
   and stored. All later passes read numbers.
2. The dictionaries' counts add up to the counts of all words.
3. Each round of Baum-Welch is one pass: tasks add up expected counts for their
   blocks, these are summed in two steps, and the driver divides. Documents are
   learned from in stretches of ``CHUNK`` tokens.
4. The counts come back to each block's dictionary by a join on the word, and
   the scaled forward recursion gives the likelihood of each whole document. A
   long one is cut into stretches that are walked side by side, once from each
   state, and chained: the same sum in another order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almenara.llm.arrays import column_bytes, document_blocks, mix, word_hashes
from almenara.llm.tables import row_key, stored, text_bytes

STATES, CLASS_BITS, ROUNDS = 12, 15, 8
END = 1 << CLASS_BITS
#: bytes of text in a block, tokens of a learning stretch, tokens scored in one walk, stretches learned from at once
BLOCK, CHUNK, LONG, GROUP = 8 << 20, 128, 8192, 1024
#: tokens' worth of plain class shares that every state starts a round with
PRIOR = 10_000.0
_PART = 1024  # classes in one row of expected counts

#: emission (class by state), transition (from by to), start of a text, start of a stretch within a text
Model = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def encode(docs: DataFrame, learn: Column, id_col: str, text_col: str) -> DataFrame:
    """One row per block: ``_docs`` (id, key, learning, words each), ``_words`` (numbers of terms), ``_classes`` and ``_terms`` of the dictionary, ``_counts`` (in learning texts)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), F.coalesce(learn, F.lit(False)).alias("_learn"), text_bytes(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = column_bytes(batch["_text"])
            learning = batch["_learn"].to_numpy(zero_copy_only=False)
            for first, last in document_blocks(offsets, BLOCK):
                hashes, edges = word_hashes(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                terms, at, often = np.unique(hashes, return_inverse=True, return_counts=True)
                order = np.argsort(-often, kind="stable")  # frequent words get small numbers
                terms, at = terms[order], np.argsort(order)[at]
                size = np.diff(edges)
                counts = np.bincount(at[np.repeat(learning[first:last], size)], minlength=len(terms))
                here = batch.slice(first, last - first)
                held = pa.StructArray.from_arrays([here["_id"], here["_key"], here["_learn"], pa.array(size, pa.int64())], names=["_id", "_key", "_learn", "_n"])
                columns = [pa.array([block], pa.int64()), _one(held), pa.array([packed(at)], pa.binary()), pa.array([class_of(terms).astype(np.uint16).tobytes()], pa.binary()), _one(pa.array(terms.view(np.int64))), _one(pa.array(counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["_block", "_docs", "_words", "_classes", "_terms", "_counts"])
                block += 1

    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_block bigint, _docs array<struct<_id:{id_type},_key:bigint,_learn:boolean,_n:bigint>>, _words binary, _classes binary, _terms array<bigint>, _counts array<bigint>")


def packed(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: the upper ones are mostly zero and compress well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _open(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.StructArray]]:
    """Row, class of each term, term number of each word, and documents of every block."""
    (words, cuts), (classes, ends) = column_bytes(batch["_words"]), column_bytes(batch["_classes"])
    for i in range(batch.num_rows):
        kinds = np.frombuffer(classes[ends[i] : ends[i + 1]].tobytes(), np.uint16).astype(np.int64)
        yield i, kinds, unpacked(words[cuts[i] : cuts[i + 1]]), batch["_docs"][i].values


def class_of(terms: np.ndarray) -> np.ndarray:
    return (terms.view(np.uint64) >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def with_ends(classes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens, each document's end included; where documents begin, and how long they are."""
    out = np.full(len(classes) + len(size), END)
    out[np.arange(len(classes)) + np.repeat(np.arange(len(size)), size)] = classes
    length = size + 1
    return out, np.cumsum(length) - length, length


def stretch(start: np.ndarray, length: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of stretches of at most ``limit`` tokens, and whether each begins its document."""
    n = -(-length // limit)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(start, n) + within * limit
    return begin, np.minimum(np.repeat(start + length, n) - begin, limit), within == 0


def walk(model: Model, classes: np.ndarray, start: np.ndarray, length: np.ndarray, begin: np.ndarray, kept: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward recursion over sequences side by side: log-likelihoods, and the states' shares at the ends.

    Sequences come longest first; ``begin`` has the state probabilities of their
    first tokens. ``kept`` collects classes, emissions, shares and scales of
    every step. Inside, states are rows, so that every step works on long rows.
    """
    emission, transition = model[0], np.ascontiguousarray(model[1].T)
    total, now = np.zeros(len(start)), np.array(begin.T, emission.dtype, order="C")
    active = len(start) - np.searchsorted(length[::-1], np.arange(length[0] if len(length) else 0), side="right")
    for t, n in enumerate(active.tolist()):
        c = classes[start[:n] + t]
        given = np.ascontiguousarray(emission[c].T)
        x = (transition @ now[:, :n] if t else now[:, :n]) * given
        scale = x.sum(axis=0)
        x /= scale
        now[:, :n] = x
        total[:n] += np.log(scale)
        if kept is not None:
            kept.append((c, given, x, scale))
    return total, now.T


class Expected:
    """Expected counts of emissions, transitions and starts."""

    def __init__(self, states: int) -> None:
        self.emission = np.zeros((END + _PART, states))
        self.transition = np.zeros((states, states))
        self.first, self.rest = np.zeros(states), np.zeros(states)
        self.likelihood = 0.0

    def add(self, model: Model, classes: np.ndarray, start: np.ndarray, length: np.ndarray, opens: np.ndarray) -> None:
        """Forward and backward over stretches, ``GROUP`` at a time."""
        transition = np.ascontiguousarray(model[1])
        order = np.argsort(-length, kind="stable")
        for a in range(0, len(order), GROUP):
            rows = order[a : a + GROUP]
            kept: list = []
            begin = np.where(opens[rows, None], model[2], model[3])
            self.likelihood += float(walk(model, classes, start[rows], length[rows], begin, kept)[0].sum())
            ahead, pairs = np.zeros((len(transition), 0), transition.dtype), np.zeros_like(transition)
            shares = []
            for c, given, x, scale in reversed(kept):
                n = ahead.shape[1]
                behind = np.ones_like(x)
                if n:
                    pairs += x[:, :n] @ ahead.T
                    behind[:, :n] = transition @ ahead
                shares.append(x * behind)
                ahead = given * behind / scale
            self.transition += pairs * transition
            self.first += shares[-1][:, opens[rows]].sum(axis=1)
            self.rest += shares[-1][:, ~opens[rows]].sum(axis=1)
            c, share = np.concatenate([k[0] for k in reversed(kept)]), np.concatenate(shares, axis=1)
            for k in range(len(share)):
                self.emission[:, k] += np.bincount(c, weights=share[k], minlength=len(self.emission))


def expected_counts(coded: DataFrame, model: Model, tasks: int) -> Expected:
    """Expected counts over all learning documents: ``tasks`` tasks add up theirs, then sums of sums; a table of fixed size."""
    states = len(model[1])
    shared = coded.sparkSession.sparkContext.broadcast(tuple(x.astype(np.float32) for x in model))  # 2**15 x states numbers
    kind, salts = "part int, sums binary", 16

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = Expected(states)
        for batch in batches:
            for _, kinds, words, held in _open(batch):
                size, learn = held.field("_n").to_numpy(), held.field("_learn").to_numpy(zero_copy_only=False)
                classes, start, length = with_ends(kinds[words], size)
                got.add(shared.value, classes, *stretch(start[learn], length[learn], CHUNK))
        parts = {i: got.emission[i * _PART : (i + 1) * _PART] for i in range(len(got.emission) // _PART)}
        parts[-1] = np.concatenate([got.transition.ravel(), got.first, got.rest, [got.likelihood]])
        yield rows_of(parts)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch["part"].to_pylist(), batch["sums"], strict=True):
                x = np.frombuffer(values.as_buffer(), np.float32)
                held[part] = held[part] + x if part in held else x.astype(np.float64)
        yield rows_of(held)

    def rows_of(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in parts.values()], pa.binary())], names=["part", "sums"])

    partial = coded.select("_docs", "_words", "_classes").coalesce(tasks).mapInArrow(gather, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    some = partial.repartition("part", "salt").select("part", "sums").mapInArrow(combine, kind)
    rows = some.repartition("part").mapInArrow(combine, kind).toArrow()
    shared.destroy()
    out = Expected(states)
    for part, values in zip(rows["part"].to_pylist(), rows["sums"].to_pylist(), strict=True):
        x = np.frombuffer(values, np.float32).astype(np.float64)
        if part >= 0:
            out.emission[part * _PART : (part + 1) * _PART] = x.reshape(_PART, states)
        else:
            out.transition = x[: states**2].reshape(states, states)
            out.first, out.rest, out.likelihood = x[states**2 : -states - 1], x[-states - 1 : -1], float(x[-1])
    return out


def start_model(plain: np.ndarray, states: int) -> Model:
    """Plain class shares, bent at random in each state; states tend to stay."""
    random = np.random.default_rng(13)
    emission = plain[:, None] * np.exp(random.normal(0, 1, (len(plain), states)))
    transition = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    even = np.full(states, 1 / states)
    return emission / emission.sum(axis=0), transition, even, even


def improved(got: Expected, plain: np.ndarray) -> Model:
    """The model that the expected counts make likeliest, with a little of the plain shares in every state."""
    emission = got.emission[: END + 1] + PRIOR * plain[:, None]
    transition, first, rest = got.transition + 1, got.first + 1, got.rest + 1
    return emission / emission.sum(axis=0), transition / transition.sum(axis=1, keepdims=True), first / first.sum(), rest / rest.sum()


def likelihoods(model: Model, classes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Log-likelihood of each document's classes; one over ``LONG`` tokens is walked in stretches from every state and chained."""
    out = np.zeros(len(start))
    states = len(model[1])
    short = np.flatnonzero(length <= LONG)
    short = short[np.argsort(-length[short], kind="stable")]
    out[short] = walk(model, classes, start[short], length[short], np.broadcast_to(model[2], (len(short), states)))[0]
    for i in np.flatnonzero(length > LONG):
        begin, size, _ = stretch(start[i : i + 1], length[i : i + 1], CHUNK)
        # the last stretch may be shorter, the others are equal: they come longest first
        logs, ends = walk(model, classes, np.repeat(begin[1:], states), np.repeat(size[1:], states), np.tile(model[1], (len(begin) - 1, 1)))
        logs, ends = logs.reshape(-1, states), ends.reshape(-1, states, states)
        total, now = walk(model, classes, begin[:1], size[:1], model[2][None, :])
        value, now = float(total[0]), now[0]
        for log, end in zip(logs, ends, strict=True):
            weight = np.log(np.maximum(now, 1e-300)) + log
            top = weight.max()
            now = np.exp(weight - top) @ end
            value += top + np.log(now.sum())
            now = now / now.sum()
        out[i] = value
    return out


def language_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``_id``, ``_key``, ``_learn``, ``_n_tokens``, ``_n_known``, ``_train_tokens``, ``_base``, ``_score`` per row of ``docs``.

    ``learn`` marks the rows to learn from (null: not). ``_base`` is the sum over
    tokens of log10((c + 1) / (N + V + 1)) with counts c, sum N and number V of
    the learning rows' tokens; ``_score`` the hidden Markov model's log10
    probability of the text, its end included. Words that no learning row has
    share one place in their class.

    Null, empty and blank texts have one token, the end; rows that repeat are
    documents of their own; null ids are scored like others; other columns make
    no difference. With no rows to learn from N is 0, ``_base`` 0 for every
    text, and the states' first tables stay. A word is known by 64 bits of hash.
    """
    coded = stored(encode(docs, learn, id_col, text_col), "coded-documents")
    flat = coded.select(F.inline(F.arrays_zip("_terms", "_counts"))).where("_counts > 0")
    counts = stored(flat.groupBy(F.col("_terms").alias("_term")).agg(F.sum("_counts").alias("_count")), "word-counts")
    # at most 2**15 rows
    by_class = counts.groupBy(F.shiftrightunsigned("_term", 64 - CLASS_BITS).alias("c")).agg(F.sum("_count").alias("n"), F.count("*").alias("v")).toArrow()
    ends = coded.select(F.inline("_docs")).where("_learn").count()
    total, kinds = np.zeros(END + 1, np.int64), np.zeros(END + 1, np.int64)
    total[by_class["c"].to_numpy()], kinds[by_class["c"].to_numpy()] = by_class["n"].to_numpy(), by_class["v"].to_numpy()
    total[END], kinds[END] = ends, int(ends > 0)
    n_all, n_kinds = int(total.sum()), int(kinds.sum())
    plain = (total + 1) / (total + 1).sum()
    model = start_model(plain, states)
    # a task's sums have a fixed size, so small inputs get few tasks and large ones one for each 64 blocks
    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, coded.count() // 64)
    for _ in range(rounds if ends else 0):
        model = improved(expected_counts(coded, model, tasks), plain)
    return _score(coded, counts, model, total, kinds, n_all, n_kinds)


def _score(coded: DataFrame, counts: DataFrame, model: Model, total: np.ndarray, kinds: np.ndarray, n_all: int, n_kinds: int) -> DataFrame:
    """Scores of all documents; each block's dictionary gets its counts by a join on the word."""
    looked_up = coded.select("_block", F.posexplode("_terms").alias("_at", "_term")).join(counts, "_term")
    found = looked_up.groupBy("_block").agg(F.collect_list(F.struct("_at", "_count")).alias("_found"))
    shared = coded.sparkSession.sparkContext.broadcast((*model, np.log(total + kinds + 1.0)))  # 2**15 x (states + 1) numbers
    id_type = coded.schema["_docs"].dataType.elementType["_id"].dataType.simpleString()
    names = ["_id", "_key", "_learn", "_n_tokens", "_n_known", "_train_tokens", "_base", "_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *tables, below = shared.value
        for batch in batches:
            for i, word_class, words, held in _open(batch):
                count = np.zeros(len(word_class), np.int64)
                if batch["_found"][i].is_valid:
                    got = batch["_found"][i].values
                    count[got.field("_at").to_numpy()] = got.field("_count").to_numpy()
                size = held.field("_n").to_numpy()
                document = np.repeat(np.arange(len(size)), size)

                def per_document(values: np.ndarray, words=words, document=document, size=size) -> np.ndarray:
                    return np.bincount(document, weights=values[words], minlength=len(size))

                base = per_document(np.log(count + 1.0)) + np.log(below_end + 1.0) - (size + 1) * np.log(n_all + n_kinds + 1.0)
                inside = per_document(np.log(count + 1.0) - below[word_class])
                classes, start, length = with_ends(word_class[words], size)
                score = inside + likelihoods(tuple(tables), classes, start, length)
                known = per_document((count > 0).astype(float)).astype(np.int64) + (below_end > 0)
                columns = [held.field("_id"), held.field("_key"), held.field("_learn"), pa.array(length), pa.array(known), pa.array(np.full(len(size), n_all)), pa.array(base / np.log(10)), pa.array(score / np.log(10))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    below_end = int(total[END])
    joined = coded.select("_block", "_docs", "_words", "_classes").join(found, "_block", "left")
    return joined.select("_docs", "_words", "_classes", "_found").mapInArrow(run, f"_id {id_type}, _key bigint, _learn boolean, _n_tokens bigint, _n_known bigint, _train_tokens bigint, _base double, _score double")
