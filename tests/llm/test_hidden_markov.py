"""Hidden Markov scores: paths enumerated, plain Python recursion over whole queries, odd cases."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from almenara.llm import hidden_markov
from almenara.llm.arrays import word_hashes
from almenara.llm.hidden_markov import END, Expected, class_of, likelihoods, stretch, walk
from almenara.llm.queries import QUERIES
from almenara.llm.samples import split_code
from tests.llm.cases import frame, odd_texts, random_texts, words

SMALL = "/root/testdata/sf0.001"


def random_model(seed, states=3, classes=5):
    rnd = np.random.default_rng(seed)
    emission = np.zeros((END + 1, states))
    emission[:classes] = rnd.random((classes, states)) + 0.1
    transition = rnd.random((states, states)) + 0.1
    first, rest = rnd.random(states), rnd.random(states)
    return emission / emission.sum(axis=0), transition / transition.sum(axis=1, keepdims=True), first / first.sum(), rest / rest.sum()


def path_probability(model, classes, path, begin):
    p = begin[path[0]] * model[0][classes[0], path[0]]
    for i in range(1, len(path)):
        p *= model[1][path[i - 1], path[i]] * model[0][classes[i], path[i]]
    return p


def plain_log(model, classes):
    """Forward recursion of one sequence, number by number."""
    emission, transition, first, _ = model
    states = range(len(first))
    now, out = [first[k] * emission[classes[0], k] for k in states], 0.0
    for c in [*classes[1:], None]:
        total = sum(now)
        out += math.log(total)
        now = [x / total for x in now]
        if c is not None:
            now = [sum(now[j] * transition[j, k] for j in states) * emission[c, k] for k in states]
    return out


def sequences(seed, n, longest):
    rnd = np.random.default_rng(seed)
    length = rnd.integers(1, longest + 1, n)
    return rnd.integers(0, 5, length.sum()), np.cumsum(length) - length, length


@pytest.mark.parametrize("seed", range(3))
def test_expected_counts_equal_the_sum_over_all_paths(seed):
    model = random_model(seed)
    classes, start, length = sequences(seed, 7, 5)
    opens = np.arange(7) % 3 != 0
    got = Expected(3)
    got.add(model, classes, start, length, opens)
    emission, transition, first, rest, logs = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3), np.zeros(3), 0.0
    for s, n, o in zip(start, length, opens, strict=True):
        text = classes[s : s + n]
        paths = {p: path_probability(model, text, p, model[2] if o else model[3]) for p in itertools.product(range(3), repeat=int(n))}
        total = sum(paths.values())
        logs += math.log(total)
        for path, p in paths.items():
            (first if o else rest)[path[0]] += p / total
            for i, k in enumerate(path):
                emission[text[i], k] += p / total
                if i:
                    transition[path[i - 1], k] += p / total
    assert got.likelihood == pytest.approx(logs)
    for a, b in ((got.emission[:5], emission), (got.transition, transition), (got.first, first), (got.rest, rest)):
        np.testing.assert_allclose(a, b, atol=1e-10)


def test_long_sequences_are_chained_exactly(monkeypatch):
    model = random_model(4)
    classes, start, length = sequences(4, 40, 90)
    want = [plain_log(model, classes[s : s + n]) for s, n in zip(start, length, strict=True)]
    np.testing.assert_allclose(likelihoods(model, classes, start, length), want)
    monkeypatch.setattr(hidden_markov, "LONG", 12)
    monkeypatch.setattr(hidden_markov, "CHUNK", 5)
    np.testing.assert_allclose(likelihoods(model, classes, start, length), want)


def test_rounds_never_lower_the_likelihood(monkeypatch):
    monkeypatch.setattr(hidden_markov, "PRIOR", 0.0)
    classes, start, length = sequences(5, 60, 30)
    model, seen = random_model(6), []
    for _ in range(12):
        got = Expected(3)
        got.add(model, classes, *stretch(start, length, 1000))
        seen.append(got.likelihood)
        emission, transition = got.emission[: END + 1], got.transition
        model = emission / emission.sum(axis=0), transition / transition.sum(axis=1, keepdims=True), got.first / got.first.sum(), model[3]
    assert all(b >= a - 1e-9 for a, b in itertools.pairwise(seen)) and seen[-1] > seen[0] + 1


def test_packed_numbers_come_back():
    numbers = np.array([0, 1, 255, 256, 70_000, 2**31])
    assert hidden_markov.unpacked(np.frombuffer(hidden_markov.packed(numbers), np.uint8)).tolist() == numbers.tolist()
    assert len(hidden_markov.unpacked(np.frombuffer(hidden_markov.packed(numbers[:0]), np.uint8))) == 0


def test_walk_of_nothing():
    assert walk(random_model(1), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 3)))[0].tolist() == []


def brute_scores(texts, learn, model):
    """Base and score of every text from counts and a plain recursion with the model's tables."""
    tokens = [words(t) for t in texts]
    counts = Counter(w for t, on in zip(tokens, learn, strict=True) if on for w in t)
    ends = sum(learn)
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    vocabulary = sorted({w for t in tokens for w in t})
    raw = "\n".join(vocabulary).encode()
    code = dict(zip(vocabulary, class_of(word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]).tolist(), strict=True))
    mass = Counter()
    for w, c in counts.items():
        mass[code[w]] += c + 1
    out = []
    for t in tokens:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t) + math.log10((ends + 1) / (n + v + 1))
        inside = sum(math.log10((counts[w] + 1) / (mass[code[w]] + 1)) for w in t)
        out.append((len(t) + 1, sum(w in counts for w in t) + (ends > 0), n, base, inside + plain_log(model, [*(code[w] for w in t), END]) / math.log(10)))
    return out


@pytest.fixture
def models(monkeypatch):
    """The tables that the last call scored with."""
    held, score = [], hidden_markov._score

    def keep(coded, counts, model, *rest):
        held.append(model)
        return score(coded, counts, model, *rest)

    monkeypatch.setattr(hidden_markov, "_score", keep)
    return held


def check(rows, texts, learn, model):
    want = brute_scores(texts, learn, model)
    for r, (n, known, total, base, score) in zip(rows, want, strict=True):
        assert (r["_n_tokens"], r["_n_known"], r["_train_tokens"]) == (n, known, total)
        assert r["_base"] == pytest.approx(base, abs=1e-6) and r["_score"] == pytest.approx(score, abs=1e-6)


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_documents_with_odd_cases(spark, models, monkeypatch, block):
    monkeypatch.setattr(hidden_markov, "BLOCK", block)
    texts = odd_texts() + random_texts(3, 60)
    texts[7] = texts[7][:4000]
    ids = [*range(len(texts) - 1), None]
    df = frame(spark, texts, ids).repartition(3)
    rows = hidden_markov.language_scores(df, F.col("doc_id") % 3 != 1, states=4, rounds=2).collect()
    rows.sort(key=lambda r: len(texts) if r._id is None else r._id)
    assert [r._id for r in rows] == ids
    check(rows, texts, [i is not None and i % 3 != 1 for i in ids], models[-1])


def test_nothing_to_learn_from_and_no_rows(spark, models):
    texts = ["a b", None, "a b"]
    rows = hidden_markov.language_scores(frame(spark, texts, [1, 2, 1]), F.lit(None).cast("boolean"), states=2).collect()
    assert [(r._n_known, r._train_tokens, r._base) for r in rows] == [(0, 0, 0.0)] * 3
    check(sorted(rows, key=lambda r: r._id), ["a b", "a b", None], [False] * 3, models[-1])
    assert hidden_markov.language_scores(frame(spark, []), F.lit(True)).count() == 0


def test_query_equals_brute_force(spark, models):
    rows = QUERIES["op13_lm_score"](spark, SMALL).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("on", split_code("doc_id", 7) != 2).orderBy("doc_id").collect()
    assert [r.held_out for r in rows] == [not d.on for d in docs]
    named = [{"_n_tokens": r.n_tokens, "_n_known": r.n_known, "_train_tokens": r.train_tokens, "_base": r.base_score, "_score": r.score} for r in rows]
    check(named, [d.text for d in docs], [d.on for d in docs], models[-1])


def test_held_out_texts_are_likelier_than_by_counts(spark, sf_dir):
    held = QUERIES["op13_lm_score"](spark, sf_dir).where("held_out")
    total = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert total.score > total.base
