"""Periodic runs: brute force over all starts and periods, odd cases, long texts."""

import random

import numpy as np
import pytest

from almenara.llm import periodic_runs
from almenara.llm.periodic_runs import PositionSet, runs_of
from tests.llm.cases import WORD, frame, odd_texts


def brute(words, min_words=6, min_periods=4):
    """Maximal stretches by (start, length, smallest period), every period tried at every word."""
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, min_periods * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rnd):
    words = []
    for _ in range(rnd.randint(0, 8)):
        unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 6))]
        words += unit * rnd.choice([1, 1, 2, 4, 5, 9]) + unit[: rnd.randint(0, len(unit))]
        words += [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 5))]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [random_words(rnd) for _ in range(30)]
    flat = np.array([hash(("w", w)) & 0x7FFFFFFFFFFFFFFF for t in texts for w in t], np.uint64)
    edges = np.cumsum([0, *(len(t) for t in texts)])
    for min_words, min_periods in ((6, 4), (8, 3), (12, 5)):
        want = [(int(e) + s, n, q) for e, t in zip(edges, texts, strict=False) for s, n, q in brute(t, min_words, min_periods)]
        assert [tuple(r) for r in runs_of(flat, edges, min_words, min_periods).tolist()] == want


def test_strings_of_few_letters_with_nested_runs():
    for n in range(4, 14):
        for code in range(2**n):
            words = [(code >> k) & 1 for k in range(n)]
            got = runs_of(np.array(words, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(11), np.array([0, n]))
            assert [tuple(r) for r in got.tolist()] == brute(words)


def test_one_word_many_times_takes_no_square_time():
    n = 200_000
    assert runs_of(np.full(n, 77, np.uint64), np.array([0, n])).tolist() == [[0, n, 1]]


def test_position_set_keeps_order():
    rnd = random.Random(1)
    values = rnd.sample(range(100_000), 5000)
    held, seen = PositionSet(values[0]), [values[0]]
    for x in values[1:]:
        before, after = held.add(x)
        assert before == max((y for y in seen if y < x), default=-1) and after == min((y for y in seen if y > x), default=-1)
        seen.append(x)
    assert [x for part in held.parts for x in part] == sorted(values) and held.size == 5000


def test_too_few_periods_are_refused():
    with pytest.raises(ValueError, match="not found"):
        runs_of(np.zeros(3, np.uint64), np.array([0, 3]), min_periods=2)


@pytest.mark.parametrize("piece", [1 << 20, 60])
def test_documents_with_odd_cases(spark, monkeypatch, piece):
    monkeypatch.setattr("almenara.llm.arrays.PIECE", piece)
    monkeypatch.setattr(periodic_runs, "PIECE", piece)
    rnd = random.Random(7)
    texts = odd_texts() + ["\n ".join(random_words(rnd)) + " " for _ in range(60)] + ["Ab ab " * 9, "é ñ\t" * 5]
    texts[7] = (texts[7] or "")[:2000]
    ids = [*range(len(texts) - 1), None]
    rows = periodic_runs.periodic_runs(frame(spark, texts, ids).repartition(3)).collect()
    by_id = {r._id: ([tuple(x) for x in r._runs], r._collapsed) for r in rows}
    assert len(rows) == len(texts)
    for i, t in zip(ids, texts, strict=True):
        words = WORD.findall(t or "")
        want = brute(words)
        assert by_id[i] == (want, collapsed(words, want))
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0
