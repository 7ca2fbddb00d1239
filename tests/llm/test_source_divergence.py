"""Source divergence: brute force, odd cases, lengths of terms, and blocks."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from almenara.llm import source_divergence
from almenara.llm.source_divergence import UNIT, count_terms
from tests.llm.cases import frame, odd_texts

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["_lang", "_source", "_part", "_item", "_value", "_rank"]
SCHEMA = "text string, lang string, source string, _term string, _count int, _group string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, min_docs=3, top=200):
    """All rows of the result from (text, lang, source), term by term."""
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        docs = Counter(w for t, of, _ in rows if of == lang for w in set(terms(t)))
        kept = sorted(w for w, n in docs.items() if n >= min_docs)
        counts = {s: Counter(w for t, of, src in rows if (of, src) == (lang, s) for w in terms(t) if docs[w] >= min_docs) for s in {r[2] for r in rows if r[1] == lang}}
        whole = sum(counts.values(), Counter())

        def shares(c, kept=kept):
            total = sum(c.values()) + len(kept)
            return {w: 1 + UNIT * (c[w] + 1) // total for w in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(-sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o.encode()) for o in counts if o != s]
            over = [(-((p[s][w] - q[w]) ** 2 // q[w]), w.encode()) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
                out |= {(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)}
    return out


def result(df, **args):
    rows = [tuple(r) for r in source_divergence.source_divergence(df, **args).select(COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(seed, n):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abCDéß日") for _ in range(rnd.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 30, 200]))) for _ in range(60)]
    rows = []
    for _ in range(n):
        source = rnd.choice(["a", "b", "B", "ñ", None, "a"])
        words = [rnd.choice(vocab[: 30 + 6 * len(source or "")]) + rnd.choice(["", "", "1", "-", "\x00"]) for _ in range(rnd.randint(0, 40))]
        rows.append((" ".join(words) if words else None, rnd.choice(["x", "y", None]), source))
    return rows


def test_random_tables_against_brute_force(spark):
    rows = random_rows(3, 150)
    df = spark.createDataFrame([(*r, "t", 1, "g") for r in rows], SCHEMA).repartition(5)
    assert result(df) == brute(rows)
    assert result(df, min_docs=1, top=7) == brute(rows, 1, 7)


def test_long_texts_in_pieces_and_small_blocks(spark, monkeypatch):
    rows = random_rows(4, 40)
    rows += [(" ".join(t for t, _, _ in rows[:20] if t) + "x" * 5000, "x", "a")] * 2
    want = brute(rows)
    df = spark.createDataFrame([(*r, "t", 1, "g") for r in rows], SCHEMA)
    monkeypatch.setattr(source_divergence, "PIECE", 64)
    monkeypatch.setattr(source_divergence, "_BLOCK", 2)
    assert result(df) == want


def test_odd_texts_and_empty_tables(spark):
    df = frame(spark, odd_texts() * 3)
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert result(df) == brute(rows)
    assert result(df.limit(0)) == set()
    few = spark.createDataFrame([("one", "x", "a"), (None, "x", "b"), ("", "x", None)], "text string, lang string, source string")
    assert {r[3:5] for r in result(few)} == {("a", 0), ("b", 0), ("", 0)}


@pytest.mark.parametrize("seed", range(3))
def test_terms_of_all_lengths_are_counted(seed):
    rnd = random.Random(seed)
    texts = [t for t, _, _ in random_rows(seed, 30) if t]
    raw = [t.encode() for t in texts]
    group = np.array([rnd.randint(0, 3) for _ in texts])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    of, term, n, docs = count_terms(np.frombuffer(b"".join(raw), np.uint8), offsets, group)
    want, held = Counter(), Counter()
    for g, t in zip(group.tolist(), texts, strict=True):
        want.update((g, w) for w in terms(t))
        held.update((g, w) for w in set(terms(t)))
    keys = [(g, w.decode()) for g, w in zip(of.tolist(), term.to_pylist(), strict=True)]
    assert dict(zip(keys, n.tolist(), strict=True)) == want
    assert dict(zip(keys, docs.tolist(), strict=True)) == held


def test_shares_of_large_counts_are_exact(spark):
    big = 10**15
    row = spark.range(1).select(source_divergence.share(source_divergence.F.lit(big - 7), source_divergence.F.lit(2 * big + 3)).alias("p")).first()
    assert row.p == 1 + UNIT * (big - 6) // (2 * big + 3)
