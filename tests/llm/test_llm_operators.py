"""Odd cases of every operator, and brute force on small random tables."""

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almenara.llm import decontaminate, graph, line_dedup, mixing, near_dup, quality_classifier, quality_rules, samples, secrets, suffix_dedup, toxicity, warc
from almenara.llm.arrays import mix, ngram_hashes, word_hashes
from almenara.session import scratch_folder
from tests.llm.cases import frame, near_components, odd_texts, random_texts, repeated_bytes, runs, shingles, words

# --- words and hashes --------------------------------------------------------


def test_word_hashes_depend_on_words_alone():
    texts = [t or "" for t in odd_texts()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    hashes, edges = word_hashes(data, offsets)
    assert np.diff(edges).tolist() == [len(words(t)) for t in texts]
    seen = {}
    for h, w in zip(hashes.tolist(), [w for t in texts for w in words(t)], strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i}" for i in range(3000)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole, _ = word_hashes(data, offsets)
    monkeypatch.setattr("almenara.llm.arrays.PIECE", 100)
    parts, edges = word_hashes(data, offsets)
    assert (whole == parts).all() and edges.tolist() == [0, 3000]
    assert len(ngram_hashes(whole, 4000)) == 0


# --- WARC --------------------------------------------------------------------


def test_warc_round_trip_with_small_chunks(spark):
    payloads = [b"", b"\n", b"\r\n\r\n", b"WARC/1.1\r\nfoo", b"a" * 1000, bytes(range(256)) * 9, b"line\n" * 300, b"ends with \r\n"]
    rows = [(warc_id, f"http://x/{i}\r\nEvil: 1", p, None) for i, p in enumerate(payloads) if (warc_id := f"<urn:almenara:record:{i}>")]
    rows.append(("<urn:almenara:record:99>", None, payloads[4], "<urn:almenara:record:4>"))
    df = spark.createDataFrame(rows, "r string, u string, p binary, f string").repartition(2)
    path = warc.write_warc(df, scratch_folder(spark, "t"), "r", "u", "p", "f", chunk_bytes=64)
    chunks = warc.read_warc(spark, path, chunk_bytes=50).cache()
    assert chunks.agg(F.max("n_bytes")).first()[0] <= 64
    by_record = {}
    for r in chunks.orderBy("record_id", "chunk").collect():
        by_record.setdefault(r.record_id, []).append(r)
    for i, p in enumerate(payloads):
        got = by_record[f"<urn:almenara:record:{i}>"]
        assert b"".join(r.payload for r in got) == p
        for k, r in enumerate(got):  # digests run along
            upto = b"".join(x.payload for x in got[: k + 1])
            assert r.sha1 == base64.b32encode(hashlib.sha1(upto).digest()).decode() and r.payload_end == len(upto)
        assert got[-1].last and got[-1].sha1 == got[-1].declared_digest
    resolved = {r.record_id: r for r in warc.resolve_revisits(chunks).collect()}
    assert resolved["<urn:almenara:record:99>"].payload_bytes == 1000
    assert resolved["<urn:almenara:record:99>"].record_type == "revisit"


def test_warc_revisits_and_odd_rows(spark):
    rows = [(1, b"x"), (2, b"x"), (None, b"x"), (3, b""), (4, b""), (5, b"yy"), (5, b"yy"), (None, b"z")]
    got = warc.mark_revisits(spark.createDataFrame(rows, "i bigint, p binary"), "i", "p").collect()
    assert sorted((r.i or 0, bytes(r.p), r._refers_to) for r in got) == sorted([(1, b"x", 2), (2, b"x", None), (0, b"x", 2), (3, b"", 4), (4, b"", None), (5, b"yy", None), (5, b"yy", None), (0, b"z", None)], key=lambda t: (t[0], t[1]))
    none = warc.mark_revisits(spark.createDataFrame(rows, "i bigint, p binary"), "i", "p", min_bytes=1)
    assert none.where("p = X''").where("_refers_to IS NOT NULL").count() == 0


def test_warc_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "r string, u string, p binary, f string")
    assert warc.read_warc(spark, warc.write_warc(empty, scratch_folder(spark, "t"), "r", "u", "p", "f")).count() == 0


def test_cut_off_record_is_an_error():
    reader = warc.RecordReader("f", 10)
    for line in (b"WARC/1.1\r", b"WARC-Type: response\r", b"Content-Length: 5\r", b"\r", b"ab"):
        list(reader.line(line))
    with pytest.raises(ValueError):
        reader.finish()


# --- line dedup --------------------------------------------------------------


def test_line_dedup_by_hand(spark):
    texts = ["Shared line one\nown a", "  shared LINE one \nshared line one\nshort\nÉ shared accent line", "é shared accent line\nshort", None, "", "Shared line one\nown a"]
    got = {r.doc_id: r for r in line_dedup.line_dedup(frame(spark, texts, ids=[1, 2, 3, 4, 5, None])).collect()}
    assert got[1].text == texts[0]
    assert got[2].text == "short\nÉ shared accent line" and got[2]._n_dropped == 2
    assert got[3].text == texts[2]  # É is not é
    assert got[4].text is None and got[4]._n_lines == 1
    assert got[5].text == "" and got[5]._kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None].text == "own a"  # under ten code points


def test_line_dedup_odd_texts_and_thresholds(spark):
    texts = odd_texts()
    done = line_dedup.line_dedup(frame(spark, texts)).collect()
    assert len(done) == len(texts) and done[0].asDict().keys() >= {"line", "node", "score"}
    assert sum(r._n_dropped for r in done) == 1
    assert sum(r._n_dropped for r in line_dedup.line_dedup(frame(spark, texts), min_docs=3).collect()) == 0
    same_id = line_dedup.line_dedup(frame(spark, ["a shared line"] * 2, ids=[7, 7])).collect()
    assert [r._n_dropped for r in same_id] == [0, 0]
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


# --- mixing ------------------------------------------------------------------


def brute_targets(sizes, pattern=(5, 2, 1), repeats=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: pattern[i % len(pattern)] for i, s in enumerate(order)}
    capped, free, room = {}, set(sizes), float(sum(sizes.values()))
    while True:
        level = {s: room * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if level[s] > repeats * sizes[s]}
        if not over:
            return {**capped, **level}
        for s in over:
            capped[s] = float(repeats * sizes[s])
            room -= capped[s]
            free.remove(s)


def test_mix_meets_its_targets(spark):
    rnd = random.Random(3)
    sources = [rnd.choice(["a", "a", "a", "a", "b", "é", None, "tiny", "z"]) for _ in range(400)]
    texts = [None if i % 50 == 0 else " ".join(["w"] * rnd.randint(0, 40)) for i in range(400)]
    got = mixing.mix_sources(frame(spark, texts, sources=sources)).collect()
    assert len(got) == 400
    sizes, taken = {}, {}
    for r in got:
        sizes[r._source] = sizes.get(r._source, 0) + r._size
        taken[r._source] = taken.get(r._source, 0) + r._taken
        assert 0 <= r._taken <= 3 * r._size
    want = brute_targets(sizes)
    for r in got:
        assert r._source_size == sizes[r._source] and r._target == pytest.approx(want[r._source])
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1
    assert abs(sum(taken.values()) - sum(sizes.values())) <= len(sizes)
    again = mixing.mix_sources(frame(spark, texts, sources=sources).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_splits_the_slot_of_a_repeated_id(spark):
    """Half the rows without id, of two sizes and equal in all: small tasks, the same mix however they are dealt."""
    rows = [(None if i % 2 else i, "w " * (5 if i % 10 < 9 else 1 + i % 40), "ab"[i % 3 > 0]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = sorted((str(r._id), r._source, r._size, r._taken) for r in mixing.mix_sources(docs).collect())
    again = sorted((str(r._id), r._source, r._size, r._taken) for r in mixing.mix_sources(docs.orderBy("source", "text").repartition(5)).collect())
    assert want == again and len(want) == 6000
    keyed = mixing.stored(docs.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), mixing.word_count("text").alias("_size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("_shuffle"), F.monotonically_increasing_id().alias("_row")).withColumn("_slot", F.substring("_shuffle", 1, 3)), "test")
    split = mixing.split_slots(keyed, least=50)
    assert split.exceptAll(keyed.select(split.columns)).select("_row").join(keyed, "_row").count() > 2900
    assert split.count() == 6000 and split.select("_row").distinct().count() == 6000
    assert max(r["count"] for r in split.groupBy("_source", "_slot").count().collect()) <= 110
    # names sort as rows do: by code, then size
    names = sorted({(r._source, r._slot, r._shuffle, r._size) for r in split.where("_id IS NULL").collect()})
    assert [n[3] for n in names if n[0] == "a"] == sorted(n[3] for n in names if n[0] == "a")


def test_mix_budget_order_and_odd_rows(spark):
    docs = frame(spark, ["a b c d"] * 30, sources=["p"] * 20 + ["q"] * 10)
    copies = mixing.mix_copies(docs, budget=50).collect()
    assert sum(r._taken for r in copies) == 50
    last = max(r._finish for r in copies if r._taken)
    assert all(r._taken for r in copies if r._finish < last)
    odd = mixing.mix_sources(frame(spark, odd_texts(), ids=[None] * 12, sources=[None] * 12)).collect()
    assert len(odd) == 12 and all(r._taken == r._size for r in odd)
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    assert [r._taken for r in mixing.mix_sources(frame(spark, ["", None])).collect()] == [0, 0]


# --- near duplicates ---------------------------------------------------------


def test_components_equal_brute_force(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    root = list(range(600))
    for a, b in links:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: root[n] for a, b in links for n in (a, b) if a != b or n in got}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates_equal_all_pairs(spark, n):
    texts = random_texts(n, 160) + odd_texts()
    got = {r._id: r for r in near_dup.near_duplicates(frame(spark, texts), shingle_words=n).collect()}
    want = near_components(texts, n)
    assert {i: r._component for i, r in got.items()} == dict(enumerate(want))
    assert all(r._n == len(shingles(texts[i], n)) for i, r in got.items())


def test_near_copies_in_blocks(spark, monkeypatch):
    """A group of near copies of which few resemble the leader, under keys split into blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(70):
        w = list(base)
        for k in rnd.sample(range(120), rnd.randint(0, 7)):
            w[k] = f"new{i}n{k}"
        texts.append(" ".join(w))
    got = {r._id: r._component for r in near_dup.near_duplicates(frame(spark, texts), shingle_words=4).collect()}
    assert got == dict(enumerate(near_components(texts, 4)))
    assert 1 < len(set(got.values())) < 70


def test_index_finds_all_pairs_under_the_distance():
    rnd = np.random.default_rng(2)
    a = rnd.integers(0, 1 << 16, (300, near_dup.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    most = near_dup.CHUNKS * (near_dup.ERRORS + 1) - 1
    for row in b:
        row[rnd.choice(near_dup.INDEXED, most, replace=False)] ^= 1
    shared = near_dup.index_keys(a) == near_dup.index_keys(b)
    assert shared.any(axis=1).all()
    assert (near_dup.shared_choices(a == b) == shared).all()


def test_similar_pairs_with_distant_signatures(spark):
    """Pairs at a similarity of exactly 0.8 whose signatures differ by chance in over a third of their symbols."""
    texts = [" ".join(f"w{i}x{k}" for k in range(n)) for i in range(30_000) for n in (7, 8)]
    rows = near_dup.signatures(list(near_dup.text_sets(pa.array(texts), 4)))
    distance = (rows[::2] != rows[1::2]).sum(axis=1)
    far = np.flatnonzero(distance > 43).tolist()
    assert far
    pairs = [texts[2 * i + k] for i in far for k in range(2)]
    got = {r._id: r._component for r in near_dup.near_duplicates(frame(spark, pairs), shingle_words=4).collect()}
    assert got == {i: i // 2 * 2 for i in range(len(pairs))}


def test_sketches_allow_every_linked_pair():
    rnd = np.random.default_rng(3)
    for size in (1, 4, 30, 200, 3000, 20000):
        a = rnd.integers(0, 1 << 63, size).astype(np.uint64)
        bits = near_dup.sketch(a)
        for out in {0, size // 10, size // 9, size // 8, size // 2}:
            b = np.concatenate([a[out:], rnd.integers(0, 1 << 63, out).astype(np.uint64)])
            linked = 100 * (size - out) >= 80 * (size + out)
            may = near_dup.may_link(bits, near_dup.sketch(b)[None], size, np.array([len(b)]), 80)[0]
            assert may or not linked
            assert size > 200 or size < 4 or out < size // 2 or not may


def test_drop_near_duplicates_odd_rows(spark):
    texts = ["a b c d e f g", "a b c d e f g", None, "", "A B c d e f g", "z"]
    kept = near_dup.drop_near_duplicates(frame(spark, texts, ids=[5, 3, 1, 2, None, None])).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 3]
    assert near_dup.drop_near_duplicates(frame(spark, [])).count() == 0


# --- quality rules -----------------------------------------------------------


@pytest.mark.parametrize("piece", [7, 64, 300])
def test_quality_of_long_texts_in_pieces(monkeypatch, piece):
    """Cut at any byte, within words, lines and characters, the counts stay."""
    rnd = random.Random(piece)
    alphabet = ["uno", "dos", "árbol", "日本語", "x" * 40, "#", "a|b", "tres"]
    texts = ["", " ", "\n\n", "w" * 500, "é" * 333, " lead and trail ", "a\n" * 60, ("same line here\n" * 9) + "same line here"]
    texts += ["".join(rnd.choice(alphabet) + rnd.choice([" ", " ", "\n", "\t", "  ", "\r\n"]) for _ in range(rnd.randrange(1, 400))) for _ in range(40)]
    lengths = (2, 3, 5, 8)
    want = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        want.append({k: int(v[0]) for k, v in quality_rules.measure(data, np.array([0, len(data)]), lengths).items()})
    monkeypatch.setattr(quality_rules, "PIECE", piece)
    for t, w in zip(texts, want, strict=True):
        if t:
            assert {k: int(v[0]) for k, v in quality_rules.measure_long(np.frombuffer(t.encode(), np.uint8), lengths).items()} == w, t


def test_quality_memory_of_a_long_text():
    """20 MB of text take under 20 bytes a byte beside it."""
    import tracemalloc

    words = np.random.default_rng(5).integers(0, 1 << 20, 3_000_000)
    data = np.frombuffer(" ".join(f"{w:06d}" for w in words).encode(), np.uint8)
    quality_rules.measure_long(data[:100], (5,))
    tracemalloc.start()
    got = quality_rules.measure_long(data, tuple(quality_rules.NGRAM_LIMITS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["n_words"][0] == 3_000_000
    assert peak < 20 * len(data), peak / len(data)


def test_quality_counts_by_hand(spark):
    line = "one two three four five six"
    texts = [f"{line}\n{line}\n\n x # $", None, "é ñ\n é ñ", "Once upon a time there was a text with no repeats at all in it"]
    got = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark, texts)).collect()}
    q = got[0]._quality
    assert (q.n_words, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == (15, 2, 1, 12)
    assert got[0]._base_failed and not got[0]._kept
    assert got[1]._quality.n_words == 0 and got[1]._base_failed
    assert got[2]._quality.word_chars == 4 and got[2]._quality.n_dup_lines == 0
    assert got[3]._kept


def test_quality_repeats_equal_brute_force(spark):
    texts = random_texts(4, 60, vocabulary=6) + odd_texts()
    rows = quality_rules.quality_measures(frame(spark, texts), lengths=(2, 3, 5)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = __import__("re").findall(r"[^\x20\x09-\x0D]+", r.text or "")
        for n in (2, 3, 5):
            seen, inside, twice = set(), set(), {}
            for i in range(len(w) - n + 1):
                g = tuple(w[i : i + n])
                twice.setdefault(g, []).append(i)
                if g in seen:
                    inside |= set(range(i, i + n))
                seen.add(g)
            assert r._quality[f"dup_{n}"] == sum(len(w[i]) for i in inside)
        assert r._quality.n_repeat_words == len({i + k for at in twice.values() if len(at) > 1 for i in at for k in range(5)})
    assert quality_rules.quality_rules(frame(spark, [])).count() == 0


# --- repeated byte strings ---------------------------------------------------


@pytest.mark.parametrize("bucket", [2, 4096])
def test_suffix_dedup_equals_brute_force(spark, bucket):
    length = 60
    rnd = random.Random(8)
    passage = "".join(rnd.choice("abcdefg é") for _ in range(90))
    texts = random_texts(6, 80, words=40) + [f"{rnd.random()}{passage}{rnd.random()}" for _ in range(12)] + ["ab" * 100, "ab" * 40 + "c" * 100] + odd_texts()[:7] + ["same text here again " * 5] * 2
    want = repeated_bytes(texts, length)
    got = {r._id: r for r in suffix_dedup.suffix_dedup(frame(spark, texts), length=length, bucket=bucket).collect()}
    assert len(got) == len(texts)
    for i, (t, gone) in enumerate(zip(texts, want, strict=True)):
        rest = bytes(b for b, g in zip((t or "").encode(), gone, strict=True) if not g)
        assert (got[i]._n_bytes, got[i]._n_removed, got[i]._n_spans) == (len(gone), sum(gone), runs(gone)), i
        assert bytes(got[i]._kept) == rest and got[i]._kept_sha256 == hashlib.sha256(rest).hexdigest()


def test_suffix_dedup_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    monkeypatch.setattr("almenara.llm.arrays.PIECE", 300)
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgh") for _ in range(4000))
    texts = [text, "zz" + text[700:1900] + "q", text[3500:] + text[:200]]
    want = repeated_bytes(texts, 60)
    got = {r._id: r for r in suffix_dedup.suffix_dedup(frame(spark, texts), length=60).collect()}
    assert [(got[i]._n_removed, got[i]._n_spans) for i in range(3)] == [(sum(g), runs(g)) for g in want]


def test_suffix_dedup_repeated_and_null_ids(spark):
    t = "".join(chr(97 + i % 26) + str(i) for i in range(40))
    got = suffix_dedup.suffix_dedup(frame(spark, [t, t, t + "x", "other"], ids=[1, 1, None, None]), length=50).collect()
    assert sorted(r._n_removed for r in got) == sorted([len(t), len(t), len(t), 0])
    assert suffix_dedup.suffix_dedup(frame(spark, []), length=50).count() == 0


def test_sliding_minimum():
    v = np.random.default_rng(0).integers(0, 99, 50).astype(np.uint64)
    for w in (1, 3, 7, 50):
        assert suffix_dedup.sliding_minimum(v, w).tolist() == [v[i : i + w].min() for i in range(51 - w)]


# --- decontamination ---------------------------------------------------------


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("size", [5, 40, 63, 64, 90])
def test_common_subsequence(size):
    rnd = np.random.default_rng(size)
    pattern = rnd.integers(0, 12, size).astype(np.uint64)
    text = rnd.integers(0, 14, (20, 70)).astype(np.uint64)
    inside = np.ones(text.shape, bool)
    inside[:, :5] = False
    length, tail = decontaminate.common_subsequence(pattern, text, inside)
    assert length.tolist() == [brute_lcs(pattern.tolist(), t[5:].tolist()) for t in text]
    assert (tail <= length).all()


def test_singular_values_near_exact_ones():
    rnd = np.random.default_rng(4)
    topics = rnd.integers(0, 400, (6, 30))
    texts = [" ".join(f"t{x}" for x in rnd.choice(topics[i % 6], 32)) for i in range(600)]
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    words_, edges = word_hashes(data, np.array([0, len(data)]))
    test = decontaminate.test_matrix()
    frequency, sketch = np.zeros(len(test)), np.zeros(test.shape)
    n = decontaminate.sketch_block(words_, edges, test, frequency, sketch)
    space = decontaminate.solve(n, frequency, sketch, test)
    exact = np.zeros((n, len(test)))
    np.add.at(exact, (np.arange(len(words_)) // decontaminate.PASSAGE, decontaminate.terms(words_)), 1)
    assert (frequency == (exact > 0).sum(axis=0)).all()
    values = np.linalg.svd(exact * space.idf, compute_uv=False)
    assert np.allclose(space.values[:6], values[:6], rtol=0.1)
    assert np.allclose(space.vectors.T @ space.vectors, np.eye(space.vectors.shape[1]), atol=1e-6)


def test_partial_sums_are_packed_without_loss():
    """A small task sends a small part of its table, which has 8.5 MB in single precision."""
    rnd = np.random.default_rng(6)
    words_ = mix(rnd.integers(0, 3000, 100_000).astype(np.uint64))
    words_[::3] = words_[0]  # a frequent word
    test = decontaminate.test_matrix()
    frequency, sketch = np.zeros(len(test)), np.zeros(test.shape, np.float32)
    decontaminate.sketch_block(words_, np.array([0, 40_000, 100_000]), test, frequency, sketch)
    sums = np.concatenate([sketch, frequency[:, None]], axis=1)
    sums[7, 3] = 40_000  # each kind of number
    parts = [sums[at : at + 1024] for at in range(0, len(sums), 1024)]
    packed = [decontaminate.pack(x) for x in parts]
    assert sum(map(len, packed)) < 600_000
    assert all((decontaminate.unpack(p, 65) == x).all() for p, x in zip(packed, parts, strict=True))
    assert len(decontaminate.pack(np.zeros((1024, 65)))) == 1024


def test_many_patterns_at_once():
    """Rows of different patterns get the subsequence with their own; what is gathered by rows lies in rows."""
    rnd = np.random.default_rng(14)
    marks, want = np.zeros((60, 80), np.uint64), []
    sizes = rnd.integers(1, 64, 60)
    for row, size in enumerate(sizes):
        pattern, text = rnd.integers(0, 9, size).astype(np.uint64), rnd.integers(0, 12, (1, rnd.integers(1, 80))).astype(np.uint64)
        inside = rnd.random(text.shape) < 0.9
        marks[row, : text.shape[1]] = decontaminate.marked(decontaminate.word_places(pattern), text, inside)[0]
        want.append((brute_lcs(pattern.tolist(), text[inside].tolist()), decontaminate.matched_long(pattern, text, inside)[1][0]))
    assert list(zip(*decontaminate.matched(marks, sizes), strict=True)) == want
    space = decontaminate.Space(np.ones(50), rnd.random((50, 20)), np.arange(20.0))
    assert space.project().flags.c_contiguous


def test_leaks_reworded_and_odd(spark):
    rnd = random.Random(5)
    vocab = [f"word{i}" for i in range(300)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    item = prose(40)
    reworded = [w if k % 7 else "changed" for k, w in enumerate(item)]
    texts = [" ".join(prose(200)) for _ in range(80)] + [" ".join(prose(50) + item + prose(60)), " ".join(prose(30) + reworded + prose(11)), " ".join(item[:20] + prose(90)), *odd_texts()]
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "never seen words " * 9)], "item_id int, text string")
    got = {(r._id, r._item) for r in decontaminate.find_leaks(frame(spark, texts), items).collect()}
    assert got == {(80, 1), (81, 1)}
    kept = decontaminate.decontaminate(frame(spark, texts), items)
    assert kept.count() == len(texts) - 2 and kept.columns == frame(spark, texts).columns
    assert decontaminate.find_leaks(frame(spark, []), items).count() == 0
    assert decontaminate.find_leaks(frame(spark, texts), items.limit(0)).count() == 0


def test_leaks_at_any_offset_and_with_two_fifths_changed(spark):
    """Items of all lengths, in capitals, and with so many words changed as the share permits, whatever their cosine."""
    rnd = random.Random(6)
    vocab = [f"ñé{i}" for i in range(400)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [prose(n) for n in (5, 14, 15, 23, 31, 32, 40, 59, 90, 140)]
    texts, want = [" ".join(prose(200)) for _ in range(60)], set()
    for i, item in enumerate(items):
        for offset in range(8):
            out = [k for k in range(len(item)) if k % 5 in (1, 3)][: 2 * len(item) // 5]
            changed = [f"new{rnd.randrange(10**6)}" if k in out else w for k, w in enumerate(item)]
            for copy in (item, [w.upper() for w in item], changed):
                want.add((len(texts), i))
                texts.append(" ".join(prose(40 + offset) + copy + prose(30)))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id int, text string")
    got = {(r._id, r._item) for r in decontaminate.find_leaks(frame(spark, texts), table).collect()}
    assert want - got == set()


def test_places_hold_every_window_that_the_check_accepts():
    rnd = np.random.default_rng(7)
    for common in (30, 300):  # few words, so that items and texts agree by chance
        words_ = rnd.integers(0, 1 << 63, common).astype(np.uint64)[np.minimum(rnd.geometric(0.1, 3000) * rnd.integers(1, 4, 3000), common) - 1]
        edges = np.array([0, 700, 703, 703, 3000])
        frequency = np.bincount(decontaminate.terms(words_), minlength=1 << decontaminate.TERM_BITS)
        items = [words_[a : a + n] for a, n in ((10, 5), (333, 14), (900, 31), (2000, 64))]
        data = [" ".join(map(str, w)) for w in items]
        bench = decontaminate.benchmark_items(list(range(4)), data, np.zeros((1 << decontaminate.TERM_BITS, 2), np.float32), frequency / 3000, 0.6)
        named = {int(w): word_hashes(np.frombuffer(str(w).encode(), np.uint8), np.array([0, len(str(w))]))[0][0] for w in np.unique(words_)}
        hashed = np.array([named[int(w)] for w in words_])
        window, item = decontaminate.places(hashed, decontaminate.terms(hashed), edges, bench)
        got = set(zip(window.tolist(), item.tolist(), strict=True))
        begin, doc = decontaminate._steps(hashed, edges)
        want = set()
        for w, (b, d) in enumerate(zip(begin, doc, strict=True)):
            for i, pattern in enumerate(bench.words):
                near = hashed[max(b - 8, edges[d]) : min(b + len(pattern) + 8, edges[d + 1])]
                if brute_lcs(pattern.tolist(), near.tolist()) >= 0.6 * len(pattern):
                    want.add((w, i))
        assert len(want) > 10 and want <= got


def test_leaks_without_the_ending(spark):
    """Copies that end before the item does: word for word, and nearly so; reworded ones still need the ending."""
    rnd = random.Random(8)
    vocab = [f"word{i}" for i in range(300)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    item, long = prose(40), prose(100)
    nearly = ["changed" if k in (5, 15) else w for k, w in enumerate(item[:34])]
    reworded = ["changed" if k % 6 == 1 else w for k, w in enumerate(item[:32])]
    copies = [item[:32], item[:24], nearly, reworded, item[:20], long[:80], long[:60]]
    texts = [" ".join(prose(200)) for _ in range(60)] + [" ".join(prose(50 + k) + c + prose(60)) for k, c in enumerate(copies)]
    table = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long))], "item_id int, text string")
    rows = decontaminate.find_leaks(frame(spark, texts), table).collect()
    assert {(r._id - 60, r._item) for r in rows} == {(0, 1), (1, 1), (2, 1), (5, 2), (6, 2)}


def test_longest_run():
    rnd = np.random.default_rng(9)
    pattern, text = rnd.integers(0, 3, 12).astype(np.uint64), rnd.integers(0, 3, (30, 25)).astype(np.uint64)
    inside = np.ones(text.shape, bool)
    inside[:, :4] = False
    seen = lambda t, n: any((t[i : i + n] == pattern[j : j + n]).all() for i in range(4, 26 - n) for j in range(13 - n))
    want = [max(n for n in range(13) if n == 0 or seen(t, n)) for t in text]
    assert decontaminate.longest_run(pattern, text, inside).tolist() == want


# --- learned scores ----------------------------------------------------------


def test_toxic_sentences_are_located(spark):
    rnd = random.Random(6)
    prose = lambda: " ".join(rnd.choice(["sun", "rain", "tree", "road", "house"]) for _ in range(9)) + ". "
    texts, labels = [], []
    for i in range(120):
        bad = i % 3 == 0
        texts.append(prose() + prose() + ("you rotten fool are vile. " if bad else prose()) + prose())
        labels.append((i, int(bad)))
    docs = frame(spark, texts + odd_texts())
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(docs, marks)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert all((got[i]._score >= 0.5) == bool(y) for i, y in labels)
    spans = got[0]._offending
    assert len(spans) == 1 and "rotten" in texts[0].encode()[spans[0].start : spans[0].end].decode()
    assert all(got[i]._score < 0.5 for i in range(120, 126))
    flat = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, marks.where("toxic = 0"))).collect()
    assert len({r._score for r in flat}) == 1
    assert toxicity.score_toxicity(frame(spark, []), model).count() == 0


def test_noisy_or():
    p = np.array([0.5, 0.5, 0.1, 0.0])
    assert toxicity.noisy_or(p, np.array([0, 2, 3, 4])).round(6).tolist() == [0.75, 0.1, 0.0]


def test_classifier_cuts_long_texts_at_blanks(monkeypatch):
    """Vectors and features of a text in pieces are those of the whole text."""
    rnd = random.Random(3)
    words = ["one", "two", "two", "three", "x-y", "ñandú", "(four)", "long" * 30]
    texts = [" ".join(rnd.choice(words) for _ in range(n)) for n in (300, 3, 900, 1, 450)] + ["", "nogap" * 200, " " * 900, "a " * 600]
    batch = pa.record_batch([pa.array([t.encode() for t in texts], pa.binary())], names=["_text"])
    index = quality_classifier.index_vectors()

    def results():
        sums, tokens = np.zeros((len(index) - 1, quality_classifier.DIMENSIONS)), []
        for buckets, edges, n, inner, more in quality_classifier._blocks(batch):
            quality_classifier.add_contexts(sums, index, buckets, edges, inner)
            tokens.append(buckets[inner])
        return sums, np.concatenate(tokens), len(tokens)

    sums, tokens, parts = results()
    for size in (64, 256, 1000):
        monkeypatch.setattr(quality_classifier, "PIECE", size)
        again, same, more = results()
        assert more > parts and (same == tokens).all() and np.allclose(again, sums)


def test_quality_scores_odd_rows(spark):
    texts = ["THE!! LOUD!! WORDS!! ARE!! HERE!!", "a calm text of common words"] * 40 + odd_texts()
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, (i + 0) % 2) for i in range(60)], "doc_id bigint, quality int")
    got = {r._id: r._score for r in quality_classifier.quality_scores(docs, labels).collect()}
    assert len(got) == len(texts) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(60, 80))
    none = quality_classifier.quality_scores(docs, labels.limit(0)).collect()
    assert {r._score for r in none} == {0.5}
    assert quality_classifier.quality_scores(frame(spark, []), labels).count() == 0


def test_word_vectors_equal_brute_force():
    index = quality_classifier.index_vectors()
    buckets, edges = np.array([3, 9, 3, 5, 7, 9]), np.array([0, 4, 4, 6])
    sums = np.zeros((len(index) - 1, quality_classifier.DIMENSIONS))
    quality_classifier.add_contexts(sums, index, buckets, edges)
    want = np.zeros_like(sums)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        for i in range(a, b):
            for j in range(max(a, i - 2), min(b, i + 3)):
                if j != i:
                    want[buckets[i]] += index[buckets[j]]
    assert np.allclose(sums, want)


def test_temperature_and_samples(spark):
    rnd = np.random.default_rng(3)
    y = rnd.integers(0, 2, 600)
    x = np.concatenate([y[:, None] + rnd.normal(0, 1.2, (600, 1)), rnd.normal(0, 1, (600, quality_classifier.FEATURES - 1))], axis=1)
    net = quality_classifier.train_network(x, y)
    assert net.temperature > 1  # learned by heart, so too sure
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(4, 1), (None, 1), (7, None)], "doc_id bigint, quality int")
    got = samples.labelled_ids(labels, "doc_id", "quality", 10).collect()
    assert len(got) == 20 and len({r._label_id for r in got}) == 20
    code = spark.createDataFrame([(None,), (12,)], "doc_id bigint").select(samples.split_code("doc_id", 3).alias("c")).collect()
    assert [r.c for r in code] == [0, __import__("zlib").crc32(b"12") % 3]


# --- secrets -----------------------------------------------------------------


def test_secret_candidates_and_redaction(spark):
    key, other = "AKIA" + "Z7Q2" * 4, "e3b0c44298fc1c14"
    texts = [f"first {key} then password={other}x tail", "a" * 30 + " " + "9" * 20, None, "", f"{key}"]
    more = [f"see AKIA{base64.b32encode(bytes([i, 7 * i % 251] * 5)).decode()} or password={hashlib.md5(bytes([i])).hexdigest()[:18]} but {'abcdefgh'[i % 8] * (16 + i)} {10**17 + i}" for i in range(60)]
    docs = frame(spark, texts + more)
    found = secrets.candidates(docs, "doc_id", "text", "source").where("_id = 0").orderBy("_nth").collect()
    assert [(r._value, r._before.strip(), r._after[:5]) for r in found] == [(key, "first", " then"), (f"{other}x", "then password=", " tail")]
    scanned = secrets.scan_secrets(docs)
    rows = scanned.collect()
    assert len(rows) == 5 + 4 * 60
    assert all(r._secret == (r._value.startswith("AKIA") or r._before.endswith("password=")) for r in rows)
    clean = {r.doc_id: r.text for r in secrets.redact(docs, scanned).collect()}
    assert clean[0] == "first [SECRET] then password=[SECRET] tail" and clean[1] == texts[1] and clean[2] is None
    assert secrets.scan_secrets(frame(spark, [])).count() == 0
    only = secrets.scan_secrets(docs, findings=spark.createDataFrame([(key, 1)], "_value string, _label int")).collect()
    assert {r._score for r in only} == {0.75}  # one value, of one label


def test_short_and_punctuated_secrets_are_candidates(spark):
    texts = ["password=Tr0ub4dor&3x!", "see https://user:pa55w0rd@host/x now", 'api_key = "abc123def456"', '{"token": "s3cr3t.v4lue"}', "PWD:\t'hunter2hunter2'", "password=short7", "time: 12:30:45 and key = 12345678", "passwords are long words", "a:b@c and mail bob@example.org"]
    found = secrets.candidates(frame(spark, texts), "doc_id", "text", "source").collect()
    got = {r._id: r._value for r in found}
    assert got == {0: "Tr0ub4dor&3x!", 1: "pa55w0rd", 2: "abc123def456", 3: "s3cr3t.v4lue", 4: "hunter2hunter2"}
    labels = {r._value: r._label for r in secrets.weak_labels(spark.createDataFrame(found)).collect()}
    assert labels == dict.fromkeys(got.values(), 1)


def test_false_positives_go_by_labelled_findings(spark):
    """The forest learns from findings that revision hashes are none; on values it has not seen few remain."""
    code = lambda kind, i: hashlib.sha1(f"{kind}{i}".encode()).hexdigest()[: 24 + i % 17]
    rows = [(f"commit {code('c', i)} merged" if i % 2 else f'key = "{code("k", i)}"') + " by them" for i in range(400)]
    docs = frame(spark, rows)
    findings = spark.createDataFrame([(code("c", i), 0) if i % 2 else (code("k", i), 1) for i in range(200)], "_value string, _label int")
    scanned = {r._id: r._secret for r in secrets.scan_secrets(docs, findings).collect()}
    unseen = range(200, 400)
    assert sum(scanned[i] for i in unseen if i % 2) <= 2, "false positives"
    assert sum(scanned[i] for i in unseen if i % 2 == 0) >= 98
