"""Workers without the package, clashing column names, long texts in pieces, benchmark in blocks, paraphrases."""

import os
import random
import subprocess
import sys
import tempfile

import numpy as np
from pyspark.sql import functions as F

from almenara.llm import decontaminate, line_dedup, near_dup, quality_rules, toxicity
from tests.llm.cases import frame, odd_texts, random_texts

CLASHING = ["_id", "_key", "_bytes", "_quality", "_score", "_leak", "_row_key", "_keep", "_KEPT", "_drop", "_key_r", "_id_r", "_offending", "_n_lines", "line", "node"]


def clashing(spark, texts):
    return frame(spark, texts).select("doc_id", "text", *(F.lit(f"own {c}").alias(c) for c in CLASHING))


def test_own_columns_pass_through_whatever_their_names(spark):
    texts = random_texts(2, 30) + odd_texts()
    docs = clashing(spark, texts)
    items = spark.createDataFrame([(1, "some words that no text has at all")], "item_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, toxic int")
    results = {
        "lines": (line_dedup.line_dedup(docs), {"_n_lines", "_n_dropped", "_kept_sha256"}),
        "near": (near_dup.drop_near_duplicates(docs), set()),
        "rules": (quality_rules.quality_rules(docs), {"_quality", "_base_failed", "_kept"}),
        "toxic": (toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)), {"_score", "_offending"}),
        "leaks": (decontaminate.decontaminate(docs, items), set()),
    }
    for name, (df, own) in results.items():
        kept = [c for c in CLASHING if c.lower() not in own]
        rows = df.select(*(F.col(f"`{c}`") for c in kept)).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"own {c}" for c in kept)], name


def test_queries_run_where_workers_have_no_package():
    """Workers get a working folder and no path to the package, so all they have is what the driver sends."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import os, sys
sys.path.insert(0, {root!r})
from almenara.session import get_session
spark = get_session("t", "local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false", spark__executorEnv__PYTHONPATH="")
from almenara.llm.queries import QUERIES
from pyspark.sql import functions as F
def blind(batches):
    try:
        import almenara
        raise AssertionError("the package is there")
    except ModuleNotFoundError:
        yield from batches
spark.range(1).mapInArrow(blind, "id bigint").collect()
for name in ("op4_decontaminate", "op8_toxicity", "op11_source_divergence", "op12_periodic_runs", "op13_lm_score"):
    print(name, len(QUERIES[name](spark, "/root/testdata/sf0.001").toArrow()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=600, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("op") >= 5


def test_long_texts_are_scored_by_whole_sentences(spark, monkeypatch):
    rnd = random.Random(3)
    vocab = ["calm", "river", "vile", "rotten", "stone", "fool", "garden"]
    long = "".join(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 9))) + rnd.choice([". ", "!", "?\n", "\n", "... "]) for _ in range(300))
    texts = ["you rotten vile fool. "] * 20 + ["a calm river garden. "] * 20 + [long, long + " no end at all", "word " * 400]
    docs = frame(spark, texts)
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([(i, int(i < 20)) for i in range(40)], "doc_id bigint, toxic int"))
    whole = {r.doc_id: (r._score, r._offending) for r in toxicity.score_toxicity(docs, model).collect()}
    monkeypatch.setattr(toxicity, "PIECE", 100)
    pieces = {r.doc_id: (r._score, r._offending) for r in toxicity.score_toxicity(docs, model).collect()}
    for i, (score, spans) in whole.items():
        assert abs(pieces[i][0] - score) < 1e-9 and [tuple(s)[:2] for s in pieces[i][1]] == [tuple(s)[:2] for s in spans]
    raw = np.frombuffer(long.encode(), np.uint8)
    cuts = list(toxicity.sentence_pieces(raw, 100))
    assert [a for a, _ in cuts] == [0, *(b for _, b in cuts[:-1])] and cuts[-1][1] == len(raw)
    assert all(chr(raw[b - 1]) in ".!?\n" for _, b in cuts[:-1])


def test_the_learning_sample_is_bounded(spark):
    docs = frame(spark, ["bad word here"] * 50 + ["good word there"] * 50, ids=[1] * 50 + [2] * 50)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    assert toxicity.fit_toxicity(docs, labels).constant is None
    assert toxicity.fit_toxicity(docs, labels, total_bytes=5).constant == 0.5


def prose(rnd, vocab, n):
    return [rnd.choice(vocab) for _ in range(n)]


def test_blocks_of_items_find_the_same_pairs(spark):
    rnd = random.Random(11)
    vocab = [f"word{i}" for i in range(300)]
    items = [prose(rnd, vocab, n) for n in (6, 20, 31, 40, 64, 90)]
    texts = [" ".join(prose(rnd, vocab, 50) + items[i % 6] + prose(rnd, vocab, 20)) for i in range(12)] + [" ".join(prose(rnd, vocab, 150)) for _ in range(40)]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id int, text string")
    want = {(i, i % 6) for i in range(12)}
    for block in (1, 4, 100):
        assert {(r._id, r._item) for r in decontaminate.find_leaks(frame(spark, texts), table, block=block).collect()} == want


def test_paraphrases_that_rare_words_rule_out(spark):
    """Items with every three words turned round and some changed: the latent search alone finds them, by their ending."""
    rnd = random.Random(12)
    topics = [[f"t{t}w{i}" for i in range(60)] for t in range(12)]
    texts = [" ".join(prose(rnd, topics[k % 12], 160)) for k in range(240)]
    items, want = [], set()
    for t in range(12):
        item = rnd.sample([f"t{t}w{i}" for i in range(60)], 40)
        items.append((t, " ".join(item)))
        turned = [item[3 * (k // 3) + 2 - k % 3] for k in range(33)]  # a third of them stay in order
        changed = ["other" if k % 16 == 5 else w for k, w in enumerate(turned)]
        want.add((len(texts), t))
        texts.append(" ".join(prose(rnd, topics[(t + 1) % 12], 40) + changed + item[33:] + prose(rnd, topics[(t + 1) % 12], 40)))
    table = spark.createDataFrame(items, "item_id int, text string")
    loose = {(r._id, r._item): r for r in decontaminate.find_leaks(frame(spark, texts), table).collect()}
    assert len(want & set(loose)) >= 0.9 * len(want)
    assert all(r._share >= 0.4 and (r._share >= 0.6 or r._cosine >= 0.7) for r in loose.values())
    strict = {(r._id, r._item) for r in decontaminate.find_leaks(frame(spark, texts), table, cosine=2.0).collect()}
    assert strict <= set(loose) and len(want - strict) >= 6
