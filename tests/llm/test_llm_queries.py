"""Every query with an SQL form against it, and held-out accuracy of the learned ones."""

import duckdb
import pytest

from almenara.llm.oracle import ORACLE
from almenara.llm.queries import QUERIES
from tests.test_oracle import comparable

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    want = duck.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert comparable([tuple(r) for r in got.collect()], got.columns) == comparable(want.fetchall(), names)


def held_out(spark, sf_dir, name, label):
    rows = QUERIES[name](spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").select("score", "predicted", label).collect()
    return [(r.score, r.predicted, r[label]) for r in rows]


def test_quality_on_held_out_rows(spark, sf_dir):
    rows = held_out(spark, sf_dir, "op2_quality_classifier", "quality")
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for s, p, _ in rows)
    assert sum(p == y for _, p, y in rows) / len(rows) > 0.95


def test_toxicity_on_held_out_rows(spark):
    rows = held_out(spark, "/root/testdata/sf0.1", "op8_toxicity", "toxic")
    assert sum(p == y for _, p, y in rows) / len(rows) > 0.96
    toxic = [p for _, p, y in rows if y]
    assert sum(toxic) / len(toxic) > 0.8


def test_leaks_are_the_items_that_documents_hold(spark, sf_dir):
    """Against the share of an item's 3-word runs in the document."""
    from tests.llm.cases import shingles

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    runs = {i.item_id: shingles(i.text, 3) for i in items}
    holding: dict = {}
    for i, grams in runs.items():
        for g in grams:
            holding.setdefault(g, []).append(i)
    want, clear = set(), set()
    for d in docs:
        hits: dict = {}
        for g in shingles(d.text, 3):
            for i in holding.get(g, ()):
                hits[i] = hits.get(i, 0) + 1
        want |= {(d.doc_id, i) for i, n in hits.items() if n >= 0.9 * len(runs[i])}
        clear |= {(d.doc_id, i) for i in runs if hits.get(i, 0) < 0.2 * len(runs[i])}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op4_decontaminate"](spark, sf_dir).collect()}
    assert len(want) > 10
    assert len(want - got) <= 0.02 * len(want)
    assert not got & clear


def test_every_verbatim_leak_is_found(spark):
    """Upper and lower case and punctuation aside, by the share of an item's 3-word runs."""
    import re

    sf_dir = "/root/testdata/sf0.1"
    runs = lambda t: {tuple(w) for w in zip(*[re.findall(r"\w+", (t or "").lower())[k:] for k in range(3)], strict=False)}
    items = {i.item_id: runs(i.text) for i in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    holding: dict = {}
    for i, grams in items.items():
        for g in grams:
            holding.setdefault(g, []).append(i)
    want = set()
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        hits: dict = {}
        for g in runs(d.text):
            for i in holding.get(g, ()):
                hits[i] = hits.get(i, 0) + 1
        want |= {(d.doc_id, i) for i, n in hits.items() if n >= 0.3 * len(items[i])}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op4_decontaminate"](spark, sf_dir).collect()}
    assert len(want) > 200 and got == want


def test_secrets_of_known_shape(spark, sf_dir):
    from almenara.llm.secrets import scan_secrets

    rows = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    known = [r for r in rows if r._value.startswith("AKIA") or r._before.endswith(("password=", 'token = "'))]
    assert len(known) > 5 and all(r._secret for r in known)
    assert not any(r._secret for r in rows if r._value.isalpha() or r._value.isdigit())
