"""The pipeline against plain Python and SQL on a small table."""

import duckdb

import corpus_pipeline
from almenara.llm.oracle import ORACLE
from tests.llm.cases import frame, near_components, shingles

SMALL = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE['op6_quality_rules']}) WHERE kept").fetchall()}
    docs = {i: t for i, t in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if i in good}
    key = lambda line: line.encode().strip(b" \t\n\r\x0b\x0c").lower().decode()
    first: dict = {}
    for i, t in docs.items():
        for line in t.split("\n"):
            first.setdefault(key(line), i)
    docs = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == i) for i, t in docs.items()}
    ids, texts = list(docs), list(docs.values())
    docs = {ids[i]: texts[i] for i, root in enumerate(near_components(texts, 5)) if root == i}
    items = [shingles(t, 3) for (t,) in con.execute(f"SELECT text FROM read_parquet('{SMALL}/benchmark.parquet')").fetchall()]
    docs = {i: t for i, t in docs.items() if not any(len(g & shingles(t, 3)) >= 0.5 * len(g) for g in items)}
    con.execute("CREATE TABLE kept (doc_id BIGINT, new VARCHAR)")
    con.executemany("INSERT INTO kept VALUES (?, ?)", list(docs.items()))
    con.execute("CREATE TABLE d2 AS SELECT d.* REPLACE (k.new AS text) FROM documents d JOIN kept k USING (doc_id)")
    con.execute("DROP TABLE documents")
    con.execute("ALTER TABLE d2 RENAME TO documents")
    want = con.execute(f"SELECT doc_id, size, taken FROM ({ORACLE['op10_mix_sources']}) ORDER BY doc_id").fetchall()
    got = sorted((r.doc_id, r.size, r.taken) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == want and len(got) > 100


def test_stages_keep_the_columns(spark):
    docs = frame(spark, ["some words that are good enough to be kept by all of these rules", None, ""])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert [r.doc_id for r in out.collect() if r.text] == [0]
