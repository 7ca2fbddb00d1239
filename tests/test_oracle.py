"""Every catalog query against its SQL form on the same tables."""

import datetime as dt

import duckdb
import pytest

from almenara.plans.catalog import QUERIES
from almenara.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def _plain(value):
    """A sortable form that keeps type differences visible."""
    if isinstance(value, float):
        value = float(f"{value:.12g}")
    kind = "date" if type(value) is dt.date else type(value).__name__
    return (kind, str(value))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLE[name])
    want_names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(want_names)
    want_rows = comparable(want.fetchall(), want_names)
    got_rows = comparable([tuple(r) for r in got.collect()], got.columns)
    assert len(got_rows) == len(want_rows)
    assert got_rows == want_rows
