"""Every registered query against its SQL, on the smallest tables."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return connection


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def own(names):
    """Without the corpus queries, which have tests of their own."""
    return sorted(n for n in names if not re.match(r"op\d+_|pipeline$", n))


def test_every_query_has_its_sql():
    assert own(registry.queries()) == own(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).first().raw_status == "FAIL"


@pytest.mark.parametrize("name", own(registry.queries()))
def test_query(spark, db, sf, name):
    df = registry.queries()[name](spark, sf)
    cursor = db.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert multiset(df.columns, df.collect()) == multiset(names, cursor.fetchall())
