"""Registered queries against their SQL on DuckDB.

By default a cross-section runs at the smallest size; ``ORACLE_ALL=1`` runs every query and
``ORACLE_SF`` picks the size.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from resalelake.plans import registry  # noqa: E402

SF = os.environ.get("ORACLE_SF", "0.001")
FOLDER = f"/root/testdata/sf{SF}"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: The training-data operators have their own tests.
KEYS = list(registry.queries())
PICKED = KEYS if os.environ.get("ORACLE_ALL") else [k for k in KEYS if k.startswith("fact_")] + KEYS[9::12]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(oracle_sql()) >= set(KEYS)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("key", PICKED)
def test_query_matches_sql(spark, duck, key):
    df = queries()[key](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(oracle_sql()[key])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    want = sorted(tuple(repr(row[i]) for i in place) for row in result.fetchall())
    got = sorted(tuple(repr(row[c]) for c in columns) for row in df.collect())
    assert got == want
