"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest

from mailtrail import feeds
from mailtrail.oracles import ORACLES
from mailtrail.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for name in feeds.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, views, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    wanted = views.sql(f"SELECT {quoted} FROM ({ORACLES[name]}) AS q").fetchall()
    assert in_order(frame.select(*columns).collect()) == in_order(wanted)
