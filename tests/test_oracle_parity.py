"""Oracle tier: every registered query equals its DuckDB SQL on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from contrail.registry import REGISTRY
from tools.check_oracle import TABLES, digest

from .conftest import SF001

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns  # rows-only check
        return
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["delays_id", "most_frequent_delay", "average_delay", "minimal_delay", "maximal_delay",
                          "year", "month"]
