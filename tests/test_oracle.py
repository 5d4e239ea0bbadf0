"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, canon, norm_type  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_registered_with_a_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 45


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toArrow()
    if name not in SQL:
        assert got.num_rows > 0
        return
    want = con.sql(SQL[name]).to_arrow_table()
    assert {f.name: norm_type(f.type) for f in got.schema} == \
        {f.name: norm_type(f.type) for f in want.schema}
    assert got.num_rows == want.num_rows
    assert canon(got.to_pandas()) == canon(want.to_pandas())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == [
        "league_id", "season", "total_matches", "total_goals", "avg_goals_per_match"]
