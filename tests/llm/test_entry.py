"""Registered corpus queries: names, SQL, and one run of each on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_every_number_is_registered():
    numbers = [int(m[1]) for n in E.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.skipif(not os.path.exists(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = E.queries()[name](spark, SF)
    columns = sorted(found.columns)
    rows = con.execute(f"SELECT {', '.join(columns)} FROM ({E.oracle_sql()[name].strip().rstrip(';')})").fetchall()
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(rows)
