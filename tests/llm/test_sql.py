"""Queries that SQL can express, against their SQL."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from pagemill.llm.oracle import ORACLES
from pagemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    relation, df = con.sql(ORACLES[name]), QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(relation.columns)
    want = sorted(tuple(map(str, row)) for row in relation.select(*df.columns).fetchall())
    assert sorted(tuple(map(str, row)) for row in df.collect()) == want


def test_all_are_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {name[: name.index("_") + 1] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
