"""Queries against their SQL, on whole small tables."""

from __future__ import annotations

import duckdb
import pytest

from prodlake.llm import oracle
from prodlake.llm.registry import oracle_sql, queries

SF = "/root/testdata/sf0.001"
# proximity matches aren't in the SQL
CASES = {**oracle_sql(), "op9_decontamination": oracle.DECONTAMINATION}


@pytest.mark.parametrize("name", sorted(CASES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    with duckdb.connect() as c:
        for table in ("documents", "benchmark", "embeddings"):
            c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        found = c.execute(CASES[name])
        columns = [x[0] for x in found.description]
        want = sorted(map(str, found.fetchall()))
    got = queries()[name](spark, SF)
    if name in oracle_sql():
        assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == want and want
