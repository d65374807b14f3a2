"""The queries that SQL can express against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from idbridge.llm.oracle import ORACLE_SQL
from idbridge.llm.queries import QUERIES

from ..conftest import SF_CHECK, SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_CHECK], ids=["sf0.001", "sf0.01"])
def test_query_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    cols = sorted(d[0] for d in res.description)
    order = [[d[0] for d in res.description].index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=repr)
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == cols
    assert sorted((tuple(r) for r in df.select(cols).collect()), key=repr) == want


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE_SQL) <= set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
