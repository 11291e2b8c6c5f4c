"""The SQL of the operators over trees gives the rows of their queries."""

import duckdb
import pytest
from cases import DATA

from weirline.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_prefix_trie"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = QUERIES[name](spark, str(DATA))
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(found.columns)
    key = lambda r: tuple(map(str, r))
    rows = sorted((tuple(r) for r in found.select(*names).collect()), key=key)
    assert rows == sorted(want.fetchall(), key=key) and rows
