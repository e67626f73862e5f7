"""The package's queries against their SQL, on the smallest tables."""

import duckdb
import pytest

from casefile.llm.queries import ORACLES, QUERIES
from check_oracles import TABLES, canon


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    df = QUERIES[key](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[key])
    want = cur.fetchall()
    assert canon(df.columns, rows) == canon([d[0] for d in cur.description], want)
