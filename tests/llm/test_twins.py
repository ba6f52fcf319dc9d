"""SQL twins of the corpus queries at the smallest scale."""

import os

import duckdb
import pytest

from finecast.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    cols = sorted(names)
    assert cols == sorted(df.columns)
    want = sorted(tuple(str(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect()) == want
