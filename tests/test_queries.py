"""The driver contract: entry, registry, and twins at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracle import TABLES, cell

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "flagship_history_on_forecast", "w03_rain_sums_wet_days", "w09_block_median_anomaly", "i03_upsert_latest", "p05_clean",
    "j01_daily_master", "j05_expand_entities", "j17_asof_strict", "a21_distribution", "a24_category_errors", "f03_horizon_dataset",
    "m03_year_split", "q09_training_audit_fail", "r02_advisories", "z02_daily_completeness", "s03_read_geojson",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 190


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = contract.queries()[name](spark, SF)
    rel = con.execute(contract.oracle_sql()[name])
    cols = sorted(d[0] for d in rel.description)
    assert cols == sorted(df.columns)
    at = [[d[0] for d in rel.description].index(c) for c in cols]
    want = sorted((tuple(cell(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(cell(v) for v in r) for r in df.select(*cols).collect()), key=repr)
    assert got == want
