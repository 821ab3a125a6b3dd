"""Every query against its SQL in DuckDB, over the smallest tables."""

import duckdb
import pandas as pd
import pytest

from noticelake.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def normal(df):
    df = df[sorted(df.columns)]
    return sorted(tuple("" if pd.isna(v) else str(v) for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name not in catalogue.ORACLES:
        assert len(got)
        return
    want = con.execute(catalogue.ORACLES[name]).df()
    assert len(want)
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


def test_filters_reach_the_scan(spark):
    plan = catalogue.QUERIES["level_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp,event_type:string>" in plan.replace("timestamp_ntz", "timestamp")
