"""Every registered query against its DuckDB text on the smallest tables, or its rows where SQL has no form."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from pointloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(5) + 0.0
        df[c] = df[c].map(lambda x: None if x is None or x is pd.NA or (isinstance(x, float) and np.isnan(x)) else float(x) if isinstance(x, (int, float, np.number)) and not isinstance(x, bool) else x)
    return sorted(map(repr, df.itertuples(index=False, name=None)))


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_against_duckdb(spark, duck, key):
    got = registry.queries()[key](spark, SF).toPandas()
    want = duck.execute(registry.oracle_sql()[key]).df()
    assert set(got.columns) == set(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("key", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows(spark, key):
    assert registry.queries()[key](spark, SF).count() > 0


@pytest.mark.parametrize("key", ["win1_echo_features", "joi4_nearest_pose", "dom9_fusion", "agg8_class_presence"])
def test_partitions_change_nothing(spark, key):
    a = registry.queries()[key](spark, SF).toPandas()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = registry.queries()[key](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows(a) == rows(b)
