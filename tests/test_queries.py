"""Every registered survey query against its SQL in DuckDB."""

import math
import os

import duckdb
import pandas as pd
import pytest

from transect.plans import catalog


def plain(df: pd.DataFrame) -> list[str]:
    def value(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        return str(v) if isinstance(v, pd.Timestamp) else v.item() if hasattr(v, "item") else v

    df = df[sorted(df.columns)].astype(object)
    return sorted(repr(tuple(value(v) for v in row)) for row in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for name in os.listdir(sf_small):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_small}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf_small, duck, name):
    got = catalog.queries()[name](spark, sf_small).toPandas()
    if name in catalog.oracle_sql():
        want = duck.execute(catalog.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
