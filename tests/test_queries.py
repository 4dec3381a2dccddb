"""Every registered query against its SQL in DuckDB, on the smallest test data."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from candlewick.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("events", "lineitem"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name, kind in frame.dtypes.items():
        if pd.api.types.is_datetime64_any_dtype(kind):
            frame[name] = frame[name].astype("datetime64[us]").astype(str)
        elif not pd.api.types.is_numeric_dtype(kind) or pd.api.types.is_bool_dtype(kind):
            frame[name] = frame[name].astype(object).where(frame[name].notna(), None).map(str)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert set(catalog.ORACLE_SQL) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = comparable(contract.queries()[name](spark, SF_DIR).toPandas())
    theirs = comparable(duck.execute(contract.oracle_sql()[name]).df())
    assert len(ours) > 0
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)


def test_absurd_numbers_of_a_busy_day(spark, tmp_path):
    """A candle with so many of the largest amounts that its volume passes 1e21."""
    name, path = "candles_absurd_numbers", f"{tmp_path}/events.parquet"
    spark.range(4000).selectExpr(
        "id AS event_id", "timestamp_ntz'2031-07-09 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "1L AS user_id",
        "if(id < 3000, 'tea', 'oat') AS event_type", "300.0D + id % 40 AS value", "'{\"k\": 7}' AS props",
    ).write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/*.parquet'")
    ours = comparable(contract.queries()[name](spark, str(tmp_path)).toPandas())
    assert sorted(ours["volume"] > 1e21) == [False, True]
    theirs = comparable(duck.execute(contract.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)


def test_entry(spark):
    daily = contract.entry(spark)
    assert daily.count() == 150
