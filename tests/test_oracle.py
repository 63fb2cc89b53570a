"""Every registered query with an oracle agrees with its DuckDB SQL (sf0.001)."""

import pytest

import __spark_entry__ as entry
from oracle_check import connect, rows_of

SQLS = entry.oracle_sql()
NAMES = sorted(SQLS)


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, duck, name):
    sdf = entry.queries()[name](spark, sf)
    spdf = sdf.toPandas()
    dpdf = duck.execute(SQLS[name]).df()
    assert sorted(sdf.columns) == sorted(dpdf.columns)
    assert rows_of(spdf) == rows_of(dpdf)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["merchant_id", "account_id", "merchant_name"]


@pytest.mark.parametrize("name", ["a114_a116_order_flags", "b17_distance_prev", "b22_mandate_scope", "b65_dashboard"])
def test_results_do_not_depend_on_the_session_time_zone(spark, duck, name):
    """Wall-clock (timestamp_ntz) arithmetic must not go through the session zone: a DST gap in
    America/Los_Angeles once shifted handoff durations by an hour. sf0.01 has such orders."""
    sf01 = "/root/testdata/sf0.01"
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        spdf = entry.queries()[name](spark, sf01).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert rows_of(spdf) == rows_of(connect(sf01).execute(SQLS[name]).df())
