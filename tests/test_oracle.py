"""Every registered query against its DuckDB formulation (or a run when it has none)."""
import pytest

import __spark_entry__ as E
from cellwatch import queries as Q
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(Q.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF, name, con)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["hour_bucket", "bloqs_id"] and df.columns[-1] == "rents"
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["fleet_extract", "battery_sessions", "days_left"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    """Hour buckets, day boundaries and day counts are wall-clock (TIMESTAMP_NTZ) based."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        ok, msg = compare(spark, SF, name, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, msg
