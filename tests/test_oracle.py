"""Every query against DuckDB, row by row, at two scale factors."""

import duckdb
import pytest

import __spark_entry__ as contract
from placelytics import oracles
from placelytics.plans.queries import QUERIES

RAW = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]

# Rows per query at sf0.01, from the fixture design.
ROWS = {
    "unique_devices_daily": 280,
    "unique_devices_weekly": 50,
    "unique_devices_monthly": 10,
    "overlap_daily": 2274,
    "overlap_weekly": 450,
    "overlap_monthly": 90,
    "overlap_weekly_range": 180,
    "unique_devices_weekly_halves": 50,
    "overlap_monthly_halves": 90,
    "device_days": 3543,
    "device_days_all": 7350,
    "profile_location": 306,
    "profile_location_unsuppressed": 3038,
    "profile_location_slotted": 3038,
    "profile_topic": 360,
    "profile_cohort": 53,
    "profile_cohort_min2": 2323,
    "profile_cohort_split": 2323,
    "covisited_monthly": 276,
    "covisited_monthly_slotted": 276,
    "covisited_daily": 8245,
    "topic_versions": 2,
    "pos_sales": 1841,
    "link_sales_1m": 80,
    "link_sales_10m": 873,
    "link_sales_30m": 2443,
    "link_pairs_3m": 279,
    "linked_devices": 120,
    "linked_visitors": 539,
    "linked_age_gender": 142,
    "linked_age_gender_months": 142,
    "linked_age_gender_fixed": 271,
    "linked_location": 44,
    "linked_topic": 726,
    "linked_overlap": 61,
    "visit_gap": 7350,
    "rolling_visits": 7350,
    "rolling_visits_cap5": 6823,
    "repeat_by_item": 1772,
    "repeat_by_item_own": 1572,
}

# Spark type names and their DuckDB counterparts.
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT"}


@pytest.fixture(scope="module")
def oracle():
    def run(sf, sql):
        with duckdb.connect() as con:
            for name in RAW:
                con.sql(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/{sf}/{name}.parquet'")
            result = con.sql(sql)
            columns = dict(zip(result.columns, map(str, result.types)))
            order = sorted(columns)
            rows = result.project(", ".join(f'"{c}"' for c in order)).fetchall()
        return columns, sorted(rows, key=repr)

    return run


def test_every_query_has_an_oracle_and_an_expected_count():
    assert set(QUERIES) == set(oracles.oracle_sql()) == set(ROWS)
    assert set(ROWS) <= set(contract.queries())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", ROWS)
def test_matches_duckdb(spark, oracle, name, sf):
    df = contract.queries()[name](spark, f"/root/testdata/{sf}")
    columns, expected = oracle(sf, contract.oracle_sql()[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    found = sorted((tuple(r) for r in df.select(*sorted(columns)).collect()), key=repr)
    assert found == expected
    if sf == "sf0.01":
        assert len(found) == ROWS[name]


def test_entry_is_the_daily_overlap(spark):
    df = contract.entry(spark)
    assert df.columns == contract.queries()["overlap_daily"](spark, "/root/testdata/sf0.001").columns
    assert df.count() == 550


@pytest.mark.parametrize("name", ["overlap_monthly", "overlap_weekly", "link_sales_10m", "pos_sales", "visit_gap"])
def test_the_session_zone_does_not_matter(spark, oracle, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = contract.queries()[name](spark, "/root/testdata/sf0.001")
        found = sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == oracle("sf0.001", contract.oracle_sql()[name])[1]
