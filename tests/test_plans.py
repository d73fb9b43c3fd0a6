"""What Spark does with the operators: no Python, no forced broadcasts, splits and pruning."""

import re

import pytest
from pyspark.sql import functions as F
from rows import config, linked, rows_of, sales, table, visit, visits

from placelytics import schemas
from placelytics.operators import buyers, dimensions, movement, poslink, profiles, repeat
from placelytics.operators import visits as ops
from placelytics.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = []

    def set_all(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.append((name, spark.conf.get(name, None)))
            spark.conf.set(name, value)

    yield set_all
    for name, before in reversed(changed):
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_no_cross_join_no_single_task_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert node not in text, node


def test_visits_are_not_shuffled_by_place(spark, conf):
    """A place may hold a third of all visits, so no exchange of visits hashes on place alone."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    # A list that Spark knows no size of, as reports build theirs.
    places = spark.createDataFrame([("T", "A", 0, "2024-01-01")], "user_id string, place_id string, competitor_id int, start_date string")
    seen = visits(spark, visit(), visit("B"))
    sold = sales(spark, {"datetime": "2024-01-10T12:00:00"})
    for found in (
        ops.device_days(seen, places),
        ops.device_days(seen, places, require_config=True),
        ops.tenant_device_days(seen, places),
        ops.place_device_days(seen, places),
        ops.device_periods(seen, places, "week"),
        poslink.link_sales(ops.listed(seen, places, "place_id"), sold),
    ):
        for line in plan(found).splitlines():
            keys = re.search(r"Exchange hashpartitioning\(([^)]*)\)", line)
            columns = {k.split("#")[0].strip() for k in keys.group(1).split(",")[:-1]} if keys else set()
            if columns and columns <= {"user_id", "place_id", "competitor_id"}:
                # Only the list itself is ever grouped by its keys.
                below = plan(found).split(line, 1)[1].splitlines()
                assert "adid" not in "".join(below[:4]), line


def test_lists_are_broadcast_only_up_to_their_bound(spark, conf, monkeypatch):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    seen, places = visits(spark, visit(), visit("B")), config(spark, ("A", 0))
    small = ops.tenant_device_days(seen, places)
    assert "SortMergeJoin" not in plan(small)
    monkeypatch.setattr(ops, "LISTED_KEYS", 0)
    large = ops.tenant_device_days(seen, places)
    assert "Broadcast" not in plan(large) and "SortMergeJoin" in plan(large)
    assert rows_of(small) == rows_of(large)


def test_days_of_the_run_reach_the_device_tables(spark, tmp_path, conf):
    conf(maxMetadataStringLength="2000")
    days = ops.device_days(visits(spark, visit()), config(spark, ("A", 0)))
    schemas_of = {"home_work": schemas.HOME_WORK, "cohorts": schemas.COHORTS, "spots": schemas.DEVICE_SPOTS}
    paths = {}
    for name, schema in schemas_of.items():
        paths[name] = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(paths[name])
    read = {name: spark.read.schema(schema).parquet(paths[name]) for name, schema in schemas_of.items()}
    span = {"start": "2024-01-05", "end": "2024-01-20"}
    topics = spark.createDataFrame([], schemas.TOPICS)
    tenant = ops.tenant_device_days(visits(spark, visit()), config(spark, ("A", 0)))
    catalog, allowed = (spark.createDataFrame([], s) for s in (schemas.SPOT_CATALOG, schemas.CATEGORIES))
    plans = [
        plan(profiles.profile_location(days, read["home_work"], **span)),
        plan(profiles.profile_cohort(days, read["cohorts"], topics, **span)),
        plan(movement.covisited_spots(tenant, read["spots"], catalog, allowed, **span)),
        plan(movement.covisited_spots(tenant, read["spots"], catalog, allowed, grain="day", **span)),
    ]
    # A single month makes the bound on the first day superfluous.
    assert all(re.search(r"PushedFilters: .*LessThanOrEqual\(start_date,2024-01-20\)", text) for text in plans[:3])
    for text in plans:
        assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(end_date,2024-01-05\)", text)
    assert re.search(r"PushedFilters: .*(In|EqualTo)\(start_date, ?\[?2024-01-01\]?\)", plans[3])


def _hot(spark, n):
    """Visits of many devices in one slot of one place, plus a few elsewhere."""
    hot = spark.range(0, n, 1, 16).select(
        F.lit("T").alias("user_id"),
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("P"), F.col("id").cast("string"))).otherwise("A").alias("place_id"),
        F.lit(0).alias("competitor_id"),
        F.concat(F.lit("device-"), F.col("id").cast("string")).alias("adid"),
        F.lit("2024-01-10").alias("date"),
        F.timestamp_seconds(F.lit(1704888000) + F.col("id") % 20).alias("datetime"),
    )
    return hot


SPLITTING = {
    "autoBroadcastJoinThreshold": "-1",
    "adaptive__autoBroadcastJoinThreshold": "-1",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "adaptive__skewJoin__skewedPartitionFactor": "2",
    "adaptive__advisoryPartitionSizeInBytes": "20KB",
    "adaptive__coalescePartitions__minPartitionSize": "10KB",
}


def test_hot_slot_of_the_link_is_split(spark, conf):
    conf(**SPLITTING)
    seen = _hot(spark, 40_000)
    sold = sales(spark, {"datetime": "2024-01-10T12:00:50"}, {"datetime": "2024-01-10T11:59:30", "item_name": "cake"})
    found = poslink.link_sales(seen, sold)
    assert found.count() == 2 * 40_000 * 49 // 50
    found.collect()
    assert "skew=true" in plan(found)


def test_hot_device_of_a_device_table_is_split(spark, conf):
    conf(**SPLITTING)
    # One device id with most of the rows of the device table, all of them different.
    areas = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("junk").alias("adid"),
        F.lit("home").alias("time_category"),
        F.lit("X").alias("prefecture"),
        F.col("id").cast("string").alias("city"),
        F.lit("b").alias("block"),
        F.lit("2024-01-01").alias("start_date"),
        F.lit("2024-01-31").alias("end_date"),
    )
    days = ops.device_days(visits(spark, visit(adid="junk"), visit(adid="10")), config(spark, ("A", 0)))
    found = profiles.profile_location(days, areas, prefectures=["X"], min_count=None)
    assert len(found.collect()) == 36_001
    assert "skew=true" in plan(found)


def test_hot_device_ahead_of_a_second_join_is_split_on_request(spark, conf):
    conf(**SPLITTING, adaptive__forceOptimizeSkewedJoin="true")
    interests = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("junk").alias("adid"),
        F.lit("hobby").alias("visit_category"),
        F.array(F.col("id").cast("string")).alias("cohortlist"),
        F.lit("2024-01-01").alias("start_date"),
        F.lit("2024-01-31").alias("end_date"),
    )
    models = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 4 == 1, "junk").otherwise(F.col("id").cast("string")).alias("adid"),
        (F.col("id") % 2).cast("int").alias("topic_id"),
        F.lit("10").alias("topic_number"),
        F.lit("preference").alias("pattern"),
        F.lit("2025-01-01").alias("ver"),
    )
    days = ops.device_days(visits(spark, visit(adid="junk"), visit(adid="10")), config(spark, ("A", 0)))
    found = profiles.profile_cohort(days, interests, models, category="hobby", min_count=None)
    rows = found.collect()
    # 36,000 cohorts of the hot id with its one topic, held in 10,000 copies, and one of device 10.
    assert len(rows) == 36_001
    assert sorted({r["count"] for r in rows}) == [1, 10_000]
    assert "skew=true" in plan(found)


def test_copies_are_merged_before_they_meet_the_visits(spark):
    copies = spark.range(0, 50_000, 1, 8).select(F.lit("d1").alias("adid"), F.lit("x").alias("city"))
    merged = dimensions.collapse(copies, "adid", "city")
    assert rows_of(merged) == [("d1", "x", 50_000)]


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_overlap_reads_the_visits_once(spark, conf, limit):
    conf(autoBroadcastJoinThreshold=limit, adaptive__autoBroadcastJoinThreshold=limit)
    df = QUERIES["overlap_weekly"](spark, SF)
    df.collect()
    text = plan(df).split("Initial Plan")[0]
    # The visits and the configuration made from them; the totals reuse the pairs' shuffle.
    assert text.count("FileScan") == 2
    assert "ReusedExchange" in text


def test_link_reads_each_input_once_in_the_competitor_report(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES["linked_overlap"](spark, SF))
    # Visits, sales, contacts, the shops under both the sales and the thresholds, and the places of the
    # thresholds once more: they limit the contacts that are read.
    assert text.count("FileScan") == 6


def test_partition_folders_are_pruned(spark, tmp_path, conf):
    conf(maxMetadataStringLength="2000")
    seen = visits(spark, *[visit(p, adid=f"d{i}", when=f"2024-01-{d}T10:00:00") for p in "ABCD" for i in range(3) for d in (10, 11)])
    path = str(tmp_path / "visits")
    copies = seen.withColumn("usr", F.col("user_id")).withColumn("place", F.col("place_id"))
    copies.write.partitionBy("usr", "place", "date").parquet(path)
    table = spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))
    listed = str(tmp_path / "config")
    config(spark, ("A", 0)).write.parquet(listed)
    monitored = spark.read.parquet(listed)
    for days in (
        ops.device_days(table, monitored),
        ops.device_days(table, monitored, require_config=True),
        ops.tenant_device_days(table, monitored),
        ops.place_device_days(table, monitored),
        ops.device_periods(table, monitored, "day"),
    ):
        scan = re.search(r"PartitionFilters: \[([^\]]*)", plan(days)).group(1)
        assert "dynamicpruning" in scan
        assert {r[0] for r in rows_of(days, "place_id")} == {"A"}
    one_day = plan(ops.device_days(spark.read.schema(table.schema).parquet(path), monitored, days=["2024-01-10"]))
    assert "2024-01-10" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", one_day).group(1)


def test_columns_are_pruned_at_the_scan(spark):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["profile_location"](spark, SF)))
    customer = next(s for s in scans if "c_custkey" in s)
    assert customer == "c_custkey:bigint,c_nationkey:int,c_mktsegment:string"


def test_rolling_visits_need_one_window(spark):
    days = ops.place_device_days(visits(spark, visit()), config(spark, ("A", 0)))
    assert plan(repeat.rolling_visits(days)).count("Window [") == 1


def test_competitor_contacts_are_read_at_the_reported_places_alone(spark, tmp_path):
    path = str(tmp_path / "visits")
    seen = visits(spark, *[visit(p, rival=1, adid="d1") for p in "ABCD"])
    seen.withColumn("place", F.col("place_id")).write.partitionBy("place").parquet(path)
    limits = str(tmp_path / "limits")
    table(spark, schemas.MIN_COUNTS, {"caption": "shop", "place_id": "A", "infimum": 1}).write.parquet(limits)
    found = buyers.linked_overlap(linked(spark, {}), spark.read.parquet(path), spark.read.parquet(limits))
    assert "dynamicpruning" in plan(found)
    assert rows_of(found, "place_id", "count") == [("A", 1)]
