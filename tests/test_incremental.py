"""Late files and state kept up day by day give what a full run gives."""

import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import config, rows_of, visit, visits

from placelytics.operators import bitmaps, overlap
from placelytics.operators import visits as ops
from placelytics.plans import jobs
from placelytics.sources import arrivals

END = "2024-02-29"
PLACES = [("A", 0), ("A", 1), ("B", 0), ("C", 0)]


@pytest.fixture(autouse=True)
def shared_folder(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))


def day(date, *devices, places="AB"):
    return [visit(p, 0, d, f"{date}T12:00:00") for d in devices for p in places]


BEFORE = [*day("2024-01-06", "d1", "d2"), *day("2024-01-10", "d1"), *day("2024-01-31", "d3", places="ABC"), *day("2024-02-14", "d1", "d4")]
LATE = [*day("2024-01-10", "d2", "d5", places="AC"), visit("A", 1, "d1", "2024-01-10T09:00:00"), visit("B", 0, None, "2024-01-10T09:00:00")]


def land(spark, path, rows, age):
    """One more file of the visit table, written ``age`` seconds ago."""
    before = set(Path(path).glob("*.parquet"))
    visits(spark, *rows).coalesce(1).write.mode("append").parquet(path)
    for f in set(Path(path).glob("*.parquet")) - before:
        os.utime(f, (time.time() - age,) * 2)


def table(spark, path):
    return spark.read.schema(visits(spark, visit()).schema).parquet(path)


def published(spark, folder):
    return {str(f.relative_to(folder)): (rows_of(spark.read.parquet(str(f))), f.stat().st_mtime_ns) for f in sorted(Path(folder).rglob("*=*")) if list(f.glob("*.parquet"))}


def test_a_late_file_recomputes_its_periods_alone(spark, tmp_path):
    path, out, whole = (str(tmp_path / x) for x in ("visits", "out", "whole"))
    land(spark, path, BEFORE, 3000)
    places = config(spark, *PLACES)
    assert jobs.refresh_overlap_reports(table(spark, path), places, out, f"{out}-state", end=END)
    before = published(spark, out)
    assert jobs.refresh_overlap_reports(table(spark, path), places, out, f"{out}-state", end=END) == []
    land(spark, path, LATE, 1000)
    assert arrivals.touched_days(table(spark, path), None, arrivals.latest_arrival(table(spark, path)))[0] == "2024-01-06"
    jobs.refresh_overlap_reports(table(spark, path), places, out, f"{out}-state", end=END)
    after = published(spark, out)
    jobs.overlap_reports(table(spark, path), places, whole, end=END)
    full = published(spark, whole)
    assert {k: v[0] for k, v in after.items()} == {k: v[0] for k, v in full.items()}
    renewed = {k for k in after if after[k] != before.get(k)}
    touched = ("date=2024-01-10", "week_of_monday=2024-01-08", "year_month=2024-01")
    assert renewed and all(k.endswith(touched) for k in renewed)
    assert any(k.endswith("date=2024-02-14") for k in after)


def test_files_that_arrived_before_are_not_read(spark, tmp_path):
    path = str(tmp_path / "visits")
    land(spark, path, BEFORE, 3000)
    mark = arrivals.latest_arrival(table(spark, path))
    land(spark, path, LATE, 1000)
    last = arrivals.latest_arrival(table(spark, path))
    assert arrivals.touched_days(table(spark, path), mark, last) == ["2024-01-10"]
    fresh = table(spark, path).where(F.col(arrivals.ARRIVED) > mark).select("date")
    assert len(fresh.inputFiles()) == 2 and fresh.rdd.getNumPartitions() == 1


def test_a_failed_report_is_made_up_for(spark, tmp_path):
    path, state = str(tmp_path / "visits"), str(tmp_path / "state")
    land(spark, path, BEFORE, 3000)

    def fail(days):
        raise OSError("disk")

    with pytest.raises(OSError, match="disk"):
        jobs.refresh(table(spark, path), state, fail)
    seen = []
    jobs.refresh(table(spark, path), state, lambda days: seen.append(days) or ["x"])
    assert seen == [["2024-01-06", "2024-01-10", "2024-01-31", "2024-02-14"]]
    assert jobs.refresh(table(spark, path), state, fail) == []


def test_an_empty_table_has_no_arrivals(spark, tmp_path):
    path = str(tmp_path / "visits")
    visits(spark).write.parquet(path)
    assert jobs.refresh(table(spark, path), str(tmp_path / "state"), lambda days: ["x"]) == []


@pytest.mark.parametrize("period", ["day", "week", "month"])
def test_state_of_single_days_equals_the_full_run(spark, tmp_path, period):
    rows, places, state = [*BEFORE, *LATE, visit("Z", 0, "d1")], config(spark, *PLACES), str(tmp_path / "state")
    seen = visits(spark, *rows)
    dates = sorted({r["date"] for r in rows})
    for days in (dates[2:], dates[:1], dates[:2], dates[1:2]):
        jobs.update_overlap_state(seen, places, state, days=days, periods=[period])
    kept = jobs.overlap_state(spark, state, period)
    whole = ops.monitored_visits(seen, places, period)
    expected = overlap.overlap(whole, period)
    assert rows_of(bitmaps.overlap(kept, period), *expected.columns) == rows_of(expected)
    expected = ops.unique_devices(whole.dropDuplicates(), period)
    assert rows_of(bitmaps.unique_devices(kept, period), *expected.columns) == rows_of(expected)
    numbers = spark.read.parquet(f"{state}/devices")
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("adid").distinct().count() == 5


def test_adding_a_day_rewrites_its_periods_alone(spark, tmp_path):
    places, state = config(spark, *PLACES), str(tmp_path / "state")
    jobs.update_overlap_state(visits(spark, *BEFORE), places, state, end=END, periods=["month"])
    before = {f: f.stat().st_mtime_ns for f in Path(state).rglob("year_month=*/*.parquet")}
    jobs.update_overlap_state(visits(spark, *LATE), places, state, end=END, periods=["month"])
    after = {f: f.stat().st_mtime_ns for f in Path(state).rglob("year_month=*/*.parquet")}
    assert {f: t for f, t in before.items() if "2024-02" in str(f)}.items() <= after.items()


def test_devices_of_many_buckets(spark, tmp_path):
    """More devices than one bitmap holds, numbered in two runs."""
    place = F.when(F.col("id") % 3 == 0, "A").otherwise("B")
    wide = spark.range(0, 80_000, 1, 4).select(
        place.alias("place_id"), F.lit(0).alias("competitor_id"), F.concat(F.lit("d"), F.col("id") % 50_000).alias("adid"), F.lit("2024-01-10").alias("date")
    )
    first = bitmaps.new_devices(wide.where("adid < 'd3'"), None)
    first.write.parquet(str(tmp_path / "first"))
    known = spark.read.parquet(str(tmp_path / "first"))
    start = known.agg(F.max("number")).first()[0] + 1
    bitmaps.new_devices(wide, known, start).write.parquet(str(tmp_path / "second"))
    devices = known.unionByName(spark.read.parquet(str(tmp_path / "second")))
    assert devices.select("number").distinct().count() == devices.count() == 50_000
    kept = bitmaps.device_bitmaps(wide.withColumn("year_month", F.lit("2024-01")), devices, "day")
    assert rows_of(bitmaps.unique_devices(kept, "day"), "place_id", "own_count") == rows_of(
        wide.distinct().groupBy("place_id").agg(F.count_distinct("adid").alias("own_count"))
    )
    expected = overlap.overlap(wide, "day")
    assert rows_of(bitmaps.overlap(kept, "day"), *expected.columns) == rows_of(expected)
