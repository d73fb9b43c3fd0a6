"""Joins that split their hot keys, with default settings, and what they return."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from rows import config, linked, rows_of, sales, table, visit, visits

from placelytics import schemas
from placelytics.operators import buyers, poslink, profiles, skew
from placelytics.operators import visits as ops


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def numbered(spark, n, share):
    """``n`` rows of which a share of one in ``share`` is cold."""
    return spark.range(0, n, 1, 8).select(
        "id", F.when(F.col("id") % share == 0, F.col("id").cast("string")).otherwise("hot").alias("adid")
    )


def days_of(spark, n):
    """Device-days of one hot device at very many places."""
    place = F.concat(F.lit("P"), F.col("id").cast("string")).alias("place_id")
    return numbered(spark, n, 50).select(place, F.lit(0).alias("competitor_id"), "adid", F.lit("2024-01-10").alias("date"))


TOPIC = {"topic_number": "10", "pattern": "preference", "ver": "2025-01-01"}


def device_tables(spark):
    topics = table(spark, schemas.TOPICS, *[{**TOPIC, "adid": a, "topic_id": t} for a, t in (("hot", 1), ("hot", 2), ("0", 3), ("50", 3))])
    spans = {"visit_category": "hobby", "start_date": "2024-01-01", "end_date": "2024-01-31"}
    cohorts = table(spark, schemas.COHORTS, *[{**spans, "adid": a, "cohortlist": c} for a, c in (("hot", ["x", "y"]), ("50", ["x"]))])
    return topics, cohorts


def reports(spark, days, hot):
    topics, cohorts = device_tables(spark)
    return [
        profiles.profile_topic(days, topics, hot=hot),
        profiles.profile_cohort(days, cohorts, topics, category="hobby", min_count=None, hot=hot),
    ]


def test_hot_device_is_split_with_default_settings(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 1000)
    days = days_of(spark, 20_000)
    hot = skew.hot_cells(days, ["adid"])
    assert [r["parts"] for r in hot.collect()] == [20]
    for split, whole in zip(reports(spark, days, hot), reports(spark, days, None)):
        assert rows_of(split, *whole.columns) == rows_of(whole)
    dealt, _, on = skew.split_hot(days, [], hot)
    sizes = [r["count"] for r in dealt.groupBy(*on).count().where("adid = 'hot'").collect()]
    assert len(sizes) == 20 and max(sizes) < 1400


def test_hot_buyer_is_split(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    topics, _ = device_tables(spark)
    sold = linked(spark, *[{"adid": "hot", "item_name": f"i{i}"} for i in range(100)], {"adid": "50"}, {"adid": None})
    found = buyers.linked_topic(sold, topics, 1, hot=skew.hot_cells(sold, ["adid"]))
    assert rows_of(found) == rows_of(buyers.linked_topic(sold, topics, 1))


def test_sketch_is_bounded_and_cold_tables_have_none(spark):
    assert skew.hot_cells(days_of(spark, 5000), ["adid"]).collect() == []
    topics, _ = device_tables(spark)
    days = ops.device_days(visits(spark, visit(adid="50")), config(spark, ("A", 0)))
    found = profiles.profile_topic(days, topics, hot=skew.hot_cells(days, ["adid"]))
    assert rows_of(found, "topic_id", "count") == [(3, 1)]


def every_pair(seen, sold, tolerance):
    out = []
    for v in seen.where("competitor_id = 0").collect():
        for s in sold.collect():
            if v["place_id"] == s["place_id"] and v["place_id"] is not None and abs(v["datetime"] - s["datetime"]) <= tolerance:
                out.append((v["adid"], v["place_id"], v["datetime"], s["item_name"], s["datetime"]))
    return sorted(out, key=repr)


PAIR = ("adid", "place_id", "datetime", "item_name", "sold_at")


@pytest.mark.parametrize("seconds", [0, 0.000001, 7, 60, 180])
@pytest.mark.parametrize("hot_rows", [1 << 20, 3])
def test_pairs_equal_all_pairs(spark, monkeypatch, seconds, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    rng, step = random.Random(seconds), max(seconds / 4, 1e-6)
    start = dt.datetime(2024, 1, 10, 23, 59, 30)

    def when():
        near = start if rng.random() < 0.7 else start + dt.timedelta(hours=rng.randrange(3))
        return (near + dt.timedelta(seconds=step * rng.randrange(-9, 9))).isoformat()

    seen = visits(spark, *[visit(rng.choice("AAB"), rng.choice([0, 0, 1]), f"d{i % 20}", when()) for i in range(60)], visit(None), visit(adid=None))
    sold = sales(spark, *[{"place_id": rng.choice(["A", "A", "B", None]), "item_name": f"i{i % 9}", "datetime": when()} for i in range(40)])
    found = poslink.link_pairs(seen, sold, dt.timedelta(seconds=seconds))
    assert rows_of(found, *PAIR) == every_pair(seen, sold, dt.timedelta(seconds=seconds))


def test_repeated_rows_give_repeated_pairs_and_days_limit(spark):
    seen = visits(spark, visit(), visit(), visit(when="2024-01-11T12:00:00"))
    sold = sales(spark, {"datetime": "2024-01-10T12:03:00"}, {"datetime": "2024-01-10T12:03:00"}, {"datetime": "2024-01-11T12:00:00"})
    assert poslink.link_pairs(seen, sold).count() == 5
    assert poslink.link_pairs(seen, sold, start="2024-01-11").count() == 1
    with pytest.raises(ValueError, match="negative"):
        poslink.link_pairs(seen, sold, dt.timedelta(seconds=-1))


def test_hot_slot_becomes_a_grid(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    seen = visits(spark, *[visit(adid=f"d{i}") for i in range(400)])
    sold = sales(spark, *[{"item_name": f"i{i}", "datetime": "2024-01-10T12:00:00"} for i in range(300)])
    found = poslink.link_pairs(seen, sold)
    assert found.count() == 400 * 300 and found.distinct().count() == 400 * 300
    contacts = seen.select("place_id", "adid").withColumn("slot", F.lit(0))
    offers = sold.select("place_id", "item_name").withColumn("slot", F.lit(0))
    left, right, on = skew.split_both(contacts, offers, ["place_id", "slot"])
    met = left.join(right, on).groupBy(*on).count().collect()
    assert sum(r["count"] for r in met) == 400 * 300
    assert len(met) == 12 and max(r["count"] for r in met) < 400 * 300 / 6


def test_pairs_need_no_nested_loop(spark):
    text = plan(poslink.link_pairs(visits(spark, visit()), sales(spark, {"datetime": "2024-01-10T12:00:00"})))
    assert "NestedLoop" not in text and "Cartesian" not in text
