import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from rows import linked, rows_of, sales, table, visit, visits

from placelytics import schemas
from placelytics.operators import buyers, poslink
from placelytics.operators.poslink import link_sales, pos_sales

MINUTE = dt.timedelta(minutes=1)


def test_bounds_are_inclusive(spark):
    seen = visits(spark, visit(when="2024-01-10T10:00:00"))
    times = ["09:58:59.999", "09:59:00", "10:01:00", "10:01:00.001"]
    sold = sales(spark, *[{"item_name": t, "datetime": f"2024-01-10T{t}"} for t in times])
    assert rows_of(link_sales(seen, sold), "item_name") == [("09:59:00",), ("10:01:00",)]


def test_link_across_midnight_keeps_the_visit_date(spark):
    seen = visits(spark, visit(when="2024-01-10T23:59:30"))
    sold = sales(spark, {"datetime": "2024-01-11T00:00:10"})
    assert rows_of(link_sales(seen, sold), "date") == [("2024-01-10",)]


def test_one_sale_links_every_device_at_the_place_once(spark):
    seen = visits(
        spark,
        *[visit(adid=f"d{i}", when="2024-01-10T10:00:00") for i in range(3)],
        visit(adid="d0", when="2024-01-10T10:00:30"),
        visit(adid="elsewhere", place="B", when="2024-01-10T10:00:00"),
        visit(adid="rival", rival=1, when="2024-01-10T10:00:00"),
    )
    found = link_sales(seen, sales(spark, {"datetime": "2024-01-10T10:00:00"}))
    assert rows_of(found, "adid") == [("d0",), ("d1",), ("d2",)]
    assert schemas.check(found, schemas.LINKED, "linked") is found


def test_days_limit_the_visits(spark):
    seen = visits(spark, visit(when="2024-01-10T10:00:00"), visit(when="2024-01-11T10:00:00"))
    sold = sales(spark, {"datetime": "2024-01-10T10:00:00"}, {"datetime": "2024-01-11T10:00:00"})
    assert rows_of(link_sales(seen, sold, start="2024-01-11", end="2024-01-31"), "date") == [("2024-01-11",)]


def _plain(seen, sold, tolerance):
    """The link as a range join over all pairs, for comparison."""
    v, s = seen.where("competitor_id = 0").alias("v"), sold.alias("s")
    micros = lambda c: F.unix_micros(c)
    reach = tolerance // dt.timedelta(microseconds=1)
    near = F.abs(micros("v.datetime") - micros("s.datetime")) <= reach
    columns = ["user_id", "v.place_id", "competitor_id", "adid", "date", "shop_code", "caption", "item_name"]
    return v.join(s, (F.col("v.place_id") == F.col("s.place_id")) & near).select(*columns).distinct()


@pytest.mark.parametrize(
    "tolerance", [dt.timedelta(0), dt.timedelta(microseconds=1), dt.timedelta(seconds=7), MINUTE, 3 * MINUTE]
)
def test_equals_the_plain_range_join(spark, tolerance):
    rng = random.Random(tolerance.total_seconds())
    step = max(tolerance.total_seconds() / 4, 1e-6)
    start = dt.datetime(2024, 1, 10, 11, 59)

    def moment():
        # Multiples of a quarter of the tolerance hit slot edges and exact bounds.
        return (start + dt.timedelta(seconds=round(rng.randrange(40) * step, 6))).isoformat()

    seen = visits(
        spark, *[visit(rng.choice("AB"), rng.choice([0, 0, 1]), f"d{rng.randrange(30)}", moment()) for _ in range(120)]
    )
    sold = sales(
        spark,
        *[
            {"place_id": rng.choice("AB"), "item_name": f"i{rng.randrange(12)}", "datetime": moment()}
            for _ in range(60)
        ],
    )
    expected = rows_of(_plain(seen, sold, tolerance))
    assert rows_of(link_sales(seen, sold, tolerance)) == expected
    assert expected


def test_negative_tolerance_is_refused(spark):
    with pytest.raises(ValueError):
        link_sales(visits(spark, visit()), sales(spark, {"datetime": "2024-01-10T10:00:00"}), -MINUTE)


def test_shop_codes_are_padded_and_nameless_lines_dropped(spark):
    shops = table(
        spark,
        schemas.SHOPS,
        {"shop_code": "001", "place_id": "A", "caption": "a"},
        {"shop_code": "1234", "place_id": "B", "caption": "b"},
    )
    when = dt.datetime(2024, 1, 10)
    lines = [(1.0, "tea", when), (1234.0, "tea", when), (1.0, None, when), (7.0, "tea", when)]
    pos = spark.createDataFrame(lines, "shop_code double, item_name string, datetime timestamp")
    assert rows_of(pos_sales(pos, shops), "shop_code", "place_id") == [("001", "A"), ("1234", "B")]
    text = pos.withColumn("shop_code", F.col("shop_code").cast("int").cast("string"))
    assert rows_of(pos_sales(text, shops), "shop_code") == [("001",), ("1234",)]


def test_linked_devices_and_visitors(spark):
    rows = linked(spark, {}, {}, {"item_name": "cake"}, {"adid": "d2"}, {"adid": None})
    assert rows_of(poslink.linked_devices(rows), "caption", "count") == [("shop", 3)]
    # Null devices are not counted here, repeated rows once, and each item has its own count.
    assert rows_of(poslink.linked_visitors(rows), "item_name", "count") == [("tea", 2)]
    everything = poslink.linked_visitors(rows, min_count=None)
    assert rows_of(everything, "item_name", "count") == [("cake", 1), ("tea", 2)]


def limits(spark, *rows):
    return table(spark, schemas.MIN_COUNTS, *rows, caption="shop", place_id="A", infimum=1)


def test_snapshot_and_shop_thresholds(spark):
    people = table(
        spark,
        schemas.AGE_GENDER,
        *[{"adid": a, "age": 30, "gender": "F", "start_date": m} for a in ("d1", "d2") for m in ("2024-01-01", "2024-02-01")],
    )
    rows = linked(spark, {}, {"adid": "d2"})
    run = lambda m: rows_of(buyers.linked_age_gender(rows, people, "2024-01-01", m), "age", "gender", "count")
    assert run(limits(spark, {"infimum": 2})) == [(30, "F", 2)]
    assert run(limits(spark, {"infimum": 3})) == []
    assert run(limits(spark, {"caption": "another shop"})) == []


def test_location_uses_one_snapshot_and_topic_keeps_all_patterns(spark):
    areas = table(
        spark,
        schemas.HOME_WORK,
        {"start_date": "2024-01-01"},
        {"start_date": "2023-12-01"},
        **{"adid": "d1", "time_category": "home", "prefecture": "X", "city": "c", "block": "b", "end_date": "2024-12-31"},
    )
    found = buyers.linked_location(linked(spark, {}), areas, "2024-01-01", limits(spark, {}))
    assert rows_of(found, "prefecture", "count") == [("X", 1)]
    topics = table(
        spark,
        schemas.TOPICS,
        {"pattern": "preference"},
        {"pattern": "behavior"},
        **{"adid": "d1", "topic_id": 1, "topic_number": "10", "ver": "2025-01-01"},
    )
    patterns = rows_of(buyers.linked_topic(linked(spark, {}), topics, limits(spark, {})), "pattern")
    assert patterns == [("behavior",), ("preference",)]


def test_competitor_contacts_are_counted_one_by_one(spark):
    seen = visits(
        spark,
        *[visit(rival=1, when=f"2024-01-10T1{i}:00:00") for i in range(3)],
        visit(rival=2),
        visit(rival=0),
        visit(rival=1, adid="not linked"),
        visit(rival=1, when="2024-01-11T10:00:00"),
        visit("B", rival=1),
    )
    rows = linked(spark, {}, {"adid": "stays"}, {"item_name": "cake"}, {"adid": None})
    found = buyers.linked_overlap(rows, seen, limits(spark, {}))
    columns = ["item_name", "duplication_place_id", "duplication_competitor_id", "count", "own_count"]
    assert rows_of(found, *columns) == [
        ("cake", "A", 1, 3, 1),
        ("cake", "A", 2, 1, 1),
        ("tea", "A", 1, 3, 2),
        ("tea", "A", 2, 1, 2),
    ]
    busy = buyers.linked_overlap(rows, seen, limits(spark, {"infimum": 2}))
    assert rows_of(busy, "duplication_competitor_id") == [(1,), (1,)]
