from rows import config, linked, rows_of, visit, visits

from placelytics.operators import repeat
from placelytics.operators.visits import place_device_days


def days(spark, *dates, **other):
    rows = visits(spark, *[visit(when=f"{d}T10:00:00", **other) for d in dates])
    return place_device_days(rows, config(spark, ("A", 0)))


def test_first_visit_has_gap_zero(spark):
    history = repeat.visit_history(days(spark, "2024-01-04", "2024-01-01", "2024-01-01"))
    assert rows_of(history, "date", "before", "interval") == [
        ("2024-01-01", "0", 0),
        ("2024-01-04", "2024-01-01", 3),
    ]


def test_rolling_frame_covers_thirty_one_days(spark):
    rolling = repeat.rolling_visits(days(spark, "2024-01-01", "2024-01-31", "2024-02-01", "2024-03-01"))
    assert rows_of(rolling, "date", "visit_count_in_30days", "visited_30days") == [
        ("2024-01-01", 1, 0),
        ("2024-01-31", 2, 1),
        ("2024-02-01", 2, 1),
        ("2024-03-01", 3, 2),
    ]


def test_other_frames(spark):
    seen = days(spark, "2024-01-01", "2024-01-08", "2024-03-01")
    assert rows_of(repeat.rolling_visits(seen, days=6), "visited_30days") == [(0,), (0,), (0,)]
    assert rows_of(repeat.rolling_visits(seen, days=7), "visited_30days") == [(0,), (0,), (1,)]
    assert rows_of(repeat.rolling_visits(seen, days=None), "visited_30days") == [(0,), (1,), (2,)]


def test_cap_drops_frequent_visitors_and_lookback_is_not_reported(spark):
    dates = [f"2024-01-{d:02d}" for d in range(1, 21)]
    assert repeat.rolling_visits(days(spark, *dates)).count() == 16
    assert repeat.rolling_visits(days(spark, *dates), cap=None).count() == 20
    late = repeat.rolling_visits(days(spark, *dates), cap=None, report_from="2024-01-20")
    assert rows_of(late, "date", "visited_30days") == [("2024-01-20", 19)]


def test_places_and_devices_have_their_own_history(spark):
    both = days(spark, "2024-01-01", "2024-01-02").union(days(spark, "2024-01-02", rival=1))
    rolling = repeat.rolling_visits(both)
    assert rows_of(rolling, "competitor_id", "date", "visited_30days") == [
        (0, "2024-01-01", 0),
        (0, "2024-01-02", 1),
        (1, "2024-01-02", 0),
    ]


def test_competitor_visit_adds_a_row_unless_own_only(spark):
    both = days(spark, "2024-01-10").union(days(spark, "2024-01-10", rival=1))
    rolling = repeat.rolling_visits(both)
    assert rows_of(repeat.repeat_by_item(rolling, linked(spark, {})), "visited_30days", "count") == [(0, 2)]
    own = repeat.repeat_by_item(rolling, linked(spark, {}), own_only=True)
    assert rows_of(own, "visited_30days", "count") == [(0, 1)]
