from rows import device_days, rows_of, table, visit

from placelytics import schemas
from placelytics.operators import movement, profiles
from placelytics.operators.visits import tenant_device_days
from rows import config, visits

WHOLE_MONTH = {"start_date": "2024-01-01", "end_date": "2024-01-31"}


def home(spark, *rows):
    defaults = {"time_category": "home", "prefecture": "X", "city": "c", "block": "b", "adid": "d1"}
    return table(spark, schemas.HOME_WORK, *rows, **{**defaults, **WHOLE_MONTH})


def topics(spark, *rows):
    defaults = {"adid": "d1", "topic_id": 1, "topic_number": "10", "pattern": "preference", "ver": "2025-01-01"}
    return table(spark, schemas.TOPICS, *rows, **defaults)


def cohorts(spark, *rows):
    return table(
        spark,
        schemas.COHORTS,
        *rows,
        **{"adid": "d1", "visit_category": "hobby", "cohortlist": ["a"], **WHOLE_MONTH},
    )


def test_validity_interval_includes_both_ends(spark):
    days = ["2023-12-31", "2024-01-01", "2024-01-15", "2024-01-16"]
    seen = device_days(spark, *[visit(when=f"{d}T10:00:00") for d in days])
    areas = home(spark, {"end_date": "2024-01-15"})
    found = profiles.profile_location(seen, areas, prefectures=["X"], min_count=None)
    assert rows_of(found, "date") == [("2024-01-01",), ("2024-01-15",)]


def test_location_counts_address_rows_and_drops_single_counts(spark):
    seen = device_days(spark, visit(), visit(adid="d2"), visit(adid=None))
    areas = home(spark, {}, {"adid": "d2"}, {"adid": "d2"}, {"block": "other"}, {"prefecture": "Y"}, {"adid": None})
    found = profiles.profile_location(seen, areas, prefectures=["X"])
    assert rows_of(found, "block", "count") == [("b", 3)]
    people = profiles.profile_location(seen, areas, prefectures=["X"], distinct_devices=True)
    assert rows_of(people, "block", "count") == [("b", 2)]


def test_topic_takes_one_model_and_is_not_suppressed(spark):
    seen = device_days(spark, visit())
    models = topics(spark, {}, {"topic_number": "5"}, {"pattern": "behavior"}, {"ver": "2024-01-01"}, {"topic_id": 2})
    assert rows_of(profiles.profile_topic(seen, models), "topic_id", "count") == [(1, 1), (2, 1)]
    assert profiles.profile_topic(seen, models, min_count=2).count() == 0
    versions = rows_of(profiles.topic_versions(models))
    assert versions == [("2024-01-01",), ("2025-01-01",)]


def test_cohorts_and_topics_multiply(spark):
    seen = device_days(spark, visit())
    interests = cohorts(spark, {"cohortlist": ["a", "b"]}, {"visit_category": "work"})
    apart = topics(spark, {}, {"topic_id": 2})
    same = topics(spark, {}, {})
    run = lambda t: profiles.profile_cohort(seen, interests, t, category="hobby", min_count=None)
    assert rows_of(run(apart), "cohort", "topic_id", "count") == [("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("b", 2, 1)]
    assert rows_of(run(same), "cohort", "count") == [("a", 2), ("b", 2)]


def test_devices_without_cohorts_drop_out(spark):
    seen = device_days(spark, visit())
    for nothing in ([], None):
        empty = cohorts(spark, {"cohortlist": nothing})
        found = profiles.profile_cohort(seen, empty, topics(spark, {}), category="hobby", min_count=None)
        assert found.count() == 0


def test_cohort_threshold_is_ten(spark):
    seen = device_days(spark, *[visit(adid=f"d{i}") for i in range(10)], *[visit("B", adid=f"d{i}") for i in range(9)])
    interests = cohorts(spark, *[{"adid": f"d{i}"} for i in range(10)])
    models = topics(spark, *[{"adid": f"d{i}"} for i in range(10)])
    found = profiles.profile_cohort(seen, interests, models, category="hobby")
    assert rows_of(found, "place_id", "count") == [("A", 10)]


def spots(spark, *rows):
    defaults = {"adid": "d1", "spot": "s", "prefecture": "X", "city": "c", "address": "1"}
    return table(spark, schemas.DEVICE_SPOTS, *rows, **{**defaults, **WHOLE_MONTH})


def catalog(spark, *categories, **other):
    defaults = {"spot": "s", "prefecture": "X", "city": "c", "address": "1", **other}
    return table(spark, schemas.SPOT_CATALOG, *[{"cohort_caption": c} for c in categories], **defaults)


def covisited(spark, grain, spot_rows, listed, allowed=("food", "fun")):
    seen = visits(spark, *[visit(when=f"2024-01-{d}T10:00:00") for d in ("10", "11", "12")])
    categories = table(spark, schemas.CATEGORIES, *[{"cohort_caption": c} for c in allowed])
    return movement.covisited_spots(
        tenant_device_days(seen, config(spark, ("A", 0))),
        spot_rows,
        listed,
        categories,
        grain=grain,
        prefectures=["X"],
    )


def test_monthly_counts_are_device_days(spark):
    monthly = covisited(spark, "month", spots(spark, {}), catalog(spark, "food"))
    assert rows_of(monthly, "start_date", "count", "cohort_caption") == [("2024-01-01", 3, "food")]
    daily = covisited(spark, "day", spots(spark, {}), catalog(spark, "food"))
    assert rows_of(daily, "date", "count") == [(f"2024-01-{d}", 1) for d in ("10", "11", "12")]


def test_spot_in_two_allowed_categories_gives_two_rows(spark):
    found = covisited(spark, "month", spots(spark, {}), catalog(spark, "food", "fun", "work"))
    assert rows_of(found, "cohort_caption", "count") == [("food", 3), ("fun", 3)]


def test_repeated_spot_rows_count_and_repeated_catalog_rows_repeat(spark):
    found = covisited(spark, "month", spots(spark, {}, {}), catalog(spark, "food", "food"))
    assert rows_of(found, "count") == [(6,), (6,)]


def test_daily_grain_takes_the_visit_month_only(spark):
    longer = spots(spark, {"start_date": "2023-12-01"}, {"prefecture": "Y"})
    assert covisited(spark, "day", longer, catalog(spark, "food")).count() == 0
    assert rows_of(covisited(spark, "month", longer, catalog(spark, "food")), "count") == [(3,)]
