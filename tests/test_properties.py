"""Rules that hold for every input, checked on the smallest scale factor."""

import pytest
from rows import linked, rows_of, sales, visit, visits

from placelytics import fixtures, schemas
from placelytics.fixtures import Tables
from placelytics.operators import movement, overlap, poslink, profiles, repeat
from placelytics.operators import visits as ops

SF = "/root/testdata/sf0.001"


class Twice(Tables):
    """Every contact loaded twice."""

    @property
    def visits(self):
        once = Tables.visits.func(self)
        return once.unionByName(once)


def spots(t):
    seen = ops.tenant_device_days(t.visits, t.place_config)
    return movement.covisited_spots(
        seen, t.device_spots, t.spot_catalog, t.categories, prefectures=fixtures.PREFECTURES
    )


def location(t, **options):
    seen = ops.device_days(t.visits, t.place_config)
    return profiles.profile_location(seen, t.home_work, prefectures=fixtures.PREFECTURES, **options)


def shop_days(t):
    return ops.place_device_days(t.visits, t.shops)


OPERATORS = {
    "overlap": lambda t: overlap.overlap(ops.monitored_visits(t.visits, t.place_config, "week"), "week"),
    "location": lambda t: location(t, min_count=None),
    "spots": spots,
    "link": lambda t: poslink.link_sales(t.visits, poslink.pos_sales(t.pos, t.shops), fixtures.LINK),
    "gaps": lambda t: repeat.visit_history(shop_days(t)),
    "rolling": lambda t: repeat.rolling_visits(shop_days(t)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_contacts_loaded_twice_change_nothing(spark, name):
    once, twice = (rows_of(OPERATORS[name](kind(spark, SF))) for kind in (Tables, Twice))
    assert once and once == twice


def test_a_higher_threshold_only_removes_rows(spark):
    tables = Tables(spark, SF)
    kept = [set(rows_of(location(tables, min_count=n))) for n in (1, 2, 3)]
    assert kept[0] > kept[1] >= kept[2]


def test_a_range_of_days_equals_the_single_days(spark):
    tables = Tables(spark, SF)
    days = ["2024-01-04", "2024-01-05", "2024-01-06"]

    def run(**span):
        seen = ops.device_days(tables.visits, tables.place_config, **span)
        return rows_of(profiles.profile_topic(seen, tables.topics))

    single = [row for day in days for row in run(days=[day])]
    assert run(start=days[0], end=days[-1]) == run(days=days) == sorted(single, key=repr)


@pytest.mark.parametrize(
    "call",
    [
        lambda s, bad: profiles.profile_location(bad, bad),
        lambda s, bad: profiles.profile_topic(bad, bad),
        lambda s, bad: profiles.profile_cohort(bad, bad, bad),
        lambda s, bad: profiles.topic_versions(bad),
        lambda s, bad: movement.covisited_spots(bad, bad, bad, bad),
        lambda s, bad: overlap.overlap(bad, "day"),
        lambda s, bad: poslink.pos_sales(bad, bad),
        lambda s, bad: poslink.link_sales(bad, bad),
        lambda s, bad: poslink.link_sales(visits(s, visit()), bad),
        lambda s, bad: poslink.linked_devices(bad),
        lambda s, bad: repeat.visit_history(bad),
        lambda s, bad: repeat.rolling_visits(bad),
        lambda s, bad: repeat.repeat_by_item(bad, bad),
    ],
)
def test_operators_refuse_tables_without_their_columns(spark, call):
    with pytest.raises(schemas.SchemaError):
        call(spark, spark.range(1))


def test_unknown_grain_is_refused(spark):
    tables = Tables(spark, SF)
    seen = ops.tenant_device_days(tables.visits, tables.place_config)
    with pytest.raises(ValueError, match="grain"):
        movement.covisited_spots(
            seen, tables.device_spots, tables.spot_catalog, tables.categories, grain="year"
        )


def test_link_result_is_what_the_reports_take(spark):
    found = poslink.link_sales(visits(spark, visit()), sales(spark, {"datetime": "2024-01-10T12:00:00"}))
    assert rows_of(found, *schemas.LINKED.names) == rows_of(linked(spark, {}), *schemas.LINKED.names)
