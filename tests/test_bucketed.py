"""Device tables that are bucketed by device are not shuffled by the reports."""

import re

import pytest
from rows import linked, rows_of

from placelytics import fixtures, schemas
from placelytics.fixtures import Tables
from placelytics.operators import buyers, profiles
from placelytics.operators import visits as ops
from placelytics.sources import readers, sinks

SF = "/root/testdata/sf0.001"
TABLES = {
    "home_work": schemas.HOME_WORK, "topics": schemas.TOPICS, "cohorts": schemas.COHORTS, "age_gender": schemas.AGE_GENDER,
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder, tables = tmp_path_factory.mktemp("buckets"), Tables(spark, SF)
    for name in TABLES:
        sinks.publish_device_table(getattr(tables, name), f"bucketed_{name}", 8, path=str(folder / name))
    yield tables
    for name in TABLES:
        spark.sql(f"DROP TABLE bucketed_{name}")


def reports(spark, t, home_work, topics, cohorts, age_gender):
    days = ops.device_days(t.visits, t.place_config)
    sold = linked(spark, *[{"adid": str(i)} for i in range(1, 40)])
    return {
        "location": profiles.profile_location(days, home_work, prefectures=fixtures.PREFECTURES),
        "topic": profiles.profile_topic(days, topics),
        "cohort": profiles.profile_cohort(days, cohorts, topics, category=fixtures.CATEGORY, min_count=None),
        "age": buyers.linked_age_gender(sold, age_gender, fixtures.SNAPSHOT, 1),
        "area": buyers.linked_location(sold, home_work, fixtures.SNAPSHOT, 1),
        "buyers_topic": buyers.linked_topic(sold, topics, 1),
    }


def test_no_exchange_on_the_side_of_device_tables(spark, stored):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        bucketed = [readers.read_table(spark, f"bucketed_{name}", schema) for name, schema in TABLES.items()]
        for name, report in reports(spark, stored, *bucketed).items():
            lines = report._jdf.queryExecution().executedPlan().toString().splitlines()
            scans = [i for i, line in enumerate(lines) if "FileScan" in line and "bucketed_" in line]
            assert scans, name
            for i in scans:
                assert "Bucketed: true" in lines[i], name
                depth, j = lines[i].index("FileScan"), i
                while j > 0 and "SortMergeJoin" not in lines[j]:
                    j -= 1
                    above = re.search(r"[A-Za-z(*]", lines[j]).start()
                    if above < depth:
                        assert "Exchange" not in lines[j], (name, lines[j])
                        depth = above
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_bucketed_tables_give_the_same_reports(spark, stored):
    bucketed = [spark.table(f"bucketed_{name}") for name in TABLES]
    plain = [getattr(stored, name) for name in TABLES]
    for ours, theirs in zip(reports(spark, stored, *bucketed).values(), reports(spark, stored, *plain).values()):
        assert rows_of(ours) == rows_of(theirs, *ours.columns)


def test_tables_without_devices_are_refused(spark):
    with pytest.raises(ValueError, match="adid"):
        sinks.publish_device_table(spark.range(1), "nothing", 2)
