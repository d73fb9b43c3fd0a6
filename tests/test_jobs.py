"""The report jobs end to end on the smallest scale factor."""

from pathlib import Path

import pytest
from rows import linked, rows_of, table, visit, visits

from placelytics import fixtures, schemas
from placelytics.fixtures import Tables
from placelytics.operators import buyers
from placelytics.plans import jobs
from placelytics.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
MONTH = {"start": "2024-01-01", "end": "2024-01-31"}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return Tables(spark, SF)


def written(spark, path, like):
    """What a job wrote, with the columns and types of the query it publishes."""
    return spark.read.schema(like.schema).parquet(path)


def same(spark, path, query):
    expected = QUERIES[query](spark, SF)
    found = rows_of(expected)
    if found:
        assert rows_of(written(spark, path, expected), *expected.columns) == found
    else:
        assert not list(Path(path).glob("*/"))


def test_overlap_reports(spark, tables, tmp_path):
    folders = jobs.overlap_reports(tables.visits, tables.place_config, str(tmp_path), end="2024-01-31")
    for folder, query in zip(folders, ["overlap_daily", "overlap_weekly", "overlap_monthly"]):
        same(spark, folder, query)
    assert (tmp_path / "duplication" / "daily" / "place_id=P0").is_dir()


def test_profile_reports_and_rerun_of_one_day(spark, tables, tmp_path):
    def run(**span):
        return jobs.profile_reports(
            *[tables.visits, tables.place_config, tables.home_work, tables.topics, tables.cohorts],
            str(tmp_path),
            prefectures=fixtures.PREFECTURES,
            category=fixtures.CATEGORY,
            **span,
        )

    for folder, query in zip(run(**MONTH), ["profile_location", "profile_topic", "profile_cohort"]):
        same(spark, folder, query)
    run(days=["2024-01-10"])
    same(spark, f"{tmp_path}/topic", "profile_topic")


@pytest.mark.parametrize("grain, query", [("month", "covisited_monthly"), ("day", "covisited_daily")])
def test_movement_report(spark, tables, tmp_path, grain, query):
    report = jobs.movement_report(
        *[tables.visits, tables.place_config, tables.device_spots, tables.spot_catalog, tables.categories],
        str(tmp_path),
        grain=grain,
        prefectures=fixtures.PREFECTURES,
        **MONTH,
    )
    same(spark, report[0], query)


def test_link_buyers_and_repeats(spark, tables, tmp_path):
    out = str(tmp_path)
    [link] = jobs.link_job(tables.visits, tables.pos, tables.shops, out, tolerance=fixtures.LINK, **MONTH)
    same(spark, link, "link_sales_30m")
    folders = jobs.buyer_reports(
        *[spark, link, tables.visits, tables.age_gender, tables.home_work, tables.topics, tables.min_counts],
        out,
        **MONTH,
    )
    queries = ["linked_devices", "linked_visitors", "linked_age_gender"]
    queries += ["linked_location", "linked_topic", "linked_overlap"]
    for folder, query in zip(folders, queries):
        same(spark, folder, query)
    repeats = jobs.repeat_report(spark, link, tables.visits, tables.shops, out, **MONTH)
    same(spark, repeats[0], "repeat_by_item")
    assert len(list((tmp_path / "repeater").glob("place=*/year=2024/month=2024-01"))) == 4


def test_default_day_is_the_report_day(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "report_day", lambda: "2024-01-10")
    jobs.profile_reports(
        *[tables.visits, tables.place_config, tables.home_work, tables.topics, tables.cohorts],
        str(tmp_path),
        prefectures=fixtures.PREFECTURES,
        category=fixtures.CATEGORY,
    )
    assert [p.name for p in (tmp_path / "topic").glob("date=*")] == ["date=2024-01-10"]


def partitions(spark, path):
    """Every published row by partition folder."""
    return {str(f.relative_to(path)): rows_of(spark.read.parquet(str(f))) for f in sorted(Path(path).rglob("*=*")) if list(f.glob("*.parquet"))}


@pytest.fixture
def two_months(spark, tables):
    """Linked sales of May and June, and device tables that differ between them."""
    days = ["2025-05-10", "2025-05-20", "2025-06-10"]
    seen = [visit("A", adid="d1", when=f"{d}T12:00:00") for d in days] + [visit("A", 7, "d1", f"{d}T15:00:00") for d in days]
    months = [("2025-05-01", "2025-05-31", 20, "X"), ("2025-06-01", "2025-06-30", 30, "Y")]
    ages = [{"adid": "d1", "age": a, "gender": "F", "start_date": s} for s, _, a, _ in months]
    homes = [{"adid": "d1", "time_category": "home", "prefecture": p, "city": "c", "block": "b", "start_date": s, "end_date": e} for s, e, _, p in months]
    topics = [{"adid": "d1", "topic_id": 1, "topic_number": "10", "pattern": "preference", "ver": "2025-01-01"}]
    return {
        "visits": visits(spark, *seen),
        "pos": table(spark, schemas.POS, *[{"shop_code": "001", "item_name": "tea", "datetime": visit(when=f"{d}T12:00:30")["datetime"]} for d in days]),
        "shops": table(spark, schemas.SHOPS, {"shop_code": "001", "place_id": "A", "caption": "shop"}),
        "age_gender": table(spark, schemas.AGE_GENDER, *ages),
        "home_work": table(spark, schemas.HOME_WORK, *homes),
        "topics": table(spark, schemas.TOPICS, *topics),
        "limits": table(spark, schemas.MIN_COUNTS, {"caption": "shop", "place_id": "A", "infimum": 1}),
    }


MAY, JUNE = {"start": "2025-05-01", "end": "2025-05-31"}, {"start": "2025-06-01", "end": "2025-06-30"}


def run_buyers(spark, t, out, **span):
    [link] = jobs.link_job(t["visits"], t["pos"], t["shops"], out, **span)
    jobs.buyer_reports(spark, link, t["visits"], t["age_gender"], t["home_work"], t["topics"], t["limits"], out, **span)
    jobs.repeat_report(spark, link, t["visits"], t["shops"], out, **span)
    return partitions(spark, out)


def test_runs_over_other_months_change_nothing_else(spark, two_months, tmp_path):
    may = run_buyers(spark, two_months, f"{tmp_path}/a", **MAY)
    both = run_buyers(spark, two_months, f"{tmp_path}/a", **JUNE)
    assert may and may.items() <= both.items() and len(both) > len(may)
    assert run_buyers(spark, two_months, f"{tmp_path}/b", **JUNE).items() <= both.items()
    assert run_buyers(spark, two_months, f"{tmp_path}/b", **MAY) == both
    whole = run_buyers(spark, two_months, f"{tmp_path}/c", start=MAY["start"], end=JUNE["end"])
    assert {k: v for k, v in whole.items() if not k.startswith("repeater")} == {k: v for k, v in both.items() if not k.startswith("repeater")}
    ages = spark.read.parquet(f"{tmp_path}/a/agegender").select("date", "age")
    assert rows_of(ages) == [("2025-05-10", 20), ("2025-05-20", 20), ("2025-06-10", 30)]


def test_only_the_days_of_the_run_are_read(spark, two_months, tmp_path):
    [link] = jobs.link_job(two_months["visits"], two_months["pos"], two_months["shops"], str(tmp_path), **MAY)
    text = jobs._linked(spark, link, "2025-05-10", "2025-05-11")._jdf.queryExecution().executedPlan().toString()
    assert "2025-05-10" in text.split("PartitionFilters: [")[1].split("], PushedFilters")[0]


def test_results_that_are_gone_are_withdrawn(spark, two_months, tmp_path):
    out = str(tmp_path)
    before = run_buyers(spark, two_months, out, **MAY) | run_buyers(spark, two_months, out, **JUNE)
    raised = table(spark, schemas.MIN_COUNTS, {"caption": "shop", "place_id": "A", "infimum": 99})
    after = run_buyers(spark, {**two_months, "limits": raised}, out, **JUNE)
    suppressed = ("agegender", "location", "topic", "duplication")
    gone = {k for k in before if k.startswith(suppressed) and "month=2025-06" in k}
    assert gone and set(before) - set(after) == gone
    assert after.items() <= before.items()
    nothing = run_buyers(spark, {**two_months, "pos": two_months["pos"].limit(0)}, out, **JUNE)
    assert not [k for k in nothing if "month=2025-06" in k]
    assert {k: v for k, v in nothing.items() if "month=2025-05" in k} == {k: v for k, v in before.items() if "month=2025-05" in k}


def test_grains_of_movement_stay_apart_and_months_are_whole(spark, tables, tmp_path):
    def run(**options):
        return jobs.movement_report(
            *[tables.visits, tables.place_config, tables.device_spots, tables.spot_catalog, tables.categories],
            str(tmp_path),
            prefectures=fixtures.PREFECTURES,
            **options,
        )

    [daily] = run(grain="day", **MONTH)
    before = partitions(spark, daily)
    [monthly] = run(grain="month", **MONTH)
    assert before and partitions(spark, daily) == before and partitions(spark, monthly)
    for span in ({}, {"start": "2024-01-20"}, {"start": "2024-01-20", "end": "2024-01-31"}):
        with pytest.raises(ValueError, match="month"):
            run(grain="month", **span)
    with pytest.raises(ValueError, match="whole months"):
        jobs.repeat_report(spark, "x", tables.visits, tables.shops, str(tmp_path), start="2024-01-02", end="2024-01-31")


def test_overlap_of_a_range_replaces_its_periods_alone(spark, tables, tmp_path):
    whole, parts = f"{tmp_path}/whole", f"{tmp_path}/parts"
    jobs.overlap_reports(tables.visits, tables.place_config, whole, end="2024-01-31")
    for start, end in (("2024-01-20", "2024-01-31"), ("2024-01-01", "2024-01-10"), ("2024-01-09", "2024-01-21")):
        jobs.overlap_reports(tables.visits, tables.place_config, parts, start=start, end=end)
    assert partitions(spark, whole) and partitions(spark, parts) == partitions(spark, whole)


def test_job_tables_are_removed_also_on_failure(spark, tables, tmp_path):
    shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    jobs.overlap_reports(tables.visits, tables.place_config, str(tmp_path), end="2024-01-31", periods=["day"])
    with pytest.raises(ZeroDivisionError), jobs._computed_once(tables.visits):
        assert list(shared.glob("job-*/*.parquet"))
        raise ZeroDivisionError
    assert not list(shared.glob("job-*"))
    assert not list(tmp_path.glob("_*"))


def test_a_shared_folder_is_required(spark, tables, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda _: None)
    with pytest.raises(ValueError, match="checkpoint"), jobs._computed_once(tables.visits):
        pass


def test_one_number_can_be_the_threshold_of_all_shops(spark):
    people = table(spark, schemas.AGE_GENDER, *[{"adid": f"d{i}", "age": 20, "gender": "F", "start_date": "2024-01-01"} for i in range(4)])
    sold = linked(spark, *[{"adid": f"d{i}", "caption": c} for i in range(4) for c in ("a", "b")], {"adid": "d0", "item_name": "milk"})
    counted = buyers.linked_age_gender(sold, people, "2024-01-01", 2)
    assert rows_of(counted, "caption", "item_name", "count") == [("a", "tea", 4), ("b", "tea", 4)]
    per_shop = buyers.linked_age_gender(sold.drop("item_name").distinct(), people, "2024-01-01", 1, by=("caption", "shop_code"))
    assert "item_name" not in per_shop.columns
    assert rows_of(per_shop, "caption", "count") == [("a", 4), ("b", 4), ("shop", 1)]
