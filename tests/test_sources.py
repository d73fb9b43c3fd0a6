import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import linked, rows_of

from placelytics import schemas
from placelytics.sources import readers
from placelytics.sources.sinks import publish, with_partitions


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_place_config(spark, folder):
    path = folder("c.csv", "note,user_id,place_id,competitor_id,start_date\nx,T,001,0,2024-01-01\ny,T,001,0,2024-02-01\nz,T,002,1,2024-01-01\n")
    config = readers.read_place_config(spark, path)
    assert rows_of(config) == [("T", "001", 0), ("T", "002", 1)]
    assert rows_of(readers.read_place_config(spark, path, place_id="002")) == [("T", "002", 1)]
    dated = readers.read_place_config_from(spark, path)
    assert dated.count() == 3
    schemas.check(dated, schemas.PLACE_CONFIG_FROM, "place_config")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_number_fails_the_read(spark, folder, ansi):
    path = folder("c.csv", "user_id,place_id,competitor_id\nT,001,x\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="competitor_id is not a whole number: x"):
            readers.read_place_config(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_missing_column_is_named(spark, folder):
    path = folder("c.csv", "user_id,place_id\nT,001\n")
    with pytest.raises(schemas.SchemaError, match="competitor_id"):
        readers.read_place_config(spark, path)


def test_shops_thresholds_and_categories(spark, folder):
    shops = readers.read_shops(spark, folder("s.csv", "shop_code,place_id,caption\n001,01,銀座\n"))
    assert rows_of(shops) == [("001", "01", "銀座")]
    limits = readers.read_min_counts(spark, folder("m.csv", "caption,place_id,infimum\n銀座,01, 5 \n"))
    assert rows_of(limits) == [("銀座", "01", 5)]
    categories = readers.read_categories(spark, folder("k.csv", "カテゴリー\n飲食\n100\n"))
    assert rows_of(categories) == [("100",), ("飲食",)]


def test_pos_exports_of_several_layouts(spark, folder, tmp_path):
    folder("may/1.csv", "購入日,商品名,店舗,購入日時\n20240510,tea,1,2024-05-10 09:30:00\n20240510,,1,2024-05-10 09:31:00\n")
    folder("may/2.csv", "購入日,商品名,店舗,購入日時\n20240511,cake,12,2024-05-11 10:00:00\n")
    folder("june/1.csv", "購入日時,店舗,商品名,購入日\n2024-06-01 08:00:00,1234,tea,20240601\n")
    months = [str(tmp_path / m) for m in ("may", "june")]
    pos = readers.read_pos(spark, *months)
    assert rows_of(pos, "shop_code", "item_name") == [
        ("001", "tea"),
        ("001", None),
        ("012", "cake"),
        ("1234", "tea"),
    ]
    day = readers.read_pos(spark, *months, purchase_days=["2024-05-11", "2024-06-01"])
    assert rows_of(day, "item_name") == [("cake",), ("tea",)]


def test_differing_headers_in_one_folder_fail(spark, folder, tmp_path):
    folder("mixed/1.csv", "商品名,店舗,購入日時\ntea,1,2024-05-10 09:30:00\n")
    folder("mixed/2.csv", "店舗,商品名,購入日時\n1,tea,2024-05-10 09:30:00\n")
    with pytest.raises(Exception, match="header"):
        readers.read_pos(spark, str(tmp_path / "mixed")).collect()


def test_pos_from_parquet_and_with_a_time_format(spark, folder, tmp_path):
    path = str(tmp_path / "parquet")
    when = dt.datetime(2024, 5, 10, 9, 30)
    spark.createDataFrame([("tea", 1.0, when)], "item string, shop double, sold timestamp_ntz").write.parquet(path)
    names = {"item": "item_name", "shop": "shop_code", "sold": "datetime"}
    assert rows_of(readers.read_pos(spark, path, format="parquet", columns=names)) == [("001", "tea", when)]
    folder("odd/1.csv", "item,shop,sold\ntea,1,10.05.2024 09:30\n")
    for kind in ("timestamp", "timestamp_ntz"):
        odd = readers.read_pos(
            spark,
            str(tmp_path / "odd"),
            columns=names,
            timestamp_format="dd.MM.yyyy HH:mm",
            timestamp_type=kind,
        )
        assert dict(odd.dtypes)["datetime"] == kind
        assert odd.select(F.col("datetime").cast("string")).first()[0] == "2024-05-10 09:30:00"


def test_pos_needs_a_folder(spark):
    with pytest.raises(ValueError):
        readers.read_pos(spark)


def test_catalog_table_is_checked(spark, tmp_path):
    linked(spark, {}).createOrReplaceTempView("linked_view")
    assert readers.read_table(spark, "linked_view", schemas.LINKED).count() == 1
    with pytest.raises(schemas.SchemaError, match="linked_view: no column age"):
        readers.read_table(spark, "linked_view", schemas.AGE_GENDER)


def test_partitions_read_back_as_text(spark, tmp_path):
    path = str(tmp_path / "linked")
    rows = linked(spark, {"place_id": "001"}, {"place_id": "002", "date": "2024-02-03"})
    publish(with_partitions(rows), path, readers.PARTITIONS)
    back = readers.read_linked(spark, path)
    assert rows_of(back, "place_id", "place", "year", "month", "dt") == [
        ("001", "001", "2024", "2024-01", "2024-01-10"),
        ("002", "002", "2024", "2024-02", "2024-02-03"),
    ]
    some = readers.read_linked(spark, path, "place=*/year=*/month=2024-02/dt=*")
    assert rows_of(some, "place", "dt") == [("002", "2024-02-03")]


def test_rewriting_one_partition_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "out")
    publish(linked(spark, {"place_id": "1"}, {"place_id": "2", "adid": "old"}), path, ["place_id"])
    publish(linked(spark, {"place_id": "2", "adid": "new"}), path, ["place_id"])
    publish(linked(spark), path, ["place_id"])
    schema = "adid string, place_id string"
    assert rows_of(spark.read.schema(schema).parquet(path)) == [("d1", "1"), ("new", "2")]


def test_csv_output(spark, tmp_path):
    path = str(tmp_path / "csv")
    publish(linked(spark, {}), path, ["place_id"], format="csv", options={"header": "true"})
    assert spark.read.option("header", True).csv(path).select("item_name").first()[0] == "tea"


def test_files_are_sorted_and_large_partitions_are_split(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        # One partition holds nearly all rows.
        many = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 1000 == 0, "tiny").otherwise("big").alias("place_id"),
            F.hash("id").alias("value"),
        )
        publish(many, path, ["place_id"], sort_by=["value"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {name: len(list((tmp_path / "wide" / f"place_id={name}").glob("*.parquet"))) for name in ("tiny", "big")}
    assert files["big"] > 2
    assert files["tiny"] <= 2
    for file in (tmp_path / "wide" / "place_id=big").glob("*.parquet"):
        values = [r[0] for r in spark.read.parquet(str(file)).collect()]
        assert values == sorted(values)
