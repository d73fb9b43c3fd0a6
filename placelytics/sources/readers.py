"""Readers for configuration files, sale exports and the linked intermediate.

Files keep the types declared here. Nothing is inferred from values, so an id such as ``001``
stays text and a malformed number fails the read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelytics import schemas
from placelytics.functions.codes import shop_code, strict_int
from placelytics.sources.workbooks import read_sheets

# Column headers of the files.
CATEGORY_HEADER = "カテゴリー"
POS_COLUMNS = {"商品名": "item_name", "店舗": "shop_code", "購入日時": "datetime"}
PURCHASE_DAY_HEADER = "購入日"

PARTITIONS = ("place", "year", "month", "dt")


def read_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table that must hold the columns of ``schema``."""
    return schemas.check(spark.table(name), schema, name)


# Text columns named by the header. A folder whose files differ in their headers fails the read
# instead of mixing columns up.
_CSV = {"header": "true", "inferSchema": "false", "enforceSchema": "false"}


def _text_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**_CSV).csv(path)


def _columns(df: DataFrame, path: str, names: Iterable[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise schemas.SchemaError(f"{path}: no column " + ", ".join(missing))
    return df.select(*names)


def read_place_config(spark: SparkSession, path: str, *, place_id: str | None = None) -> DataFrame:
    """Monitored places, distinct; ``place_id`` keeps the rows of one place."""
    config = _columns(_text_csv(spark, path), path, ["user_id", "place_id", "competitor_id"])
    if place_id is not None:
        config = config.where(F.col("place_id") == place_id)
    return config.withColumn("competitor_id", strict_int("competitor_id")).dropDuplicates()


def read_place_config_from(spark: SparkSession, path: str) -> DataFrame:
    """Monitored places with the date each is watched from, as for the overlap reports."""
    columns = ["place_id", "user_id", "competitor_id", "start_date"]
    config = _columns(_text_csv(spark, path), path, columns)
    return config.withColumn("competitor_id", strict_int("competitor_id"))


def read_shops(spark: SparkSession, path: str) -> DataFrame:
    """Shop code, place and caption, all text."""
    return _columns(_text_csv(spark, path), path, ["shop_code", "place_id", "caption"])


def read_min_counts(spark: SparkSession, path: str) -> DataFrame:
    """Suppression threshold per shop, as a number."""
    limits = _columns(_text_csv(spark, path), path, ["caption", "place_id", "infimum"])
    return limits.withColumn("infimum", strict_int("infimum"))


def read_categories(spark: SparkSession, path: str, column: str = CATEGORY_HEADER) -> DataFrame:
    """Allowed spot categories, one column."""
    listed = _columns(_text_csv(spark, path), path, [column])
    return listed.select(F.col(column).alias("cohort_caption"))


def read_pos(
    spark: SparkSession,
    *folders: str,
    format: str = "csv",
    columns: Mapping[str, str] = POS_COLUMNS,
    purchase_days: Iterable[str] | None = None,
    day_column: str = PURCHASE_DAY_HEADER,
    timestamp_format: str | None = None,
    timestamp_type: str = "timestamp",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Sold lines from folders of exports, read by the executors in one scan per folder.

    ``format="workbook"`` reads ``.xlsx`` files, their first sheet or the one ``options`` names as ``sheet``;
    its files may differ in the order of their columns. Any other format is one of Spark's. The files of a folder share one layout; folders are united by column name, so their column
    order may differ. ``purchase_days`` keeps the lines whose ``yyyyMMdd`` purchase day is one
    of the given ``yyyy-MM-dd`` days. Shop codes come out padded.
    """
    if not folders:
        raise ValueError("no folder given")
    wanted = None if purchase_days is None else [day.replace("-", "") for day in purchase_days]

    def lines(folder: str) -> DataFrame:
        kept = [*columns, *([] if wanted is None else [day_column])]
        if format == "workbook":
            df = read_sheets(spark, folder, kept, **(options or {}))
        else:
            settings = {**(_CSV if format == "csv" else {}), **(options or {})}
            df = _columns(spark.read.format(format).options(**settings).load(folder), folder, kept)
        if wanted is not None:
            df = df.where(F.col(day_column).cast("string").isin(wanted))
        return df.select([F.col(theirs).alias(ours) for theirs, ours in columns.items()])

    def typed(df: DataFrame) -> DataFrame:
        when = F.col("datetime")
        if isinstance(df.schema["datetime"].dataType, T.StringType) and timestamp_format:
            parse = F.to_timestamp if timestamp_type == "timestamp" else F.to_timestamp_ntz
            pattern = timestamp_format if parse is F.to_timestamp else F.lit(timestamp_format)
            when = parse(when, pattern)
        elif isinstance(df.schema["datetime"].dataType, T.StringType):
            when = when.cast(timestamp_type)
        return df.select(
            shop_code(df, "shop_code").alias("shop_code"), "item_name", when.alias("datetime")
        )

    united = reduce(DataFrame.unionByName, [typed(lines(folder)) for folder in folders])
    return schemas.check(united, schemas.POS, "pos")


def read_linked(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The linked intermediate with its partition columns as text.

    ``glob`` picks some of its folders, such as ``place=*/year=2025/month=*/dt=*``.
    """
    text = [T.StructField(name, T.StringType()) for name in PARTITIONS]
    reader = spark.read.schema(T.StructType([*schemas.LINKED.fields, *text])).option("basePath", path)
    return reader.parquet(path if glob is None else f"{path.rstrip('/')}/{glob}")
