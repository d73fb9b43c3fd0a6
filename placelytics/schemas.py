"""Logical tables and the check every operator runs on its inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


_COMPETITOR = T.StructField("competitor_id", T.IntegerType())
_DATETIME = T.StructField("datetime", T.TimestampType())

VISITS = T.StructType([*_strings("user_id", "place_id"), _COMPETITOR, *_strings("adid", "date"), _DATETIME])
PLACE_CONFIG = T.StructType([*_strings("user_id", "place_id"), _COMPETITOR])
PLACE_CONFIG_FROM = T.StructType([*PLACE_CONFIG.fields, *_strings("start_date")])
HOME_WORK = T.StructType(
    _strings("adid", "time_category", "prefecture", "city", "block", "start_date", "end_date")
)
AGE_GENDER = T.StructType(
    [*_strings("adid"), T.StructField("age", T.IntegerType()), *_strings("gender", "start_date")]
)
TOPICS = T.StructType(
    [
        *_strings("adid"),
        T.StructField("topic_id", T.IntegerType()),
        *_strings("topic_number", "pattern", "ver"),
    ]
)
COHORTS = T.StructType(
    [
        *_strings("adid", "visit_category"),
        T.StructField("cohortlist", T.ArrayType(T.StringType())),
        *_strings("start_date", "end_date"),
    ]
)
DEVICE_SPOTS = T.StructType(
    _strings("adid", "spot", "prefecture", "city", "address", "start_date", "end_date")
)
SPOT_CATALOG = T.StructType(_strings("spot", "prefecture", "city", "address", "cohort_caption"))
CATEGORIES = T.StructType(_strings("cohort_caption"))
SHOPS = T.StructType(_strings("shop_code", "place_id", "caption"))
POS = T.StructType([*_strings("shop_code", "item_name"), _DATETIME])
SALES = T.StructType([*_strings("shop_code", "place_id", "caption", "item_name"), _DATETIME])
MIN_COUNTS = T.StructType([*_strings("caption", "place_id"), T.StructField("infimum", T.IntegerType())])
LINKED = T.StructType(
    [
        *_strings("user_id", "place_id"),
        _COMPETITOR,
        *_strings("adid", "date", "shop_code", "caption", "item_name"),
    ]
)

DEVICE_DAYS = T.StructType([*_strings("place_id"), _COMPETITOR, *_strings("adid", "date")])
TENANT_DEVICE_DAYS = T.StructType([*_strings("user_id"), *DEVICE_DAYS.fields])

# Columns whose type the data owner chooses; only their presence is checked.
_ANY_TYPE = {"age", "gender", "topic_id", "shop_code"}


class SchemaError(ValueError):
    """An input lacks a column or has one of the wrong type."""


def _same_type(field: T.StructField, found: T.DataType) -> bool:
    if field.name in _ANY_TYPE:
        return True
    if isinstance(field.dataType, T.TimestampType):
        return isinstance(found, (T.TimestampType, T.TimestampNTZType))
    if isinstance(field.dataType, T.IntegerType):
        return isinstance(found, T.IntegralType)
    if isinstance(field.dataType, T.ArrayType):
        return isinstance(found, T.ArrayType) and found.elementType == field.dataType.elementType
    return found == field.dataType


def check(df: DataFrame, schema: T.StructType, table: str, only: Iterable[str] | None = None) -> DataFrame:
    """``df`` unchanged, or a SchemaError that lists every missing and mistyped column."""
    wanted = [f for f in schema.fields if only is None or f.name in set(only)]
    found = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"no column {f.name}" for f in wanted if f.name not in found]
    problems += [
        f"{f.name} is {found[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in wanted
        if f.name in found and not _same_type(f, found[f.name])
    ]
    if problems:
        raise SchemaError(f"{table}: " + "; ".join(problems))
    return df
