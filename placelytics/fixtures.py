"""The driver's synthetic tables as the library's logical tables.

``purchase`` events play the sales, all other events the visits; customers are devices,
suppliers are spots. These are test devices, not realistic data: the prefecture is a region
name, the cohort an order priority.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Query parameters on these tables.
PREFECTURES = ("ASIA", "AMERICA", "EUROPE")
CATEGORIES = ("cat_0", "cat_1")
CATEGORY = "interest"
SNAPSHOT = "2024-01-01"
CONFIG_START = "2024-01-03"
LINK = dt.timedelta(minutes=30)

MONTHS = (("2023-12-01", "2023-12-31"), ("2024-01-01", "2024-01-31"))

# Columns read from the driver's tables. With the schema given, planning opens no file.
RAW = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_suppkey BIGINT",
    "events": "ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
}


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _literals(*rows: dict[str, str]) -> Column:
    """One row per given row of constants."""
    return F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows]))


class Tables:
    """Logical tables over the Parquet files of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def _raw(self, name: str) -> DataFrame:
        return self._spark.read.schema(RAW[name]).parquet(f"{self._dir}/{name}.parquet")

    @cached_property
    def _events(self) -> DataFrame:
        """Events with the number in ``props``.

        Read with a generator: filters on ``k`` cannot slip below it, so each document is parsed
        once and not again for every filter.
        """
        k = F.json_tuple("props", "k").alias("k")
        return (
            self._raw("events")
            .select("ts", "event_type", "user_id", k)
            .withColumn("k", F.col("k").cast("int"))
        )

    @cached_property
    def visits(self) -> DataFrame:
        kind = F.col("event_type")
        shop = F.col("k") % 4
        return self._events.where(kind != "purchase").select(
            F.when(shop < 2, "T1").otherwise("T2").alias("user_id"),
            F.concat(F.lit("P"), shop.cast("string")).alias("place_id"),
            F.when(kind == "signup", 1).when(kind == "error", 2).otherwise(0).alias("competitor_id"),
            _text("user_id").alias("adid"),
            F.col("ts").cast("date").cast("string").alias("date"),
            F.col("ts").alias("datetime"),
        )

    @cached_property
    def device_numbers(self) -> DataFrame:
        """The dictionary of devices; a test device is its own number."""
        seen = self._raw("events").select("user_id").where(F.col("user_id").isNotNull()).distinct()
        return seen.select(_text("user_id").alias("adid"), F.col("user_id").alias("number"))

    @cached_property
    def place_config(self) -> DataFrame:
        """At most 12 rows at any scale: four places, each under three competitor ids.

        That bound, not an estimate, is why it is marked for broadcast.
        """
        p3_rival = (F.col("place_id") == "P3") & (F.col("competitor_id") == 2)
        p2_own = (F.col("place_id") == "P2") & (F.col("competitor_id") == 0)
        config = (
            self.visits.select("user_id", "place_id", "competitor_id")
            .where(~p3_rival & ~p2_own)
            .distinct()
            .withColumn("start_date", F.lit(CONFIG_START))
        )
        return F.broadcast(config)

    @cached_property
    def shops(self) -> DataFrame:
        """At most 4 rows at any scale, hence marked for broadcast."""
        shop = (F.col("k") % 4).cast("string")
        return F.broadcast(
            self._events.select(shop.alias("shop"))
            .distinct()
            .select(
                F.lpad("shop", 3, "0").alias("shop_code"),
                F.concat(F.lit("P"), "shop").alias("place_id"),
                F.concat(F.lit("shop_"), "shop").alias("caption"),
            )
        )

    @cached_property
    def pos(self) -> DataFrame:
        k = F.col("k")
        item = F.concat(F.lit("item_"), (k % 7).cast("string"))
        return self._events.where(F.col("event_type") == "purchase").select(
            (k % 4).alias("shop_code"),
            F.when(k % 14 == 13, None).otherwise(item).alias("item_name"),
            F.col("ts").alias("datetime"),
        )

    @cached_property
    def min_counts(self) -> DataFrame:
        infimum = F.when(F.col("shop_code") == "002", 3).otherwise(2)
        return self.shops.where(F.col("shop_code") != "003").select(
            "caption", "place_id", infimum.alias("infimum")
        )

    @cached_property
    def _nations(self) -> DataFrame:
        """Nation with region name; 25 rows at any scale."""
        named = self._raw("nation").join(
            F.broadcast(self._raw("region")), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return F.broadcast(
            named.select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("prefecture"))
        )

    @cached_property
    def home_work(self) -> DataFrame:
        end = F.when(F.col("c_custkey") % 3 == 0, "2024-01-15").otherwise("2024-01-31")
        return (
            self._raw("customer")
            .join(self._nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _text("c_custkey").alias("adid"),
                F.explode(F.array(F.lit("home"), F.lit("work"))).alias("time_category"),
                "prefecture",
                "city",
                F.col("c_mktsegment").alias("block"),
                F.lit("2024-01-01").alias("start_date"),
                end.alias("end_date"),
            )
        )

    @cached_property
    def age_gender(self) -> DataFrame:
        months = F.array(*[F.lit(start) for start, _ in MONTHS])
        earlier = (F.col("start_date") < SNAPSHOT).cast("int")
        return self._raw("customer").withColumn("start_date", F.explode(months)).select(
            _text("c_custkey").alias("adid"),
            ((F.col("c_custkey") + earlier) % 7 * 10).cast("int").alias("age"),
            F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
            "start_date",
        )

    @cached_property
    def topics(self) -> DataFrame:
        models = (("2025-01-01", "10"), ("2025-01-01", "5"), ("2024-01-01", "10"))
        rows = [
            {"pattern": pattern, "ver": ver, "topic_number": number}
            for pattern in ("preference", "behavior")
            for ver, number in models
        ]
        return (
            self._raw("customer")
            .select(
                _text("c_custkey").alias("adid"),
                (F.col("c_nationkey") % 4).alias("topic_id"),
                _literals(*rows).alias("model"),
            )
            .select("adid", "topic_id", "model.topic_number", "model.pattern", "model.ver")
        )

    @cached_property
    def cohorts(self) -> DataFrame:
        category = F.when(F.col("o_orderstatus") == "P", "other").otherwise(CATEGORY)
        end = F.when(F.col("o_custkey") % 4 == 0, "2024-01-20").otherwise("2024-01-31")
        return (
            self._raw("orders")
            .groupBy("o_custkey", category.alias("visit_category"))
            .agg(F.collect_set("o_orderpriority").alias("cohortlist"))
            .select(
                _text("o_custkey").alias("adid"),
                "visit_category",
                "cohortlist",
                F.lit("2024-01-01").alias("start_date"),
                end.alias("end_date"),
            )
        )

    @cached_property
    def _suppliers(self) -> DataFrame:
        return (
            self._raw("supplier")
            .join(self._nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("s_name").alias("spot"), "prefecture", "city")
        )

    @cached_property
    def spot_catalog(self) -> DataFrame:
        category = F.concat(F.lit("cat_"), (F.col("s_suppkey") % 5).cast("string"))
        return self._suppliers.select(
            "spot", "prefecture", "city", _text("s_suppkey").alias("address"), category.alias("cohort_caption")
        )

    @cached_property
    def categories(self) -> DataFrame:
        rows = ", ".join(f"('{c}')" for c in CATEGORIES)
        return self._spark.sql(f"SELECT * FROM VALUES {rows} AS c(cohort_caption)")

    @cached_property
    def device_spots(self) -> DataFrame:
        bought = (
            self._raw("lineitem")
            .join(self._raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select("o_custkey", "l_suppkey")
            .distinct()
        )
        months = [{"start_date": start, "end_date": end} for start, end in MONTHS]
        return (
            bought.join(self._suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .withColumn("month", _literals(*months))
            .select(
                _text("o_custkey").alias("adid"),
                "spot",
                "prefecture",
                "city",
                _text("s_suppkey").alias("address"),
                "month.start_date",
                "month.end_date",
            )
        )
