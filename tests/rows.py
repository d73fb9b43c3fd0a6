"""Small hand-made inputs."""

import datetime as dt

from placelytics import schemas


def table(spark, schema, *rows, **defaults):
    """Rows as dicts; columns left out take the given default or null."""
    names = schema.names
    return spark.createDataFrame([tuple({**defaults, **r}.get(n) for n in names) for r in rows], schema)


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def visit(place="A", rival=0, adid="d1", when="2024-01-10T12:00:00", **other):
    moment = at(when)
    return {
        "user_id": "T",
        "place_id": place,
        "competitor_id": rival,
        "adid": adid,
        "date": when[:10],
        "datetime": moment,
        **other,
    }


def visits(spark, *rows):
    return table(spark, schemas.VISITS, *rows)


def config(spark, *places, start="2024-01-01"):
    """Places as (place_id, competitor_id) or (place_id, competitor_id, start_date)."""
    rows = [
        {"user_id": "T", "place_id": p[0], "competitor_id": p[1], "start_date": p[2] if len(p) > 2 else start}
        for p in places
    ]
    return table(spark, schemas.PLACE_CONFIG_FROM, *rows)


def sales(spark, *rows):
    defaults = {"shop_code": "001", "place_id": "A", "caption": "shop", "item_name": "tea"}
    moments = [{**r, "datetime": at(r["datetime"])} for r in rows]
    return table(spark, schemas.SALES, *moments, **defaults)


def linked(spark, *rows):
    defaults = {
        "user_id": "T",
        "place_id": "A",
        "competitor_id": 0,
        "adid": "d1",
        "date": "2024-01-10",
        "shop_code": "001",
        "caption": "shop",
        "item_name": "tea",
    }
    return table(spark, schemas.LINKED, *rows, **defaults)


def device_days(spark, *rows):
    return visits(spark, *rows).select("place_id", "competitor_id", "adid", "date").distinct()


def rows_of(df, *columns):
    """Sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
