"""Small inputs shared by the tests."""

from __future__ import annotations

from datetime import datetime

from shopfunnel.operators.gate import with_partition_columns
from shopfunnel.schemas import BRONZE, PROCESSED

CLEAN = {
    "event_time": "2021-03-05 08:15:20 UTC",
    "event_type": "view",
    "product_id": "58",
    "category_id": "640",
    "category_code": "garden.tools.rake",
    "brand": "oakley",
    "price": "23.75",
    "user_id": "417",
    "user_session": "b2-77",
}


def bronze(spark, *rows):
    """Raw rows, each the clean one with some columns replaced."""
    full = [{**CLEAN, **row} for row in rows]
    return spark.createDataFrame([tuple(r[c] for c in BRONZE.names) for r in full], BRONZE)


def events(spark, *rows):
    """Processed rows with partition columns, each the clean one with some columns replaced."""
    base = {
        **CLEAN,
        "event_time": "2019-10-01 12:00:00",
        "product_id": 58,
        "category_id": 640,
        "price": 10.0,
        "user_id": 417,
    }
    full = [{**base, **row} for row in rows]
    for r in full:
        r["event_time"] = datetime.fromisoformat(r["event_time"])
    return with_partition_columns(
        spark.createDataFrame([tuple(r[c] for c in PROCESSED.names) for r in full], PROCESSED)
    )
