"""Declared schemas of every row set, and the checks that hold data to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


class ContractError(ValueError):
    """A row set does not have the columns and types its contract declares."""


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


# Fixed column names, order and types of the event log and of the tables built from it.
PROCESSED = _schema(
    event_time=TIMESTAMP,
    event_type=STRING,
    product_id=LONG,
    category_id=LONG,
    category_code=STRING,
    brand=STRING,
    price=DOUBLE,
    user_id=LONG,
    user_session=STRING,
)
PARTITIONS = _schema(event_month_date=DATE, event_date=DATE, event_month=STRING)
FACT = _schema(
    user_id=LONG,
    user_session=STRING,
    product_id=LONG,
    category_main=STRING,
    brand=STRING,
    price=DOUBLE,
    event_date=DATE,
    event_month=STRING,
    event_month_date=DATE,
    has_view=LONG,
    has_cart=LONG,
    has_purchase=LONG,
    funnel_stage=STRING,
)
MONTHLY = _schema(
    event_month=STRING,
    event_month_date=DATE,
    category_main=STRING,
    brand=STRING,
    view_count=LONG,
    cart_count=LONG,
    purchase_count=LONG,
    view_to_cart_rate=DOUBLE,
    cart_to_purchase_rate=DOUBLE,
    overall_conversion_rate=DOUBLE,
)
DAILY = _schema(
    event_date=DATE,
    event_month=STRING,
    event_month_date=DATE,
    category_main=STRING,
    brand=STRING,
    view_sessions=LONG,
    view_to_cart_sessions=LONG,
    cart_sessions=LONG,
    cart_to_purchase_sessions=LONG,
    view_to_purchase_sessions=LONG,
    view_to_cart_rate=DOUBLE,
    cart_to_purchase_rate=DOUBLE,
    overall_conversion_rate=DOUBLE,
)

#: The raw log: the processed columns, every one a string.
BRONZE = _schema(**{name: STRING for name in PROCESSED.names})
#: What the tables hold: processed rows plus the derived date columns.
EVENTS = T.StructType(PROCESSED.fields + PARTITIONS.fields)
#: The staging view adds the top-level category behind the full category path.
STAGING = T.StructType(
    EVENTS.fields[:5] + [T.StructField("category_main", STRING, True)] + EVENTS.fields[5:]
)

#: Columns the raw log may fail to convert, in the order a failure reason lists them.
GATED = ("event_time", "product_id", "category_id", "price", "user_id")
#: Columns without which an event cannot be placed.
KEYS = ("event_time", "user_id", "product_id")
#: Stages of the funnel, first to last; also the event types the models accept.
STAGES = ("view", "cart", "purchase")

# Fixed column descriptions of the source table.
COLUMN_DOCS = {
    "event_time": "Time of the event, UTC",
    "event_type": "Kind of event: view, cart or purchase",
    "product_id": "Product the event is about",
    "category_id": "Category of the product",
    "category_code": "Dotted category path, such as electronics.smartphone",
    "brand": "Brand of the product",
    "price": "Price of the product",
    "user_id": "User behind the event",
    "user_session": "Session the event belongs to",
    "event_date": "Day of the event (partition)",
    "event_month": "Month of the event as yyyy-MM (partition)",
    "event_month_date": "First day of the event's month",
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order, each cast to its declared type.

    A cast to the type a column already has disappears from the plan.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def contract_breaches(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Every difference in column names or types; nullability is not part of a contract."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    return [
        f"{name}: declared {want.get(name, 'absent')}, found {have.get(name, 'absent')}"
        for name in sorted(have.keys() | want.keys())
        if have.get(name) != want.get(name)
    ]


def assert_contract(df: DataFrame, declared: T.StructType, name: str) -> DataFrame:
    """``df`` unchanged, or :class:`ContractError`; decided from the plan, without a job."""
    breaches = contract_breaches(df.schema, declared)
    if breaches:
        raise ContractError(f"{name} breaks its contract: " + "; ".join(breaches))
    return df
