from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shopfunnel.operators import clustering, layout
from shopfunnel.schemas import PROCESSED
from tests.rows import events

KEYS = ("event_type", "category_code", "brand")


@pytest.fixture(scope="module")
def log(spark):
    """12,000 events of one day; the three columns know nothing of each other."""
    pick = {
        "event_type": F.element_at(F.array(*map(F.lit, ("view", "cart", "purchase"))), (F.col("id") % 3 + 1).cast("int")),
        "category_code": F.concat(F.lit("electronics.kind"), F.lpad((F.xxhash64("id") % 40).cast("string"), 3, "0")),
        "brand": F.when(F.col("id") % 11 > 0, F.concat(F.lit("b"), F.hash("id") % 60)),
        "event_time": F.lit("2019-10-01 12:00:00").cast("timestamp"),
        "user_session": F.concat(F.lit("s"), "id"),
    }
    full = spark.range(0, 12_000, 1, 8).select(
        *[pick.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PROCESSED.fields]
    )
    return full.withColumn("event_date", F.to_date("event_time")).withColumn("event_month", F.lit("2019-10")).withColumn(
        "event_month_date", F.lit("2019-10-01").cast("date")
    )


def read_share(path, column, value):
    """Share of the row groups a reader cannot skip for ``column = value``, by their min and max."""
    kept = seen = 0
    for file in path.glob("event_date=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(at).statistics
            seen += 1
            kept += stats.has_min_max and stats.min <= value <= stats.max
    return kept / seen


def test_a_filter_on_any_key_skips_row_groups(spark, log, tmp_path):
    conf, key = spark.sparkContext._jsc.hadoopConfiguration(), "parquet.block.size"
    conf.set(key, str(8 * 1024))
    try:
        layout.clustered_table(log, "by_all", KEYS, str(tmp_path / "all"), interleave=True)
        layout.clustered_table(log, "by_first", KEYS, str(tmp_path / "first"))
    finally:
        conf.unset(key)
    least = {c: log.agg(F.max(c)).first()[0] for c in KEYS}
    interleaved, plain = ({c: read_share(tmp_path / p, c, least[c]) for c in KEYS} for p in ("all", "first"))
    assert all(share <= 0.6 for share in interleaved.values()), interleaved
    assert interleaved["brand"] < plain["brand"], (interleaved, plain)
    assert spark.table("by_all").count() == spark.table("by_first").count() == log.count()


def test_the_key_interleaves_ranks(spark):
    values = [(a, b) for a in range(8) for b in "abcdefgh"]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([*values, (None, None)], "a int, b string")
    found = {(r.a, r.b): r.key for r in df.withColumn("key", clustering.interleaved_order(df, ["a", "b"], bits=3)).collect()}
    for (a, b), key in found.items():
        x, y = (a, "abcdefgh".index(b)) if b else (0, 0)
        assert key == sum(((x >> i & 1) << (2 * i + 1)) + ((y >> i & 1) << (2 * i)) for i in range(3))


def test_more_values_than_classes(spark):
    df = spark.range(0, 5_000, 1, 8).select((F.col("id") * 37 % 5_000).alias("v"))
    keys = [r.key for r in df.withColumn("key", clustering.interleaved_order(df, ["v"], bits=4)).orderBy("v").collect()]
    assert keys == sorted(keys) and set(keys) == set(range(16))
    assert max(keys.count(k) for k in range(16)) <= 5_000 / 16 + 1


def test_equal_rows_are_split_and_kept(spark):
    """One combination fills most of the day, told apart by the session only."""
    rows = events(spark, *[{"user_session": f"s{i}"} for i in range(900)], *[{"brand": f"b{i}"} for i in range(50)])
    dealt = clustering.interleaved(rows, KEYS, leading=("event_date",))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 950 and dealt.exceptAll(rows).count() == 0
    assert dealt.columns == rows.columns


def test_odd_tables(spark):
    none = events(spark, {"brand": None, "category_code": None, "event_type": None})
    for rows in (none, none.limit(0)):
        assert clustering.interleaved(rows, KEYS).count() == rows.count()
    with pytest.raises(ValueError, match="63 bits"):
        clustering.interleaved_order(none, KEYS, bits=22)
    with pytest.raises(ValueError, match="63 bits"):
        clustering.interleaved_order(none, [])
