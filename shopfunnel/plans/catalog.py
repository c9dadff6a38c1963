"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfunnel.functions.events import parse_event_time
from shopfunnel.operators import checks, gate, layout, profile, sketches, versions
from shopfunnel.plans import behaviour, models, refresh, reports, warehouse
from shopfunnel.plans.load import load_month
from shopfunnel.schemas import BRONZE, EVENTS, GATED, PROCESSED
from shopfunnel.session import pin_utc, remove, work_path, written
from shopfunnel.sources.csv import first_rows, input_files, month_file, scan_bronze
from shopfunnel.sources.tables import read_events, refresh_external, register_external
from shopfunnel.sources.testlog import event_log, raw_log
from shopfunnel.streaming import clean

Query = Callable[[SparkSession, str], DataFrame]

#: The one month the test tables hold.
MONTH = "2024-01"
#: Columns that order the event log.
LOG_ORDER = ("event_time", "user_id", "product_id", "event_type", "user_session")

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(pin_utc(spark), sf_dir)

    QUERIES[run.__name__] = pinned
    return run


# --- the row-quality gate ---------------------------------------------------------------


@query
def bronze_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.with_typed(raw_log(spark, sf_dir)).drop(*GATED)


@query
def cast_failures_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.quarantined(gate.with_typed(raw_log(spark, sf_dir)))


@query
def cast_failures_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.failures_by_column(gate.with_typed(raw_log(spark, sf_dir)))


@query
def row_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.row_metrics(gate.with_typed(raw_log(spark, sf_dir)))


@query
def row_id_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = gate.with_row_id(raw_log(spark, sf_dir))
    return ids.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("_row_id").alias("ids"))


@query
def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gate.processed(gate.with_typed(raw_log(spark, sf_dir)))
    return gate.with_partition_columns(rows)


# --- files and tables -------------------------------------------------------------------


def _as_csv(spark: SparkSession, sf_dir: str) -> list[str]:
    """The raw log as two CSV datasets, the first and the second half of the month.

    Rows whose time is not readable go with the second.
    """
    raw = raw_log(spark, sf_dir)
    early = F.coalesce(F.dayofmonth(parse_event_time(F.col("event_time"))) <= 15, F.lit(False))
    folder = work_path(spark, "csv")
    halves = raw.withColumn("half", F.when(early, "early").otherwise("late"))
    halves.write.partitionBy("half").csv(folder, header=True)
    return [f"{folder}/half=early", f"{folder}/half=late"]


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_bronze(spark, _as_csv(spark, sf_dir))


@query
def csv_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of the raw log written in order over many files; it ends inside one."""
    folder = work_path(spark, "csv")
    raw_log(spark, sf_dir).orderBy(*BRONZE.names).write.csv(folder, header=True)
    return first_rows(spark, folder, 5_000)


@query
def csv_month_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "processed")
    load_month(spark, _as_csv(spark, sf_dir), root, MONTH)
    return read_events(spark, root)


@query
def csv_month_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarantine = work_path(spark, "quarantine")
    load_month(spark, _as_csv(spark, sf_dir), work_path(spark, "processed"), MONTH, quarantine)
    return spark.read.parquet(f"{quarantine}/event_month={MONTH}")


@query
def csv_month_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a load, as it reports them."""
    metrics = load_month(spark, _as_csv(spark, sf_dir), work_path(spark, "processed"), MONTH)
    fields = {name: int(value) for name, value in asdict(metrics).items()}
    return spark.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in fields.items()])


@query
def csv_month_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month loaded twice as versions, and what is not shown removed."""
    root = work_path(spark, "published")
    for _ in range(2):
        load_month(spark, _as_csv(spark, sf_dir), root, MONTH, versioned=True)
    versions.remove_superseded(spark, root, older_than=-60)
    return read_events(spark, root)


@query
def csv_month_published_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarantine = work_path(spark, "quarantine")
    load_month(spark, _as_csv(spark, sf_dir), work_path(spark, "published"), MONTH, quarantine, versioned=True)
    return spark.read.parquet(f"{quarantine}/event_month={MONTH}")


@query
def csv_month_published_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a load, counted from the footers of what it wrote."""
    metrics = load_month(spark, _as_csv(spark, sf_dir), work_path(spark, "published"), MONTH, versioned=True)
    fields = {name: int(value) for name, value in asdict(metrics).items()}
    return spark.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in fields.items()])


@query
def csv_month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log under the path of its month, listed and read back."""
    folder = work_path(spark, "months")
    path = month_file(folder, MONTH)
    raw_log(spark, sf_dir).coalesce(3).write.csv(path, header=True)
    files = input_files(spark, path).filter(F.col("path").endswith(".csv"))
    full = files.agg(F.every(F.col("bytes") > 0)).first()[0]
    rows = scan_bronze(spark, path).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.withColumn("all_have_bytes", F.lit(full))


@query
def month_replace_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "replaced")
    layout.append_events(event_log(spark, sf_dir), root)
    delivery = written(processed(spark, sf_dir), work_path(spark, "delivery"))
    for _ in range(2):
        layout.replace_month(delivery, root, MONTH)
    return read_events(spark, root)


@query
def append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, each of half the log, read together."""
    log, root = event_log(spark, sf_dir), work_path(spark, "appended")
    layout.append_events(log.filter("product_id % 2 = 0"), root)
    layout.append_events(log.filter("product_id % 2 <> 0"), root)
    return read_events(spark, root)


def _two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with the days after the 15th moved to the next month."""
    log = event_log(spark, sf_dir)
    late = F.dayofmonth("event_time") > 15
    shifted = F.when(late, F.col("event_time") + F.expr("interval 1 month")).otherwise(F.col("event_time"))
    both = gate.with_partition_columns(log.withColumn("event_time", shifted).select(*PROCESSED.names))
    return written(both.select(*EVENTS.names), work_path(spark, "two-months-log"))


def _ten_days(both: DataFrame) -> DataFrame:
    """A delivery of the first month that lacks its last days."""
    return both.filter((F.col("event_month") == MONTH) & (F.dayofmonth("event_time") <= 10))


@query
def month_replace_keeps_other_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days after the 15th belong to the next month; the first month is reloaded with ten days."""
    both, root = _two_months(spark, sf_dir), work_path(spark, "two-months")
    layout.overwrite_events(both, root)
    for _ in range(2):
        layout.replace_month(both.filter(F.dayofmonth("event_time") <= 10), root, MONTH)
    return read_events(spark, root)


def _published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Two months published as versions, and their dataset."""
    both, root = _two_months(spark, sf_dir), work_path(spark, "published")
    for r in both.select("event_month").distinct().collect():
        versions.replace_month(both, root, r.event_month)
    return both, root


@query
def aborted_replace_keeps_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that wrote its rows and stopped before it published them."""
    both, root = _published(spark, sf_dir)
    versions.write_version(_ten_days(both), root, "aborted")
    return read_events(spark, root)


@query
def published_replace_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table that follows a month's replacement, and outlives the old version's files."""
    both, root = _published(spark, sf_dir)

    def build(database: str) -> DataFrame:
        table = f"{database}.events_published"
        register_external(spark, table, root)
        versions.write_version(both, root, "aborted")
        versions.replace_month(_ten_days(both), root, MONTH)
        refresh_external(spark, table, root, [MONTH])
        versions.remove_superseded(spark, root, older_than=-60)
        return spark.table(table).select(*EVENTS.names)

    return _in_database(spark, build)


@query
def published_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended to published months, some twice, around the reload of one of them."""
    both, root = _two_months(spark, sf_dir), work_path(spark, "batches")
    odd = F.col("product_id") % 2 == 1
    for batch in ("batch-1", "batch-1"):
        versions.append_batch(both.filter(odd), root, batch)
    versions.replace_month(_ten_days(both).filter(odd), root, MONTH)
    for batch in ("batch-1", "batch-2", "batch-2"):
        versions.append_batch(both.filter(~odd & ((F.col("event_month") != MONTH) | (F.dayofmonth("event_time") <= 10))), root, batch)
    return read_events(spark, root)


@query
def month_replace_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "replaced")
    layout.overwrite_events(event_log(spark, sf_dir), root)
    delivery = written(processed(spark, sf_dir), work_path(spark, "delivery"))

    def build(database: str) -> DataFrame:
        table = f"{database}.events_replaced"
        register_external(spark, table, root)
        for _ in range(2):
            layout.replace_month_in_table(delivery, table, MONTH)
        return spark.table(table).select(*EVENTS.names)

    return _in_database(spark, build)


def _events_per(keys: list[str], table: DataFrame) -> DataFrame:
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))


@query
def external_table_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "external")
    layout.overwrite_events(event_log(spark, sf_dir), root)
    keys = ["event_month", "event_date"]
    return _in_database(spark, lambda db: _events_per(keys, register_external(spark, f"{db}.events_by_day", root)))


@query
def partitioned_table_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    return _in_database(spark, lambda db: layout.partitioned_table(log, f"{db}.events_partitioned").select(*EVENTS.names))


@query
def clustered_table_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    keys = ["event_date", "event_type"]
    return _in_database(spark, lambda db: _events_per(keys, layout.clustered_table(log, f"{db}.events_by_type")))


@query
def interleaved_table_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day under a filter on each of the columns a table is clustered by at once."""
    log = event_log(spark, sf_dir)
    cluster_by = ("event_type", "category_code", "brand")

    def build(database: str) -> DataFrame:
        table = layout.clustered_table(log, f"{database}.events_interleaved", cluster_by, interleave=True)
        least = table.agg(*[F.min(c).alias(c) for c in cluster_by])
        parts = [
            _events_per(["event_date", c], table.filter(F.col(c) == least.select(c).scalar())).select(
                F.lit(c).alias("filtered"), F.col(c).alias("value"), "event_date", "events"
            )
            for c in cluster_by
        ]
        return parts[0].unionAll(parts[1]).unionAll(parts[2])

    return _in_database(spark, build)


def _from_warehouse(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of a warehouse built from the log."""
    root = work_path(spark, "processed")
    layout.overwrite_events(event_log(spark, sf_dir), root)

    def build(database: str) -> DataFrame:
        warehouse.build_event_tables(spark, root, database)
        warehouse.build_models(spark, database)
        return spark.table(f"{database}.{table}")

    return _in_database(spark, build)


def _refreshed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of a warehouse built from two months, after one was reloaded and refreshed."""
    both, root = _published(spark, sf_dir)

    def build(database: str) -> DataFrame:
        refresh.refresh(spark, root, database)
        versions.replace_month(_ten_days(both), root, MONTH)
        refresh.refresh(spark, root, database, [MONTH])
        if table == refresh.CHECKS_TABLE:
            return refresh.merged_checks(spark, database)
        return spark.table(f"{database}.{table}").select(*refresh.TABLES[table][0].names)

    return _in_database(spark, build)


@query
def refreshed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, warehouse.CLUSTERED)


@query
def refreshed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, warehouse.FACT_TABLE)


@query
def refreshed_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, warehouse.MONTHLY_TABLE)


@query
def refreshed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, warehouse.DAILY_TABLE)


@query
def refreshed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, refresh.CHECKS_TABLE)


#: Ranges of days that overlap, span the two months, or hold one day.
RANGES = [
    (date(2024, 1, 1), date(2024, 1, 10)),
    (date(2024, 1, 8), date(2024, 2, 20)),
    (date(2024, 2, 25), date(2024, 2, 25)),
]


@query
def refreshed_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of ranges of days, and whether the sketches kept by a refresh tell them within their bound."""
    both, root = _published(spark, sf_dir)

    def build(database: str) -> DataFrame:
        refresh.refresh(spark, root, database)
        versions.replace_month(_ten_days(both), root, MONTH)
        refresh.refresh(spark, root, database, [MONTH])
        keys = ["first_day", "last_day", "column_name"]
        kept = spark.table(f"{database}.{refresh.DISTINCT_TABLE}")
        told = sketches.distinct_in_ranges(kept, RANGES).withColumnRenamed("distinct_values", "told")
        log = sketches.in_ranges(spark.table(f"{database}.{warehouse.CLUSTERED}"), RANGES)
        counts = profile.value_counts(log, PROCESSED.names, keys[:2])
        exact = counts.groupBy(*keys).agg(F.count("value").alias("distinct_values"))
        off = F.abs(F.col("told") - F.col("distinct_values"))
        return exact.join(told, keys, "left").select(
            *keys,
            "distinct_values",
            (off <= sketches.error_bound() * F.col("distinct_values")).alias("within_bound"),
        )

    return _in_database(spark, build)


@query
def warehouse_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_in_order(_from_warehouse(spark, sf_dir, warehouse.DAILY_TABLE))


@query
def warehouse_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.monthly_in_order(_from_warehouse(spark, sf_dir, warehouse.MONTHLY_TABLE))


@query
def warehouse_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_warehouse(spark, sf_dir, warehouse.FACT_TABLE)


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of the processed and the quarantined rows of the raw log, read as a stream."""
    folder = _as_csv(spark, sf_dir)[0].rsplit("/", 1)[0]
    root, quarantine = work_path(spark, "streamed"), work_path(spark, "stream-quarantine")
    stream = clean.bronze_stream(spark, f"{folder}/*", files_per_batch=4)
    clean.start(stream, root, work_path(spark, "stream-state"), quarantine).awaitTermination()
    return root, quarantine


@query
def stream_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, _streamed(spark, sf_dir)[0])


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_streamed(spark, sf_dir)[1]).drop("batch")


# --- models -----------------------------------------------------------------------------


@query
def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.staging(event_log(spark, sf_dir))


@query
def fact_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.funnel_fact(staging(spark, sf_dir))


@query
def funnel_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.monthly_in_order(models.monthly_mart(fact_funnel(spark, sf_dir)))


@query
def funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_in_order(models.daily_mart(fact_funnel(spark, sf_dir)))


@query
def funnel_daily_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = models.funnel_fact(models.staging(processed(spark, sf_dir)))
    return models.daily_in_order(models.daily_mart(fact))


@query
def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging(spark, sf_dir)
    fact = models.funnel_fact(staged)
    monthly, daily = models.monthly_mart(fact), models.daily_mart(fact)
    first, *rest = warehouse.check_models(staged, fact, monthly, daily)
    for more in rest:
        first = first.unionByName(more)
    return first


@query
def check_results_on_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    return checks.check(log, "event_log", checks.STAGING_CHECKS, EVENTS)


# --- profile ----------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(*PROCESSED.names)


@query
def profile_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(_log(spark, sf_dir))


@query
def profile_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.info(_log(spark, sf_dir))


@query
def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing(_log(spark, sf_dir))


@query
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.numeric_summary(_log(spark, sf_dir))
    inexact = {c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")}
    return summary.withColumns(inexact)


@query
def profile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers, among them ids of 19 digits that no double tells apart, as text."""
    log = _log(spark, sf_dir).withColumns(
        {
            "listing_id": 2053013555631882655 + F.col("product_id"),
            "account_id": -9223372036854775807 + 3 * F.col("user_id"),
        }
    )
    columns = ["product_id", "category_id", "user_id", "listing_id", "account_id"]
    summary = profile.exact_summary(log, columns)
    return summary.withColumns({c: F.col(c).cast("string") for c in ("min", "p25", "p50", "p75", "max")})


@query
def profile_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.text_summary(_log(spark, sf_dir))


@query
def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_rows(_log(spark, sf_dir).select("event_type", "product_id", "brand", "user_session"))


@query
def profile_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows, on a log that holds some twice."""
    log = _log(spark, sf_dir)
    return profile.duplicate_rows(log.unionByName(log.filter("product_id % 3 = 0")))


@query
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(_log(spark, sf_dir))


@query
def profile_event_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.event_mix(_log(spark, sf_dir))


@query
def profile_event_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.event_ratios(_log(spark, sf_dir))


@query
def profile_cardinalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.cardinalities(_log(spark, sf_dir))


@query
def profile_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.price_profile(_log(spark, sf_dir)).withColumns(
        {c: F.round(c, 4) for c in ("mean", "median")}
    )


@query
def head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    first = profile.head(log, LOG_ORDER).withColumn("part", F.lit("head"))
    return first.unionByName(profile.tail(log, LOG_ORDER).withColumn("part", F.lit("tail")))


@query
def sample_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    whole = profile.shape(log).withColumn("scope", F.lit("all"))
    return whole.unionByName(profile.shape(profile.sample(log, 5_000)).withColumn("scope", F.lit("sample")))


# --- reports ----------------------------------------------------------------------------


@query
def report_monthly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.monthly_rates(models.monthly_mart(fact_funnel(spark, sf_dir)))


@query
def report_rates_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rates_by(models.monthly_mart(fact_funnel(spark, sf_dir)), "category_main")


@query
def report_rates_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rates_by(models.monthly_mart(fact_funnel(spark, sf_dir)), "brand")


@query
def report_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_trend(models.daily_mart(fact_funnel(spark, sf_dir)))


@query
def report_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_volume(models.daily_mart(fact_funnel(spark, sf_dir)))


@query
def report_stage_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stage_distribution(fact_funnel(spark, sf_dir))


@query
def report_category_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_stages(fact_funnel(spark, sf_dir))


@query
def report_stage_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stage_detail(fact_funnel(spark, sf_dir))


@query
def report_event_type_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.event_type_by_hour(event_log(spark, sf_dir))


# --- behaviour --------------------------------------------------------------------------


@query
def session_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.session_lengths(staging(spark, sf_dir))


@query
def views_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.views_before_purchase(staging(spark, sf_dir))


@query
def repeat_purchasers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.repeat_purchasers(staging(spark, sf_dir))


@query
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.top_by(staging(spark, sf_dir), "product_id")


@query
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.top_by(staging(spark, sf_dir), "category_main")


@query
def brand_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.brand_revenue(staging(spark, sf_dir))


@query
def cart_abandonment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.cart_abandonment(fact_funnel(spark, sf_dir))


@query
def hourly_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.hourly_peaks(staging(spark, sf_dir))


@query
def weekday_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.weekday_traffic(staging(spark, sf_dir))


@query
def daily_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.daily_change(staging(spark, sf_dir))


@query
def user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.user_segments(fact_funnel(spark, sf_dir))


@query
def weekly_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.retention(staging(spark, sf_dir), "week")


def _in_database(spark: SparkSession, build: Callable[[str], DataFrame]) -> DataFrame:
    """What ``build`` makes of a database of its own, which is dropped when its rows are kept."""
    name, path = f"shopfunnel_{uuid.uuid4().hex[:12]}", work_path(spark, "database")
    spark.sql("CREATE DATABASE IDENTIFIER(:name) LOCATION :path", args={"name": name, "path": path})
    try:
        return written(build(name), work_path(spark, "from-database"))
    finally:
        spark.sql("DROP DATABASE IDENTIFIER(:name) CASCADE", args={"name": name})
        remove(spark, path)
