"""The registered queries in plain SQL over the same tables, to compare results with."""

from __future__ import annotations

from shopfunnel.schemas import BRONZE, EVENTS, GATED, PROCESSED, STAGING
from shopfunnel.sources.testlog import BAD, LACKING

LOG_COLUMNS = ", ".join(PROCESSED.names)
EVENT_COLUMNS = ", ".join(EVENTS.names)
QUARANTINE_COLUMNS = ", ".join(f"{c}_raw" if c in GATED else c for c in BRONZE.names)

SQL_TYPES = {
    "timestamp": "TIMESTAMP",
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
}


def _defective(column: str, text: str) -> str:
    cases = f"WHEN k IN ({', '.join(map(str, BAD[column]))}) THEN 'bad_{column}' "
    if column in LACKING:
        cases += f"WHEN k IN ({', '.join(map(str, LACKING[column]))}) THEN NULL "
    return f"CASE {cases}ELSE {text} END AS {column}"


KEYED = """
keyed AS (
  SELECT *, (user_id // 3) * 5 + k % 5 AS product_id
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)
),
keyed_log AS (
  SELECT k,
    date_trunc('second', ts) AS event_time,
    CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
    product_id,
    1000 + CAST(p_size AS BIGINT) AS category_id,
    CASE WHEN p_size > 15 THEN lower(p_type) || '.' || split_part(p_name, ' ', 2) END AS category_code,
    CASE WHEN p_size > 4 AND p_size NOT BETWEEN 16 AND 18 THEN p_brand END AS brand,
    p_retailprice AS price,
    user_id,
    CASE WHEN k <> 99 THEN user_id || '-' || strftime(ts, '%Y-%m-%d') END AS user_session
  FROM keyed LEFT JOIN part ON product_id = p_partkey
)"""

DATED = """,
    CAST(date_trunc('month', event_time) AS DATE) AS event_month_date,
    CAST(event_time AS DATE) AS event_date,
    strftime(event_time, '%Y-%m') AS event_month"""

LOG = f"{KEYED}, log AS (SELECT {LOG_COLUMNS}{DATED} FROM keyed_log)"

_MOVED = f"""{KEYED}, moved AS (
  SELECT * REPLACE (CASE WHEN day(event_time) > 15 THEN event_time + INTERVAL 1 MONTH ELSE event_time END AS event_time)
  FROM keyed_log
), log AS (SELECT {LOG_COLUMNS}{DATED} FROM moved"""
#: Days after the 15th in the next month; and with the first month loaded again, with ten days.
TWO_MONTHS = f"{_MOVED})"
RELOADED = f"{_MOVED} WHERE day(event_time) <= 10 OR day(event_time) > 15)"

RAW = f"""{KEYED}, raw AS (
  SELECT {_defective("event_time", "strftime(event_time, '%Y-%m-%d %H:%M:%S') || ' UTC'")},
    event_type,
    {_defective("product_id", "CAST(product_id AS VARCHAR)")},
    {_defective("category_id", "CAST(category_id AS VARCHAR)")},
    category_code, brand,
    {_defective("price", "CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR)")},
    {_defective("user_id", "CAST(user_id AS VARCHAR)")},
    user_session
  FROM keyed_log
), typed AS (
  SELECT event_type, category_code, brand, user_session,
    event_time AS event_time_raw,
    try_strptime(regexp_replace(event_time, ' UTC$', ''), '%Y-%m-%d %H:%M:%S') AS event_time_typed,
    {", ".join(
        f"{c} AS {c}_raw, TRY_CAST({c} AS {SQL_TYPES[PROCESSED[c].dataType.simpleString()]}) AS {c}_typed"
        for c in GATED[1:]
    )}
  FROM raw
)"""

FAILED = {c: f"({c}_raw IS NOT NULL AND {c}_typed IS NULL)" for c in GATED}
ANY_FAILED = " OR ".join(FAILED.values())
REASON = "concat_ws(', ', " + ", ".join(f"CASE WHEN {p} THEN '{c}' END" for c, p in FAILED.items()) + ")"
HAS_KEYS = "(event_time_typed IS NOT NULL AND user_id_typed IS NOT NULL AND product_id_typed IS NOT NULL)"
BAD_KEY = f"({FAILED['event_time']} OR {FAILED['user_id']} OR {FAILED['product_id']})"

GATED_ROWS = f"""{RAW}, kept AS (
  SELECT {", ".join(f"{c}_typed AS {c}" if c in GATED else c for c in PROCESSED.names)}
  FROM typed WHERE {HAS_KEYS}
), log AS (SELECT {LOG_COLUMNS}{DATED} FROM kept)"""

STAGE_NAMES = ("view", "cart", "purchase")

MODELS = f""", staged AS (
  SELECT {", ".join(
      "split_part(category_code, '.', 1) AS category_main" if c == "category_main" else c for c in STAGING.names
  )}
  FROM log
  WHERE event_type IN ('view', 'cart', 'purchase')
    AND user_id IS NOT NULL AND user_session IS NOT NULL AND product_id IS NOT NULL
), fact AS (
  SELECT *, [{", ".join(f"'{stage}'" for stage in STAGE_NAMES)}][greatest(has_view, 2 * has_cart, 3 * has_purchase)] AS funnel_stage
  FROM (
    SELECT user_id, user_session, product_id, category_main, brand, price, event_date, event_month,
      event_month_date,
      {", ".join(f"CAST(bool_or(event_type = '{stage}') AS BIGINT) AS has_{stage}" for stage in STAGE_NAMES)}
    FROM staged GROUP BY ALL
  )
)"""


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def _rate(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, 2)"


MONTHLY_RATES = f"""
    {_rate("cart_count", "view_count")} AS view_to_cart_rate,
    {_rate("purchase_count", "cart_count")} AS cart_to_purchase_rate,
    {_rate("purchase_count", "view_count")} AS overall_conversion_rate"""
DAILY_RATES = f"""
    {_rate("view_to_cart_sessions", "view_sessions")} AS view_to_cart_rate,
    {_rate("cart_to_purchase_sessions", "cart_sessions")} AS cart_to_purchase_rate,
    {_rate("view_to_purchase_sessions", "view_sessions")} AS overall_conversion_rate"""

MARTS = f"""{MODELS}, monthly AS (
  SELECT *, {MONTHLY_RATES} FROM (
    SELECT event_month, event_month_date, category_main, brand,
      {_count("has_view = 1")} AS view_count,
      {_count("has_view = 1 AND has_cart = 1")} AS cart_count,
      {_count("has_view = 1 AND has_cart = 1 AND has_purchase = 1")} AS purchase_count
    FROM fact GROUP BY ALL
  ) WHERE view_count > 0
), daily AS (
  SELECT *, {DAILY_RATES} FROM (
    SELECT event_date, event_month, event_month_date, category_main, brand,
      {_count("has_view = 1")} AS view_sessions,
      {_count("has_view = 1 AND has_cart = 1")} AS view_to_cart_sessions,
      {_count("has_cart = 1")} AS cart_sessions,
      {_count("has_cart = 1 AND has_purchase = 1")} AS cart_to_purchase_sessions,
      {_count("has_view = 1 AND has_purchase = 1")} AS view_to_purchase_sessions
    FROM fact GROUP BY ALL
  )
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def _sums(*columns: str) -> str:
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in columns)


MONTHLY_SUMS = _sums("view_count", "cart_count", "purchase_count")
DAILY_SUMS = _sums(
    "view_sessions",
    "view_to_cart_sessions",
    "cart_sessions",
    "cart_to_purchase_sessions",
    "view_to_purchase_sessions",
)
NUMERIC = ("product_id", "category_id", "price", "user_id")
TEXT = ("event_type", "category_code", "brand", "user_session")
ORDER = ("event_time", "user_id", "product_id", "event_type", "user_session")


def _gate() -> dict[str, str]:
    processed = _with(GATED_ROWS, f"SELECT {EVENT_COLUMNS} FROM log")
    quarantine = _with(
        RAW, f"SELECT {QUARANTINE_COLUMNS}, {REASON} AS failure_reason FROM typed WHERE {ANY_FAILED}"
    )
    load_metrics = _with(
        RAW,
        f"""
SELECT count(*) AS total, {_count(ANY_FAILED)} AS cast_failed, {_count(HAS_KEYS)} AS processed,
  {_count(f"NOT {HAS_KEYS}")} AS dropped, CAST(0 AS BIGINT) AS misfiled
FROM typed""",
    )
    return {
        "bronze_typed": _with(RAW, "SELECT * FROM typed"),
        "cast_failures_labeled": quarantine,
        "csv_month_quarantine": quarantine,
        "stream_quarantine": quarantine,
        "row_id_uniqueness": _with(RAW, "SELECT count(*) AS row_count, count(*) AS ids FROM raw"),
        "cast_failures_by_column": _with(
            RAW,
            _union(f"SELECT '{c}' AS column_name, {_count(p)} AS failures FROM typed" for c, p in FAILED.items()),
        ),
        "row_metrics": _with(
            RAW,
            f"""
SELECT *, coalesce(cast_failed / nullif(total, 0), 0) AS cast_failed_rate,
  coalesce(processed / nullif(total, 0), 0) AS processed_rate
FROM (
  SELECT count(*) AS total, {_count(ANY_FAILED)} AS cast_failed, {_count(HAS_KEYS)} AS processed,
    {_count(f"NOT {HAS_KEYS} AND {BAD_KEY}")} AS dropped_bad_key,
    {_count(f"NOT {HAS_KEYS} AND NOT {BAD_KEY}")} AS dropped_null_key
  FROM typed
)""",
        ),
        "processed": processed,
        "csv_scan": _with(RAW, f"SELECT {', '.join(BRONZE.names)} FROM raw"),
        "csv_first_rows": _with(
            RAW,
            f"SELECT {', '.join(BRONZE.names)} FROM raw ORDER BY "
            + ", ".join(f"{c} NULLS FIRST" for c in BRONZE.names) + " LIMIT 5000",
        ),
        "csv_month_load": processed,
        "month_replace_roundtrip": processed,
        "month_replace_in_table": processed,
        "stream_processed": processed,
        "csv_month_published": processed,
        "csv_month_published_quarantine": quarantine,
        "csv_month_published_metrics": load_metrics,
        "csv_month_metrics": load_metrics,
        "csv_month_files": _with(RAW, "SELECT count(*) > 0 AS all_have_bytes, count(*) AS row_count FROM raw"),
        "append_events": _with(LOG, f"SELECT {EVENT_COLUMNS} FROM log"),
        "partitioned_table_by_day": _with(LOG, f"SELECT {EVENT_COLUMNS} FROM log"),
        "month_replace_keeps_other_months": _with(RELOADED, f"SELECT {EVENT_COLUMNS} FROM log"),
        "published_replace_in_table": _with(RELOADED, f"SELECT {EVENT_COLUMNS} FROM log"),
        "published_batches": _with(RELOADED, f"SELECT {EVENT_COLUMNS} FROM log"),
        "aborted_replace_keeps_month": _with(TWO_MONTHS, f"SELECT {EVENT_COLUMNS} FROM log"),
        "external_table_by_day": _with(
            LOG, "SELECT event_month, event_date, count(*) AS events FROM log GROUP BY ALL"
        ),
        "interleaved_table_filters": _with(
            LOG,
            _union(
                f"""
SELECT '{c}' AS filtered, {c} AS value, event_date, count(*) AS events FROM log
WHERE {c} = (SELECT min({c}) FROM log) GROUP BY ALL"""
                for c in ("event_type", "category_code", "brand")
            ),
        ),
        "refreshed_distinct": _with(
            f"""{RELOADED}, ranges(first_day, last_day) AS (VALUES
  (DATE '2024-01-01', DATE '2024-01-10'), (DATE '2024-01-08', DATE '2024-02-20'), (DATE '2024-02-25', DATE '2024-02-25'))""",
            _union(
                f"""
SELECT first_day, last_day, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, TRUE AS within_bound
FROM ranges JOIN log ON event_date BETWEEN first_day AND last_day GROUP BY ALL"""
                for c in PROCESSED.names
            ),
        ),
        "clustered_table_by_type": _with(
            LOG, "SELECT event_date, event_type, count(*) AS events FROM log GROUP BY ALL"
        ),
    }


def _checks(table: str, model: str, not_null, accepted: str | None, contract: bool) -> list[str]:
    found = [(c, "not_null", f"{c} IS NULL") for c in not_null]
    if accepted:
        found.append((accepted, "accepted_values", f"{accepted} NOT IN ('view', 'cart', 'purchase')"))
    rows = [
        f"SELECT '{model}' AS model, '{c}' AS column_name, '{kind}' AS check_name, {_count(p)} AS failures FROM {table}"
        for c, kind, p in found
    ]
    if contract:
        rows.append(f"SELECT '{model}', '*', 'contract', {_count('FALSE')} FROM {table}")
    return rows


def _models() -> dict[str, str]:
    ids = ("user_id", "user_session", "product_id")
    daily = "SELECT * FROM daily ORDER BY event_date, overall_conversion_rate DESC NULLS LAST"
    all_checks = _union(
        _checks("staged", "staged_events", ids, "event_type", False)
        + _checks("fact", "funnel_fact", ("event_date",), "funnel_stage", True)
        + _checks("monthly", "funnel_monthly", (), None, True)
        + _checks("daily", "funnel_daily", ("event_date", "view_sessions", "cart_sessions"), None, True)
    )
    return {
        "staging": _with(LOG + MODELS, "SELECT * FROM staged"),
        "fact_funnel": _with(LOG + MODELS, "SELECT * FROM fact"),
        "funnel_monthly": _with(
            LOG + MARTS,
            "SELECT * FROM monthly ORDER BY event_month_date, overall_conversion_rate DESC NULLS LAST",
        ),
        "funnel_daily": _with(LOG + MARTS, daily),
        "funnel_daily_from_raw": _with(GATED_ROWS + MARTS, daily),
        "refreshed_events": _with(RELOADED, f"SELECT {EVENT_COLUMNS} FROM log"),
        "refreshed_fact": _with(RELOADED + MODELS, "SELECT * FROM fact"),
        "refreshed_monthly": _with(RELOADED + MARTS, "SELECT * FROM monthly"),
        "refreshed_daily": _with(RELOADED + MARTS, "SELECT * FROM daily"),
        "refreshed_checks": _with(RELOADED + MARTS, all_checks),
        "warehouse_daily": _with(LOG + MARTS, daily),
        "warehouse_fact": _with(LOG + MODELS, "SELECT * FROM fact"),
        "warehouse_monthly": _with(LOG + MARTS, "SELECT * FROM monthly"),
        "check_results": _with(LOG + MARTS, all_checks),
        "check_results_on_raw_events": _with(
            LOG, _union(_checks("log", "event_log", ids, "event_type", True))
        ),
    }


def _profile() -> dict[str, str]:
    def stats(column: str) -> str:
        return f"""
SELECT '{column}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique,
  first(value ORDER BY n DESC, value) AS top, max(n) AS freq
FROM (SELECT {column} AS value, count(*) AS n FROM log WHERE {column} IS NOT NULL GROUP BY ALL)"""

    def exact(column: str) -> str:
        def quartile(k: int) -> str:
            low = f"max(CASE WHEN place = (n - 1) * {k} // 4 THEN v END)"
            high = f"max(CASE WHEN place = ((n - 1) * {k} + 3) // 4 THEN v END)"
            part = f"({high} - {low}) * max((n - 1) * {k} % 4)"
            return (
                f"CAST(CAST({low} + {part} // 4 AS DECIMAL(38,6)) "
                f"+ CAST(CAST({part} % 4 AS DOUBLE) / 4 AS DECIMAL(38,6)) AS VARCHAR) AS p{25 * k}"
            )

        def end(f: str) -> str:
            return f"CAST(CAST({f}(v) AS DECIMAL(38,6)) AS VARCHAR) AS {f}"

        return f"""
SELECT '{column}' AS column_name, count(*) AS count, {end("min")}, {", ".join(map(quartile, (1, 2, 3)))}, {end("max")}
FROM (SELECT v, n, row_number() OVER (ORDER BY v) - 1 AS place
  FROM (SELECT CAST({column} AS HUGEINT) AS v, count({column}) OVER () AS n FROM ids WHERE {column} IS NOT NULL))"""

    info = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(PROCESSED.fields)]
    first = ", ".join(f"{c} ASC NULLS FIRST" for c in ORDER)
    last = ", ".join(f"{c} DESC NULLS LAST" for c in ORDER)
    return {
        "profile_shape": _with(LOG, "SELECT count(*) AS row_count, 9 AS column_count FROM log"),
        "profile_info": _with(
            LOG,
            _union(
                f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM log"
                for i, c, t in info
            ),
        ),
        "profile_missing": _with(
            LOG,
            _union(
                f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM log" for c in PROCESSED.names
            ),
        ),
        "profile_numeric": _with(
            LOG,
            _union(
                f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max
FROM log"""
                for c in NUMERIC
            ),
        ),
        "profile_exact": _with(
            f"""{LOG}, ids AS (
  SELECT product_id, category_id, user_id, 2053013555631882655 + product_id AS listing_id,
    -9223372036854775807 + 3 * user_id AS account_id
  FROM log)""",
            _union(map(exact, ("product_id", "category_id", "user_id", "listing_id", "account_id"))),
        ),
        "profile_strings": _with(LOG, _union(map(stats, TEXT))),
        "profile_duplicate_rows": _with(
            f"""{LOG}, doubled AS (
  SELECT {LOG_COLUMNS} FROM log UNION ALL SELECT {LOG_COLUMNS} FROM log WHERE product_id % 3 = 0)""",
            "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM doubled GROUP BY " + LOG_COLUMNS + ")",
        ),
        "profile_duplicates": _with(
            LOG,
            """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM log GROUP BY event_type, product_id, brand, user_session)""",
        ),
        "profile_distinct": _with(
            LOG,
            _union(
                f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM log"
                for c in PROCESSED.names
            ),
        ),
        "profile_event_mix": _with(
            LOG,
            """
SELECT event_type, count(*) AS events,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM log) * 100, 2) AS share
FROM log GROUP BY event_type""",
        ),
        "profile_event_ratios": _with(
            LOG,
            f"""
SELECT *, {_rate("cart_events", "view_events")} AS cart_per_view,
  {_rate("purchase_events", "cart_events")} AS purchase_per_cart
FROM (
  SELECT {", ".join(f"{_count(f"event_type = '{s}'")} AS {s}_events" for s in ("view", "cart", "purchase"))}
  FROM log
)""",
        ),
        "profile_cardinalities": _with(
            LOG,
            """
SELECT count(DISTINCT category_code) AS categories, count(DISTINCT brand) AS brands,
  count(DISTINCT product_id) AS products, count(DISTINCT user_id) AS users,
  count(DISTINCT user_session) AS sessions,
  (SELECT brand FROM log WHERE brand IS NOT NULL GROUP BY brand ORDER BY count(*) DESC, brand LIMIT 1) AS top_brand,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM log WHERE brand IS NOT NULL GROUP BY brand)) AS top_brand_events,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM log WHERE user_session IS NOT NULL GROUP BY user_session))
    AS most_events_in_session
FROM log""",
        ),
        "profile_price": _with(
            LOG,
            f"""
SELECT round(avg(price), 4) AS mean, round(quantile_cont(price, 0.5), 4) AS median, min(price) AS min,
  max(price) AS max, {_count("price = 0")} AS zero_prices
FROM log""",
        ),
        "head_tail": _with(
            LOG,
            f"""
(SELECT {LOG_COLUMNS}, 'head' AS part FROM log ORDER BY {first} LIMIT 5)
UNION ALL
(SELECT {LOG_COLUMNS}, 'tail' AS part FROM log ORDER BY {last} LIMIT 5)""",
        ),
        "sample_shape": _with(
            LOG,
            """
SELECT count(*) AS row_count, 9 AS column_count, 'all' AS scope FROM log
UNION ALL
SELECT count(*), 9, 'sample' FROM (SELECT * FROM log LIMIT 5000)""",
        ),
    }


def _reports() -> dict[str, str]:
    def rates_by(dimension: str) -> str:
        return _with(
            LOG + MARTS,
            f"SELECT *, {MONTHLY_RATES} FROM (SELECT {dimension}, {MONTHLY_SUMS} FROM monthly GROUP BY {dimension})",
        )

    return {
        "report_monthly_rates": rates_by("event_month"),
        "report_rates_by_category": rates_by("category_main"),
        "report_rates_by_brand": rates_by("brand"),
        "report_daily_trend": _with(
            LOG + MARTS,
            f"SELECT event_date, {DAILY_RATES} FROM (SELECT event_date, {DAILY_SUMS} FROM daily GROUP BY event_date)",
        ),
        "report_daily_volume": _with(
            LOG + MARTS,
            f"SELECT event_date, {_sums('view_sessions', 'cart_sessions')} FROM daily GROUP BY event_date",
        ),
        "report_stage_distribution": _with(
            LOG + MODELS,
            f"""
SELECT funnel_stage, count(*) AS fact_rows, {_rate("count(*)", "(SELECT count(*) FROM fact)")} AS share
FROM fact GROUP BY funnel_stage""",
        ),
        "report_category_stage": _with(
            LOG + MODELS,
            f"""
SELECT category_main, {", ".join(f"{_count(f"funnel_stage = '{s}'")} AS {s}" for s in ("view", "cart", "purchase"))}
FROM fact GROUP BY category_main""",
        ),
        "report_stage_detail": _with(
            LOG + MODELS,
            f"""
SELECT *, {_rate("fact_rows", "sum(fact_rows) OVER (PARTITION BY category_main)")} AS share
FROM (SELECT category_main, funnel_stage, count(*) AS fact_rows FROM fact GROUP BY ALL)""",
        ),
        "report_event_type_by_hour": _with(
            LOG,
            "SELECT CAST(hour(event_time) AS INTEGER) AS hour, event_type, count(*) AS events FROM log GROUP BY ALL",
        ),
    }


def _behaviour() -> dict[str, str]:
    def top(column: str) -> str:
        return _with(
            LOG + MODELS,
            f"""
SELECT {column}, count(*) AS events FROM staged WHERE {column} IS NOT NULL
GROUP BY {column} ORDER BY events DESC, {column} LIMIT 10""",
        )

    def ranked(slot: str, name: str) -> str:
        return _with(
            LOG + MODELS,
            f"""
SELECT *, CAST(rank() OVER (PARTITION BY event_type ORDER BY events DESC) AS INTEGER) AS rank
FROM (SELECT event_type, CAST({slot} AS INTEGER) AS {name}, count(*) AS events FROM staged GROUP BY ALL)""",
        )

    return {
        "session_lengths": _with(
            LOG + MODELS,
            """
SELECT user_session, count(*) AS events,
  CAST(date_diff('second', min(event_time), max(event_time)) AS BIGINT) AS seconds
FROM staged GROUP BY user_session""",
        ),
        "views_before_purchase": _with(
            LOG + MODELS,
            """
, firsts AS (
  SELECT user_id, product_id, min(event_time) AS bought_at, min(category_main) AS category
  FROM staged WHERE event_type = 'purchase' GROUP BY ALL
), earlier AS (
  SELECT f.user_id, f.product_id, count(*) AS views
  FROM staged s JOIN firsts f ON s.user_id = f.user_id AND s.product_id = f.product_id
  WHERE s.event_type = 'view' AND s.event_time < f.bought_at GROUP BY ALL
)
SELECT category AS category_main, count(*) AS products_bought,
  CAST(coalesce(sum(views), 0) AS BIGINT) AS views_before,
  round(CAST(coalesce(sum(views), 0) AS DOUBLE) / count(*), 4) AS mean_views
FROM firsts LEFT JOIN earlier USING (user_id, product_id)
GROUP BY category""",
        ),
        "repeat_purchasers": _with(
            LOG + MODELS,
            """
SELECT user_id, count(DISTINCT user_session) AS purchase_sessions, count(*) AS purchases
FROM staged WHERE event_type = 'purchase'
GROUP BY user_id HAVING count(DISTINCT user_session) > 1""",
        ),
        "top_products": top("product_id"),
        "top_categories": top("category_main"),
        "brand_revenue": _with(
            LOG + MODELS,
            f"""
SELECT brand, {_count("event_type = 'view'")} AS views, {_count("event_type = 'purchase'")} AS purchases,
  coalesce(round(sum(price) FILTER (WHERE event_type = 'purchase'), 2), 0) AS revenue
FROM staged GROUP BY brand""",
        ),
        "cart_abandonment": _with(
            LOG + MODELS,
            f"""
SELECT *, {_rate("carted", "fact_rows")} AS cart_rate, {_rate("bought", "fact_rows")} AS purchase_rate,
  {_rate("abandoned", "carted")} AS abandonment_rate
FROM (
  SELECT product_id, count(*) AS fact_rows, {_count("has_cart = 1")} AS carted,
    {_count("has_purchase = 1")} AS bought, {_count("has_cart = 1 AND has_purchase = 0")} AS abandoned
  FROM fact GROUP BY product_id
)""",
        ),
        "hourly_peaks": ranked("hour(event_time)", "hour"),
        "weekday_traffic": ranked("isodow(event_time)", "weekday"),
        "daily_change": _with(
            LOG + MODELS,
            """
, days AS (SELECT event_date, count(*) AS events FROM staged GROUP BY event_date)
SELECT d.event_date, d.events, b.events AS events_before, d.events - b.events AS change
FROM days d LEFT JOIN days b ON d.event_date = b.event_date + 1""",
        ),
        "user_segments": _with(
            LOG + MODELS,
            """
SELECT segment, count(*) AS users
FROM (
  SELECT user_id,
    CASE WHEN count(DISTINCT user_session) FILTER (WHERE has_purchase = 1) > 1 THEN 'repeat buyer'
         WHEN max(has_purchase) = 1 THEN 'buyer'
         WHEN max(has_cart) = 1 THEN 'cart only' ELSE 'view only' END AS segment
  FROM fact GROUP BY user_id
)
GROUP BY segment""",
        ),
        "weekly_retention": _with(
            LOG + MODELS,
            """
, active AS (SELECT DISTINCT user_id, CAST(date_trunc('week', event_time) AS DATE) AS active FROM staged)
SELECT cohort, active, count(*) AS users
FROM (SELECT *, min(active) OVER (PARTITION BY user_id) AS cohort FROM active)
GROUP BY cohort, active""",
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {**_gate(), **_models(), **_profile(), **_reports(), **_behaviour()}
