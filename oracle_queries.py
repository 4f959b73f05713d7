"""The registered queries in DuckDB SQL, over views of the test tables."""

from __future__ import annotations

from html.entities import html5


def _round(x: str) -> str:
    """Half up to two digits, after ten, as the reports round."""
    return f"round(cast({x} as decimal(38, 10)), 2)::double"


def _month(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m')"


def _decode(text: str) -> str:
    """References of the standard's table and numeric ones, each decoded once, by a walk over the pieces."""
    pattern = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
    named = [(f"&{name}", value) for name, value in html5.items() if name.endswith(";")]
    quoted = [", ".join("'" + x.replace("'", "''") + "'" for x in column) for column in zip(*named)]
    table = f"map([{quoted[0]}], [{quoted[1]}])"
    digits = "ltrim(regexp_replace(r, '[&#xX;]', '', 'g'), '0')"
    value = f"CASE WHEN r[3] IN ('x', 'X') THEN try_cast('0x' || {digits} AS bigint) ELSE try_cast({digits} AS bigint) END"
    numeric = f"""
        CASE WHEN ({value}) BETWEEN 1 AND 55295 OR ({value}) BETWEEN 57344 AND 1114111 THEN chr(({value})::int) ELSE chr(65533) END"""
    one = f"CASE WHEN r[2] = '#' THEN {numeric} ELSE coalesce({table}[r], r) END"
    pieces = f"string_split_regex({text}, '{pattern}')"
    references = f"list_append(list_transform(regexp_extract_all({text}, '{pattern}'), lambda r: {one}), '')"
    return f"CASE WHEN contains({text}, '&') THEN array_to_string(list_transform(list_zip({pieces}, {references}), lambda z: z[1] || z[2]), '') ELSE {text} END"


K = "regexp_extract(props, '([0-9]+)', 1)::int"
EVENTS = f"(SELECT event_id, ts, event_type, value, {K} AS passengers FROM events)"

HOURLY = f"""
WITH base AS (
    SELECT event_type, avg(passengers) AS base FROM {EVENTS} WHERE event_type IN ('view', 'click') GROUP BY 1
),
month AS (SELECT * FROM {EVENTS} WHERE strftime(ts, '%Y-%m') = '2024-01')
SELECT strftime(ts, '%Y-%m-%d %H') AS pickup_hour, {_round("avg(passengers + base)")} AS avg_passenger_count
FROM month LEFT JOIN base USING (event_type)
GROUP BY 1 ORDER BY 1
"""

TREND = f"""
WITH monthly AS (
    SELECT {_month("o_orderdate")} AS month, count(*) AS n_trips, avg(o_totalprice) AS mean FROM orders GROUP BY 1
),
lagged AS (SELECT *, lag(mean) OVER (ORDER BY month) AS before FROM monthly)
SELECT month, n_trips, {_round("mean")} AS avg_amount, {_round("before")} AS previous_avg_amount,
       {_round("mean - before")} AS change
FROM lagged
"""


def _by_month(table: str, times: int = 1) -> str:
    ts, key, amount, vendor = {
        "orders": ("o_orderdate", "o_orderkey", "o_totalprice", "o_custkey"),
        "lineitem": ("l_shipdate", "l_orderkey", "l_extendedprice", "l_linenumber"),
    }[table]
    return f"""
SELECT {_month(ts)} AS source_date, count(*) * {times} AS n_trips, (sum({key}) * {times})::bigint AS id_sum,
       (sum({vendor}) * {times})::bigint AS vendor_sum,
       strftime(min({ts}), '%Y-%m-%d %H:%M:%S') AS first_pickup, strftime(max({ts}), '%Y-%m-%d %H:%M:%S') AS last_pickup,
       (sum(date_diff('day', DATE '1990-01-01', {ts}::date)) * {times})::bigint AS pickup_days,
       {_round(f"sum({amount}) * {times}")} AS amount
FROM {table} GROUP BY 1"""


def _drift_sums(fraction: str = "0.25", cast: str = "") -> str:
    """Sums of the drifting columns: whole passengers up to 1999, and a fraction more from 2000 on."""
    return f"""
SELECT {_month("l_shipdate")} AS source_date, count(*) AS n_trips,
       {_round(f"sum((trunc(l_quantity) + CASE WHEN year(l_shipdate) >= 2000 THEN {fraction} ELSE 0 END){cast})")} AS passengers,
       sum(CASE WHEN year(l_shipdate) >= 2000 THEN 2.5::double WHEN year(l_shipdate) >= 1997 THEN 1.5::double END) AS airport_fees,
       {_round("sum(l_extendedprice)")} AS amount
FROM lineitem GROUP BY 1"""


OFFERED = f"""
(SELECT DISTINCT 'orders_trips' AS dataset, {_month("o_orderdate")} AS month FROM orders
 UNION ALL SELECT DISTINCT 'lineitem_trips', {_month("l_shipdate")} FROM lineitem)"""

BOTH_TABLES = f"""
SELECT *, 'lineitem_trips' AS table_name FROM ({_by_month("lineitem")})
UNION ALL
SELECT *, 'orders_trips' AS table_name FROM ({_by_month("orders")})
"""

OBJECTS = f"""
    SELECT DISTINCT 'orders_trips' AS dataset, {_month("o_orderdate")} AS source_date FROM orders
    UNION ALL
    SELECT DISTINCT 'lineitem_trips', {_month("l_shipdate")} FROM lineitem
"""

ANCHORS = r"""
    SELECT page_id, unnest(found) AS anchor, (generate_subscripts(found, 1) - 1)::bigint AS pos
    FROM (
        SELECT page_id, regexp_extract_all(
            regexp_replace(html, '(?s)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
            '(?s)<a\s[^>]*>.*?</a>') AS found
        FROM pages
    )
"""

LINKS = f"""
    SELECT page_id, pos, {_decode("regexp_extract(anchor, 'href=\"([^\"]*)\"', 1)")} AS href,
           array_to_string(list_filter(list_transform(
               regexp_split_to_array(regexp_extract(anchor, '(?s)^<a\\s[^>]*>(.*?)</a>$', 1), '<[^>]*>'),
               lambda x: trim({_decode("x")})), lambda x: x <> ''), ' ') AS text
    FROM ({ANCHORS})
"""

CATEGORIES = "(VALUES ('The'), ('que'), ('DER'), ('nt'), ('no such category')) AS c(category)"
PERIODS = "(VALUES ('/th'), ('/en'), ('on')) AS p(period)"

CATEGORY_LINKS = f"""
    SELECT page_id, pos, href, text, category, period
    FROM ({LINKS}), {CATEGORIES}, {PERIODS}
    WHERE contains(lower(text), lower(category)) AND contains(href, period)
"""

PAGE_TEXT = f"(SELECT page_id, lower({_decode('regexp_replace(html, $$<!--|-->|<[^>]*>$$, chr(1), $$g$$)')}) AS text FROM pages)"

TRIPS = "(lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _rule(name: str, condition: str) -> str:
    return f"SELECT '{name}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE {condition}) AS n_bad FROM {TRIPS}"


RULES = "\nUNION ALL\n".join(
    [
        _rule("null_pickup", "o_orderdate IS NULL"),
        _rule("null_vendor", "l_linenumber IS NULL"),
        _rule("null_passengers", "l_quantity IS NULL"),
        _rule("null_amount", "l_extendedprice IS NULL"),
        _rule("negative_amount", "l_extendedprice < 0"),
        _rule("dropoff_before_pickup", "l_shipdate < o_orderdate"),
        _rule("pickup_outside_source_date", f"{_month('o_orderdate')} <> {_month('l_shipdate')}"),
        f"""SELECT 'repeated_row', sum(n)::bigint, sum(n - 1)::bigint
            FROM (SELECT count(*) AS n FROM {TRIPS} GROUP BY l_orderkey, l_linenumber)""",
    ]
)

DRIFT_COLUMNS = """(VALUES
    ('tpep_pickup_datetime', 'timestamp_ntz', 0, 9999), ('vendorid', 'int', 0, 9999),
    ('total_amount', 'double', 0, 9999), ('trip_id', 'bigint', 0, 9999),
    ('passenger_count', 'int', 0, 1996), ('passenger_count', 'bigint', 1997, 1999),
    ('passenger_count', 'double', 2000, 9999), ('airport_fee', 'double', 1997, 9999)
) AS c(column_name, type, first_year, last_year)"""

ORACLES: dict[str, str] = {
    "hourly_avg_passengers_with_vendor_baseline": HOURLY,
    "trips_with_vendor_baseline": f"""
        WITH base AS (
            SELECT event_type, avg(passengers) AS base FROM {EVENTS} WHERE event_type IN ('view', 'click') GROUP BY 1
        )
        SELECT event_id, event_type, passengers, {_round("base")} AS baseline, {_round("passengers + base")} AS combined
        FROM {EVENTS} LEFT JOIN base USING (event_type)""",
    "vendor_avg_passengers": f"""
        SELECT event_type AS vendorid, avg(passengers) AS passenger_count FROM {EVENTS} GROUP BY 1""",
    "monthly_avg_passengers": f"""
        SELECT {_month("l_shipdate")} AS month, {_round("avg(trunc(l_quantity)::int)")} AS average_passenger_count
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "monthly_avg_amount": f"""
        SELECT {_month("o_orderdate")} AS month, {_round("avg(o_totalprice)")} AS average_total_amount
        FROM orders GROUP BY 1 ORDER BY 1""",
    "month_filter_rows": f"""
        SELECT l_linenumber, count(*) AS n_trips FROM lineitem WHERE {_month("l_shipdate")} = '1998-05' GROUP BY 1""",
    "hour_of_day_avg_fleet": f"""
        WITH fleet AS (
            SELECT ts AS pickup, passengers FROM {EVENTS} WHERE event_type NOT IN ('view', 'click')
            UNION ALL
            SELECT ts, passengers FROM {EVENTS} WHERE event_type IN ('view', 'click')
        )
        SELECT hour(pickup)::int AS hour, count(*) AS n_trips, {_round("avg(passengers)")} AS avg_passenger_count
        FROM fleet WHERE strftime(pickup, '%Y-%m') = '2024-01' GROUP BY 1 ORDER BY 1""",
    "peak_low_hours": """
        SELECT hour, n_trips, (rank() OVER (ORDER BY n_trips DESC))::int AS peak_rank,
               (rank() OVER (ORDER BY n_trips))::int AS low_rank
        FROM (SELECT hour(ts)::int AS hour, count(*) AS n_trips FROM events GROUP BY 1) ORDER BY 1""",
    "monthly_trend": TREND,
    "amount_distribution": f"""
        SELECT {_month("l_shipdate")} AS month, count(l_extendedprice) AS n,
               {_round("min(l_extendedprice)")} AS min_amount,
               {_round("quantile_cont(l_extendedprice, 0.25)")} AS q1_amount,
               {_round("quantile_cont(l_extendedprice, 0.5)")} AS median_amount,
               {_round("quantile_cont(l_extendedprice, 0.75)")} AS q3_amount,
               {_round("max(l_extendedprice)")} AS max_amount,
               {_round("avg(l_extendedprice)")} AS avg_amount
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "amount_quantiles_by_cutting": f"""
        SELECT {_month("l_shipdate")} AS month, count(l_extendedprice) AS n,
               {_round("quantile_cont(l_extendedprice, 0.1)")} AS p10,
               {_round("quantile_cont(l_extendedprice, 0.5)")} AS p50,
               {_round("quantile_cont(l_extendedprice, 0.99)")} AS p99
        FROM lineitem GROUP BY 1""",
    "amount_histogram": f"""
        SELECT {_month("o_orderdate")} AS month, floor(o_totalprice / 50000.0::double) * 50000.0::double AS class_from,
               count(*) AS n_trips
        FROM orders GROUP BY 1, 2 ORDER BY 1, 2""",
    "amount_outliers": f"""
        WITH rows AS (SELECT event_id, {_month("ts")} AS month, value FROM events),
        quartiles AS (
            SELECT month, quantile_cont(value, 0.25) AS low, quantile_cont(value, 0.75) AS high FROM rows GROUP BY 1
        ),
        fences AS (
            SELECT month, low - 1.5::double * (high - low) AS low_fence, high + 1.5::double * (high - low) AS high_fence
            FROM quartiles
        )
        SELECT event_id, month, value, {_round("low_fence")} AS low_fence, {_round("high_fence")} AS high_fence
        FROM rows JOIN fences USING (month) WHERE value < low_fence OR value > high_fence""",
    "quality_rule_counts": f"""
        SELECT rule, n_rows, n_bad, round(cast(n_bad / n_rows as decimal(38, 10)), 6)::double AS bad_rate
        FROM ({RULES}) ORDER BY rule""",
    "schema_drift_report": f"""
        SELECT 'lineitem_trips' AS dataset, column_name, type, min(month) AS first_month, max(month) AS last_month,
               count(*) AS n_objects
        FROM (SELECT DISTINCT {_month("l_shipdate")} AS month, year(l_shipdate) AS year FROM lineitem)
        JOIN {DRIFT_COLUMNS} ON year BETWEEN first_year AND last_year
        GROUP BY 1, 2, 3""",
    "drift_safe_read": f"""
        SELECT {_month("l_shipdate")} AS source_date, count(*) AS n_trips,
               sum(trunc(l_quantity))::bigint AS passengers,
               sum(CASE WHEN year(l_shipdate) >= 2000 THEN 2.5 WHEN year(l_shipdate) >= 1997 THEN 1.5 END)::double
                   AS airport_fees
        FROM lineitem GROUP BY 1""",
    "conform_audit_columns": f"""
        SELECT o_orderkey AS trip_id, o_orderdate AS pickup, '2023-06-01' AS ingestion_date,
               'orders_trips_' || {_month("o_orderdate")} || '.parquet' AS file_name, 'orders_trips' AS dataset,
               {_month("o_orderdate")} AS source_date
        FROM orders""",
    "target_paths": f"""
        SELECT dataset || '_' || source_date || '.parquet' AS file_name, dataset, source_date,
               'zone/production/' || dataset || '_parquet/' || replace(source_date, '-', '_') AS target
        FROM ({OBJECTS})""",
    "tolerant_projection": f"""
        SELECT l_linenumber AS VendorID, l_shipdate AS tpep_pickup_datetime, trunc(l_quantity)::int AS passenger_count,
               l_extendedprice AS total_amount, '2023-06-01' AS ingestion_date,
               'lineitem_trips_' || {_month("l_shipdate")} || '.parquet' AS data_source,
               {_month("l_shipdate")} AS source_date
        FROM lineitem""",
    "dataset_profile": f"""
        SELECT 'orders_trips' AS dataset, {_month("o_orderdate")} AS source_date, count(*) AS n_rows, 8::bigint AS n_columns
        FROM orders GROUP BY 1, 2
        UNION ALL
        SELECT 'lineitem_trips', {_month("l_shipdate")}, count(*), 8::bigint FROM lineitem GROUP BY 1, 2""",
    "distinct_sources": f"SELECT dataset || '_' || source_date || '.parquet' AS file_name FROM ({OBJECTS})",
    "preview_rows": """
        SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5""",
    "landed_file_lookup": f"""
        WITH wanted AS (SELECT DISTINCT 'orders_trips_' || {_month("l_shipdate")} AS file_name FROM lineitem),
        landed AS (SELECT DISTINCT 'orders_trips_' || {_month("o_orderdate")} || '.parquet' AS name FROM orders)
        SELECT file_name, min(name) AS found FROM wanted LEFT JOIN landed ON starts_with(name, file_name) GROUP BY 1""",
    "files_to_fetch": f"""
        SELECT DISTINCT 'orders_trips' AS dataset, 'orders_trips_' || {_month("l_shipdate")} || '.parquet' AS file_name,
               'files/orders_trips_' || {_month("l_shipdate")} || '.parquet' AS href
        FROM lineitem
        WHERE {_month("l_shipdate")} NOT IN (SELECT {_month("o_orderdate")} FROM orders)""",
    "run_grid": """
        WITH months AS (
            SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                          INTERVAL 1 MONTH)) AS first_day
            FROM orders
        )
        SELECT category, strftime(first_day, '%Y-%m') AS month
        FROM (SELECT DISTINCT o_orderpriority AS category FROM orders), months""",
    "staging_roundtrip": _by_month("orders"),
    "staging_rerun": _by_month("orders"),
    "append_roundtrip": _by_month("orders", times=2),
    "publish_create": _by_month("orders"),
    "publish_rerun": _by_month("orders"),
    "publish_append": _by_month("orders", times=2),
    "publish_evolving": f"""
        SELECT {_month("o_orderdate")} AS source_date,
               CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS priority, count(*) AS n_trips
        FROM orders GROUP BY 1, 2""",
    "register_landed_dir": BOTH_TABLES,
    "publish_all_tables": BOTH_TABLES,
    "etl_monthly_report": f"""
        SELECT {_month("l_shipdate")} AS month, {_round("avg(trunc(l_quantity)::int)")} AS average_passenger_count
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "etl_hourly_report": HOURLY,
    "report_as_strings": f"""
        SELECT month, n_trips::varchar AS n_trips, avg_amount::varchar AS avg_amount,
               previous_avg_amount::varchar AS previous_avg_amount, change::varchar AS change
        FROM ({TREND})""",
    "report_persisted": HOURLY,
    "page_links": LINKS,
    "category_links": CATEGORY_LINKS,
    "category_links_exact": f"""
        SELECT page_id, pos, href, text, category, period
        FROM ({LINKS}), {CATEGORIES}, {PERIODS}
        WHERE lower(text) = lower(category) AND contains(href, period)""",
    "first_category_link": f"""
        SELECT page_id, category, period, arg_min(href, pos) AS href FROM ({CATEGORY_LINKS}) GROUP BY 1, 2, 3""",
    "missing_links": f"""
        SELECT page_id, category, period FROM pages, {CATEGORIES}, {PERIODS}
        EXCEPT SELECT page_id, category, period FROM ({CATEGORY_LINKS})""",
    "missing_categories": f"""
        SELECT category FROM {CATEGORIES}
        WHERE NOT EXISTS (SELECT 1 FROM {PAGE_TEXT} WHERE contains(text, lower(category)))""",
    "missing_categories_by_page": f"""
        SELECT page_id, category FROM {PAGE_TEXT}, {CATEGORIES} WHERE NOT contains(text, lower(category))""",
    "incremental_load": _by_month("orders"),
    "incremental_load_drifting": _drift_sums("0"),
    "incremental_runs_drifting": _drift_sums(),
    "publish_widening": f"""
        SELECT {_month("l_shipdate")} AS source_date, count(*) AS n_trips, {_round("sum(l_quantity)")} AS passengers,
               {_round("sum(CASE WHEN year(l_shipdate) < 1998 THEN trunc(l_extendedprice) ELSE l_extendedprice END)")} AS amount
        FROM lineitem GROUP BY 1""",
    "publish_promoted": f"""
        SELECT {_month("l_shipdate")} AS source_date, count(*) AS n_trips, sum(trunc(l_quantity))::bigint AS passengers,
               {_round("sum(CASE WHEN year(l_shipdate) < 1998 THEN trunc(l_extendedprice) ELSE l_extendedprice END)")} AS amount
        FROM lineitem GROUP BY 1""",
    "publish_gains_partition": f"""
        SELECT 'no month' AS undated, CASE WHEN year(o_orderdate) < 1998 THEN NULL ELSE {_month("o_orderdate")} END AS source_date,
               count(*) AS n_trips, sum(o_orderkey)::bigint AS id_sum
        FROM orders GROUP BY 1, 2
        UNION ALL
        SELECT 'derived month', {_month("o_orderdate")}, count(*), sum(o_orderkey)::bigint FROM orders GROUP BY 1, 2""",
    "files_republished": f"""
        SELECT 'orders_trips' AS dataset, 'orders_trips_' || month || '.parquet' AS file_name, month AS source_date,
               CASE WHEN month >= '2000-01' THEN 'new' WHEN month = '1996-03' THEN 'gone' ELSE 'republished' END AS change
        FROM (SELECT {_month("o_orderdate")} AS month, count(*) FILTER (o_orderkey % 2 = 0) AS n_even FROM orders GROUP BY 1)
        WHERE month >= '2000-01' OR month = '1996-03' OR (month LIKE '1997-%' AND n_even > 0)""",
    "republished_reload": _by_month("orders").replace("FROM orders", "FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderkey % 2 = 0"),
    "column_footers": f"""
        SELECT 'lineitem_trips' AS dataset, month AS source_date, column_name, type, n_rows, 0::bigint AS n_nulls
        FROM (SELECT {_month("l_shipdate")} AS month, any_value(year(l_shipdate)) AS year, count(*) AS n_rows FROM lineitem GROUP BY 1)
        JOIN {DRIFT_COLUMNS} ON year BETWEEN first_year AND last_year""",
    "register_drifting_zone": _drift_sums(),
    "publish_all_drifting": _drift_sums(),
    "etl_month_by_month_drifting": _drift_sums(),
    "whole_run": BOTH_TABLES,
    "plan_to_fetch": f"""
        SELECT dataset, dataset || '_' || month || '.parquet' AS file_name, 'files/' || dataset || '_' || month || '.parquet' AS href
        FROM {OFFERED} WHERE dataset = 'lineitem_trips'""",
    "plan_missing": f"""
        SELECT page_id, category, period
        FROM (VALUES (0::bigint, 'Orders Trip Records', 'orders_trips'), (0, 'Lineitem Trip Records', NULL),
                     (0, 'No Such Records', NULL), (1, 'Orders Trip Records', NULL),
                     (1, 'Lineitem Trip Records', 'lineitem_trips'), (1, 'No Such Records', NULL)) t(page_id, category, dataset),
             (SELECT DISTINCT month AS period FROM {OFFERED})
        WHERE NOT EXISTS (SELECT 1 FROM {OFFERED} o WHERE o.dataset = t.dataset AND o.month = period)""",
    "monthly_sql_report": f"""
        SELECT {_month("l_shipdate")} AS month, {_round("avg(trunc(l_quantity)::int)")} AS average_passenger_count
        FROM lineitem GROUP BY 1""",
    "approximate_quantiles": """
        SELECT event_type, count(value) AS n, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS q2,
               quantile_disc(value, 0.75) AS q3
        FROM events GROUP BY 1""",
}
