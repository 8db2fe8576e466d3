"""DuckDB SQL that recomputes each registered query from the driver tables, written apart from the Spark code."""

from __future__ import annotations

TRIPS = """
order_rows AS (
    SELECT *, o_orderkey AS k,
           o_orderdate + to_minutes((o_orderkey % 24) * 60 + o_orderkey % 60) AS starts,
           o_orderdate + to_minutes((o_orderkey % 24) * 60 + o_orderkey % 60 + (o_orderkey * 7) % 90 - 2) AS ends
    FROM orders
),
copied AS (
    SELECT *, 0 AS copy FROM order_rows
    UNION ALL
    SELECT *, 1 AS copy FROM order_rows WHERE k % 50 = 0
),
delivered AS (
    SELECT CASE WHEN k % 211 <> 0 THEN CAST(o_custkey % 4 AS INTEGER) END AS vendor_id,
           CASE WHEN k % 53 <> 0 THEN CAST(k % 7 AS DOUBLE) END AS passenger_count,
           CASE WHEN k % 101 = 0 THEN NULL WHEN k % 97 = 0 THEN -o_totalprice ELSE o_totalprice END AS total_amount,
           CASE WHEN k % 103 <> 0 THEN starts END AS pickup_ts,
           CASE WHEN k % 107 <> 0 THEN ends END AS dropoff_ts,
           CAST(k % 300 AS DOUBLE) / 10 AS trip_distance,
           strftime(o_orderdate, '%Y-%m') AS delivery_month,
           copy
    FROM copied
)"""

COLUMNS = "vendor_id, passenger_count, total_amount, pickup_ts, dropoff_ts, trip_distance"

# Deliveries of 1997 carry no distance.
LANDED_COLUMNS = (
    "vendor_id, passenger_count, total_amount, pickup_ts, dropoff_ts, "
    "CASE WHEN delivery_month NOT LIKE '1997-%' THEN trip_distance END AS trip_distance"
)

REASONS = """concat_ws(',',
    CASE WHEN vendor_id IS NULL THEN 'vendor_not_null' END,
    CASE WHEN pickup_ts IS NULL THEN 'pickup_not_null' END,
    CASE WHEN dropoff_ts IS NULL THEN 'dropoff_not_null' END,
    CASE WHEN total_amount IS NULL THEN 'amount_not_null' END,
    CASE WHEN (pickup_ts >= TIMESTAMP '1996-01-01' AND pickup_ts < TIMESTAMP '2001-01-01') IS NOT TRUE
         THEN 'pickup_in_window' END,
    CASE WHEN (total_amount > 0) IS NOT TRUE THEN 'amount_positive' END,
    CASE WHEN (dropoff_ts >= pickup_ts) IS NOT TRUE THEN 'dropoff_after_pickup' END
) AS _reject_reason"""

TIME = """
CAST(year(pickup_ts) AS INTEGER) AS pickup_year,
CAST(month(pickup_ts) AS INTEGER) AS pickup_month,
strftime(pickup_ts, '%Y-%m') AS pickup_year_month,
CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
CAST(pickup_ts AS DATE) AS pickup_date"""


def clean(body: str, columns: str = COLUMNS, where: str = "true") -> str:
    return f"""
    WITH {TRIPS},
    trips AS (SELECT {columns} FROM delivered WHERE {where}),
    deduped AS (SELECT DISTINCT {COLUMNS} FROM trips),
    tagged AS (SELECT *, {REASONS} FROM deduped),
    rejected AS (SELECT * FROM tagged WHERE _reject_reason <> ''),
    valid AS (SELECT {COLUMNS} FROM tagged WHERE _reject_reason = ''),
    silver AS (SELECT *, {TIME} FROM valid),
    q1 AS (
        SELECT pickup_year_month, count(*) AS trips, round(avg(total_amount), 2) AS avg_total_amount
        FROM silver GROUP BY 1
    ),
    q2 AS (
        SELECT pickup_hour, count(*) AS trips, round(avg(passenger_count), 3) AS avg_passenger_count
        FROM silver WHERE pickup_month = 5 AND passenger_count > 0 GROUP BY 1
    )
    {body}"""


Q1 = "SELECT * FROM q1 ORDER BY 1"
Q2 = "SELECT * FROM q2 ORDER BY 1"


def metrics(source: str, checks: dict[str, tuple[str, str]], extra: str = "") -> str:
    """One row per check over a relation; a predicate that is NULL failed."""
    rows = []
    for name, (severity, predicate) in checks.items():
        failed = f"CAST(count(*) FILTER (WHERE ({predicate}) IS NOT TRUE) AS BIGINT)"
        rows.append(
            f"SELECT '{name}' AS \"check\", '{severity}' AS severity, count(*) AS rows_in, "
            f"{failed} AS rows_failed, {failed} = 0 AS passed{extra} FROM {source}"
        )
    return " UNION ALL ".join(rows)


TRIP_CHECKS = {
    "vendor_not_null": ("QUARANTINE", "vendor_id IS NOT NULL"),
    "pickup_not_null": ("QUARANTINE", "pickup_ts IS NOT NULL"),
    "dropoff_not_null": ("QUARANTINE", "dropoff_ts IS NOT NULL"),
    "amount_not_null": ("QUARANTINE", "total_amount IS NOT NULL"),
    "pickup_in_window": (
        "QUARANTINE",
        "pickup_ts >= TIMESTAMP '1996-01-01' AND pickup_ts < TIMESTAMP '2001-01-01'",
    ),
    "amount_positive": ("QUARANTINE", "total_amount > 0"),
    "dropoff_after_pickup": ("QUARANTINE", "dropoff_ts >= pickup_ts"),
    "passenger_positive": ("WARN", "passenger_count IS NOT NULL AND passenger_count > 0"),
}
SHIPMENT_CHECKS = {
    "ship_date_not_null": ("BLOCK", "l_shipdate IS NOT NULL"),
    "price_not_nan": ("BLOCK", "NOT isnan(l_extendedprice)"),
    "shipped_in_window": (
        "QUARANTINE",
        "l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'",
    ),
    "quantity_positive": ("QUARANTINE", "l_quantity > 0"),
    "discount_below_tenth": ("QUARANTINE", "l_discount < 0.1"),
    "taxed": ("WARN", "l_tax > 0"),
}
ACCOUNT_CHECKS = {
    "name_not_null": ("BLOCK", "c_name IS NOT NULL"),
    "balance_positive": ("QUARANTINE", "c_acctbal > 0"),
    "known_segment": ("WARN", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')"),
}

SHIPMENTS = """(
    SELECT DISTINCT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax
    FROM lineitem
)"""

OUTCOME = "CASE WHEN severity = 'WARN' THEN 'WARN' WHEN NOT passed THEN 'FAIL' ELSE 'ok' END AS outcome"


def run(source: str, checks: dict[str, tuple[str, str]], run_id: str, dataset: str = "") -> str:
    named = f", '{dataset}' AS dataset" if dataset else ""
    return metrics(source, checks, f", '{run_id}' AS run_id, 'silver' AS layer{named}")


LATER_CHECKS = {name: check for name, check in TRIP_CHECKS.items() if name != "vendor_not_null"}


HISTORY = " UNION ALL ".join(
    [
        run("deduped", TRIP_CHECKS, "run-1"),
        run(SHIPMENTS, SHIPMENT_CHECKS, "run-2"),
        run("customer", ACCOUNT_CHECKS, "run-3"),
        run("deduped", TRIP_CHECKS, "run-4"),
    ]
)

RECONCILED = """
SELECT (SELECT count(*) FROM trips) AS raw,
       count(*) AS deduped,
       CAST(count(*) FILTER (WHERE _reject_reason <> '') AS BIGINT) AS quarantined,
       CAST(count(*) FILTER (WHERE _reject_reason = '') AS BIGINT) AS valid,
       CAST(count(*) FILTER (WHERE _reject_reason LIKE '%,%') AS BIGINT) AS multi_failed,
       true AS balanced
FROM tagged"""

PRICE_PROFILE = """
SELECT round(min(l_extendedprice), 2) AS min, round(avg(l_extendedprice), 2) AS avg,
       round(quantile_disc(l_extendedprice, 0.5), 2) AS p50, round(max(l_extendedprice), 2) AS max
FROM lineitem"""

ORDER_MONTHS = """
SELECT strftime(m, '%Y-%m') AS month
FROM (
    SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), {last}, INTERVAL 1 MONTH)) AS m
    FROM orders
)"""
ALL_MONTHS = ORDER_MONTHS.format(last="date_trunc('month', max(o_orderdate))")

FACT = f"SELECT {COLUMNS}, {TIME} FROM valid"

# One month came again without rows, another with half of its own.
REDELIVERED = """(delivery_month NOT IN ('1998-02', '1998-03')
           OR delivery_month = '1998-03' AND pickup_ts IS NOT NULL AND trip_distance < 15)"""

CLOCK_NAMES = """(SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS now,
    o_orderpriority AS current_date, CASE WHEN o_orderkey % 3 = 0 THEN 'now''' ELSE 'é now()' END AS note FROM orders)"""

CLOCK_CHECKS = {
    "present": ("QUARANTINE", "now IS NOT NULL"),
    "not_low": ("QUARANTINE", '"current_date" <> \'5-LOW\''),
    "quoted": ("QUARANTINE", "note <> 'now'''"),
    "doubled": ("WARN", "note = 'é now()'"),
    "past": ("WARN", "now < localtimestamp AND now < today()"),
    "future": ("WARN", "now > localtimestamp + INTERVAL 1 DAY OR note = 'é now()'"),
}

ORACLES: dict[str, str] = {
    "month_spine": ALL_MONTHS,
    "ingest_plan": f"""
        SELECT month,
               CASE WHEN month <= '1997-12' THEN 'skipped'
                    WHEN month IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders) THEN 'ingested'
                    ELSE 'missing' END AS status
        FROM ({ORDER_MONTHS.format(last="TIMESTAMP '2002-08-01'")})""",
    "ingest_totals": f"""
        SELECT CASE WHEN month <= '1997-12' THEN 'skipped' ELSE 'ingested' END AS status, count(*) AS count
        FROM ({ALL_MONTHS}) GROUP BY 1 ORDER BY 1""",
    "ingest_totals_forced": f"SELECT 'ingested' AS status, count(*) AS count FROM ({ALL_MONTHS})",
    # The tables of the correctness check, by the path that the driver states for them.
    "table_hashes": """
        SELECT parse_filename(filename) AS name, CAST(size AS BIGINT) AS bytes, sha256(content) AS sha256
        FROM read_blob('/root/testdata/sf0.01/*.parquet')""",
    "bronze_conform": f"WITH {TRIPS} SELECT {LANDED_COLUMNS} FROM delivered",
    "bronze_audit": f"""
        WITH {TRIPS}
        SELECT pickup_ts, total_amount,
               delivery_month AS _source_month,
               delivery_month[1:4] AS source_year,
               delivery_month[6:7] AS source_month,
               'run-1' AS _batch_id,
               'landing/orders/year=' || delivery_month[1:4] || '/month=' || delivery_month[6:7]
                   || '/delivery=orders_tripdata_' || delivery_month AS _source_folder
        FROM delivered""",
    "bronze_provenance": f"""
        WITH {TRIPS}
        SELECT delivery_month AS _source_month, delivery_month[1:4] AS source_year,
               delivery_month[6:7] AS source_month, 'run-1' AS _batch_id, count(*) AS count
        FROM delivered GROUP BY ALL""",
    "bronze_union": """
        SELECT c_custkey AS party, CAST(c_nationkey AS INTEGER) AS nation, c_mktsegment, NULL::VARCHAR AS s_name
        FROM customer
        UNION ALL
        SELECT s_suppkey, CAST(s_nationkey AS INTEGER), NULL, s_name FROM supplier""",
    "silver_dedup": f"""
        WITH {TRIPS}
        SELECT {COLUMNS},
               min('landing/orders/year=' || delivery_month[1:4] || '/month=' || delivery_month[6:7]
                   || '/orders_tripdata_' || delivery_month || '-' || copy || '.parquet') AS _source_file
        FROM delivered GROUP BY {COLUMNS}""",
    "silver_enrich": f"WITH {TRIPS} SELECT {COLUMNS}, {TIME} FROM delivered",
    "silver_clean": clean("SELECT * FROM silver"),
    "dq_tag": clean("SELECT * FROM tagged"),
    "dq_valid": clean("SELECT * FROM valid"),
    "dq_quarantine": clean("SELECT * FROM rejected"),
    "dq_metrics": clean(f"SELECT *, {OUTCOME} FROM ({metrics('deduped', TRIP_CHECKS)})"),
    "dq_reason_counts": clean(
        "SELECT reason, count(*) AS count FROM (SELECT unnest(string_split(_reject_reason, ',')) AS reason "
        "FROM rejected) GROUP BY 1 ORDER BY 2 DESC, 1"
    ),
    "dq_reconcile": clean(RECONCILED),
    "dq_history": clean(HISTORY),
    "dq_latest": clean(
        f"""SELECT * FROM ({HISTORY}) WHERE run_id IN (
            SELECT run_id FROM ({HISTORY}) GROUP BY 1 ORDER BY 1 DESC LIMIT 3) ORDER BY run_id DESC, "check\""""
    ),
    "gold_fact": clean(FACT),
    "roundtrip_fact": clean(FACT),
    "gold_q1": clean(Q1),
    "gold_q2": clean(Q2),
    "gold_monthly_revenue": clean(
        "SELECT pickup_year_month, round(sum(total_amount), 2) AS revenue FROM silver GROUP BY 1 ORDER BY 1"
    ),
    "sql_q1_mart": clean(Q1),
    "sql_q2_mart": clean(Q2),
    "sql_q1_silver": clean(Q1),
    "sql_q2_silver": clean(Q2),
    "eda_volume": clean("SELECT pickup_year_month, count(*) AS count FROM silver GROUP BY 1 ORDER BY 1"),
    "eda_amount_profile": clean(
        "SELECT round(min(total_amount), 2) AS min, round(avg(total_amount), 2) AS avg, "
        "round(quantile_disc(total_amount, 0.5), 2) AS p50, round(max(total_amount), 2) AS max FROM silver"
    ),
    "eda_passenger_dist": clean("SELECT passenger_count, count(*) AS count FROM silver GROUP BY 1 ORDER BY 1"),
    "eda_passenger_share": clean(
        "SELECT count(*) AS row_count, "
        "CAST(count(*) FILTER (WHERE passenger_count = 1) AS BIGINT) AS one_count, "
        "round(count(*) FILTER (WHERE passenger_count = 1) / count(*), 4) AS one_share, "
        "CAST(count(*) FILTER (WHERE coalesce(passenger_count, 0) = 0) AS BIGINT) AS none_count, "
        "round(count(*) FILTER (WHERE coalesce(passenger_count, 0) = 0) / count(*), 4) AS none_share FROM silver"
    ),
    "kpi_q1": clean(
        "SELECT round(avg(avg_total_amount), 2) AS mean_of_means, "
        "(SELECT pickup_year_month FROM q1 ORDER BY avg_total_amount DESC, 1 LIMIT 1) AS peak_key, "
        "max(avg_total_amount) AS peak_value, CAST(sum(trips) AS BIGINT) AS total_count FROM q1"
    ),
    "kpi_q2": clean(
        "SELECT (SELECT pickup_hour FROM q2 ORDER BY avg_passenger_count DESC, 1 LIMIT 1) AS max_key, "
        "max(avg_passenger_count) AS max_value, "
        "(SELECT pickup_hour FROM q2 ORDER BY avg_passenger_count, 1 LIMIT 1) AS min_key, "
        "min(avg_passenger_count) AS min_value, "
        "(SELECT pickup_hour FROM q2 ORDER BY trips DESC, 1 LIMIT 1) AS busiest_key FROM q2"
    ),
    "shipment_metrics": f"SELECT *, {OUTCOME} FROM ({metrics(SHIPMENTS, SHIPMENT_CHECKS)})",
    "shipment_monthly_price": f"""
        SELECT strftime(l_shipdate, '%Y-%m') AS ship_year_month, count(*) AS shipments,
               round(avg(l_extendedprice), 3) AS avg_price
        FROM {SHIPMENTS}
        WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'
          AND l_quantity > 0 AND l_discount < 0.1 AND NOT isnan(l_extendedprice)
        GROUP BY 1 ORDER BY 1""",
    "shipment_price_profile": PRICE_PROFILE,
    "shipment_price_profile_refined": PRICE_PROFILE,
    "account_quarantine": "SELECT *, 'balance_positive' AS _reject_reason FROM customer WHERE NOT c_acctbal > 0",
    "account_metrics": f"SELECT *, {OUTCOME} FROM ({metrics('customer', ACCOUNT_CHECKS)})",
    "event_hourly_value": """
        SELECT event_type, CAST(hour(ts) AS INTEGER) AS event_hour, count(*) AS events,
               round(avg(value), 3) AS avg_value
        FROM events GROUP BY 1, 2 ORDER BY 1, 2""",
    "pipeline_q1": clean(Q1, LANDED_COLUMNS),
    "pipeline_q2": clean(Q2, LANDED_COLUMNS),
    "pipeline_counts": clean(RECONCILED, LANDED_COLUMNS),
    "pipeline_clock_counts": clean(
        RECONCILED.replace(
            "FROM tagged",
            """FROM (SELECT * REPLACE (concat_ws(',', nullif(_reject_reason, ''),
                CASE WHEN (pickup_ts > localtimestamp OR total_amount < 150000) IS NOT TRUE THEN 'recent_or_small' END
            ) AS _reject_reason) FROM tagged)""",
        ),
        LANDED_COLUMNS,
    ),
    "two_datasets_marts": clean("""
        SELECT 'orders' AS dataset, *, CAST(8 AS BIGINT) AS checks FROM q1
        UNION ALL
        SELECT 'doubled', pickup_year_month, count(*), round(avg(total_amount * 2), 2), 8 FROM silver GROUP BY 2"""),
    "bronze_plain_parts": f"""
        WITH {TRIPS} SELECT delivery_month AS month, count(*) AS count, 'ingested' AS status FROM delivered GROUP BY 1""",
    "bronze_redelivered": f"""
        WITH {TRIPS} SELECT delivery_month AS month, count(*) AS count FROM delivered WHERE {REDELIVERED} GROUP BY 1""",
    "bronze_alternating": f"WITH {TRIPS} SELECT {COLUMNS} FROM delivered",
    "silver_redelivered": clean(f"SELECT *, {TIME} FROM tagged", LANDED_COLUMNS, REDELIVERED),
    "dq_redelivered": clean(
        f"SELECT * FROM ({run('deduped', TRIP_CHECKS, 'run-2', 'orders')})", LANDED_COLUMNS, REDELIVERED
    ),
    "dq_clock_names": f"SELECT *, {OUTCOME} FROM ({metrics(CLOCK_NAMES, CLOCK_CHECKS)})",
    "dq_clock_names_valid": f"""
        SELECT * FROM {CLOCK_NAMES} WHERE now IS NOT NULL AND "current_date" <> '5-LOW' AND note <> 'now'''""",
    "bronze_zoned": "SELECT CAST(hour(ts) AS INTEGER) AS event_hour, count(*) AS count FROM events GROUP BY 1",
    "dq_blocked_run": clean(
        "SELECT *, false AS published FROM ("
        + run("deduped", {"vendor_known": ("BLOCK", "vendor_id IS NOT NULL"), **LATER_CHECKS}, "run-1", "orders")
        + ")",
        LANDED_COLUMNS,
    ),
    "pipeline_checks": clean(
        f"""SELECT * FROM ({run('deduped', TRIP_CHECKS, 'run-1', 'orders')}
            UNION ALL {run('deduped', TRIP_CHECKS, 'run-2', 'orders')})""",
        LANDED_COLUMNS,
    ),
    "pipeline_fact": clean(FACT, LANDED_COLUMNS),
}
