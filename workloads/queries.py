"""One query per operator. Each reads whole driver tables; those that test files write them to a scratch folder first."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.datasets.trips import HOURLY_MART, MONTHLY_MART
from stratalake.functions.predicates import in_window, not_nan, not_null, positive
from stratalake.functions.timedims import year_month
from stratalake.operators import marts, profile, quality
from stratalake.operators.conform import add_provenance, conform, union_by_name
from stratalake.operators.dedup import deduplicate, put_back, within_bound
from stratalake.operators.quality import BLOCK, QUARANTINE, REASON, WARN, Check
from stratalake.plans.jobs import (
    check_history,
    clean,
    dedup_rows,
    reconcile_layers,
    run_bronze,
    run_gold,
    run_pipeline,
    run_profile,
    run_silver,
)
from stratalake.plans.sql import answers, hour_mean_query, month_mean_query
from stratalake.sources import landing
from stratalake.sources.layout import BRONZE, CHECK_RESULTS, DQ, GOLD, SILVER, landing_root, table_path
from stratalake.sources.tables import append_table, clustered, overwrite_table, read_optional, read_table
from stratalake.spec import FILE_NUMBER, DatasetSpec, MeanMart
from workloads.order_trips import COLUMNS, SPEC, delivered_trips, delivery_files, land, land_alternating, numbered_trips, plain_parts, trips
from workloads.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "run-1"
BASE_URL = "https://example.org/trip-data"

SHIPMENTS = DatasetSpec(
    name="lineitem",
    entity="shipments",
    columns={
        "l_shipdate": "timestamp_ntz",
        "l_orderkey": "bigint",
        "l_linenumber": "int",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
    },
    time_column="l_shipdate",
    time_prefix="ship",
    checks=(
        Check("ship_date_not_null", not_null("l_shipdate"), BLOCK),
        Check("price_not_nan", not_nan("l_extendedprice"), BLOCK),
        Check("shipped_in_window", in_window("l_shipdate", "1996-01-01 00:00:00", "2001-01-01 00:00:00"), QUARANTINE),
        Check("quantity_positive", positive("l_quantity"), QUARANTINE),
        Check("discount_below_tenth", "l_discount < 0.1", QUARANTINE),
        Check("taxed", positive("l_tax"), WARN),
    ),
    marts=(
        # Three digits: at two, some month's exact mean lies on a rounding tie, where the order of sums decides.
        MeanMart("agg_monthly_price", ("ship_year_month",), "l_extendedprice", "avg_price", 3, count_alias="shipments"),
    ),
)

ACCOUNT_CHECKS = (
    Check("name_not_null", not_null("c_name"), BLOCK),
    Check("balance_positive", positive("c_acctbal"), QUARANTINE),
    Check("known_segment", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')", WARN),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reason_text(df: DataFrame) -> DataFrame:
    return df.withColumn(REASON, F.array_join(REASON, ","))


# Sources and bronze


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(
        year_month(F.min("o_orderdate")).alias("first_month"), year_month(F.max("o_orderdate")).alias("last_month")
    )


def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.months_between(order_months(spark, sf_dir), "first_month", "last_month")


def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for all months of orders and one year more, after the months before 1998 were ingested."""
    lake = land(spark, sf_dir, scratch_folder(spark))
    bounds = order_months(spark, sf_dir).collect()[0]
    landing.ingest(spark, lake, SPEC.name, bounds["first_month"], "1997-12")
    asked = landing.month_spine(spark, bounds["first_month"], "2002-08")
    known = landing.registered_files(spark, lake, SPEC.name)
    return landing.ingest_plan(asked, landing.landing_files(spark, lake, SPEC.name), known)


def ingest_status(spark: SparkSession, sf_dir: str, force: bool) -> DataFrame:
    """Totals of a second ingest over the whole range, after one up to 1997."""
    lake = land(spark, sf_dir, scratch_folder(spark))
    bounds = order_months(spark, sf_dir).collect()[0]
    landing.ingest(spark, lake, SPEC.name, bounds["first_month"], "1997-12")
    statuses = landing.ingest(spark, lake, SPEC.name, bounds["first_month"], bounds["last_month"], force=force)
    return landing.ingest_totals(statuses)


def ingest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_status(spark, sf_dir, force=False)


def ingest_totals_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_status(spark, sf_dir, force=True)


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = land(spark, sf_dir, scratch_folder(spark))
    return landing.landing_manifest(spark, lake, SPEC.name, BASE_URL)


def table_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, bytes and digest of the files of the driver tables, hashed as the manifest does."""
    files = landing.file_hashes(spark, [sf_dir])
    return files.select(F.substring_index("path", "/", -1).alias("name"), "bytes", "sha256")


def drifted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = land(spark, sf_dir, scratch_folder(spark))
    return landing.read_conformed(spark, lake, SPEC.name, SPEC.columns, RUN_ID)


def bronze_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drifted_rows(spark, sf_dir).select(*COLUMNS)


def bronze_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance per row; the file name is cut to its folder, because part names are random."""
    folder = F.regexp_extract("_source_file", "^(.*)/[^/]*$", 1).alias("_source_folder")
    keys = ("pickup_ts", "total_amount", "_source_month", "source_year", "source_month", "_batch_id")
    return drifted_rows(spark, sf_dir).select(*keys, folder)


def bronze_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_provenance(delivered_trips(spark, sf_dir), F.col("_source_file"), RUN_ID)
    return rows.groupBy("_source_month", "source_year", "source_month", "_batch_id").count()


def bronze_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as parties: each side lacks a column of the other, and key types differ."""
    customers = conform(
        table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "party", "c_nationkey": "nation"}),
        {"party": "bigint", "nation": "int", "c_mktsegment": "string"},
    )
    suppliers = conform(
        table(spark, sf_dir, "supplier").withColumnsRenamed({"s_suppkey": "party", "s_nationkey": "nation"}),
        {"party": "bigint", "nation": "int", "s_name": "string"},
    )
    return union_by_name([customers, suppliers])


# Silver


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of each row is a number, as in the silver job, and comes back from the dictionary of files."""
    files = within_bound(delivery_files(month_spine(spark, sf_dir)))
    return put_back(dedup_rows(numbered_trips(spark, sf_dir), SPEC), files, FILE_NUMBER)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(trips(spark, sf_dir), SPEC).valid


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(trips(spark, sf_dir), SPEC.keys)


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(trips(spark, sf_dir), SPEC).quarantine


def silver_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.enrich(trips(spark, sf_dir), SPEC.time_column, SPEC.time_prefix)


def dq_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_text(quality.tag(deduped(spark, sf_dir), SPEC.checks))


def dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.Split(deduped(spark, sf_dir), SPEC.checks).valid


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_text(rejected(spark, sf_dir))


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_outcome(clean(trips(spark, sf_dir), SPEC).metrics)


def dq_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reason_counts(rejected(spark, sf_dir))


def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(trips(spark, sf_dir), SPEC.keys, SPEC.checks)


def dq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over three tables appended to one history."""
    path = table_path(scratch_folder(spark), DQ, CHECK_RESULTS)
    runs = {
        "run-1": clean(trips(spark, sf_dir), SPEC).metrics,
        "run-2": clean(table(spark, sf_dir, "lineitem"), SHIPMENTS).metrics,
        "run-3": quality.check_metrics(table(spark, sf_dir, "customer"), ACCOUNT_CHECKS),
        "run-4": clean(trips(spark, sf_dir), SPEC).metrics,
    }
    for run_id, metrics in runs.items():
        append_table(quality.with_run(metrics, run_id, SILVER), path)
    return read_table(spark, path)


def dq_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_runs(dq_history(spark, sf_dir))


CLOCK_CHECKS = (
    Check("present", "now IS NOT NULL", QUARANTINE),
    Check("not_low", "current_date <> '5-LOW'", QUARANTINE),
    Check("quoted", r"note <> 'now\''", QUARANTINE),
    Check("doubled", "note = 'é now()'", WARN),
    Check("past", "now < now() AND now < localtimestamp AND now < curdate()", WARN),
    Check("future", "now > timestampadd(DAY, 1, current_timestamp) OR note = \"é now()\"", WARN),
)


def clock_named(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Check]]:
    """Orders with columns that are named like clocks, and checks that ask such columns, clocks and quoted words."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.when(k % 7 != 0, F.col("o_orderdate")).alias("now"),
        F.col("o_orderpriority").alias("current_date"),
        F.when(k % 3 == 0, "now'").otherwise("é now()").alias("note"),
    )
    return rows, quality.bound(rows, CLOCK_CHECKS)


def dq_clock_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_outcome(quality.check_metrics(*clock_named(spark, sf_dir)))


def dq_clock_names_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_rows(*clock_named(spark, sf_dir))


# Gold


def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact(cleaned(spark, sf_dir), SPEC.fact_columns)


def roundtrip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(scratch_folder(spark), GOLD, SPEC.fact_table)
    overwrite_table(clustered(gold_fact(spark, sf_dir), SPEC.silver_partitions), path, SPEC.silver_partitions)
    return read_table(spark, path, SPEC.fact_schema)


def mart(index: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mean_mart(cleaned(spark, sf_dir), SPEC.marts[index])


def gold_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(0, spark, sf_dir)


def gold_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(1, spark, sf_dir)


def gold_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.total_mart(cleaned(spark, sf_dir), "pickup_year_month", "total_amount", "revenue")


def stored_mart(index: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart written to gold and asked with SQL through its view."""
    lake = scratch_folder(spark)
    spec_mart = SPEC.marts[index]
    spec = DatasetSpec(SPEC.name, SPEC.columns, SPEC.time_column, marts=(spec_mart,))
    overwrite_table(mart(index, spark, sf_dir), table_path(lake, GOLD, spec.mart_table(spec_mart)))
    return answers(spark, spec, lake)[spec_mart.name]


def sql_q1_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_mart(0, spark, sf_dir)


def sql_q2_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_mart(1, spark, sf_dir)


def sql_q1_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned(spark, sf_dir).createOrReplaceTempView("silver_orders_trips")
    return spark.sql(month_mean_query("silver_orders_trips", "pickup_ts", "total_amount", "avg_total_amount"))


def sql_q2_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned(spark, sf_dir).createOrReplaceTempView("silver_orders_trips")
    return spark.sql(hour_mean_query("silver_orders_trips", "pickup_ts", "passenger_count", "avg_passenger_count", 5))


def kpi_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.trend_kpis(gold_q1(spark, sf_dir), "pickup_year_month", "avg_total_amount", "trips")


def kpi_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.extreme_kpis(gold_q2(spark, sf_dir), "pickup_hour", "avg_passenger_count", "trips")


# Profiles


def eda_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.volume(cleaned(spark, sf_dir), "pickup_year_month")


def eda_amount_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_profile(cleaned(spark, sf_dir), "total_amount")


def eda_passenger_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(cleaned(spark, sf_dir), "passenger_count")


def eda_passenger_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = {"one": "passenger_count = 1", "none": "passenger_count IS NULL OR passenger_count = 0"}
    return marts.share(cleaned(spark, sf_dir), shares)


# Other tables, to show that nothing is tied to trips


def shipment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_outcome(clean(table(spark, sf_dir, "lineitem"), SHIPMENTS).metrics)


def shipment_monthly_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(*SHIPMENTS.columns)
    return marts.mean_mart(clean(rows, SHIPMENTS).valid, SHIPMENTS.marts[0])


def shipment_price_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_profile(table(spark, sf_dir, "lineitem"), "l_extendedprice")


def shipment_price_profile_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures with a small last step, so that the histogram passes of large tables are used here too."""
    return profile.numeric_profile(table(spark, sf_dir, "lineitem"), "l_extendedprice", finish_rows=100)


def account_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_text(quality.Split(table(spark, sf_dir, "customer"), ACCOUNT_CHECKS).quarantine)


def account_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_outcome(quality.check_metrics(table(spark, sf_dir, "customer"), ACCOUNT_CHECKS))


def event_hourly_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = marts.enrich(table(spark, sf_dir, "events"), "ts", "event")
    by_hour = MeanMart("agg_hourly_value", ("event_type", "event_hour"), "value", "avg_value", 3, count_alias="events")
    return marts.mean_mart(events, by_hour)


# Jobs: landing to answers through the tables of a lake


def pipeline(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    lake = land(spark, sf_dir, scratch_folder(spark))
    bounds = order_months(spark, sf_dir).collect()[0]
    return lake, run_pipeline(spark, SPEC, lake, bounds["first_month"], bounds["last_month"], RUN_ID)


def pipeline_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir)[1][MONTHLY_MART]


def pipeline_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline(spark, sf_dir)[1][HOURLY_MART]


def pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = pipeline(spark, sf_dir)
    counts = reconcile_layers(spark, SPEC, lake)
    quality.assert_reconciled(counts)
    return counts


def pipeline_clock_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with a check against the clock: every row of bronze is in one of the two tables."""
    lake = land(spark, sf_dir, scratch_folder(spark))
    recent = Check("recent_or_small", "pickup_ts > now() OR total_amount < 150000", QUARANTINE)
    spec = replace(SPEC, checks=(*SPEC.checks, recent))
    run_bronze(spark, spec, lake, "run-1")
    run_silver(spark, spec, lake, "run-1")
    return reconcile_layers(spark, spec, lake)


def two_datasets_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart of two datasets in one lake, after both have run: the second has twice the amounts."""
    lake = scratch_folder(spark)
    double = replace(SPEC, name="doubled")
    out = []
    for spec, factor in ((SPEC, 1), (double, 2)):
        months = {"year": F.substring("delivery_month", 1, 4), "month": F.substring("delivery_month", 6, 2)}
        rows = plain_parts(spark, sf_dir).withColumns({**months, "total_amount": F.col("total_amount") * factor})
        overwrite_table(clustered(rows.drop("delivery_month"), list(months)), landing_root(lake, spec.name), list(months))
    for spec in (SPEC, double):
        run_bronze(spark, spec, lake, RUN_ID)
        run_silver(spark, spec, lake, RUN_ID)
        run_gold(spark, spec, lake)
    for spec in (SPEC, double):
        monthly = answers(spark, spec, lake)[MONTHLY_MART]
        checks = check_history(spark, lake, RUN_ID).filter(F.col("dataset") == spec.name).count()
        out.append(monthly.select(F.lit(spec.name).alias("dataset"), "*", F.lit(checks).cast("bigint").alias("checks")))
    return out[0].unionByName(out[1])


def bronze_plain_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and months of bronze after deliveries that are part files right in the month's folder, in a lake whose root
    has a folder named landing itself."""
    lake = f"{scratch_folder(spark)}/landing/2020-01/lake"
    months = {"year": F.substring("delivery_month", 1, 4), "month": F.substring("delivery_month", 6, 2)}
    rows = plain_parts(spark, sf_dir).withColumns(months).drop("delivery_month")
    overwrite_table(clustered(rows, list(months)), landing_root(lake, SPEC.name), list(months))
    bounds = order_months(spark, sf_dir).collect()[0]
    statuses = landing.ingest(spark, lake, SPEC.name, bounds["first_month"], bounds["last_month"])
    run_bronze(spark, SPEC, lake, RUN_ID)
    bronze = read_table(spark, table_path(lake, BRONZE, SPEC.table), SPEC.bronze_schema)
    counts = bronze.groupBy(F.col("_source_month").alias("month")).count()
    return counts.join(statuses, "month", "full").select("month", "count", "status")


def bronze_alternating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed rows of deliveries whose types change with every month."""
    lake = land_alternating(spark, sf_dir, scratch_folder(spark))
    return landing.read_conformed(spark, lake, SPEC.name, SPEC.columns, RUN_ID).select(*COLUMNS)


def redelivered(spark: SparkSession, sf_dir: str, silver_before: bool) -> tuple[str, list[str]]:
    """A lake whose bronze got one month again without rows and another with half of its own."""
    lake = land(spark, sf_dir, scratch_folder(spark))
    run_bronze(spark, SPEC, lake, "run-1")
    if silver_before:
        run_silver(spark, SPEC, lake, "run-1")
    root = landing_root(lake, SPEC.name)
    again = plain_parts(spark, sf_dir).drop("delivery_month")
    for month, kept in (("02", "false"), ("03", "trip_distance < 15")):
        part = f"{root}/year=1998/month={month}/delivery=orders_tripdata_1998-{month}"
        again.filter(f"date_format(pickup_ts, 'yyyy-MM') = '1998-{month}'").filter(kept).write.mode("overwrite").parquet(part)
    months = ["1998-02", "1998-03"]
    run_bronze(spark, SPEC, lake, "run-2", months=months)
    return lake, months


def bronze_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of bronze by month after one month was landed again without rows and another with half of its own."""
    lake, _ = redelivered(spark, sf_dir, silver_before=False)
    bronze = read_table(spark, table_path(lake, BRONZE, SPEC.table), SPEC.bronze_schema)
    return bronze.groupBy(F.col("_source_month").alias("month")).count()


def silver_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected rows after silver took over two months that were delivered again, and made only what they can
    change anew."""
    lake, months = redelivered(spark, sf_dir, silver_before=True)
    run_silver(spark, SPEC, lake, "run-2", months=months)
    valid = read_table(spark, table_path(lake, SILVER, SPEC.table), SPEC.silver_schema)
    rejected = read_table(spark, table_path(lake, SILVER, SPEC.rejected_table), SPEC.rejected_schema)
    rejected = marts.enrich(rejected, SPEC.time_column, SPEC.time_prefix)
    names = [*SPEC.fact_columns, REASON]
    return valid.withColumn(REASON, F.lit("")).select(*names).unionByName(reason_text(rejected).select(*names))


def dq_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check history of that run: totals of the whole tables, of which only some months were counted."""
    lake, months = redelivered(spark, sf_dir, silver_before=True)
    run_silver(spark, SPEC, lake, "run-2", months=months)
    return check_history(spark, lake, "run-2")


def bronze_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of events that were delivered as moments, conformed under a session zone other than UTC."""
    before = spark.conf.get("spark.sql.session.timeZone")
    path = f"{scratch_folder(spark)}/moments"
    moment = F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts))")
    table(spark, sf_dir, "events").select("event_id", moment.alias("ts")).write.parquet(path)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        conformed = conform(spark.read.parquet(path), {"event_id": "bigint", "ts": "timestamp_ntz"})
        hours = conformed.groupBy(F.hour("ts").alias("event_hour")).count()
        hours.write.parquet(f"{path}-hours")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    return spark.read.parquet(f"{path}-hours")


def dq_blocked_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check history after a run that a BLOCK check stopped; nothing else was published."""
    lake = land(spark, sf_dir, scratch_folder(spark))
    spec = replace(SPEC, checks=(Check("vendor_known", not_null("vendor_id"), BLOCK), *SPEC.checks[1:]))
    run_bronze(spark, spec, lake, RUN_ID)
    try:
        run_silver(spark, spec, lake, RUN_ID)
    except quality.BlockedRunError:
        published = read_optional(spark, table_path(lake, SILVER, spec.table))
        return check_history(spark, lake, RUN_ID).withColumn("published", F.lit(published is not None))
    raise AssertionError("the run was not blocked")


def pipeline_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check history after the jobs have run, silver twice."""
    lake = land(spark, sf_dir, scratch_folder(spark))
    run_bronze(spark, SPEC, lake, "run-1")
    run_silver(spark, SPEC, lake, "run-1")
    run_silver(spark, SPEC, lake, "run-2")
    return run_profile(spark, SPEC, lake, "total_amount", "passenger_count")["latest_checks"]


def pipeline_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact table after bronze was rebuilt for one year in place."""
    lake = land(spark, sf_dir, scratch_folder(spark))
    run_bronze(spark, SPEC, lake, "run-1")
    run_bronze(spark, SPEC, lake, "run-2", months=[f"1997-{m:02d}" for m in range(1, 13)])
    run_silver(spark, SPEC, lake, "run-2")
    return read_table(spark, run_gold(spark, SPEC, lake), SPEC.fact_schema)


QUERIES: dict[str, Query] = {
    "month_spine": month_spine,
    "ingest_plan": ingest_plan,
    "ingest_totals": ingest_totals,
    "ingest_totals_forced": ingest_totals_forced,
    "landing_manifest": landing_manifest,
    "table_hashes": table_hashes,
    "bronze_conform": bronze_conform,
    "bronze_audit": bronze_audit,
    "bronze_provenance": bronze_provenance,
    "bronze_union": bronze_union,
    "silver_dedup": silver_dedup,
    "silver_enrich": silver_enrich,
    "silver_clean": cleaned,
    "dq_tag": dq_tag,
    "dq_valid": dq_valid,
    "dq_quarantine": dq_quarantine,
    "dq_metrics": dq_metrics,
    "dq_reason_counts": dq_reason_counts,
    "dq_reconcile": dq_reconcile,
    "dq_history": dq_history,
    "dq_latest": dq_latest,
    "gold_fact": gold_fact,
    "roundtrip_fact": roundtrip_fact,
    "gold_q1": gold_q1,
    "gold_q2": gold_q2,
    "gold_monthly_revenue": gold_monthly_revenue,
    "sql_q1_mart": sql_q1_mart,
    "sql_q2_mart": sql_q2_mart,
    "sql_q1_silver": sql_q1_silver,
    "sql_q2_silver": sql_q2_silver,
    "eda_volume": eda_volume,
    "eda_amount_profile": eda_amount_profile,
    "eda_passenger_dist": eda_passenger_dist,
    "eda_passenger_share": eda_passenger_share,
    "kpi_q1": kpi_q1,
    "kpi_q2": kpi_q2,
    "shipment_metrics": shipment_metrics,
    "shipment_monthly_price": shipment_monthly_price,
    "shipment_price_profile": shipment_price_profile,
    "shipment_price_profile_refined": shipment_price_profile_refined,
    "account_quarantine": account_quarantine,
    "account_metrics": account_metrics,
    "event_hourly_value": event_hourly_value,
    "pipeline_q1": pipeline_q1,
    "pipeline_q2": pipeline_q2,
    "pipeline_counts": pipeline_counts,
    "pipeline_clock_counts": pipeline_clock_counts,
    "two_datasets_marts": two_datasets_marts,
    "bronze_plain_parts": bronze_plain_parts,
    "bronze_redelivered": bronze_redelivered,
    "bronze_alternating": bronze_alternating,
    "silver_redelivered": silver_redelivered,
    "dq_redelivered": dq_redelivered,
    "dq_clock_names": dq_clock_names,
    "dq_clock_names_valid": dq_clock_names_valid,
    "bronze_zoned": bronze_zoned,
    "dq_blocked_run": dq_blocked_run,
    "pipeline_checks": pipeline_checks,
    "pipeline_fact": pipeline_fact,
}
