from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import duckdb
import pytest
from golden import FAILED, Q1, Q2, QUARANTINED, RAW, SPEC, VALID, golden, land_golden
from pyspark.sql import functions as F

from stratalake.__main__ import chosen_spec, execute, parse, window
from stratalake.datasets.trips import HOURLY_MART, MONTHLY_MART, green, yellow
from stratalake.operators import quality
from stratalake.operators.quality import BLOCK, Check
from stratalake.plans import jobs
from stratalake.plans.sql import hour_mean_query, month_mean_query, register_views
from stratalake.sources import versions
from stratalake.sources.layout import landing_month, table_path
from stratalake.sources.tables import read_optional, read_table
from stratalake.spec import DatasetSpec
from stratalake.streaming.incremental import stream_bronze


def table(spark, lake, layer, name, schema=None):
    return read_table(spark, table_path(lake, layer, name), schema)


def mart_rows(df):
    return {r[0]: (r[1], r[2]) for r in df.collect()}


def test_pipeline_on_golden_trips(spark, lake):
    land_golden(spark, lake)
    answers = jobs.run_pipeline(spark, SPEC, lake, "2023-01", "2023-01", "run-1")
    assert mart_rows(answers[MONTHLY_MART]) == Q1
    assert mart_rows(answers[HOURLY_MART]) == Q2

    bronze = table(spark, lake, "bronze", "yellow_trips", SPEC.bronze_schema)
    assert bronze.count() == RAW
    row = bronze.first()
    assert (row["source_year"], row["source_month"], row["_source_month"]) == ("2023", "01", "2023-01")
    assert row["_batch_id"] == "run-1" and row["_source_file"].startswith("landing/yellow/")

    silver = table(spark, lake, "silver", "yellow_trips", SPEC.silver_schema)
    rejected = table(spark, lake, "silver", "yellow_trips_rejected", SPEC.rejected_schema)
    assert (silver.count(), rejected.count()) == (VALID, QUARANTINED)
    assert silver.filter("_source_file IS NULL OR _batch_id IS NULL OR source_month <> '01'").isEmpty()
    assert "pickup_hour" not in rejected.columns
    assert read_table(spark, table_path(lake, "silver", "yellow_trips_rejected")).columns == rejected.columns

    fact = table(spark, lake, "gold", "fact_yellow_trips", SPEC.fact_schema)
    assert fact.count() == VALID and len(fact.columns) == 11

    checks = jobs.check_history(spark, lake, "run-1").collect()
    assert {r["check"]: r["rows_failed"] for r in checks} == FAILED
    assert {(r["rows_in"], r["layer"]) for r in checks} == {(RAW - 1, "silver")}
    quality.assert_reconciled(jobs.reconcile_layers(spark, SPEC, lake))


def test_jobs_can_be_run_again(spark, lake):
    land_golden(spark, lake)
    for run in ("run-1", "run-2"):
        answers = jobs.run_pipeline(spark, SPEC, lake, "2023-01", "2023-01", run)
    assert mart_rows(answers[MONTHLY_MART]) == Q1
    assert table(spark, lake, "silver", "yellow_trips", SPEC.silver_schema).count() == VALID
    assert jobs.check_history(spark, lake).count() == 16


def test_copies_in_two_deliveries_are_one_trip(spark, lake):
    land_golden(spark, lake, "2023-01")
    land_golden(spark, lake, "2023-02")
    jobs.run_bronze(spark, SPEC, lake, "b")
    jobs.run_silver(spark, SPEC, lake, "r")
    silver = table(spark, lake, "silver", "yellow_trips", SPEC.silver_schema)
    assert silver.count() == VALID
    assert {r["source_month"] for r in silver.collect()} == {"01"}


def test_one_month_is_rebuilt_in_place(spark, lake):
    land_golden(spark, lake, "2023-01")
    land_golden(spark, lake, "2023-02")
    jobs.run_bronze(spark, SPEC, lake, "b1")
    jobs.run_bronze(spark, SPEC, lake, "b2", months=["2023-02"])
    bronze = table(spark, lake, "bronze", "yellow_trips", SPEC.bronze_schema)
    assert {(r["source_month"], r["_batch_id"]) for r in bronze.collect()} == {("01", "b1"), ("02", "b2")}
    assert bronze.count() == 2 * RAW
    with pytest.raises(FileNotFoundError):
        jobs.run_bronze(spark, SPEC, lake, "b3", months=["2023-03"])


def test_month_delivered_again_without_rows_disappears(spark, lake):
    land_golden(spark, lake, "2023-01")
    land_golden(spark, lake, "2023-02")
    jobs.run_bronze(spark, SPEC, lake, "b1")
    golden(spark).limit(0).write.mode("overwrite").parquet(f"{landing_month(lake, 'yellow', '2023-02')}/yellow_tripdata_2023-02.parquet")
    jobs.run_bronze(spark, SPEC, lake, "b2", months=["2023-02"])
    bronze = table(spark, lake, "bronze", "yellow_trips", SPEC.bronze_schema)
    assert {r["source_month"] for r in bronze.collect()} == {"01"} and bronze.count() == RAW


def test_silver_refuses_chance_and_missing_rows(spark, lake, monkeypatch):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b")
    with pytest.raises(ValueError, match="same answer"):
        jobs.run_silver(spark, replace(SPEC, checks=[Check("luck", "rand() < 0.5")]), lake, "r")
    whole = quality.quarantined_rows
    monkeypatch.setattr(quality, "quarantined_rows", lambda df, checks: whole(df, checks).filter("total_amount > 0"))
    with pytest.raises(quality.ReconciliationError, match="12 bronze rows"):
        jobs.run_silver(spark, SPEC, lake, "r")


def everything(spark, lake, spec=SPEC):
    """Published rows of silver without what names the run, and the counts table."""
    valid = table(spark, lake, "silver", spec.table, spec.silver_schema).drop("_batch_id", "_ingested_at")
    rejected = table(spark, lake, "silver", spec.rejected_table, spec.rejected_schema).drop("_batch_id", "_ingested_at")
    counts = table(spark, lake, "silver", spec.counts_table, spec.counts_schema)
    return [sorted(map(repr, df.collect())) for df in (valid, rejected, counts)]


def redeliver(spark, lake, month, rows):
    rows.write.mode("overwrite").parquet(f"{landing_month(lake, 'yellow', month)}/yellow_tripdata_{month}.parquet")


@pytest.mark.parametrize("month", ["2023-01", "2023-02"])
@pytest.mark.parametrize("kept", ["false", "total_amount < 35", "VendorID = 2 OR tpep_pickup_datetime IS NULL"])
def test_some_months_again_equal_a_full_run(spark, lake, month, kept):
    """Copies of all rows lie in two deliveries: what one no longer has survives from the other, and what is new in the
    earlier one takes over. A third delivery is not touched."""
    extra = golden(spark).withColumn("total_amount", F.col("total_amount") + 1000)
    for m in ("2023-01", "2023-02"):
        land_golden(spark, lake, m)
    redeliver(spark, lake, "2023-03", extra)
    jobs.run_bronze(spark, SPEC, lake, "b1")
    jobs.run_silver(spark, SPEC, lake, "r1")
    new = golden(spark).filter(kept).unionByName(extra.limit(3).withColumn("trip_distance", F.lit(0.5)))
    redeliver(spark, lake, month, new)
    jobs.run_bronze(spark, SPEC, lake, "b2", months=[month])
    jobs.run_silver(spark, SPEC, lake, "r2", months=[month])
    found, history = everything(spark, lake), sorted(map(repr, jobs.check_history(spark, lake, "r2").drop("run_id").collect()))
    jobs.run_silver(spark, SPEC, lake, "r3")
    assert found == everything(spark, lake)
    assert history == sorted(map(repr, jobs.check_history(spark, lake, "r3").drop("run_id").collect()))
    quality.assert_reconciled(jobs.reconcile_layers(spark, SPEC, lake))


def test_only_changed_months_are_written_again(spark, lake):
    land_golden(spark, lake, "2023-01")
    jobs.run_bronze(spark, SPEC, lake, "b1")
    jobs.run_silver(spark, SPEC, lake, "r1")
    before = versions.current(spark, f"{lake}/silver", SPEC.table).tables[SPEC.table]
    redeliver(spark, lake, "2023-02", golden(spark).filter("month(tpep_pickup_datetime) = 2"))
    jobs.run_bronze(spark, SPEC, lake, "b2", months=["2023-02"])
    jobs.run_silver(spark, SPEC, lake, "r2", months=["2023-02"])
    after = versions.current(spark, f"{lake}/silver", SPEC.table).tables[SPEC.table]
    assert {f for f in after if after[f] != before.get(f)} == {"pickup_year=2023/pickup_month=2"}
    assert jobs.in_months(SPEC, [None, (2023, 1), (2023, 2), (2022, 12), (2020, 5)])._jc.toString().count(">=") == 2


def gold(spark, lake):
    fact = table(spark, lake, "gold", SPEC.fact_table, SPEC.fact_schema)
    return [sorted(map(repr, df.collect())) for df in (fact, *(table(spark, lake, "gold", SPEC.mart_table(m)) for m in SPEC.marts))]


def test_gold_takes_over_changed_months_only(spark, lake):
    land_golden(spark, lake, "2023-01")
    land_golden(spark, lake, "2023-03")
    jobs.run_bronze(spark, SPEC, lake, "b1")
    jobs.run_silver(spark, SPEC, lake, "r1")
    jobs.run_gold(spark, SPEC, lake)
    assert mart_rows(table(spark, lake, "gold", MONTHLY_MART)) == Q1
    layer = f"{lake}/gold"
    before = versions.current(spark, layer, SPEC.fact_table).tables
    for month in ("2023-01", "2023-03"):
        new = golden(spark).filter("month(tpep_pickup_datetime) <> 5").withColumn("trip_distance", F.lit(9.0))
        redeliver(spark, lake, month, new.filter("month(tpep_pickup_datetime) = 2 OR month(tpep_pickup_datetime) = 1"))
    jobs.run_bronze(spark, SPEC, lake, "b2", months=["2023-03"])
    jobs.run_silver(spark, SPEC, lake, "r2", months=["2023-03"])
    jobs.run_gold(spark, SPEC, lake)
    after = versions.current(spark, layer, SPEC.fact_table).tables
    same = "pickup_year=2023/pickup_month=5"
    silver = versions.current(spark, f"{lake}/silver", SPEC.table).tables[SPEC.table]
    assert set(after[SPEC.fact_table]) == set(silver)
    found = gold(spark, lake)
    jobs.run_gold(spark, SPEC, lake)
    again = versions.current(spark, layer, SPEC.fact_table).tables
    assert again == after and gold(spark, lake) == found
    assert before[SPEC.fact_table][same] and after[SPEC.fact_table][same]
    # A rebuild from nothing gives the same.
    other = f"{lake}-again"
    for month in ("2023-01", "2023-03"):
        read = spark.read.parquet(f"{landing_month(lake, 'yellow', month)}/yellow_tripdata_{month}.parquet") if month == "2023-03" else golden(spark)
        read.write.parquet(f"{landing_month(other, 'yellow', month)}/yellow_tripdata_{month}.parquet")
    jobs.run_bronze(spark, SPEC, other, "b1")
    jobs.run_silver(spark, SPEC, other, "r1")
    jobs.run_gold(spark, SPEC, other)
    assert gold(spark, other) == found


def test_a_full_run_where_a_partial_one_would_differ(spark, lake):
    """Other checks than the published tables have, a clock, or copies that may differ in their time."""
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b")
    jobs.run_silver(spark, SPEC, lake, "r1")
    layer = f"{lake}/silver"
    for spec in (
        replace(SPEC, checks=[*SPEC.checks, Check("short", "trip_distance < 3")]),
        replace(SPEC, checks=[*SPEC.checks, Check("past", "tpep_pickup_datetime < localtimestamp")]),
        replace(SPEC, dedup_keys=("VendorID", "total_amount")),
    ):
        jobs.run_silver(spark, spec, lake, "r2", months=["2023-01"])
        found = everything(spark, lake)
        assert len(set(versions.current(spark, layer, SPEC.table).tables[SPEC.table].values())) == 1
        jobs.run_silver(spark, spec, lake, "r3")
        assert found == everything(spark, lake)


def test_reconciliation_counts_and_shuffles_no_row(spark, lake):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b1")
    jobs.run_silver(spark, SPEC, lake, "r1")
    counts = jobs.reconcile_layers(spark, SPEC, lake)
    assert counts.first().asDict() == {
        "raw": RAW, "deduped": RAW - 1, "quarantined": QUARANTINED, "valid": VALID, "multi_failed": 1, "balanced": True
    }
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "total_amount" not in plan
    # Bronze that silver has not taken over, or a published table that lost rows, is found.
    land_golden(spark, lake, "2023-02")
    jobs.run_bronze(spark, SPEC, lake, "b2", months=["2023-02"])
    with pytest.raises(quality.ReconciliationError):
        quality.assert_reconciled(jobs.reconcile_layers(spark, SPEC, lake))
    jobs.run_silver(spark, SPEC, lake, "r2", months=["2023-02"])
    quality.assert_reconciled(jobs.reconcile_layers(spark, SPEC, lake))
    next(Path(f"{lake}/silver/{SPEC.table}").rglob("pickup_month=2/*.parquet")).unlink()
    with pytest.raises(quality.ReconciliationError):
        quality.assert_reconciled(jobs.reconcile_layers(spark, SPEC, lake))


@pytest.mark.parametrize("fails_at", ["valid", "rejected", "proof", "counts", "pointer"])
def test_a_run_that_fails_leaves_the_published_tables(spark, lake, monkeypatch, fails_at):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b1")
    jobs.run_silver(spark, SPEC, lake, "r1")
    before = everything(spark, lake)
    redeliver(spark, lake, "2023-02", golden(spark).withColumn("total_amount", F.col("total_amount") + 7))
    jobs.run_bronze(spark, SPEC, lake, "b2", months=["2023-02"])
    write, whole = versions.write_version, quality.quarantined_rows
    names = {"valid": SPEC.table, "rejected": SPEC.rejected_table, "counts": SPEC.counts_table}

    def failing(df, path, version, partition_by=()):
        write(df, path, version, partition_by)
        if path.endswith(f"/{names[fails_at]}"):
            raise OSError("disk full")

    if fails_at in names:
        monkeypatch.setattr(versions, "write_version", failing)
    elif fails_at == "proof":
        monkeypatch.setattr(quality, "quarantined_rows", lambda df, checks: whole(df, checks).filter("total_amount > 0"))
    else:
        monkeypatch.setattr(versions, "_system", lambda session, path, real=versions._system: (_ for _ in ()).throw(OSError("no")) if "/." in path else real(session, path))
    with pytest.raises((OSError, quality.ReconciliationError)):
        jobs.run_silver(spark, SPEC, lake, "r2", months=["2023-02"])
    monkeypatch.undo()
    assert everything(spark, lake) == before
    jobs.run_silver(spark, SPEC, lake, "r2", months=["2023-02"])
    assert table(spark, lake, "silver", SPEC.table, SPEC.silver_schema).count() == 2 * VALID + 1  # an amount of -5 came as 2


def test_a_table_that_was_never_published_is_missing(spark, lake):
    versions.write_version(spark.range(3), f"{lake}/silver/t", "v1")
    assert read_optional(spark, f"{lake}/silver/t") is None
    first = versions.publish(spark, f"{lake}/silver", "t", {"t": {"": "v1"}}, None)
    assert read_table(spark, f"{lake}/silver/t").count() == 3
    with pytest.raises(versions.ConcurrentRunError):
        versions.publish(spark, f"{lake}/silver", "t", {"t": {"": "v2"}}, None)
    pointer = first
    for n in range(2, 6):
        versions.write_version(spark.range(n), f"{lake}/silver/t", f"v{n}")
        pointer = versions.publish(spark, f"{lake}/silver", "t", {"t": {"": f"v{n}"}}, pointer)
    assert read_table(spark, f"{lake}/silver/t").count() == 5
    assert sorted(p.name for p in Path(f"{lake}/silver/t").glob("version=*")) == ["version=v4", "version=v5"]


def test_a_retried_run_replaces_its_metrics(spark, lake):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b")
    for run in ("007", "007", "008"):
        jobs.run_silver(spark, SPEC, lake, run)
    history = jobs.check_history(spark, lake)
    assert history.count() == 16 and {(r["run_id"], r["dataset"]) for r in history.collect()} == {("007", "yellow"), ("008", "yellow")}


def test_another_engine_reads_the_tables(spark, lake):
    land_golden(spark, lake)
    jobs.run_pipeline(spark, SPEC, lake, "2023-01", "2023-01", "r")
    con = duckdb.connect()
    silver = f"read_parquet('{lake}/silver/yellow_trips/**/*.parquet', hive_partitioning = true)"
    count, mean, months = con.sql(f"SELECT count(*), avg(total_amount), list(DISTINCT pickup_month) FROM {silver}").fetchall()[0]
    rows = table(spark, lake, "silver", "yellow_trips", SPEC.silver_schema)
    assert (count, mean) == (VALID, rows.agg({"total_amount": "avg"}).first()[0]) and sorted(months) == [1, 2, 5]
    monthly = con.sql(f"SELECT * FROM '{lake}/gold/{MONTHLY_MART}/*.parquet' ORDER BY 1").fetchall()
    assert monthly == sorted(map(tuple, table(spark, lake, "gold", MONTHLY_MART).collect()))


def test_block_failure_publishes_metrics_only(spark, lake):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b")
    strict = replace(SPEC, checks=[*SPEC.checks, Check("amount_not_negative", "total_amount >= 0", BLOCK)])
    with pytest.raises(quality.BlockedRunError, match="amount_not_negative"):
        jobs.run_silver(spark, strict, lake, "blocked")
    assert read_optional(spark, table_path(lake, "silver", "yellow_trips")) is None
    history = {r["check"]: r for r in jobs.check_history(spark, lake, "blocked").collect()}
    assert history["amount_not_negative"]["rows_failed"] == 1
    assert {k: v["rows_failed"] for k, v in history.items() if k in FAILED} == FAILED

    passing = replace(SPEC, checks=[*SPEC.checks, Check("vendor_known", "VendorID IN (1, 2)", BLOCK)])
    jobs.run_silver(spark, passing, lake, "passed")
    assert jobs.check_history(spark, lake, "passed").count() == 9


def test_block_check_on_a_dropped_copy_does_not_stop_the_run(spark, lake):
    """The failing copy comes from the later file, which deduplication drops."""
    spec = DatasetSpec(
        "x", {"id": "int", "ts": "timestamp_ntz", "note": "string"}, "ts", dedup_keys=("id", "ts"),
        checks=[Check("note_is_a", "note = 'a'", BLOCK)],
    )
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id int, note string").selectExpr(
        "id", "TIMESTAMP_NTZ '2023-01-01 00:00:00' AS ts", "note"
    )
    df.write.parquet(f"{landing_month(lake, 'x', '2023-01')}/x_tripdata_2023-01.parquet")
    jobs.run_bronze(spark, spec, lake, "b")
    jobs.run_silver(spark, spec, lake, "r")
    (row,) = jobs.check_history(spark, lake, "r").collect()
    assert (row["rows_in"], row["rows_failed"]) == (1, 0)


def test_checks_may_read_provenance(spark, lake):
    land_golden(spark, lake, "2023-01")
    land_golden(spark, lake, "2023-02")
    jobs.run_bronze(spark, SPEC, lake, "b")
    spec = replace(SPEC, checks=[Check("delivered_in_february", "_source_month = '2023-02'")])
    jobs.run_silver(spark, spec, lake, "r")
    (row,) = jobs.check_history(spark, lake, "r").collect()
    assert (row["rows_in"], row["rows_failed"]) == (RAW - 1, RAW - 1)
    assert table(spark, lake, "silver", "yellow_trips_rejected").count() == RAW - 1


def test_all_rows_rejected_leaves_readable_tables(spark, lake):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b")
    nothing = replace(SPEC, checks=[Check("never", "false")])
    jobs.run_silver(spark, nothing, lake, "r")
    jobs.run_gold(spark, nothing, lake)
    assert table(spark, lake, "silver", "yellow_trips", SPEC.silver_schema).count() == 0
    assert table(spark, lake, "silver", "yellow_trips_rejected").count() == RAW - 1
    assert table(spark, lake, "gold", MONTHLY_MART).count() == 0


def test_profile_with_and_without_history(spark, lake):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b")
    jobs.run_silver(spark, SPEC, lake, "r")
    found = jobs.run_profile(spark, SPEC, lake, "total_amount", "passenger_count")
    assert tuple(found["amount"].first()) == (10.0, 40.0, 40.0, 70.0)
    assert {r["reason"]: r["count"] for r in found["reasons"].collect()} == {k: v for k, v in FAILED.items() if v and k != "passenger_positive"}  # noqa: E501
    assert found["latest_checks"].count() == 8


def test_views_and_sql_over_silver(spark, lake):
    land_golden(spark, lake)
    jobs.run_pipeline(spark, SPEC, lake, "2023-01", "2023-01", "r")
    views = register_views(spark, SPEC, lake)
    assert set(views) == {
        "silver_yellow_trips", "silver_yellow_trips_rejected", "gold_fact_yellow_trips",
        f"gold_{MONTHLY_MART}", f"gold_{HOURLY_MART}", "dq_check_results",
    }
    time = SPEC.time_column
    monthly = spark.sql(month_mean_query("silver_yellow_trips", time, "total_amount", "a"))
    hourly = spark.sql(hour_mean_query("silver_yellow_trips", time, "passenger_count", "a", 5))
    assert mart_rows(monthly) == Q1 and mart_rows(hourly) == Q2
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "(pickup_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    other = month_mean_query("silver_yellow_trips", time, "total_amount", "a", prefix="ride")
    assert spark.sql(other).columns[0] == "ride_year_month"


def test_month_mart_reads_only_its_folders(spark, lake):
    land_golden(spark, lake)
    jobs.run_bronze(spark, SPEC, lake, "b")
    jobs.run_silver(spark, SPEC, lake, "r")
    from stratalake.operators.marts import mean_mart

    silver = table(spark, lake, "silver", "yellow_trips", SPEC.silver_schema)
    plan = mean_mart(silver, SPEC.marts[1])._jdf.queryExecution().executedPlan().toString()
    assert "(pickup_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThan(passenger_count,0.0)" in plan
    assert "ReadSchema: struct<passenger_count:double,pickup_hour:int>" in plan


def test_another_dataset_is_a_spec(spark, lake):
    spec = green()
    names = {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    folder = f"{landing_month(lake, 'green', '2023-01')}/green_tripdata_2023-01.parquet"
    golden(spark).withColumnsRenamed(names).write.parquet(folder)
    land_golden(spark, lake)
    answers = jobs.run_pipeline(spark, spec, lake, "2023-01", "2023-01", "r")
    assert mart_rows(answers[MONTHLY_MART]) == Q1
    jobs.run_pipeline(spark, SPEC, lake, "2023-01", "2023-01", "r")
    assert table(spark, lake, "gold", MONTHLY_MART).count() == table(spark, lake, "gold", spec.mart_table(spec.marts[0])).count()
    assert {(r["dataset"], r["count"]) for r in jobs.check_history(spark, lake, "r").groupBy("dataset").count().collect()} == {("green", 8), ("yellow", 8)}


def test_stream_handles_each_file_once(spark, lake, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        query = stream_bronze(spark, SPEC, lake, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
        bronze = table(spark, lake, "bronze", "yellow_trips", SPEC.bronze_schema)
        return {(r["_source_month"], r["_batch_id"]) for r in bronze.collect()}, bronze.count()

    land_golden(spark, lake, "2023-01")
    assert run() == ({("2023-01", "stream-000000")}, RAW)
    assert run() == ({("2023-01", "stream-000000")}, RAW)
    land_golden(spark, lake, "2023-02")
    batches, count = run()
    assert batches == {("2023-01", "stream-000000"), ("2023-02", "stream-000001")} and count == 2 * RAW


def test_command_line(spark, lake):
    land_golden(spark, lake)

    def run(command, *options):
        return execute(spark, SPEC, parse([command, "--lake", lake, *options]), "cli")

    shown = run("ingest", "--start", "2023-01", "--end", "2023-02")
    assert {tuple(r) for r in shown["totals"].collect()} == {("ingested", 1), ("missing", 1)}
    assert run("bronze") == {} and "checks" in run("silver") and run("gold") == {}
    assert mart_rows(run("analyze")[MONTHLY_MART]) == Q1
    report = run("report")
    assert tuple(report["monthly amounts"].first()) == (33.33, "2023-05", 55.0, 7)
    assert tuple(report["passengers by hour"].first()) == (8, 2.0, 8, 2.0, 8)
    assert run("reconcile")["row counts"].first()["balanced"]
    assert set(run("eda")) == {"volume", "amount", "distribution", "reasons", "latest_checks"}
    assert mart_rows(run("pipeline", "--force")[HOURLY_MART]) == Q2
    assert Path(lake).exists()


def test_command_line_takes_any_spec_and_some_months(spark, lake, capsys, monkeypatch):
    assert chosen_spec(parse(["gold", "--lake", lake, "--spec", "golden:SPEC"])) == SPEC
    assert chosen_spec(parse(["gold", "--lake", lake, "--spec", "stratalake.datasets.trips:green"])).name == "green"
    land_golden(spark, lake, "2023-01")
    land_golden(spark, lake, "2023-02")
    for command, months in (("bronze", "2023-01"), ("silver", None), ("bronze", "2023-02"), ("silver", "2023-02")):
        execute(spark, SPEC, parse([command, "--lake", lake, *(["--months", months] if months else [])]), f"{command}-{months}")
    assert table(spark, lake, "bronze", SPEC.table, SPEC.bronze_schema).count() == 2 * RAW
    quality.assert_reconciled(jobs.reconcile_layers(spark, SPEC, lake))


def test_results_are_printed_once(spark, lake, capsys, monkeypatch):
    from stratalake import __main__ as command

    made = spark.range(120).withColumn("n", F.col("id") * 2)
    monkeypatch.setattr(command, "execute", lambda *a: {"many": made, "few": made.limit(1)})
    assert command.main(["analyze", "--lake", lake]) == 0
    out = capsys.readouterr().out
    assert "only the first 50 rows" in out and "|98 |" not in out.split("few")[1] and "|49 |98 |" in out


def test_window_follows_the_months_asked_for():
    asked = ["silver", "--lake", "x", "--start", "2024-11", "--end", "2024-12"]
    assert window(parse(asked)) == ("2024-11-01 00:00:00", "2025-01-01 00:00:00")
    assert window(parse([*asked, "--window-end", "2024-12-05 00:00:00"]))[1] == "2024-12-05 00:00:00"
    assert yellow(*window(parse(["gold", "--lake", "x"]))) == yellow()


def test_spec_refuses_unknown_columns_and_repeated_checks():
    with pytest.raises(ValueError, match="does not declare"):
        DatasetSpec("x", {"a": "int"}, "b")
    with pytest.raises(ValueError, match="repeats"):
        DatasetSpec("x", {"a": "date"}, "a", checks=[Check("c", "true"), Check("c", "true")])
