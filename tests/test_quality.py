from __future__ import annotations

import pytest
from golden import FAILED, QUARANTINED, RAW, SPEC, VALID, golden
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.operators.quality import BLOCK, QUARANTINE, REASON, WARN, Check, Split
from stratalake.plans.jobs import clean

AMOUNT = Check("amt_positive", "amt > 0")


def amounts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values, 1)], "id int, amt double")


def failed(metrics):
    return {r["check"]: r["rows_failed"] for r in metrics.collect()}


def test_gate_splits_and_warn_does_not_move_rows(spark):
    checks = [AMOUNT, Check("id_negative", F.col("id") < 0, WARN)]
    out = Split(amounts(spark, 5.0, -1.0, 0.0), checks)
    assert [r["id"] for r in out.valid.collect()] == [1]
    assert out.valid.columns == ["id", "amt"]
    assert sorted(r["id"] for r in out.quarantine.collect()) == [2, 3]
    assert failed(out.metrics) == {"amt_positive": 2, "id_negative": 3}
    assert {r["severity"] for r in out.metrics.collect()} == {QUARANTINE, WARN}


def test_reasons_are_listed_in_check_order(spark):
    checks = [AMOUNT, Check("id_large", "id > 10"), Check("warned", "false", WARN), Check("blocked", "false", BLOCK)]
    row = quality.quarantined_rows(amounts(spark, -1.0), checks).first()
    assert row[REASON] == ["amt_positive", "id_large", "blocked"]


def test_null_predicate_fails(spark):
    out = Split(amounts(spark, None, 1.0), [AMOUNT])
    assert out.valid.count() == 1 and out.quarantine.count() == 1
    assert failed(out.metrics) == {"amt_positive": 1}


def test_nan_is_positive_unless_checked(spark):
    nan = amounts(spark, float("nan"))
    assert Split(nan, [AMOUNT]).valid.count() == 1
    assert Split(nan, [AMOUNT, Check("amt_is_number", "NOT isnan(amt)")]).valid.count() == 0


def test_tag_keeps_every_row(spark):
    tagged = quality.tag(amounts(spark, 1.0, -1.0), [AMOUNT]).orderBy("id").collect()
    assert [r[REASON] for r in tagged] == [[], ["amt_positive"]]


def test_without_gates_everything_is_valid(spark):
    out = Split(amounts(spark, 1.0, -1.0), [Check("w", "false", WARN)])
    assert out.valid.count() == 2 and out.quarantine.count() == 0
    assert dict(out.quarantine.dtypes)[REASON] == "array<string>"


def test_no_checks_at_all(spark):
    out = Split(amounts(spark, 1.0), [])
    assert out.valid.count() == 1 and out.quarantine.count() == 0 and out.metrics.count() == 0


def test_empty_input_counts_zero(spark):
    metrics = quality.check_metrics(amounts(spark), [AMOUNT]).collect()
    assert [tuple(r) for r in metrics] == [("amt_positive", QUARANTINE, 0, 0, True)]
    row = quality.reconcile(amounts(spark), ["id", "amt"], [AMOUNT]).first()
    assert row.asDict() == {
        "raw": 0, "deduped": 0, "quarantined": 0, "valid": 0, "multi_failed": 0, "balanced": True
    }


def test_all_rows_invalid(spark):
    out = Split(amounts(spark, -1.0, -2.0), [AMOUNT])
    assert out.valid.isEmpty() and out.quarantine.count() == 2


def test_metric_types(spark):
    assert quality.check_metrics(amounts(spark, 1.0), [AMOUNT]).dtypes == [
        ("check", "string"),
        ("severity", "string"),
        ("rows_in", "bigint"),
        ("rows_failed", "bigint"),
        ("passed", "boolean"),
    ]


def test_block_failure_raises_with_the_check_name(spark):
    checks = [Check("must_hold", "amt > 0", BLOCK), Check("other", "amt > 0")]
    with pytest.raises(ValueError, match=r"must_hold \(1 rows\)"):
        quality.assert_no_block_failures(quality.check_metrics(amounts(spark, -1.0, 1.0), checks))
    quality.assert_no_block_failures(quality.check_metrics(amounts(spark, 1.0), checks))
    quality.assert_no_block_failures(quality.check_metrics(amounts(spark, -1.0), [AMOUNT]))


def test_outcome_words(spark):
    checks = [Check("good", "true"), Check("bad", "false"), Check("warned", "true", WARN)]
    shown = quality.with_outcome(quality.check_metrics(amounts(spark, 1.0), checks)).collect()
    assert {r["check"]: r["outcome"] for r in shown} == {"good": "ok", "bad": "FAIL", "warned": "WARN"}


def test_unknown_severity_is_refused():
    with pytest.raises(ValueError, match="severity"):
        Check("x", "true", "FATAL")


def test_reason_counts_and_latest_runs(spark):
    rejected = quality.quarantined_rows(amounts(spark, -1.0, None, 3.0), [AMOUNT, Check("small", "amt < 2")])
    assert [tuple(r) for r in quality.reason_counts(rejected).collect()] == [("amt_positive", 2), ("small", 2)]
    history = spark.createDataFrame([(f"c{i:02d}", f"run-{i % 2}") for i in range(30)], "check string, run_id string")
    latest = quality.latest_runs(history.unionByName(history.withColumn("run_id", F.lit("run-"))), 2).collect()
    assert [r["run_id"] for r in latest] == ["run-1"] * 15 + ["run-0"] * 15
    assert [r["check"] for r in latest[:2]] == ["c01", "c03"]


def test_reconciliation_balances_and_is_enforced(spark):
    row = quality.reconcile(golden(spark), SPEC.keys, SPEC.checks).first()
    assert (row["raw"], row["deduped"], row["valid"], row["quarantined"]) == (RAW, RAW - 1, VALID, QUARANTINED)
    assert row["multi_failed"] == 1 and row["balanced"]
    wrong = spark.createDataFrame([(10, 9, 1, 7, 0, False)], "raw int, deduped int, quarantined int, valid int, multi_failed int, balanced boolean")  # noqa: E501
    with pytest.raises(quality.ReconciliationError):
        quality.assert_reconciled(wrong)


def test_golden_trips(spark):
    out = clean(golden(spark), SPEC)
    assert out.valid.count() == VALID
    assert out.valid.filter("passenger_count = 0").count() == 1
    assert {"pickup_year", "pickup_month", "pickup_year_month", "pickup_hour", "pickup_date"} <= set(out.valid.columns)
    rejected = out.quarantine.collect()
    assert len(rejected) == QUARANTINED
    no_pickup = next(r for r in rejected if r["tpep_pickup_datetime"] is None)
    assert no_pickup[REASON] == ["pickup_not_null", "pickup_in_window", "dropoff_after_pickup"]
    assert failed(out.metrics) == FAILED
    assert {r["rows_in"] for r in out.metrics.collect()} == {RAW - 1}


def test_valid_filter_reaches_the_parquet_reader(spark, tmp_path):
    path = str(tmp_path / "trips")
    golden(spark).write.parquet(path)
    plan = clean(spark.read.parquet(path), SPEC).valid._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan and "GreaterThan(total_amount,0.0)" in plan
    assert "SortAggregate" not in plan and "Python" not in plan


def test_clock_is_read_once_and_chance_is_refused(spark):
    df = spark.createDataFrame([(1, "now")], "id int, word string")
    rules = ["current_timestamp() > TIMESTAMP '2020-01-01'", "word = 'now' AND now() IS NOT NULL", "current_date > DATE '2020-01-01'"]
    checks = quality.bound(df, [Check(f"c{i}", r) for i, r in enumerate(rules)] + [Check("column", F.col("id") > 0)])
    assert "timestamp_micros(" in checks[0].valid_when and "= 'now' AND timestamp_micros(" in checks[1].valid_when
    assert quality.valid_rows(df, checks).count() == 1
    for rule in ("rand() < 0.5", F.rand() < 0.5, F.current_timestamp() > F.lit("2020-01-01").cast("timestamp"), "uuid() > 'a'"):
        with pytest.raises(ValueError, match="same answer"):
            quality.bound(df, [Check("c", rule)])


def test_only_what_tells_the_time_is_bound(spark):
    """Columns named like clocks, escaped quotes, double quotes, back quotes and characters beyond 16 bits stay."""
    df = spark.createDataFrame([(None, "now'", "d"), ("x", "now()", None)], "now string, note string, current_date string")
    rules = {
        "now IS NOT NULL": 1,
        r"note <> 'now\''": 1,
        'note = "now()"': 1,
        "`current_date` IS NULL": 1,
        "current_date = 'd'": 1,
        "note = 'now()' AND now() > TIMESTAMP '2020-01-01'": 1,
        "concat('\U0001f600', note) = '\U0001f600now()' AND localtimestamp() > DATE '2020-01-01' AND curdate() > DATE '2020-01-01'": 1,
        "unix_timestamp() > 1600000000 AND unix_timestamp(TIMESTAMP '2020-01-01') < 1600000000": 2,
        "current_timestamp > TIMESTAMP '2020-01-01' /* now() */": 2,
    }
    for rule, kept in rules.items():
        (check,) = quality.bound(df, [Check("c", rule)])
        assert quality.valid_rows(df, [check]).count() == kept, rule
    (check,) = quality.bound(df, [Check("c", "now IS NOT NULL AND current_date IS NULL")])
    assert check.valid_when == "now IS NOT NULL AND current_date IS NULL"


def test_counts_by_group_add_up(spark):
    df = spark.createDataFrame([(k, v) for k in (1, 2, None) for v in (1.0, -1.0, None)], "k int, amt double")
    checks = [AMOUNT, Check("small", "amt < 1", WARN)]
    counts = quality.check_counts(df, checks, ["k"])
    assert counts.count() == 3
    assert quality.metrics_of(counts, checks).collect() == quality.check_metrics(df, checks).collect()
    empty = quality.check_counts(df.limit(0), checks, ["k"])
    assert quality.metrics_of(empty, checks).collect() == quality.check_metrics(df.limit(0), checks).collect()
    assert quality.metrics_of(quality.check_counts(df, [], ["k"]), []).count() == 0
