from __future__ import annotations

from golden import Q1, Q2, SPEC, golden
from pyspark.sql import functions as F

from stratalake.operators import marts
from stratalake.operators.marts import finished_mart, mart_parts, mean_mart
from stratalake.plans.jobs import clean
from stratalake.spec import MeanMart


def test_golden_marts(spark):
    silver = clean(golden(spark), SPEC).valid
    monthly, hourly = (marts.mean_mart(silver, m) for m in SPEC.marts)
    assert [tuple(r) for r in monthly.collect()] == [(k, *v) for k, v in Q1.items()]
    assert [tuple(r) for r in hourly.collect()] == [(k, *v) for k, v in Q2.items()]
    assert monthly.columns == ["pickup_year_month", "trips", "avg_total_amount"]
    assert hourly.columns == ["pickup_hour", "trips", "avg_passenger_count"]


def test_fact_columns_drop_provenance(spark):
    fact = marts.fact(clean(golden(spark), SPEC).valid, SPEC.fact_columns)
    assert len(fact.columns) == 11
    assert fact.columns[:6] == list(SPEC.columns)


def test_time_dimensions_ignore_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = []
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT TIMESTAMP_NTZ '2023-03-26 02:30:00' AS t")
            seen.append(tuple(marts.enrich(df, "t", "p").drop("t").selectExpr("*", "string(p_date) AS d").drop("p_date").first()))  # noqa: E501
        assert set(seen) == {(2023, 3, "2023-03", 2, "2023-03-26")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_monthly_total(spark):
    df = spark.createDataFrame([("2023-01", 1.25), ("2023-01", 2.5), ("2023-02", None)], "m string, v double")
    assert [tuple(r) for r in marts.total_mart(df, "m", "v", "total").collect()] == [("2023-01", 3.75), ("2023-02", None)]


def test_kpis_take_the_earliest_group_on_a_tie(spark):
    monthly = spark.createDataFrame([("b", 5.0, 1), ("a", 5.0, 2), ("c", 2.0, 4)], "k string, v double, n bigint")
    assert tuple(marts.trend_kpis(monthly, "k", "v", "n").first()) == (4.0, "a", 5.0, 7)
    hourly = spark.createDataFrame([(3, 1.0, 9), (1, 2.0, 9), (2, 2.0, 1), (0, 1.0, 8)], "k int, v double, n bigint")
    assert tuple(marts.extreme_kpis(hourly, "k", "v", "n").first()) == (1, 2.0, 0, 1.0, 1)


def test_share_counts_null_as_not_met(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (1.0,)], "v double")
    row = marts.share(df, {"one": "v = 1", "none": "v IS NULL OR v = 0"}).first()
    assert tuple(row) == (4, 2, 0.5, 2, 0.5)
    assert tuple(marts.share(df.limit(0), {"one": "v = 1"}).first()) == (0, 0, None)


def test_mart_with_hot_group_sends_partial_sums(spark):
    mart = MeanMart("m", ("k",), "v", "avg_v")
    df = spark.range(100_000).selectExpr("IF(id % 3 = 0, -1, id % 10) AS k", "cast(id % 5 AS double) AS v")
    out = marts.mean_mart(df, mart)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_count" in plan
    assert sum(r["trips"] for r in out.collect()) == 100_000


def test_means_do_not_depend_on_the_order_of_sums(spark):
    """Exact halves, negative ones, cents that doubles cannot hold, and sums whose order changes the last digit."""
    rows = [("half", 0.005), ("half", 0.005), ("minus", -0.005), ("minus", -0.005), ("tenths", 0.1), ("tenths", 0.2), ("tenths", 0.3)]
    rows += [("wide", 1e11), *[("wide", 0.01)] * 1000, ("wide", -1e11), ("none", None), ("third", 1.0), ("third", 1.0), ("third", 0.0)]
    mart = MeanMart("m", ("k",), "v", "mean", 2)
    want = {"half": 0.01, "minus": -0.01, "tenths": 0.2, "wide": 0.01, "none": None, "third": 0.67}
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: (r[1] or 0, r[0]))):
        df = spark.createDataFrame(order, "k string, v double").repartition(3)
        assert {r["k"]: r["mean"] for r in mean_mart(df, mart).collect()} == want


def test_values_beyond_whole_millionths(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("inf", inf), ("inf", 1.0), ("nan", nan), ("nan", 2.0), ("huge", 1e300), ("huge", 3e300), ("both", 1e13), ("both", 0.5)]
    out = {r["k"]: r["mean"] for r in mean_mart(spark.createDataFrame(rows, "k string, v double"), MeanMart("m", ("k",), "v", "mean", 2)).collect()}
    assert (out["inf"], out["huge"], out["both"]) == (inf, 2e300, 5000000000000.25) and out["nan"] != out["nan"]


def test_parts_add_up(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id % 3 AS month", "id / 7.0D AS v")
    mart = MeanMart("m", ("k",), "v", "mean", 3, where="id >= 0", count_alias="n")
    rows = df.withColumn("id", F.lit(1))
    assert finished_mart(mart_parts(rows, mart, ["month"]), mart).collect() == mean_mart(rows, mart).collect()
