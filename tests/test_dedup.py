from __future__ import annotations

from golden import SPEC
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.operators import dedup
from stratalake.operators.conform import file_number
from stratalake.operators.dedup import deduplicate, put_back, within_bound
from stratalake.plans.jobs import dedup_rows


def test_null_nan_and_signed_zero_are_equal(spark):
    nan = float("nan")
    rows = [(None, 1.0), (None, 1.0), (nan, 1.0), (nan, 1.0), (0.0, 1.0), (-0.0, 1.0)]
    assert deduplicate(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).count() == 3


def test_smallest_payload_survives_whole(spark):
    rows = [(1, "b", 1), (1, "a", 9), (2, "c", 5), (1, "a", 3)]
    df = spark.createDataFrame(rows, "k int, f string, n int").repartition(4)
    out = deduplicate(df, ["k"])
    assert out.columns == ["k", "f", "n"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", 3), (2, "c", 5)]


def test_null_payload_is_smallest_and_copies_are_counted(spark):
    rows = [(1, 5.0), (1, None), (2, 7.0), (2, 6.0), (2, 6.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    lone = deduplicate(df, ["k"], copies="n").collect()
    paired = deduplicate(df.withColumn("w", F.lit("x")), ["k"], copies="n").drop("w").collect()
    assert sorted(map(tuple, lone)) == sorted(map(tuple, paired)) == [(1, None, 2), (2, 6.0, 3)]
    assert sorted(map(tuple, deduplicate(df, ["k", "v"], copies="n").select("k", "n").collect())) == [(1, 1), (1, 1), (2, 1), (2, 2)]


def test_derived_columns_follow_the_survivor(spark):
    rows = [(1, "2023-02"), (1, "2023-01")]
    df = spark.createDataFrame(rows, "k int, m string").withColumn("year", F.substring("m", 1, 4))
    out = deduplicate(df, ["k"], {"year": F.substring("m", 1, 4)})
    assert [tuple(r) for r in out.collect()] == [(1, "2023-01", "2023")]


def hot_rows(spark):
    """A third of the rows are copies of one row, spread over many files."""
    n = 30_000
    k = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 7000)
    return spark.range(0, n, 1, 16).select(
        k.alias("k"),
        (k % 11).cast("double").alias("v"),
        F.concat(F.lit("file-"), F.format_string("%03d", F.col("id") % 40)).alias("f"),
        F.lit("b").alias("b"),
    )


def numbered(spark, rows, columns, order):
    """Rows with a number for ``columns``, and the dictionary of numbers, in the order of the columns."""
    dictionary = rows.select(*columns).distinct().withColumn("code", F.dense_rank().over(Window.orderBy(*order)).cast("long"))
    same = [rows[c].eqNullSafe(dictionary[c]) for c in columns]
    coded = rows.join(dictionary, same).select(*[rows[c] for c in rows.columns if c not in columns], "code")
    return coded, dictionary


def test_a_number_changes_nothing_but_the_plan(spark):
    rows = hot_rows(spark)
    plain = deduplicate(rows, ["k", "v"])
    coded, dictionary = numbered(spark, rows, ["f", "b"], ["f", "b"])
    coded.write.mode("overwrite").saveAsTable("coded_rows")
    out = put_back(deduplicate(spark.table("coded_rows"), ["k", "v"]), within_bound(dictionary), "code").select(*rows.columns)
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("HashAggregate") :]
    assert "SortAggregate" not in plan and "Join" not in below.split("coded_rows")[0]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))
    spark.sql("DROP TABLE coded_rows")


def test_a_large_dictionary_is_joined_without_a_broadcast_hint(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BROADCAST_BYTES", 39 * dedup.ROW_BYTES)
    rows = hot_rows(spark)
    coded, dictionary = numbered(spark, rows, ["f", "b"], ["f", "b"])
    out = put_back(deduplicate(coded, ["k", "v"]), within_bound(dictionary), "code").select(*rows.columns)
    assert "strategy=broadcast" not in out._jdf.queryExecution().logical().toString()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, deduplicate(rows, ["k", "v"]).collect()))


def test_a_number_that_the_dictionary_lacks(spark):
    coded = spark.createDataFrame([(1, 5), (1, 3), (2, 7), (3, None)], "k int, code long")
    dictionary = spark.createDataFrame([(3, "a", None), (5, "b", "x")], "code long, f string, b string")
    out = put_back(deduplicate(coded, ["k"]), within_bound(dictionary), "code").select("k", "f", "b")
    assert sorted(map(tuple, out.collect())) == [(1, "a", None), (2, None, None), (3, None, None)]


def test_file_numbers_order_by_month_and_differ(spark):
    rows = [(f"f{i}", m) for m in ("2022-12", "2023-01", "", "2023-02", "x") for i in range(200)]
    out = spark.createDataFrame(rows, "f string, m string").withColumn("n", file_number(F.col("f"), F.col("m"))).collect()
    assert len({r["n"] for r in out if r["m"] not in ("", "x")}) == 600 and None not in {r["n"] for r in out}
    by_month = {m: [r["n"] for r in out if r["m"] == m] for m in ("", "2022-12", "2023-01", "2023-02")}
    assert max(by_month[""]) < min(by_month["2022-12"]) and max(by_month["2022-12"]) < min(by_month["2023-01"])
    assert max(by_month["2023-01"]) < min(by_month["2023-02"])


def test_silver_dedup_hashes(spark):
    from workloads.queries import silver_dedup

    plan = silver_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_copies_leave_a_task_once(spark):
    """Aggregation starts before the shuffle, so a hot row cannot fill one reducer."""
    df = spark.range(10).select(*[F.lit(1).cast(t).alias(c) for c, t in {**SPEC.columns, "tpep_pickup_datetime": "int", "tpep_dropoff_datetime": "int"}.items()])  # noqa: E501
    plan = dedup_rows(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
