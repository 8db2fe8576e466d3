from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.datasets.trips import yellow
from stratalake.operators.conform import add_provenance, conform, union_by_name

COLUMNS = {"VendorID": "int", "passenger_count": "double", "total_amount": "double"}


def test_casts_known_columns_and_drops_the_rest(spark):
    rows = [("17", 4, "8.25", True), (None, 0, "-3", False), ("9", None, None, True)]
    df = spark.createDataFrame(rows, "vendorId string, passenger_count smallint, total_amount string, paid boolean")
    out = conform(df, COLUMNS)
    assert out.dtypes == list(COLUMNS.items())
    assert out.collect() == [(17, 4.0, 8.25), (None, 0.0, -3.0), (9, None, None)]


def test_absent_column_is_typed_null_and_case_is_ignored(spark):
    out = conform(spark.createDataFrame([(7,)], "vendorid bigint"), COLUMNS)
    assert out.dtypes == list(COLUMNS.items())
    assert out.first() == (7, None, None)


def test_values_that_do_not_fit_become_null(spark):
    df = spark.createDataFrame(
        [(2**40, "abc", "1.5"), (5, " 2 ", "NaN")], "VendorID bigint, passenger_count string, total_amount string"
    )
    first, second = conform(df, COLUMNS).collect()
    assert first == (None, None, 1.5)
    assert second[:2] == (5, 2.0) and second[2] != second[2]
    nan = spark.createDataFrame([(float("nan"),)], "VendorID double")
    assert conform(nan, {"VendorID": "int"}).first() == (None,)


def test_types_of_the_trip_spec(spark):
    out = conform(spark.range(1), yellow().columns)
    assert dict(out.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert out.columns == list(yellow().columns)


def test_provenance_from_folders_and_names(spark):
    keys = {
        "landing/green/year=2019/month=11/part-00003-9129-4910-a.c000.parquet": ("2019-11", "2019", "11"),
        "landing/green/year=2019/month=12/green_tripdata_2018-01/part-0.parquet": ("2019-12", "2019", "12"),
        "landing/green/late/green_tripdata_2021-07.parquet": ("2021-07", "2021", "07"),
        "landing/green/part-20190-1234-56.parquet": ("", "", ""),
    }
    rows = spark.createDataFrame([(k,) for k in keys], "key string")
    for row in add_provenance(rows, F.col("key"), "nightly-7").collect():
        assert (row["_source_month"], row["source_year"], row["source_month"]) == keys[row["key"]]
        assert row["_source_file"] == row["key"]
        assert row["_batch_id"] == "nightly-7" and row["_ingested_at"] is not None


def test_zoned_times_are_read_as_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    got = set()
    try:
        for zone in ("America/Sao_Paulo", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.range(1).select(F.expr("timestamp_micros(1572143400000001)").alias("t"))
            got.add(conform(df, {"t": "timestamp_ntz"}).select(F.col("t").cast("string")).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {"2019-10-27 02:30:00.000001"}


def test_file_without_a_month_gives_empty_text(spark):
    row = add_provenance(spark.range(1), F.lit("landing/yellow/trips.parquet"), "b").first()
    assert (row["_source_month"], row["source_year"], row["source_month"]) == ("", "", "")


def test_union_by_name_over_drifting_types(spark):
    whole = spark.createDataFrame([(4, "a"), (6, "b")], "total_amount bigint, note string")
    broken = spark.createDataFrame([("1.5",), ("n/a",)], "total_amount string")
    out = union_by_name([conform(df, {"total_amount": "double"}) for df in (whole, broken)])
    assert out.dtypes == [("total_amount", "double")]
    assert [r[0] for r in out.collect()] == [4.0, 6.0, 1.5, None]
    wider = union_by_name([out, spark.createDataFrame([(True,)], "extra boolean")])
    assert wider.columns == ["total_amount", "extra"] and wider.filter("extra").first()[0] is None
