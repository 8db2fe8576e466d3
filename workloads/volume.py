"""Monthly trip deliveries of any size, repeated from every row of ``lineitem``, for throughput runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.datasets.trips import yellow
from stratalake.sources.layout import landing_root
from stratalake.sources.tables import clustered, overwrite_table

SPEC = yellow()
FIRST_MONTH = "2023-01"
LAST_MONTH = "2023-05"

# 64-bit passenger counts in the first delivery, doubles later; each select list is one variant.
VARIANTS = {
    "month = '01'": "CAST(passenger_count AS bigint) AS passenger_count",
    "month <> '01'": "passenger_count",
}


def volume_trips(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    """``copies`` trips per lineitem row, spread over January to May 2023 with about one per cent dirt."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    # One small file is one scan task; its rows are dealt out before they are multiplied.
    dealt = lines.repartition(spark.sparkContext.defaultParallelism)
    rows = dealt.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    h = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_extendedprice", "r"), F.lit(1_000_000_007))
    hashed = rows.select("*", h.alias("h"))
    second = F.col("h") % (151 * 86_400)
    start = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
    pickup = start + F.make_dt_interval(secs=second)
    amount = F.round(F.col("l_extendedprice") / 1000 + F.col("h") % 1000 / 100, 2)
    return hashed.select(
        (F.col("h") % 2 + 1).cast("int").alias("VendorID"),
        F.when(F.col("h") % 23 != 0, F.col("l_quantity") % 6 + 1).cast("double").alias("passenger_count"),
        F.when(F.col("h") % 113 == 0, -amount).otherwise(amount).alias("total_amount"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + F.make_dt_interval(secs=F.col("h") % 3600 - 2)).alias("tpep_dropoff_datetime"),
        (F.col("h") % 300 / 10).alias("trip_distance"),
        F.lit("N").alias("store_and_fwd_flag"),
    )


def land_volume(spark: SparkSession, sf_dir: str, lake: str, copies: int) -> None:
    dated = volume_trips(spark, sf_dir, copies).withColumns(
        {
            "year": F.lit("2023"),
            "month": F.substring(F.to_date("tpep_pickup_datetime").cast("string"), 6, 2),
        }
    )
    deliveries = dated.withColumn("delivery", F.concat(F.lit("yellow_tripdata_2023-"), F.col("month")))
    for where, passengers in VARIANTS.items():
        others = [c for c in SPEC.columns if c != "passenger_count"]
        folders = ("year", "month", "delivery")
        variant = deliveries.filter(where).selectExpr(passengers, *others, "store_and_fwd_flag", *folders)
        overwrite_table(clustered(variant, folders), landing_root(lake, SPEC.name), folders, touched_only=True)
