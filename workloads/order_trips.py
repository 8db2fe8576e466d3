"""Trips derived from every row of ``orders``, with deterministic dirt so that each check has something to find."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.datasets.trips import trip_spec
from stratalake.plans.parallel import in_parallel
from stratalake.sources.layout import landing_root
from stratalake.sources.tables import clustered, overwrite_table
from stratalake.spec import FILE_NUMBER

WINDOW_START = "1996-01-01 00:00:00"
WINDOW_END = "2001-01-01 00:00:00"

SPEC = trip_spec(
    "orders",
    vendor="vendor_id",
    pickup="pickup_ts",
    dropoff="dropoff_ts",
    window_start=WINDOW_START,
    window_end=WINDOW_END,
)
COLUMNS = list(SPEC.columns)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_delivery(spark, sf_dir).select(*COLUMNS)


def delivered_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the key of the file they came in; the two copies of a row came in different files."""
    return _with_delivery(spark, sf_dir).select(*COLUMNS, delivery_key().alias("_source_file"))


def numbered_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the number of the file they came in, as bronze keeps it; numbers follow the order of the keys."""
    return _with_delivery(spark, sf_dir).select(*COLUMNS, delivery_number().alias(FILE_NUMBER))


def delivery_files(months: DataFrame) -> DataFrame:
    """The dictionary of all files that ``months`` can have."""
    files = months.select(F.col("month").alias("delivery_month"), F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    return files.select(delivery_number().alias(FILE_NUMBER), delivery_key().alias("_source_file"))


def delivery_number() -> Column:
    year, mm = (F.substring("delivery_month", at, n).cast("bigint") for at, n in ((1, 4), (6, 2)))
    return (year * 12 + mm) * 2 + F.col("copy")


def plain_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with their delivery month, for deliveries in the types of the spec."""
    return _with_delivery(spark, sf_dir).select(*COLUMNS, "delivery_month")


def delivery_key() -> Column:
    month = F.col("delivery_month")
    year, mm = F.substring(month, 1, 4), F.substring(month, 6, 2)
    template = "landing/orders/year=%s/month=%s/orders_tripdata_%s-%d.parquet"
    return F.format_string(template, year, mm, month, F.col("copy"))


def _with_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the table; a row with a copy is repeated in place instead of reading the table twice."""
    k = F.col("o_orderkey")
    minute = (k % 24) * 60 + k % 60
    copies = F.when(k % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))

    def at(minutes: Column) -> Column:
        return F.col("o_orderdate") + F.make_dt_interval(mins=minutes.cast("int"))

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.when(k % 211 != 0, (F.col("o_custkey") % 4).cast("int")).alias("vendor_id"),
        F.when(k % 53 != 0, (k % 7).cast("double")).alias("passenger_count"),
        F.when(k % 101 == 0, F.lit(None))
        .when(k % 97 == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("total_amount"),
        F.when(k % 103 != 0, at(minute)).alias("pickup_ts"),
        F.when(k % 107 != 0, at(minute + (k * 7) % 90 - 2)).alias("dropoff_ts"),
        ((k % 300) / 10).alias("trip_distance"),
        F.substring(F.to_date("o_orderdate").cast("string"), 1, 7).alias("delivery_month"),
        F.explode(copies).alias("copy"),
    )


# How the deliveries of some years differ from the spec. Each variant is a select list over the trips.
VARIANTS = {
    # 64-bit integers where the spec has int and double.
    (None, "1997"): [
        "cast(vendor_id AS bigint) AS vendor_id",
        "cast(passenger_count AS bigint) AS passenger_count",
        "total_amount",
        "pickup_ts",
        "dropoff_ts",
        "trip_distance",
    ],
    # Another column-name case, no distance, one unknown column.
    ("1997", "1998"): [
        "vendor_id AS VENDOR_ID",
        "passenger_count",
        "total_amount",
        "pickup_ts",
        "dropoff_ts",
        "'card' AS payment",
    ],
    # Amounts as text, with text that is no number where the amount is missing.
    ("1998", "1999"): [
        "vendor_id",
        "passenger_count",
        "coalesce(cast(total_amount AS string), 'n/a') AS total_amount",
        "pickup_ts",
        "dropoff_ts",
        "trip_distance",
    ],
    ("1999", None): COLUMNS,
}


def land(spark: SparkSession, sf_dir: str, lake: str) -> str:
    """Write all trips as monthly deliveries whose types drift from year to year; returns the lake root."""
    month = F.col("delivery_month")
    variants = []
    for (first, last), columns in VARIANTS.items():
        since = month >= first if first else F.lit(True)
        variants.append((since & (month < last) if last else since, columns))
    return _land(spark, sf_dir, lake, variants)


def land_alternating(spark: SparkSession, sf_dir: str, lake: str) -> str:
    """Monthly deliveries of which every other one has 64-bit integers where the spec has int and double."""
    even = F.substring("delivery_month", 6, 2).cast("int") % 2 == 0
    return _land(spark, sf_dir, lake, [(even, VARIANTS[None, "1997"]), (~even, COLUMNS)])


def _land(spark: SparkSession, sf_dir: str, lake: str, variants: list[tuple[Column, list[str]]]) -> str:
    rows = _with_delivery(spark, sf_dir)
    month = F.col("delivery_month")
    folders = {
        "year": F.substring(month, 1, 4),
        "month": F.substring(month, 6, 2),
        "delivery": F.concat(F.lit("orders_tripdata_"), month),
    }

    def write(which: Column, columns: list[str]) -> None:
        variant = rows.filter(which).selectExpr(*columns, "delivery_month").withColumns(folders).drop("delivery_month")
        overwrite_table(
            clustered(variant, list(folders)), landing_root(lake, SPEC.name), list(folders), touched_only=True
        )

    # The variants touch different months, so they can be written side by side.
    in_parallel(spark, *[partial(write, which, columns) for which, columns in variants])
    return lake
