"""Twelve trips, one per cleaning path, and the results worked out by hand."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from stratalake.datasets.trips import yellow
from stratalake.sources.layout import landing_month

SPEC = yellow()
SCHEMA = (
    "VendorID int, passenger_count double, total_amount double, tpep_pickup_datetime timestamp_ntz, "
    "tpep_dropoff_datetime timestamp_ntz, trip_distance double"
)


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


# The trips, and what cleaning and the two marts make of them.
ROWS = [
    # plain trips
    (1, 1.0, 10.0, "2023-01-10T12:00", "2023-01-10T12:15", 1.0),
    (2, 3.0, 20.0, "2023-01-20T09:00", "2023-01-20T09:30", 2.0),
    (1, 2.0, 30.0, "2023-02-05T08:00", "2023-02-05T08:20", 3.0),
    (1, 1.0, 40.0, "2023-05-03T08:10", "2023-05-03T08:30", 1.5),
    (2, 3.0, 50.0, "2023-05-03T08:50", "2023-05-03T09:10", 4.0),
    (2, 2.0, 60.0, "2023-05-05T09:15", "2023-05-05T09:40", 5.0),
    # no passengers: stays, but not in the passenger mart
    (1, 0.0, 70.0, "2023-05-06T09:20", "2023-05-06T09:45", 2.0),
    # copy of the first trip
    (1, 1.0, 10.0, "2023-01-10T12:00", "2023-01-10T12:15", 1.0),
    # before the window
    (1, 5.0, 999.0, "2022-12-15T10:00", "2022-12-15T10:20", 3.0),
    # negative amount
    (1, 1.0, -5.0, "2023-05-04T08:00", "2023-05-04T08:20", 1.0),
    # no pickup time
    (1, 1.0, 12.0, None, "2023-01-01T00:10", 1.0),
    # dropoff before pickup
    (1, 1.0, 15.0, "2023-03-01T10:00", "2023-03-01T09:00", 2.0),
]
RAW, VALID, QUARANTINED = 12, 7, 4
Q1 = {"2023-01": (2, 15.0), "2023-02": (1, 30.0), "2023-05": (4, 55.0)}
Q2 = {8: (2, 2.0), 9: (1, 2.0)}
FAILED = {
    "vendor_not_null": 0,
    "pickup_not_null": 1,
    "dropoff_not_null": 0,
    "amount_not_null": 0,
    "pickup_in_window": 2,
    "amount_positive": 1,
    "dropoff_after_pickup": 2,
    "passenger_positive": 1,
}


def golden(spark: SparkSession) -> DataFrame:
    rows = [(v, p, a, at(start), at(end), d) for v, p, a, start, end, d in ROWS]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def land_golden(spark: SparkSession, lake: str, month: str = "2023-01") -> None:
    """All twelve trips as one delivery."""
    golden(spark).write.parquet(f"{landing_month(lake, 'yellow', month)}/yellow_tripdata_{month}.parquet")
