"""Taxi trips as the public monthly files deliver them, with the cleaning policy and the two marts."""

from __future__ import annotations

from stratalake.functions.predicates import in_window, not_before, not_null, positive, present_and_positive
from stratalake.operators.quality import QUARANTINE, WARN, Check
from stratalake.spec import DatasetSpec, MeanMart

# The default ingestion window, half open, and the month of the passenger mart.
WINDOW_START = "2023-01-01 00:00:00"
WINDOW_END = "2023-06-01 00:00:00"
PASSENGER_MONTH = 5

# Names of the gold marts.
MONTHLY_MART = "agg_monthly_total_amount"
HOURLY_MART = "agg_may_passengers_by_hour"


def trip_spec(
    name: str,
    *,
    vendor: str,
    pickup: str,
    dropoff: str,
    passengers: str = "passenger_count",
    amount: str = "total_amount",
    distance: str = "trip_distance",
    window_start: str = WINDOW_START,
    window_end: str = WINDOW_END,
    passenger_month: int = PASSENGER_MONTH,
    plain_marts: bool = False,
) -> DatasetSpec:
    """The trip policy over any naming of its six columns.

    Times carry no zone (``timestamp_ntz``), so hours and months do not move with the session time zone.
    """
    return DatasetSpec(
        name=name,
        plain_marts=plain_marts,
        columns={
            vendor: "int",
            passengers: "double",
            amount: "double",
            pickup: "timestamp_ntz",
            dropoff: "timestamp_ntz",
            distance: "double",
        },
        time_column=pickup,
        dedup_keys=(pickup, amount, dropoff, distance, vendor, passengers),
        # The names of the checks.
        checks=(
            Check("vendor_not_null", not_null(vendor), QUARANTINE),
            Check("pickup_not_null", not_null(pickup), QUARANTINE),
            Check("dropoff_not_null", not_null(dropoff), QUARANTINE),
            Check("amount_not_null", not_null(amount), QUARANTINE),
            Check("pickup_in_window", in_window(pickup, window_start, window_end), QUARANTINE),
            Check("amount_positive", positive(amount), QUARANTINE),
            Check("dropoff_after_pickup", not_before(dropoff, pickup), QUARANTINE),
            Check("passenger_positive", present_and_positive(passengers), WARN),
        ),
        marts=(
            MeanMart(MONTHLY_MART, ("pickup_year_month",), amount, f"avg_{amount}", digits=2),
            MeanMart(
                HOURLY_MART,
                ("pickup_hour",),
                passengers,
                f"avg_{passengers}",
                digits=3,
                where=f"pickup_month = {passenger_month} AND {positive(passengers)}",
            ),
        ),
    )


def yellow(window_start: str = WINDOW_START, window_end: str = WINDOW_END) -> DatasetSpec:
    return trip_spec(
        "yellow",
        vendor="VendorID",
        pickup="tpep_pickup_datetime",
        dropoff="tpep_dropoff_datetime",
        plain_marts=True,
        window_start=window_start,
        window_end=window_end,
    )


def green(window_start: str = WINDOW_START, window_end: str = WINDOW_END) -> DatasetSpec:
    return trip_spec(
        "green",
        vendor="VendorID",
        pickup="lpep_pickup_datetime",
        dropoff="lpep_dropoff_datetime",
        window_start=window_start,
        window_end=window_end,
    )
