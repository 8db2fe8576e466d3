"""Time dimensions of one timestamp, and the month named in a file key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A delivery month as it is written in folders and in file names.
FOLDER_MONTH = r"(?:^|/)year=(\d{4})/month=(\d{2})(?:/|$)"
FILE_MONTH = r"_tripdata_(\d{4}-\d{2})"


def year_month(ts: Column) -> Column:
    """``yyyy-MM`` from the ISO text of the date: no session time zone is involved and no formatter is called per row."""
    return F.substring(F.to_date(ts).cast("string"), 1, 7)


def time_dimensions(time_column: str, prefix: str) -> dict[str, Column]:
    ts = F.col(time_column)
    return {
        f"{prefix}_year": F.year(ts),
        f"{prefix}_month": F.month(ts),
        f"{prefix}_year_month": year_month(ts),
        f"{prefix}_hour": F.hour(ts),
        f"{prefix}_date": F.to_date(ts),
    }


def source_month(source_file: Column) -> Column:
    """Delivery month of a file key, or an empty string (never NULL) when it names none.

    The folders decide, then the name of the delivery; digits in part-file names mean nothing.
    """
    year, month = (F.regexp_extract(source_file, FOLDER_MONTH, k) for k in (1, 2))
    named = F.regexp_extract(source_file, FILE_MONTH, 1)
    return F.coalesce(F.when(year != "", F.concat_ws("-", year, month)).otherwise(named), F.lit(""))


def source_month_parts(month: Column) -> dict[str, Column]:
    return {"source_year": F.substring(month, 1, 4), "source_month": F.substring(month, 6, 2)}
