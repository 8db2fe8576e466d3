"""Project raw deliveries onto a fixed schema and stamp where each row came from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.predicates import quoted
from stratalake.functions.timedims import source_month, source_month_parts

#: Bits of a file's number that tell the files of one month apart.
NUMBER_BITS = 44


def conform(df: DataFrame, columns: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``columns`` (name -> type) in that order, then ``keep``; any other column is dropped.

    Names match without regard to case. A column the delivery lacks becomes a typed NULL, and a value that does not
    fit the type becomes NULL too, so that bad values reach the quality gate instead of ending the job.
    """
    present = {name.lower(): name for name in df.columns}
    out = []
    for name, type_name in columns.items():
        found = present.get(name.lower())
        if found is None:
            value = F.lit(None).cast(type_name)
        elif type_name == "timestamp_ntz" and isinstance(df.schema[found].dataType, T.TimestampType):
            # A moment becomes its UTC time, whatever the session's zone.
            value = F.expr(f"timestampadd(MICROSECOND, unix_micros({quoted(found)}), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
        else:
            value = F.col(quoted(found)).try_cast(type_name)
        out.append(value.alias(name))
    return df.select(*out, *keep)


def add_provenance(
    df: DataFrame, source_file: Column, batch_id: str, month: Column | None = None, at: Column | None = None
) -> DataFrame:
    """File, delivery month, batch and time of each row.

    ``month`` is read from the file name of every row unless the caller already has it per file; ``at`` is the current
    time unless given.
    """
    stamped = df.withColumn("_source_file", source_file).withColumn(
        "_source_month", source_month(F.col("_source_file")) if month is None else month
    )
    return stamped.withColumns(
        {
            **source_month_parts(F.col("_source_month")),
            "_batch_id": F.lit(batch_id),
            "_ingested_at": F.current_timestamp() if at is None else at,
        }
    )


def file_number(source_file: Column, month: Column, salt: int = 0) -> Column:
    """A number for a file: its delivery month first, then a hash of its key. It stands in for the whole provenance of
    a row, in eight bytes, and needs no lookup to be made."""
    year, mm = (F.substring(month, at, n).try_cast("bigint") for at, n in ((1, 4), (6, 2)))
    months = F.coalesce(year * 12 + mm, F.lit(0))
    return F.shiftleft(months, NUMBER_BITS).bitwiseOR(
        F.xxhash64(source_file, F.lit(salt)).bitwiseAND(F.lit((1 << NUMBER_BITS) - 1))
    )


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from one frame is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
