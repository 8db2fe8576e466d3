"""Grouped-average marts and the headline figures read from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.timedims import time_dimensions
from stratalake.spec import MeanMart


def enrich(df: DataFrame, time_column: str, prefix: str) -> DataFrame:
    return df.withColumns(time_dimensions(time_column, prefix))


def fact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


#: Values are added up as whole millionths, which are exact in any order; larger ones, infinities and NaN as doubles.
UNIT = 1_000_000
LARGE = 9e12
LOW_BITS = 20


def mean_mart(df: DataFrame, mart: MeanMart) -> DataFrame:
    """Rows and rounded mean per group, ordered by group. Partial sums leave each task, never rows.

    Sums are of whole millionths, so the last digit does not depend on the order in which tasks add up.
    """
    return finished_mart(mart_parts(df, mart), mart, merge=False)


def mart_parts(df: DataFrame, mart: MeanMart, by: Sequence[str] = ()) -> DataFrame:
    """What a mean mart needs of the rows of each group, and of ``by``: parts of many inputs can be added up."""
    source = df.filter(mart.where) if mart.where else df
    value = F.col(mart.value).cast("double")
    whole = F.when(F.abs(value) < LARGE, F.floor(value * UNIT + 0.5))
    # Two sums of few bits each: neither overflows before 2^43 rows.
    return source.groupBy(*dict.fromkeys([*by, *mart.keys])).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(value).alias("_values"),
        F.sum(F.shiftright(whole, LOW_BITS)).alias("_high"),
        F.sum(whole.bitwiseAND(F.lit((1 << LOW_BITS) - 1))).alias("_low"),
        F.count_if(value.isNotNull() & ~(F.abs(value) < LARGE)).alias("_large"),
        F.sum(F.when(~(F.abs(value) < LARGE), value)).alias("_rest"),
    )


def finished_mart(parts: DataFrame, mart: MeanMart, merge: bool = True) -> DataFrame:
    """The mart from its parts; with ``merge`` several parts of a group are added up first."""
    sums = ("_rows", "_values", "_high", "_low", "_large", "_rest")
    if merge:
        parts = parts.groupBy(*mart.keys).agg(*[F.sum(c).alias(c) for c in sums])
    total = F.expr(f"cast(coalesce(_high, 0) as decimal(38, 0)) * {1 << LOW_BITS} + coalesce(_low, 0)")
    scale = 10**mart.digits
    # Halves are rounded away from zero, on whole numbers: a rounded quotient would be rounded twice.
    nearest = F.expr(f"(2 * abs(_total) * {scale} + _values * {UNIT}BD) div (2 * _values * {UNIT}BD)")
    exact = F.signum("_total") * nearest / F.lit(float(scale))
    rough = F.round((F.col("_total").cast("double") / UNIT + F.coalesce("_rest", F.lit(0.0))) / F.col("_values"), mart.digits)
    mean = F.when((F.col("_values") > 0) & (F.col("_large") == 0), exact).when(F.col("_values") > 0, rough)
    out = parts.withColumn("_total", total.cast("decimal(38,0)"))
    return out.select(*mart.keys, F.col("_rows").alias(mart.count_alias), mean.alias(mart.alias)).orderBy(*mart.keys)


def total_mart(df: DataFrame, key: str, value: str, alias: str, digits: int = 2) -> DataFrame:
    return df.groupBy(key).agg(F.round(F.sum(value), digits).alias(alias)).orderBy(key)


def trend_kpis(mart: DataFrame, key: str, value: str, count: str) -> DataFrame:
    """Plain mean of the group means, the peak group (earliest on a tie) and the total count of a mart."""
    peak = F.min(F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
    return mart.agg(
        F.round(F.avg(value), 2).alias("mean_of_means"),
        peak["k"].alias("peak_key"),
        (-peak["v"]).alias("peak_value"),
        F.sum(count).alias("total_count"),
    )


def extreme_kpis(mart: DataFrame, key: str, value: str, count: str) -> DataFrame:
    """Groups with the highest mean, the lowest mean and the most rows; the earliest group wins a tie."""

    def highest(measure: str) -> Column:
        return F.max_by(key, F.struct(F.col(measure), -F.col(key)))

    return mart.agg(
        highest(value).alias("max_key"),
        F.max(value).alias("max_value"),
        F.min_by(key, F.struct(F.col(value), F.col(key))).alias("min_key"),
        F.min(value).alias("min_value"),
        highest(count).alias("busiest_key"),
    )


def share(df: DataFrame, shares: Mapping[str, str]) -> DataFrame:
    """Per named predicate the rows that meet it and their part of all rows; NULL counts as not met."""
    rows = F.count(F.lit(1))
    out = [rows.alias("row_count")]
    for name, predicate in shares.items():
        met = F.count_if(F.expr(predicate))
        out += [met.alias(f"{name}_count"), F.round(F.try_divide(met, rows), 4).alias(f"{name}_share")]
    return df.agg(*out)
