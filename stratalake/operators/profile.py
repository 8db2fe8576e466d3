"""Column profiles that stay distributed whatever the number of rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Rows one task may sort or hold for the last step of an exact quantile, and histogram buckets per refinement pass.
FINISH_ROWS = 1_000_000
BUCKETS = 4096
# Buckets of the first histogram for each doubling of a value, and a number above all of them.
SCALE = 256
OFFSET = 1100 * SCALE


def volume(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().orderBy(key)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, the NULL group included and first."""
    return df.groupBy(column).count().orderBy(column)


def numeric_profile(df: DataFrame, column: str, digits: int = 2, finish_rows: int = FINISH_ROWS) -> DataFrame:
    """One row: rounded min, mean, median and max; the median is exact, see ``exact_quantile``. One histogram gives
    all but the median's last digits."""
    with _values(df, column) as values:
        counts = _histogram(values)
        rows = sum(r["rows"] for r in counts)
        figures = {
            "min": counts[0]["low"] if counts else None,
            "avg": sum(r["total"] for r in counts) / rows if counts else None,
            "p50": _quantile(values, counts, 0.5, finish_rows, BUCKETS),
            "max": counts[-1]["high"] if counts else None,
        }
    one_row = df.sparkSession.range(1)
    return one_row.select(*[F.round(F.lit(v).cast("double"), digits).alias(k) for k, v in figures.items()])


def exact_quantile(
    df: DataFrame, column: str, fraction: float, *, finish_rows: int = FINISH_ROWS, buckets: int = BUCKETS
) -> float | None:
    """Smallest value whose cumulative share reaches ``fraction``; NULL is left out and NaN sorts last.

    Merging one quantile sketch per task into a single reducer grows with the number of tasks. Here the first pass
    counts rows per bucket of a scale that orders all doubles, ``SCALE`` buckets for each doubling, so the bucket that
    holds the wanted rank has few of the rows and the second pass orders these. Where they are still more than
    ``finish_rows``, passes in between cut the bucket into ``buckets`` more. A task sends as many counts as it meets
    buckets, whatever its rows.
    """
    with _values(df, column) as values:
        return _quantile(values, _histogram(values), fraction, finish_rows, buckets)


@contextmanager
def _values(df: DataFrame, column: str) -> Iterator[DataFrame]:
    """The column's values. What is not simply read from files is computed once and kept on the executors' disks, eight
    bytes a row, since it is asked for twice; what is lost with an executor is computed again."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    computed = "Exchange" in values._jdf.queryExecution().sparkPlan().toString() or any(
        name in values._jdf.queryExecution().optimizedPlan().toString() for name in ("Aggregate", "Join", "Window", "Generate")
    )
    if not computed:
        yield values
        return
    values = values.persist(StorageLevel.DISK_ONLY)
    try:
        yield values
    finally:
        values.unpersist()


def _place(v: Column) -> Column:
    """The bucket of a double: a whole number that never falls when the double rises, with zero, both infinities and NaN
    in buckets of their own."""
    size = F.floor(F.log2(F.abs(v)) * SCALE) + OFFSET
    finite = F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("long"))
    return F.when(F.isnan(v), 2 * OFFSET).when(v == math.inf, 2 * OFFSET - 1).when(v == -math.inf, -2 * OFFSET).otherwise(finite)


def _histogram(values: DataFrame) -> list[Row]:
    """``rows``, ``low``, ``high`` and ``total`` of each bucket that has values, in order."""
    v = F.col("v")
    counts = values.groupBy(_place(v).alias("place")).agg(
        F.count(v).alias("rows"), F.min(v).alias("low"), F.max(v).alias("high"), F.sum(v).alias("total")
    )
    return sorted(counts.collect(), key=lambda r: r["place"])


def _quantile(values: DataFrame, counts: list[Row], fraction: float, finish_rows: int, buckets: int) -> float | None:
    if not counts:
        return None
    total = sum(r["rows"] for r in counts)
    rank, hit = _find_rank(counts, min(total, max(1, math.ceil(fraction * total))))
    low, high, rows = hit["low"], hit["high"], hit["rows"]
    v = F.col("v")
    while low < high and rows > finish_rows:
        # Halves, because the width of a range between the largest doubles would overflow.
        step = (high / 2 - low / 2) / buckets
        if step == 0:
            break
        bucket = F.least(F.floor((v / 2 - low / 2) / step), F.lit(buckets - 1))
        finer = (
            _between(values, low, high)
            .groupBy(bucket.alias("bucket"))
            .agg(F.count(v).alias("rows"), F.min(v).alias("low"), F.max(v).alias("high"))
            .collect()
        )
        rank, hit = _find_rank(sorted(finer, key=lambda r: r["bucket"]), rank)
        low, high, rows = hit["low"], hit["high"], hit["rows"]
    if low == high or low != low:
        return float(low)
    # At most finish_rows rows are left, so one task can order them.
    return float(_between(values, low, high).orderBy(v).offset(rank - 1).limit(1).collect()[0]["v"])


def _between(values: DataFrame, low: float, high: float) -> DataFrame:
    return values.filter(F.col("v").between(low, high))


def _find_rank(counts: list[Row], rank: int) -> tuple[int, Row]:
    for row in counts:
        if rank <= row["rows"]:
            return rank, row
        rank -= row["rows"]
    raise AssertionError("rank lies beyond the counted rows")
