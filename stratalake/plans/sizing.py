"""Split and shuffle sizes for the bytes a job reads."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratalake.sources import versions

GIB = 1 << 30
# Map and reduce tasks both grow with the data, and shuffle blocks with their product; past these counts tasks grow
# instead, and the sorts behind them spill.
MAX_SPLITS = 65_536
MAX_SHUFFLE_PARTITIONS = 32_768
# Files a task keeps open for a partitioned write before it sorts its rows by partition instead. Tasks of the layer
# jobs mostly hold one partition, so the sort is skipped, and the open buffers stay few.
OPEN_FILES = 4

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def table_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the parquet files of a table, or below some folders, from the listing. Of a table with versions, only
    the published ones count."""
    live = [place for path in paths for place in (versions.live_paths(spark, path) or [path])]
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return listing.load(live).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).collect()[0]["bytes"]


def shuffle_partitions_for(input_bytes: int) -> int:
    return min(MAX_SHUFFLE_PARTITIONS, -(-input_bytes // GIB))


def split_bytes_for(input_bytes: int) -> int:
    return -(-input_bytes // MAX_SPLITS)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Raise the session's sizes to what ``input_bytes`` needs, never lower them, and put them back afterwards.

    Adaptive execution joins shuffle partitions that turn out small but cannot add any to an aggregation, so the
    starting number has to suit the data.
    """
    before = {key: spark.conf.get(key) for key in (SHUFFLE_PARTITIONS, SPLIT_BYTES, WRITERS)}
    partitions = max(int(before[SHUFFLE_PARTITIONS]), shuffle_partitions_for(input_bytes))
    split = max(_as_bytes(before[SPLIT_BYTES]), split_bytes_for(input_bytes))
    spark.conf.set(SHUFFLE_PARTITIONS, str(partitions))
    spark.conf.set(SPLIT_BYTES, str(split))
    spark.conf.set(WRITERS, str(max(int(before[WRITERS]), OPEN_FILES)))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _as_bytes(size: str) -> int:
    """Spark writes sizes as ``134217728``, ``134217728b``, ``128m`` or ``128mb``."""
    text = size.strip().lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)
