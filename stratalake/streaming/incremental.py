"""Bronze as files arrive: each landed file is noticed once and its delivery month is rebuilt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.functions.timedims import source_month
from stratalake.plans.jobs import run_bronze
from stratalake.sources.landing import file_key
from stratalake.sources.layout import landing_root
from stratalake.spec import DatasetSpec

# Columns the binary file source always has; only the path is used, so no file content is read.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_bronze(
    spark: SparkSession, spec: DatasetSpec, lake: str, checkpoint: str, *, fmt: str = "parquet"
) -> StreamingQuery:
    """Process every landed file not seen before, then stop. ``checkpoint`` must lie on shared storage.

    The stream carries file names only, because one stream has one schema and deliveries drift. A batch replaces
    whole month partitions, so a batch that is tried again after a failure gives the same table.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(landing_root(lake, spec.name))
        .select(source_month(file_key(F.col("path"), spec.name)).alias("month"))
    )

    def rebuild(batch: DataFrame, batch_number: int) -> None:
        months = sorted(row["month"] for row in batch.distinct().collect())
        if "" in months:
            raise ValueError("a landed file names no month")
        if months:
            run_bronze(batch.sparkSession, spec, lake, f"stream-{batch_number:06d}", months=months, fmt=fmt)

    return (
        arrivals.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
