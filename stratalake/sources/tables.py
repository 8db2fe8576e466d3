"""Read and write layer tables. ``fmt`` is any file table format of the session: parquet here, delta where installed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.versions import read_published


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    """``schema`` (DDL) saves the footer read of plain parquet and keeps folder values such as ``'04'`` as text.

    Of a parquet table with versions, the published rows are read.
    """
    if fmt == "parquet":
        published = read_published(spark, path, schema)
        if published is not None:
            return published
    reader = spark.read.format(fmt)
    if schema and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def read_optional(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    """None when the table does not exist; any other failure is raised."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE")


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought to their partition, for a partitioned write of input that is spread over all partitions.

    It is a rebalance, so adaptive execution cuts a partition that holds much of the data into several even files and
    joins small ones. Without adaptive execution nothing is shuffled: more files come out, but no task gets a whole
    large partition.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return df.hint("rebalance", *partition_by) if adaptive else df


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    fmt: str = "parquet",
    touched_only: bool = False,
) -> None:
    """Replace a table and its schema, or with ``touched_only`` just the partitions that ``df`` has rows for."""
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def replace_rows(df: DataFrame, path: str, partition_by: Sequence[str], where: str, *, fmt: str) -> None:
    """Replace the rows that meet ``where`` in one commit of a table format that has commits; a month that comes
    without rows is emptied."""
    df.write.format(fmt).mode("overwrite").option("replaceWhere", where).partitionBy(*partition_by).save(path)


def append_table(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)
