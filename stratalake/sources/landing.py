"""The landing zone: which deliveries are there, which are registered, and their provenance manifest."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.timedims import source_month
from stratalake.operators.conform import add_provenance
from stratalake.sources.drift import SOURCE_PATH, listed_files, parquet_files, scan_conformed
from stratalake.sources.footers import can_open, hashed
from stratalake.sources.layout import DQ, LANDING, MANIFEST, landing_month, landing_root, table_path
from stratalake.sources.tables import is_missing_path, overwrite_table, read_optional

MANIFEST_SCHEMA = "url string, key string, bytes bigint, sha256 string, dataset string, month string"

# About 300 bytes per file name: 150 MB at most.
MAX_BROADCAST_FILES = 500_000

INGESTED = "ingested"
SKIPPED = "skipped"
MISSING = "missing"


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every ``yyyy-MM`` from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(F.lit(start).alias("first_month"), F.lit(end).alias("last_month"))
    return months_between(bounds, "first_month", "last_month")


def months_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every month between two ``yyyy-MM`` columns, both included."""
    days = F.sequence(_first_day(first), _first_day(last), F.expr("interval 1 month"))
    return bounds.select(F.explode(days).alias("day")).select(F.substring(F.col("day").cast("string"), 1, 7).alias("month"))


def file_key(path: Column, dataset: str | None = None) -> Column:
    """Path below the lake root (``landing/...``); the whole path when the file lies outside a landing folder.

    The last ``landing/<dataset>/`` counts, so a lake root may have a folder of that name itself.
    """
    below = "[^/]+" if dataset is None else re.escape(dataset)
    inside = F.regexp_extract(path, rf"^(?:.*/)?({LANDING}/{below}/.*)$", 1)
    return F.when(inside != "", inside).otherwise(path)


def landing_files(spark: SparkSession, lake: str, dataset: str) -> DataFrame:
    """``path, key, month, length`` of every landed parquet file, from the listing alone: no file is opened."""
    root = landing_root(lake, dataset)
    try:
        listing = parquet_files(spark).format("binaryFile").load(root)
    except AnalysisException as error:
        raise _nothing_landed(root, error) from error
    key = file_key(F.col("path"), dataset)
    return listing.select("path", key.alias("key"), source_month(key).alias("month"), "length")


def landing_manifest(
    spark: SparkSession, lake: str, dataset: str, base_url: str = "", months: Sequence[str] | None = None
) -> DataFrame:
    """``dataset, month, url, key, bytes, sha256`` per landed file, hashed in parallel where the files are read."""
    folders = _folders(lake, dataset, months)
    try:
        files = file_hashes(spark, folders)
    except AnalysisException as error:
        raise _nothing_landed(", ".join(folders), error) from error
    key = file_key(F.col("path"), dataset)
    return files.select(
        F.lit(dataset).alias("dataset"),
        source_month(key).alias("month"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), F.substring_index(key, "/", -1)).alias("url"),
        key.alias("key"),
        "bytes",
        "sha256",
    )


def file_hashes(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``path, bytes, sha256`` of every parquet file below the folders.

    Files are read as streams in bounded memory. Where Python cannot open the store, Spark reads each into a row, which
    holds two gigabytes at most.
    """
    files = parquet_files(spark).format("binaryFile").load(list(folders))
    if not can_open(folders[0]):
        return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    listed = files.select("path", F.col("length").alias("bytes"))
    # A listing packs small files into few tasks; the digests are the work, so files are dealt out one by one.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listed.join(hashed(files.select("path").repartition(n, "path")), "path")


def sidecar_manifests(spark: SparkSession, lake: str, dataset: str) -> DataFrame | None:
    """Manifests written as ``*.manifest.json`` beside the files by an earlier tool, or None without any."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.manifest.json")
    try:
        return reader.option("multiLine", True).schema(MANIFEST_SCHEMA).json(landing_root(lake, dataset))
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise


def ingest_plan(months: DataFrame, landed: DataFrame, manifest: DataFrame | None, force: bool = False) -> DataFrame:
    """``month, status`` for the asked months.

    A registered month is skipped unless ``force``; a landed one is to be ingested; the rest is missing.
    """
    asked = months.select("month").distinct()
    if manifest is None or force:
        open_months, skipped = asked, None
    else:
        registered = manifest.select("month").distinct()
        open_months = asked.join(registered, "month", "left_anti")
        skipped = asked.join(registered, "month", "left_semi").withColumn("status", F.lit(SKIPPED))
    present = landed.select("month", F.lit(INGESTED).alias("status")).distinct()
    status = F.coalesce("status", F.lit(MISSING)).alias("status")
    planned = open_months.join(present, "month", "left").select("month", status)
    return planned if skipped is None else planned.unionByName(skipped)


def ingest(
    spark: SparkSession,
    lake: str,
    dataset: str,
    start: str,
    end: str,
    *,
    force: bool = False,
    base_url: str = "",
    fmt: str = "parquet",
) -> DataFrame:
    """Register the landed months of a range in the manifest table; returns ``month, status``.

    The plan has one row per month and is the only thing collected. The manifest is partitioned by month and only
    touched partitions are replaced, so a rerun, forced or after a failure, never registers a month twice.
    """
    known = registered_files(spark, lake, dataset, fmt=fmt)
    plan = ingest_plan(month_spine(spark, start, end), landing_files(spark, lake, dataset), known, force)
    statuses = {row["month"]: row["status"] for row in plan.collect()}
    new = sorted(month for month, status in statuses.items() if status == INGESTED)
    if new:
        manifest = landing_manifest(spark, lake, dataset, base_url, new)
        overwrite_table(manifest, _manifest_path(lake), ("dataset", "month"), fmt=fmt, touched_only=True)
    return spark.createDataFrame(sorted(statuses.items()), "month string, status string")


def registered_files(spark: SparkSession, lake: str, dataset: str, *, fmt: str = "parquet") -> DataFrame | None:
    """Manifest rows of a dataset, from the manifest table and from sidecar files."""
    table = read_optional(spark, _manifest_path(lake), MANIFEST_SCHEMA, fmt)
    sidecars = sidecar_manifests(spark, lake, dataset)
    frames = [f for f in (table, sidecars) if f is not None]
    if not frames:
        return None
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return rows.filter(F.col("dataset") == dataset)


def ingest_totals(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").count().orderBy("status")


def read_conformed(
    spark: SparkSession,
    lake: str,
    dataset: str,
    columns: dict[str, str],
    batch_id: str,
    months: Sequence[str] | None = None,
    at: Column | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """All landed rows of a dataset (or of some months) in fixed types, with provenance; ``at`` as in
    ``add_provenance``, ``files`` the listing where the caller has it."""
    folders = _folders(lake, dataset, months)
    try:
        files = listed_files(spark, folders) if files is None else files
        rows = scan_conformed(spark, folders, columns, files)
    except AnalysisException as error:
        raise _nothing_landed(", ".join(folders), error) from error
    key, month = file_key(F.col(SOURCE_PATH), dataset), None
    files = _file_names(files, dataset)
    if files.count() <= MAX_BROADCAST_FILES:
        # Patterns are matched once per file instead of once per row; a path the listing spells differently is not.
        rows = rows.join(F.broadcast(files), SOURCE_PATH, "left")
        key = F.coalesce(F.col("_file_key"), key)
        month = F.coalesce(F.col("_file_month"), source_month(F.col("_source_file")))
    return add_provenance(rows, key, batch_id, month, at).drop(SOURCE_PATH, "_file_key", "_file_month")


@contextmanager
def landed_files(
    spark: SparkSession, lake: str, dataset: str, months: Sequence[str] | None = None
) -> Iterator[DataFrame]:
    """The listing of a dataset's files (of some months), made once for all that ask for it."""
    folders = _folders(lake, dataset, months)
    try:
        files = listed_files(spark, folders).cache()
    except AnalysisException as error:
        raise _nothing_landed(", ".join(folders), error) from error
    try:
        yield files
    finally:
        files.unpersist()


def file_provenance(files: DataFrame, dataset: str, batch_id: str, at: Column) -> DataFrame:
    """Provenance of each listed file."""
    named = add_provenance(_file_names(files, dataset), F.col("_file_key"), batch_id, F.col("_file_month"), at)
    return named.drop(SOURCE_PATH, "_file_key", "_file_month")


def _file_names(files: DataFrame, dataset: str) -> DataFrame:
    key = file_key(F.col(SOURCE_PATH), dataset)
    return files.select(SOURCE_PATH, key.alias("_file_key"), source_month(key).alias("_file_month"))


def _folders(lake: str, dataset: str, months: Sequence[str] | None) -> list[str]:
    if months is None:
        return [landing_root(lake, dataset)]
    return [landing_month(lake, dataset, month) for month in months]


def _manifest_path(lake: str) -> str:
    return table_path(lake, DQ, MANIFEST)


def _first_day(month: str) -> Column:
    return F.to_date(F.concat(F.col(month), F.lit("-01")))


def _nothing_landed(where: str, error: AnalysisException) -> Exception:
    """Only a missing path or a folder without parquet files means that nothing landed."""
    if is_missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
        return FileNotFoundError(f"no landed parquet files under {where}; ingest first")
    return error
