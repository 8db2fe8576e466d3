"""The layer jobs. Each reads the layer before it, so any of them can be run again on its own."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import partial
from itertools import count

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.timedims import source_month_parts
from stratalake.operators import marts, profile, quality
from stratalake.operators.conform import file_number
from stratalake.operators.dedup import deduplicate, put_back, within_bound
from stratalake.plans.parallel import in_parallel
from stratalake.plans.sizing import sized_for, table_bytes
from stratalake.plans.sql import answers
from stratalake.sources import versions
from stratalake.sources.landing import file_provenance, ingest, landed_files, read_conformed
from stratalake.sources.layout import BRONZE, CHECK_RESULTS, DQ, GOLD, SILVER, join, table_path
from stratalake.sources.tables import clustered, overwrite_table, read_optional, read_table, replace_rows
from stratalake.spec import (
    BRONZE_PARTITIONS,
    FILE_NUMBER,
    HISTORY_PARTITIONS,
    HISTORY_SCHEMA,
    PROVENANCE,
    DatasetSpec,
)

PARQUET = "parquet"
#: Rows of bronze that a deduplicated row stands for; not written.
COPIES = "_copies"


#: A month of the time column, None for rows without a time.
Month = tuple[int, int] | None


@dataclass(frozen=True)
class Clean:
    """Dedup, gate and enrich one frame; each result is planned when it is asked for.

    Gates that read dedup keys only are moved below the aggregation by the optimizer, so the valid and the rejected
    side each shuffle their own rows only. With ``files``, the dictionary of file numbers, rows are deduplicated by
    their number alone; ``early`` puts provenance back before the gate, for checks that read it.
    """

    rows: DataFrame
    spec: DatasetSpec
    copies: str | None = None
    files: DataFrame | None = None
    early: bool = False

    @property
    def _deduplicated(self) -> DataFrame:
        if self.files is None:
            return dedup_rows(self.rows, self.spec, self.copies)
        out = dedup_rows(self.rows.select(*self.spec.columns, FILE_NUMBER), self.spec, self.copies)
        return put_back(out, self.files, FILE_NUMBER) if self.early else out

    @property
    def valid(self) -> DataFrame:
        accepted = quality.valid_rows(self._deduplicated, self.spec.checks)
        return marts.enrich(accepted, self.spec.time_column, self.spec.time_prefix)

    @property
    def quarantine(self) -> DataFrame:
        return quality.quarantined_rows(self._deduplicated, self.spec.checks)

    @property
    def metrics(self) -> DataFrame:
        return quality.check_metrics(dedup_keys_only(self.rows, self.spec) or self._deduplicated, self.spec.checks)


def clean(df: DataFrame, spec: DatasetSpec, copies: str | None = None) -> Clean:
    """The checks' clock is read once here, for all results. ``copies`` names a column for the rows each stands for."""
    return Clean(df, replace(spec, checks=quality.bound(df, spec.checks)), copies)


def dedup_rows(df: DataFrame, spec: DatasetSpec, copies: str | None = None) -> DataFrame:
    """Year and month of the delivery are cut from ``_source_month`` after the shuffle instead of going through it."""
    derived = source_month_parts(F.col("_source_month")) if "_source_month" in df.columns else {}
    return deduplicate(df, spec.keys, {c: e for c, e in derived.items() if c in df.columns}, copies)


def dedup_keys_only(df: DataFrame, spec: DatasetSpec) -> DataFrame | None:
    """Enough for metrics when the keys hold every column the checks read, and far less to shuffle than whole rows; else
    None."""
    if set(spec.keys) == set(spec.columns) and checks_business_columns_only(df, spec):
        return df.select(*spec.columns).distinct()
    return None


def checks_business_columns_only(df: DataFrame, spec: DatasetSpec) -> bool:
    """False when some check reads provenance, such as the delivery month."""
    try:
        _ = df.select(*spec.columns).select(*[c.failed for c in spec.checks]).schema
    except AnalysisException as error:
        if (error.getCondition() or "").startswith(("UNRESOLVED_COLUMN", "CANNOT_RESOLVE_DATAFRAME_COLUMN")):
            return False
        raise
    return True


def run_bronze(
    spark: SparkSession,
    spec: DatasetSpec,
    lake: str,
    batch_id: str,
    *,
    months: Sequence[str] | None = None,
    fmt: str = PARQUET,
) -> str:
    """Landing files to conformed rows with provenance. Without ``months`` the table is rebuilt, else just they are.

    Deliveries are files per month and the table is partitioned by delivery month, so no shuffle is needed. Rows carry
    the number of their file, which is their provenance in eight bytes; the dictionary of files is a table beside
    bronze. Both change at once, and a month that comes without rows disappears.
    """
    with landed_files(spark, lake, spec.name, months) as listed:
        return _write_bronze(spark, spec, lake, batch_id, months, fmt, listed)


def _write_bronze(
    spark: SparkSession, spec: DatasetSpec, lake: str, batch_id: str, months: Sequence[str] | None, fmt: str, listed: DataFrame
) -> str:
    layer, target = join(lake, BRONZE), table_path(lake, BRONZE, spec.table)
    at = F.timestamp_micros(F.lit(time.time_ns() // 1000))
    rows = read_conformed(spark, lake, spec.name, spec.columns, batch_id, months, at, listed)
    files = file_provenance(listed, spec.name, batch_id, at)
    salt, size = _salt(files), listed.agg(F.coalesce(F.sum("length"), F.lit(0))).collect()[0][0]
    rows, files = (df.withColumn(FILE_NUMBER, file_number(F.col("_source_file"), F.col("_source_month"), salt)) for df in (rows, files))
    files = files.select(FILE_NUMBER, *PROVENANCE)
    gone = None if months is None else [f"source_year={m[:4]}/source_month={m[5:7]}" for m in months]
    outputs = [
        Output(rows, layer, spec.table, BRONZE_PARTITIONS, gone),
        Output(clustered(files, BRONZE_PARTITIONS), layer, spec.files_table, BRONZE_PARTITIONS, gone),
    ]
    with sized_for(spark, size):
        if fmt == PARQUET:
            with staging(spark, layer, spec.table) as held:
                held.write(*outputs)
        else:
            which = [f"(source_year = '{m[:4]}' AND source_month = '{m[5:7]}')" for m in months or []]
            for out in outputs:
                if months is None:
                    overwrite_table(out.rows, out.path, out.partition_by, fmt=fmt)
                else:
                    replace_rows(out.rows, out.path, out.partition_by, " OR ".join(which), fmt=fmt)
    return target


def _salt(files: DataFrame) -> int:
    """The first salt that gives every file a number of its own."""
    for salt in count():
        number = file_number(F.col("_source_file"), F.col("_source_month"), salt)
        twice = files.groupBy(number.alias("n")).agg(F.count_distinct("_source_file").alias("files")).filter("files > 1")
        if twice.isEmpty():
            return salt
    raise AssertionError("unreachable")


@dataclass(frozen=True)
class Output:
    """Rows of one table of a layer. ``gone``: partition folders that they replace; None replaces all."""

    rows: DataFrame
    layer: str
    name: str
    partition_by: Sequence[str] = ()
    gone: Sequence[str] | None = None

    @property
    def path(self) -> str:
        return join(self.layer, self.name)


class Staging:
    """One version of some tables of a layer, written beside the published ones."""

    def __init__(self, spark: SparkSession, layer: str) -> None:
        self.spark, self.layer, self.version = spark, layer, versions.new_version()
        self.outputs: list[Output] = []

    def write(self, *outputs: Output) -> list[DataFrame]:
        """Write tables side by side; returns them as they will be read."""
        self.outputs += outputs
        write = partial(versions.write_version, version=self.version)
        in_parallel(self.spark, *[partial(write, o.rows, o.path, partition_by=o.partition_by) for o in outputs])
        return [self.spark.read.schema(o.rows.schema).parquet(versions.version_path(o.path, self.version)) for o in outputs]

    def folders(self, before: versions.Pointer | None) -> dict[str, dict[str, str]]:
        out = {}
        for o in self.outputs:
            kept = {} if o.gone is None or before is None else dict(before.tables.get(o.name, {}))
            for folder in o.gone or ():
                kept.pop(folder, None)
            out[o.name] = {**kept, **versions.written_folders(self.spark, o.path, self.version, o.partition_by)}
        return out

    def discard(self) -> None:
        for o in self.outputs:
            versions.discard(self.spark, o.path, self.version)


@contextmanager
def staging(spark: SparkSession, layer: str, group: str, note: Mapping[str, object] | None = None) -> Iterator[Staging]:
    """Tables written in the block are published together when it ends; if anything fails before, readers keep what
    they had."""
    before = versions.current(spark, layer, group)
    held = Staging(spark, layer)
    try:
        yield held
        versions.publish(spark, layer, group, held.folders(before), before, note)
    except BaseException:
        held.discard()
        raise


@contextmanager
def copied(spark: SparkSession, layer: str, fmt: str) -> Iterator[Staging]:
    """The same for a format with commits of its own, which gets the rows from a copy when the block has ended."""
    held = Staging(spark, join(layer, "_aside"))
    try:
        yield held
        for o in held.outputs:
            rows = spark.read.schema(o.rows.schema).parquet(versions.version_path(o.path, held.version))
            overwrite_table(rows, join(layer, o.name), o.partition_by, fmt=fmt)
    finally:
        held.discard()


def run_silver(
    spark: SparkSession,
    spec: DatasetSpec,
    lake: str,
    run_id: str,
    *,
    months: Sequence[str] | None = None,
    fmt: str = PARQUET,
) -> str:
    """Bronze to valid and rejected tables, with metrics appended to the check history.

    BLOCK checks are looked for first, with a filter that stops at the first hit, so a blocked run publishes nothing
    but its metrics. Otherwise both tables are written aside. Every row of them carries the number of bronze rows it
    stands for up to its write, and the sums must be the rows of bronze, else the run fails and the published tables
    stay. Check counts are made from the two new tables, which together are the deduplicated input.

    ``months``: delivery months that bronze has got anew since silver was published. Only what they can change is then
    made again, see ``changed_months``; the result is that of a full run. A full run is made where that cannot be told:
    copies that may differ in their time, other columns or checks than the published tables have, or a check against
    the clock.
    """
    layer = join(lake, SILVER)
    source = table_path(lake, BRONZE, spec.table)
    bronze = read_table(spark, source, spec.numbered_schema, fmt)
    rules, given = _rules(spec), spec.checks
    spec = replace(spec, checks=quality.bound(bronze, spec.checks))
    rules = rules if list(spec.checks) == list(given) else None
    before = versions.current(spark, layer, spec.table) if fmt == PARQUET else None
    partial_run = (
        months is not None
        and before is not None
        and rules is not None
        and before.note.get("rules") == rules
        and spec.time_column in spec.keys
    )
    changed = changed_months(spark, spec, lake, bronze, months) if partial_run else None
    if changed is not None:
        bronze = bronze.filter(in_months(spec, changed))
    kept, refused = Observation("valid"), Observation("rejected")
    standing = F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows")
    with sized_for(spark, table_bytes(spark, source)):
        _stop_if_blocked(spark, bronze, spec, lake, run_id, fmt)
        files = within_bound(read_table(spark, table_path(lake, BRONZE, spec.files_table), spec.files_schema, fmt))
        plain = checks_business_columns_only(bronze, spec)
        cleaned = Clean(bronze, spec, COPIES, files, early=not plain)
        # Provenance text is put back after the second shuffle, just before the write, unless a check reads it.
        restore = put_back if plain else lambda df, *_: df
        valid = restore(clustered(cleaned.valid, spec.silver_partitions), files, FILE_NUMBER).observe(kept, standing)
        quarantine = restore(cleaned.quarantine, files, FILE_NUMBER).observe(refused, standing)
        quarantine = quarantine.select(*spec.columns, *PROVENANCE, quality.REASON)
        gone = None
        if changed is not None:
            gone = month_folders(spec, changed)
            others = read_table(spark, table_path(lake, SILVER, spec.rejected_table), spec.rejected_schema)
            quarantine = quarantine.unionByName(others.filter(~in_months(spec, changed)))
        with staging(spark, layer, spec.table, {"rules": rules}) if fmt == PARQUET else copied(spark, layer, fmt) as held:
            valid, quarantine = held.write(
                Output(valid.select(*spec.columns, *PROVENANCE, *spec.time_columns), held.layer, spec.table, spec.silver_partitions, gone),
                Output(quarantine, held.layer, spec.rejected_table),
            )
            columns = [*spec.columns, *([] if plain else PROVENANCE)]
            fresh = valid.select(*columns).unionByName(quarantine.select(*columns))
            fresh = _counts(spec, bronze, fresh if changed is None else fresh.filter(in_months(spec, changed)))
            fresh = spark.createDataFrame(fresh.collect(), spec.counts_schema)
            total = sum(r["bronze_rows"] for r in fresh.collect())
            if kept.get["rows"] + refused.get["rows"] != total:
                raise quality.ReconciliationError(
                    f"{total} bronze rows, but {kept.get['rows']} valid and {refused.get['rows']} rejected ones"
                )
            counts = fresh if changed is None else fresh.unionByName(_other_counts(spark, spec, lake, changed))
            (counts,) = held.write(Output(counts, held.layer, spec.counts_table))
            metrics = quality.metrics_of(counts, spec.checks)
            metrics = spark.createDataFrame(metrics.collect(), metrics.schema)
        _record(metrics, spec, lake, run_id, fmt)
    return table_path(lake, SILVER, spec.table)


def changed_months(
    spark: SparkSession, spec: DatasetSpec, lake: str, bronze: DataFrame, months: Sequence[str]
) -> list[Month]:
    """Months of the time column that the delivery months ``months`` can have changed, None for rows without a time.

    A delivery changes a published row that came from it, valid or rejected, and whatever equals one of its new rows.
    Copies have the same time, so all copies of such rows lie in these months, in whichever delivery. Two narrow scans
    tell: of published provenance and time, and of the new partitions of bronze.
    """
    time = F.col(spec.time_column)
    one = F.struct(F.year(time).alias("year"), F.month(time).alias("month")).alias("m")
    from_these = F.col("_source_month").isin(*months)
    published = [
        read_table(spark, table_path(lake, SILVER, spec.table), spec.silver_schema),
        read_table(spark, table_path(lake, SILVER, spec.rejected_table), spec.rejected_schema),
    ]
    folder = F.concat_ws("-", "source_year", "source_month").isin(*months)
    found = [df.filter(from_these).select(one).distinct() for df in published] + [bronze.filter(folder).select(one).distinct()]
    rows = found[0].unionByName(found[1]).unionByName(found[2]).distinct().collect()
    return sorted(((r["m"]["year"], r["m"]["month"]) if r["m"]["year"] is not None else None for r in rows), key=lambda m: m or (0, 0))


def in_months(spec: DatasetSpec, months: Sequence[Month]) -> Column:
    """Rows whose time lies in some of the months; never NULL. Months that follow each other are one range, which the
    parquet reader can use."""
    time, kind = F.col(spec.time_column), spec.columns[spec.time_column]
    out = time.isNull() if None in months else F.lit(False)
    numbers = sorted(y * 12 + m - 1 for y, m in (m for m in months if m is not None))
    while numbers:
        n = next(i for i in range(1, len(numbers) + 1) if i == len(numbers) or numbers[i] != numbers[0] + i)
        first, last, numbers = numbers[0], numbers[n - 1] + 1, numbers[n:]
        if 12 <= first and last < 9999 * 12:
            low, high = (F.lit(f"{k // 12:04d}-{k % 12 + 1:02d}-01 00:00:00").cast("timestamp_ntz").cast(kind) for k in (first, last))
            out = out | (time.isNotNull() & (time >= low) & (time < high))
        else:
            out = out | (time.isNotNull() & (F.year(time) * 12 + F.month(time) - 1).between(first, last - 1))
    return F.coalesce(out, F.lit(False))


def month_folders(spec: DatasetSpec, months: Sequence[Month]) -> list[str]:
    none = "__HIVE_DEFAULT_PARTITION__"
    return ["/".join(f"{c}={v}" for c, v in zip(spec.silver_partitions, m or (none, none), strict=True)) for m in months]


def _rules(spec: DatasetSpec) -> str:
    """What two runs must have in common for one to take over rows of the other."""
    checks = [(c.name, str(c.valid_when), c.severity) for c in spec.checks]
    text = json.dumps([list(spec.columns.items()), spec.keys, spec.time_column, spec.time_prefix, checks])
    return hashlib.sha256(text.encode()).hexdigest()


def _counts(spec: DatasetSpec, bronze: DataFrame, published: DataFrame) -> DataFrame:
    """By month of the time column: rows of bronze, of the published tables, and check failures. One row a month."""
    time = dict(zip(spec.silver_partitions, (F.year(spec.time_column), F.month(spec.time_column)), strict=True))
    counts = quality.check_counts(published.withColumns(time), spec.checks, spec.silver_partitions)
    raw = bronze.groupBy(*[e.alias(c) for c, e in time.items()]).agg(F.count(F.lit(1)).alias("bronze_rows"))
    both = raw.unionByName(counts, allowMissingColumns=True).groupBy(*time)
    # Each side has one row of a month at most.
    return both.agg(
        F.coalesce(F.sum("bronze_rows"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"),
        F.first("rows_failed", ignorenulls=True).alias("rows_failed"),
    )


def _other_counts(spark: SparkSession, spec: DatasetSpec, lake: str, changed: Sequence[Month]) -> DataFrame:
    """Published counts of all other months."""
    key = F.coalesce(F.concat(*[x for c in spec.silver_partitions for x in (F.lit("-"), F.col(c).cast("string"))]), F.lit(""))
    known = read_table(spark, table_path(lake, SILVER, spec.counts_table), spec.counts_schema)
    return known.filter(~key.isin(*[f"-{m[0]}-{m[1]}" if m else "" for m in changed]))


def _stop_if_blocked(
    spark: SparkSession, bronze: DataFrame, spec: DatasetSpec, lake: str, run_id: str, fmt: str
) -> None:
    """A filter looks for a failing row. Only if there is one are the deduplicated counts made, which then decide:
    the row could be a copy that deduplication drops."""
    breaking = quality.breaks_block_check(bronze, spec.checks)
    if breaking is None or breaking.isEmpty():
        return
    files = read_table(spark, table_path(lake, BRONZE, spec.files_table), spec.files_schema, fmt)
    counted = Clean(bronze, spec, files=files, early=True).metrics
    metrics = spark.createDataFrame(counted.collect(), counted.schema)
    try:
        quality.assert_no_block_failures(metrics)
    except quality.BlockedRunError:
        _record(metrics, spec, lake, run_id, fmt)
        raise


def run_gold(spark: SparkSession, spec: DatasetSpec, lake: str, *, fmt: str = PARQUET) -> str:
    """Silver to the fact table and the marts of the spec.

    Silver is already clustered by the partitions of the fact table, so writing it needs no shuffle. Each mart scans
    only its own columns, and a mart limited to a month only that month's folders. Marts are added up from parts, a few
    sums for each group and month. Only months that silver has published anew since the last run are read: their rows
    of the fact table and their parts are replaced, all others stay.
    """
    source = table_path(lake, SILVER, spec.table)
    silver = read_table(spark, source, spec.silver_schema, fmt)
    target = table_path(lake, GOLD, spec.fact_table)
    if fmt != PARQUET:
        with sized_for(spark, table_bytes(spark, source)):
            writes = [partial(overwrite_table, marts.mean_mart(silver, m), table_path(lake, GOLD, spec.mart_table(m)), fmt=fmt) for m in spec.marts]
            fact = partial(overwrite_table, marts.fact(silver, spec.fact_columns), target, spec.silver_partitions, fmt=fmt)
            in_parallel(spark, fact, *writes)
        return target
    layer, months = join(lake, GOLD), spec.silver_partitions
    shape = hashlib.sha256(repr((spec.fact_columns, list(spec.marts))).encode()).hexdigest()
    published, before = versions.current(spark, join(lake, SILVER), spec.table), versions.current(spark, layer, spec.fact_table)
    taken = dict(published.tables[spec.table]) if published is not None else None
    known = before.note.get("silver") if before is not None and before.note.get("shape") == shape else None
    gone = None if known is None or taken is None else sorted(f for f in {*known, *taken} if known.get(f) != taken.get(f))
    if gone is not None:
        silver = silver.filter(_in_folders(months, gone))
    parts = {f"{spec.mart_table(m)}_parts": marts.mart_parts(silver, m, months) for m in spec.marts}
    with sized_for(spark, table_bytes(spark, source)):
        with staging(spark, layer, spec.fact_table, {"silver": taken, "shape": shape}) as held:
            held.write(
                Output(marts.fact(silver, spec.fact_columns), layer, spec.fact_table, months, gone),
                *[Output(rows, layer, name, months, gone) for name, rows in parts.items()],
            )
        stored = {name: versions.read_table_of(spark, layer, spec.fact_table, name, rows.schema) for name, rows in parts.items()}
        in_parallel(spark, *[
            partial(overwrite_table, marts.finished_mart(stored[f"{spec.mart_table(m)}_parts"], m), table_path(lake, GOLD, spec.mart_table(m)))
            for m in spec.marts
        ])
    return target


def _in_folders(columns: Sequence[str], folders: Sequence[str]) -> Column:
    """Rows of some partition folders, by their partition columns alone."""
    none = "__HIVE_DEFAULT_PARTITION__"
    names = [[part.split("=", 1)[1] for part in folder.split("/")] for folder in folders]
    keys = ["/".join(n) for n in names]
    own = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit(none)) for c in columns])
    return own.isin(*keys) if keys else F.lit(False)


def check_history(
    spark: SparkSession, lake: str, run_id: str | None = None, *, fmt: str = "parquet"
) -> DataFrame:
    """Recorded check results, of all runs or of one."""
    history = read_table(spark, table_path(lake, DQ, CHECK_RESULTS), HISTORY_SCHEMA, fmt)
    return history if run_id is None else history.filter(F.col("run_id") == run_id)


def reconcile_layers(spark: SparkSession, spec: DatasetSpec, lake: str, *, fmt: str = PARQUET) -> DataFrame:
    """Counts of the published tables against bronze; pass the result to ``quality.assert_reconciled``.

    Silver notes for each month how many rows of bronze its rows stand for, proven when it was published. So bronze is
    only counted, not grouped by its keys again: the row counts must be the noted ones.
    """
    bronze = read_table(spark, table_path(lake, BRONZE, spec.table), spec.bronze_schema, fmt)
    valid = read_table(spark, table_path(lake, SILVER, spec.table), spec.silver_schema, fmt)
    rejected = read_table(spark, table_path(lake, SILVER, spec.rejected_table), spec.rejected_schema, fmt)
    counts = read_optional(spark, table_path(lake, SILVER, spec.counts_table), spec.counts_schema, fmt)
    if counts is None:
        return quality.reconcile_tables(bronze, valid, rejected, spec.keys)
    return quality.reconcile_counts(bronze, valid, rejected, counts)


def run_profile(
    spark: SparkSession, spec: DatasetSpec, lake: str, amount: str, category: str, *, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Volume, amount figures, value distribution, reject reasons and, where there is a history, the latest checks."""
    silver = read_table(spark, table_path(lake, SILVER, spec.table), spec.silver_schema, fmt)
    rejected = read_table(spark, table_path(lake, SILVER, spec.rejected_table), spec.rejected_schema, fmt)
    history = read_optional(spark, table_path(lake, DQ, CHECK_RESULTS), HISTORY_SCHEMA, fmt)
    out = {
        "volume": profile.volume(silver, f"{spec.time_prefix}_year_month"),
        "amount": profile.numeric_profile(silver, amount),
        "distribution": profile.distribution(silver, category),
        "reasons": quality.reason_counts(rejected),
    }
    if history is not None:
        out["latest_checks"] = quality.latest_runs(history.filter(F.col("dataset") == spec.name))
    return out


def run_pipeline(
    spark: SparkSession,
    spec: DatasetSpec,
    lake: str,
    start: str,
    end: str,
    run_id: str,
    *,
    force: bool = False,
    base_url: str = "",
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Ingest, bronze, silver, gold, and the answers of the marts."""
    ingest(spark, lake, spec.name, start, end, force=force, base_url=base_url, fmt=fmt)
    run_bronze(spark, spec, lake, run_id, fmt=fmt)
    run_silver(spark, spec, lake, run_id, fmt=fmt)
    run_gold(spark, spec, lake, fmt=fmt)
    return answers(spark, spec, lake, fmt=fmt)


def _record(metrics: DataFrame, spec: DatasetSpec, lake: str, run_id: str, fmt: str) -> None:
    """A run that is tried again replaces its own metrics."""
    rows = quality.with_run(metrics, run_id, SILVER, spec.name)
    overwrite_table(rows, table_path(lake, DQ, CHECK_RESULTS), HISTORY_PARTITIONS, fmt=fmt, touched_only=True)
