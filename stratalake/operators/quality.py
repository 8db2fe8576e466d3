"""Declarative row checks: tag, split, count, gate, reconcile.

A check states when a row is valid. A predicate that is NULL counts as failed. BLOCK and QUARANTINE checks gate rows
(a failing row goes to quarantine with its reasons); WARN checks are only counted. BLOCK failures also stop the run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "BLOCK"
QUARANTINE = "QUARANTINE"
WARN = "WARN"

REASON = "_reject_reason"


class BlockedRunError(ValueError):
    """A BLOCK check failed."""


class ReconciliationError(ValueError):
    """Row counts do not add up."""


@dataclass(frozen=True)
class Check:
    name: str
    valid_when: str | Column
    severity: str = QUARANTINE

    def __post_init__(self) -> None:
        if self.severity not in (BLOCK, QUARANTINE, WARN):
            raise ValueError(f"unknown severity {self.severity!r} in check {self.name!r}")

    @property
    def predicate(self) -> Column:
        return self.valid_when if isinstance(self.valid_when, Column) else F.expr(self.valid_when)

    @property
    def failed(self) -> Column:
        """NOT (predicate IS TRUE), so that NULL fails."""
        return self.predicate.eqNullSafe(F.lit(True)) == F.lit(False)


def bound(df: DataFrame, checks: Sequence[Check]) -> list[Check]:
    """The checks with the clock read once, now, for every query that will use them.

    Which words of a rule tell the time is decided as Spark decides it: the parser says what is a function and what a
    name, with its place in the text, and a name that ``df`` has as a column is that column. A predicate that may answer
    differently when asked twice (``rand()``, or the clock inside a Column) is refused, because a row could then be valid
    for one table and for the other alike, or for neither.
    """
    clock = None
    out = []
    for check in checks:
        rule = check.valid_when
        places = _clock_places(df, rule) if isinstance(rule, str) else []
        if places:
            clock = clock or _clock(df)
            for start, stop, name in sorted(places, reverse=True):
                rule = rule[:start] + clock[name] + rule[stop:]
        plan = df.select(Check(check.name, rule).predicate.alias("p"))._jdf.queryExecution().analyzed()
        if not plan.deterministic() or _tells_time(plan.expressions()):
            raise ValueError(f"check {check.name!r} does not give the same answer whenever it is asked")
        out.append(Check(check.name, rule, check.severity))
    return out


#: Functions without arguments that tell the time; those that may stand without brackets, if no column has the name.
CLOCK = ("current_timestamp", "now", "localtimestamp", "current_date", "curdate", "unix_timestamp")
BARE_CLOCK = ("current_timestamp", "localtimestamp", "current_date")


def _clock_places(df: DataFrame, rule: str) -> list[tuple[int, int, str]]:
    """Start, end and name of what tells the time in a rule."""
    columns = {c.lower() for c in df.columns}
    out = []

    def visit(node) -> None:
        kind = node.getClass().getSimpleName()
        if kind in ("UnresolvedFunction", "UnresolvedAttribute") and node.nameParts().size() == 1:
            name = node.nameParts().apply(0).lower()
            calls = kind == "UnresolvedFunction" and name in CLOCK and node.children().size() == 0
            if calls or (kind == "UnresolvedAttribute" and name in BARE_CLOCK and name not in columns):
                out.append((node.origin().startIndex().get(), node.origin().stopIndex().get() + 1, name))
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(df.sparkSession._jsparkSession.sessionState().sqlParser().parseExpression(rule))
    return out


def _tells_time(expressions) -> bool:
    each = (expressions.apply(i) for i in range(expressions.size()))
    return any(
        e.getClass().getSimpleName() in ("CurrentTimestamp", "Now", "LocalTimestamp", "CurrentDate")
        or _tells_time(e.children())
        for e in each
    )


def _clock(df: DataFrame) -> dict[str, str]:
    row = df.sparkSession.sql(
        "SELECT unix_micros(current_timestamp()) AS micros, cast(localtimestamp() AS string) AS here, "
        "cast(current_date() AS string) AS day"
    ).collect()[0]
    moment, day = f"timestamp_micros({row['micros']})", f"DATE '{row['day']}'"
    return {
        "current_timestamp": moment,
        "now": moment,
        "localtimestamp": f"TIMESTAMP_NTZ '{row['here']}'",
        "current_date": day,
        "curdate": day,
        "unix_timestamp": f"{row['micros'] // 1_000_000}L",
    }


def gating(checks: Sequence[Check]) -> list[Check]:
    """The checks whose failure sends a row to quarantine: all but WARN."""
    return list(filter(lambda check: check.severity in (BLOCK, QUARANTINE), checks))


def reasons(checks: Sequence[Check]) -> Column:
    """Names of the failed gates in check order; an empty array for a clean row."""
    outcomes = [F.struct(F.lit(c.name).alias("name"), c.failed.alias("failed")) for c in gating(checks)]
    if not outcomes:
        return F.array().cast("array<string>")
    return F.transform(F.filter(F.array(*outcomes), lambda o: o["failed"]), lambda o: o["name"])


def tag(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return df.withColumn(REASON, reasons(checks))


def valid_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows every gate accepts.

    A filter drops NULL as it drops FALSE, so the bare predicates suffice here, and bare comparisons reach the parquet
    reader, where the tagging expression would not.
    """
    gates = gating(checks)
    return df.filter(reduce(and_, [c.predicate for c in gates])) if gates else df


def quarantined_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows some gate rejects, with their reasons. The reasons are built for rejected rows only."""
    gates = gating(checks)
    rejected = df.filter(reduce(or_, [c.failed for c in gates])) if gates else df.filter(F.lit(False))
    return tag(rejected, checks)


def check_metrics(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check, severity, rows_in, rows_failed, passed``: one aggregation over ``df``, then one row per check."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(c.failed).alias(f"_failed_{i}") for i, c in enumerate(checks)],
    )
    return _per_check(counts, checks)


def _per_check(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    if not checks:
        return counts.selectExpr(
            "'' AS check", "'' AS severity", "rows_in", "0L AS rows_failed", "true AS passed"
        ).filter(F.lit(False))
    cells = []
    for i, c in enumerate(checks):
        cells += [F.lit(c.name), F.lit(c.severity), F.col(f"_failed_{i}")]
    rows = counts.select("rows_in", F.stack(F.lit(len(checks)), *cells).alias("check", "severity", "rows_failed"))
    return rows.select("check", "severity", "rows_in", "rows_failed", (F.col("rows_failed") == 0).alias("passed"))


def check_counts(df: DataFrame, checks: Sequence[Check], keys: Sequence[str]) -> DataFrame:
    """For each group of ``keys``: ``rows_in`` and ``rows_failed``, failures by check name. Groups can be counted apart
    and added up, see ``metrics_of``."""
    failed = [F.count_if(c.failed).alias(f"_failed_{i}") for i, c in enumerate(checks)]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_in"), *failed)
    cells = [x for i, c in enumerate(checks) for x in (F.lit(c.name), F.col(f"_failed_{i}"))]
    named = F.create_map(*cells) if cells else F.lit(None)
    return counts.select(*keys, "rows_in", named.cast("map<string,bigint>").alias("rows_failed"))


def metrics_of(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Check metrics from counts by group."""
    failed = [F.coalesce(F.sum(F.col("rows_failed")[c.name]), F.lit(0)).alias(f"_failed_{i}") for i, c in enumerate(checks)]
    total = counts.agg(F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"), *failed)
    return _per_check(total, checks)


@dataclass(frozen=True)
class Split:
    """Valid rows, quarantined rows and metrics of one frame, each planned when it is asked for."""

    rows: DataFrame
    checks: Sequence[Check]

    @property
    def valid(self) -> DataFrame:
        return valid_rows(self.rows, self.checks)

    @property
    def quarantine(self) -> DataFrame:
        return quarantined_rows(self.rows, self.checks)

    @property
    def metrics(self) -> DataFrame:
        return check_metrics(self.rows, self.checks)


def with_outcome(metrics: DataFrame) -> DataFrame:
    """Adds the word to show per check: WARN checks show ``WARN`` whatever their count."""
    outcome = F.when(F.col("severity") == WARN, WARN).when(~F.col("passed"), "FAIL").otherwise("ok")
    return metrics.withColumn("outcome", outcome)


def with_run(metrics: DataFrame, run_id: str, layer: str, dataset: str | None = None) -> DataFrame:
    """Metrics as they go to a history; ``dataset`` tells tables that share one apart."""
    named = {} if dataset is None else {"dataset": F.lit(dataset)}
    return metrics.withColumns({"layer": F.lit(layer), **named, "run_id": F.lit(run_id)})


def assert_no_block_failures(metrics: DataFrame) -> None:
    failed = metrics.filter((F.col("severity") == BLOCK) & ~F.col("passed")).select("check", "rows_failed").collect()
    if failed:
        listed = ", ".join(f"{r['check']} ({r['rows_failed']} rows)" for r in failed)
        raise BlockedRunError(f"BLOCK checks failed: {listed}")


def breaks_block_check(df: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    """Rows that fail some BLOCK check, or None when no check blocks. Only a filter, so ``isEmpty`` can stop early."""
    blocking = [c.failed for c in checks if c.severity == BLOCK]
    return df.filter(reduce(or_, blocking)) if blocking else None


def reason_counts(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.select(F.explode(REASON).alias("reason"))
        .groupBy("reason")
        .count()
        .orderBy(F.desc("count"), "reason")
    )


def latest_runs(history: DataFrame, runs: int = 3) -> DataFrame:
    """All rows of the newest ``runs`` runs, newest first; the check name settles the order inside one run."""
    newest = history.select("run_id").distinct().orderBy(F.desc("run_id")).limit(runs)
    return history.join(F.broadcast(newest), "run_id", "left_semi").orderBy(F.desc("run_id"), "check")


def reconcile(df: DataFrame, keys: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """One row: raw, deduped, quarantined, valid, rows failing more than one gate, and whether they balance.

    One scan and one shuffle of the keys: each distinct key row carries the number of its copies. The gates may read
    key columns only.
    """
    gates = gating(checks)
    failures = F.size(reasons(checks))
    distinct_rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    clean = reduce(and_, [F.coalesce(c.predicate, F.lit(False)) for c in gates]) if gates else F.lit(True)
    totals = distinct_rows.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw"),
        F.count(F.lit(1)).alias("deduped"),
        F.count_if(failures > 0).alias("quarantined"),
        F.count_if(clean).alias("valid"),
        F.count_if(failures > 1).alias("multi_failed"),
    )
    return totals.withColumn("balanced", _balanced())


def reconcile_tables(
    bronze: DataFrame, valid: DataFrame, quarantine: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """The same row as ``reconcile``, counted from the published tables against the keys of the raw one."""
    raw = bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    raw_counts = raw.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw"), F.count(F.lit(1)).alias("deduped")
    )
    valid_counts = valid.agg(F.count(F.lit(1)).alias("valid"))
    rejected_counts = quarantine.agg(
        F.count(F.lit(1)).alias("quarantined"), F.count_if(F.size(REASON) > 1).alias("multi_failed")
    )
    totals = (
        raw_counts.unionByName(valid_counts, allowMissingColumns=True)
        .unionByName(rejected_counts, allowMissingColumns=True)
        .agg(*[F.max(c).alias(c) for c in ("raw", "deduped", "quarantined", "valid", "multi_failed")])
    )
    return totals.withColumn("balanced", _balanced())


def reconcile_counts(bronze: DataFrame, valid: DataFrame, quarantine: DataFrame, counts: DataFrame) -> DataFrame:
    """The same row, from row counts: of the raw and published tables, and those that were noted (``bronze_rows``,
    ``rows_in``) when the published ones were made. No row is shuffled."""
    noted = counts.agg(
        F.coalesce(F.sum("bronze_rows"), F.lit(0)).alias("noted"), F.coalesce(F.sum("rows_in"), F.lit(0)).alias("deduped")
    )
    rejected = quarantine.agg(
        F.count(F.lit(1)).alias("quarantined"), F.count_if(F.size(REASON) > 1).alias("multi_failed")
    )
    parts = [bronze.agg(F.count(F.lit(1)).alias("raw")), valid.agg(F.count(F.lit(1)).alias("valid")), rejected, noted]
    names = ("raw", "deduped", "quarantined", "valid", "multi_failed", "noted")
    totals = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).agg(*[F.max(c).alias(c) for c in names])
    return totals.withColumn("balanced", _balanced() & (F.col("raw") == F.col("noted"))).drop("noted")


def _balanced() -> Column:
    return (F.col("valid") + F.col("quarantined") == F.col("deduped")) & (F.col("raw") >= F.col("deduped"))


def assert_reconciled(reconciliation: DataFrame) -> None:
    row = reconciliation.first()
    if row is None or not row["balanced"]:
        raise ReconciliationError(f"row counts do not balance: {row.asDict() if row else 'no counts'}")
