"""What describes a dataset: columns, duplicates, checks, time column and marts. Plain data, no session needed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from stratalake.functions.predicates import quoted
from stratalake.operators.quality import REASON, Check

# Provenance columns of every bronze row, in table order, and the folder columns of the bronze table.
PROVENANCE = {
    "_source_file": "string",
    "_source_month": "string",
    "source_year": "string",
    "source_month": "string",
    "_batch_id": "string",
    "_ingested_at": "timestamp",
}
#: The number of a row's file, in bronze and in the dictionary of its files.
FILE_NUMBER = "_file_number"
BRONZE_PARTITIONS = ("source_year", "source_month")
HISTORY_SCHEMA = (
    "check string, severity string, rows_in bigint, rows_failed bigint, passed boolean, layer string, dataset string, "
    "run_id string"
)
HISTORY_PARTITIONS = ("dataset", "run_id")


@dataclass(frozen=True)
class MeanMart:
    """Count and rounded mean of ``value`` per ``keys``, over the rows that meet ``where``."""

    name: str
    keys: Sequence[str]
    value: str
    alias: str
    digits: int = 2
    where: str | None = None
    count_alias: str = "trips"


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: Mapping[str, str]
    time_column: str
    checks: Sequence[Check] = ()
    dedup_keys: Sequence[str] = ()
    marts: Sequence[MeanMart] = ()
    entity: str = "trips"
    time_prefix: str = "pickup"
    #: The one dataset of a lake whose marts are published under their plain names.
    plain_marts: bool = False

    def __post_init__(self) -> None:
        known = set(self.columns)
        unknown = [c for c in [self.time_column, *self.dedup_keys] if c not in known]
        if unknown:
            raise ValueError(f"spec {self.name!r} uses columns it does not declare: {unknown}")
        names = [c.name for c in self.checks]
        if len(names) != len(set(names)):
            raise ValueError(f"spec {self.name!r} repeats a check name: {names}")

    @property
    def keys(self) -> list[str]:
        """Columns that make two rows copies of each other: all business columns unless the spec says otherwise."""
        return list(self.dedup_keys or self.columns)

    @property
    def table(self) -> str:
        return f"{self.name}_{self.entity}"

    def mart_table(self, mart: MeanMart) -> str:
        return mart.name if self.plain_marts else f"{self.table}_{mart.name}"

    @property
    def rejected_table(self) -> str:
        return f"{self.table}_rejected"

    @property
    def files_table(self) -> str:
        """Provenance by file number."""
        return f"{self.table}_files"

    @property
    def counts_table(self) -> str:
        """Rows of bronze, deduplicated rows and check failures by the month of the time column."""
        return f"{self.table}_counts"

    @property
    def fact_table(self) -> str:
        return f"fact_{self.table}"

    @property
    def time_columns(self) -> dict[str, str]:
        p = self.time_prefix
        return {
            f"{p}_year": "int",
            f"{p}_month": "int",
            f"{p}_year_month": "string",
            f"{p}_hour": "int",
            f"{p}_date": "date",
        }

    @property
    def silver_partitions(self) -> tuple[str, str]:
        return f"{self.time_prefix}_year", f"{self.time_prefix}_month"

    @property
    def fact_columns(self) -> list[str]:
        return [*self.columns, *self.time_columns]

    @property
    def bronze_schema(self) -> str:
        return ddl({**self.columns, **PROVENANCE})

    @property
    def numbered_schema(self) -> str:
        """What the silver job reads of bronze."""
        return ddl({**self.columns, **PROVENANCE, FILE_NUMBER: "bigint"})

    @property
    def files_schema(self) -> str:
        return ddl({FILE_NUMBER: "bigint", **PROVENANCE})

    @property
    def counts_schema(self) -> str:
        return ddl({**{c: "int" for c in self.silver_partitions}, "bronze_rows": "bigint", "rows_in": "bigint", "rows_failed": "map<string,bigint>"})

    @property
    def silver_schema(self) -> str:
        return ddl({**self.columns, **PROVENANCE, **self.time_columns})

    @property
    def rejected_schema(self) -> str:
        return ddl({**self.columns, **PROVENANCE, REASON: "array<string>"})

    @property
    def fact_schema(self) -> str:
        return ddl({**self.columns, **self.time_columns})


def ddl(columns: Mapping[str, str]) -> str:
    return ", ".join(f"{quoted(name)} {type_name}" for name, type_name in columns.items())
