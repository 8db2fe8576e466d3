"""Compare a Spark result with DuckDB the way a result check does: names, types and values, order left out."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# DuckDB type of each Spark type that results use.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return value + 0.0  # no signed zero; otherwise values must be equal to the last bit
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {row[0]: row[1] for row in described}
    got_types = {name: TYPES.get(type_name, type_name) for name, type_name in df.dtypes}
    out = []
    if want_types != got_types:
        changed = {n for n in {*want_types, *got_types} if want_types.get(n) != got_types.get(n)}
        out.append(f"types differ: {[(n, got_types.get(n), want_types.get(n)) for n in sorted(changed)]}")
        if set(want_types) != set(got_types):
            return out
    got = _bag(df.columns, df.collect())
    want = _bag([row[0] for row in described], con.execute(sql).fetchall())
    if got != want:
        extra, lacking = got - want, want - got
        out.append(
            f"rows differ: {got.total()} against {want.total()}; "
            f"only here {list(extra)[:3]}; only there {list(lacking)[:3]}"
        )
    return out
