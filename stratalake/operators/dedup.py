"""Exact duplicates on a set of key columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a dictionary may take when it is sent to every executor, and what a row of file names takes at most.
BROADCAST_BYTES = 256 << 20
ROW_BYTES = 400


def deduplicate(
    df: DataFrame, keys: Sequence[str], derived: Mapping[str, Column] | None = None, copies: str | None = None
) -> DataFrame:
    """One row per distinct ``keys``; among copies the smallest payload wins (NULL is smallest), so a rerun keeps the
    same row. ``copies`` names a column for the number of rows that each stands for.

    Copies collapse inside each map task before the shuffle, so one heavily copied row sends at most one record per
    task. ``derived`` names payload columns that follow from other columns: they are left out of the shuffle and
    computed again afterwards. Put selective columns first in ``keys``: the aggregate sorts by them when the payload
    holds strings.
    """
    derived = dict(derived or {})
    payload = [c for c in df.columns if c not in keys and c not in derived]
    counted = [] if copies is None else [F.count(F.lit(1)).alias(copies)]
    names = [*df.columns, *([] if copies is None else [copies])]
    if not payload:
        distinct = df.groupBy(*keys).agg(*counted) if counted else df.select(*keys).distinct()
        return distinct.withColumns(derived).select(*names)
    if len(payload) == 1:
        # Two fixed-width figures, if the value is a number: rows are hashed instead of sorted.
        lone = F.when(F.count_if(F.col(payload[0]).isNull()) == 0, F.min(payload[0])).alias(payload[0])
        return df.groupBy(*keys).agg(lone, *counted).withColumns(derived).select(*names)
    survivors = df.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("_survivor"), *counted)
    kept = [*keys, "_survivor.*", *([] if copies is None else [copies])]
    return survivors.select(*kept).withColumns(derived).select(*names)


def put_back(df: DataFrame, dictionary: DataFrame, code: str) -> DataFrame:
    """``df`` with the columns of ``dictionary`` in place of ``code``, which names one row of it. A code that the
    dictionary lacks leaves its columns NULL."""
    return df.join(dictionary, code, "left").drop(code)


def within_bound(dictionary: DataFrame) -> DataFrame:
    """The dictionary, to be broadcast if its rows, counted, are within ``BROADCAST_BYTES``; else the planner joins it."""
    return F.broadcast(dictionary) if dictionary.count() * ROW_BYTES <= BROADCAST_BYTES else dictionary
