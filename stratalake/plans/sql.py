"""SQL over the layers: views named after their tables, and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.functions.predicates import quoted
from stratalake.sources.layout import DQ, GOLD, SILVER, CHECK_RESULTS, table_path
from stratalake.sources.tables import read_optional
from stratalake.spec import HISTORY_SCHEMA, DatasetSpec, MeanMart


def register_views(spark: SparkSession, spec: DatasetSpec, lake: str, *, fmt: str = "parquet") -> list[str]:
    """Temporary views ``silver_*``, ``gold_*`` and ``dq_*`` for the tables that exist; returns their names."""
    tables = {
        f"silver_{spec.table}": (SILVER, spec.table, spec.silver_schema),
        f"silver_{spec.rejected_table}": (SILVER, spec.rejected_table, spec.rejected_schema),
        f"gold_{spec.fact_table}": (GOLD, spec.fact_table, spec.fact_schema),
        **{f"gold_{spec.mart_table(mart)}": (GOLD, spec.mart_table(mart), None) for mart in spec.marts},
        f"dq_{CHECK_RESULTS}": (DQ, CHECK_RESULTS, HISTORY_SCHEMA),
    }
    registered = []
    for view, (layer, name, schema) in tables.items():
        table = read_optional(spark, table_path(lake, layer, name), schema, fmt)
        if table is not None:
            table.createOrReplaceTempView(view)
            registered.append(view)
    return registered


def mart_query(mart: MeanMart, view: str) -> str:
    """The stored mart."""
    keys = ", ".join(quoted(k) for k in mart.keys)
    return f"SELECT {keys}, {quoted(mart.count_alias)}, {quoted(mart.alias)} FROM {quoted(view)} ORDER BY {keys}"


def month_mean_query(view: str, time: str, value: str, alias: str, digits: int = 2, prefix: str = "pickup") -> str:
    """Mean per month straight from cleaned rows; the cast to a date keeps the session time zone out of the month."""
    return f"""
        SELECT date_format(to_date({quoted(time)}), 'yyyy-MM') AS {quoted(prefix + '_year_month')},
               count(*) AS trips,
               round(avg({quoted(value)}), {digits}) AS {quoted(alias)}
        FROM {quoted(view)}
        GROUP BY 1
        ORDER BY 1
    """


def hour_mean_query(
    view: str, time: str, value: str, alias: str, month: int, digits: int = 3, prefix: str = "pickup"
) -> str:
    """Mean of positive values per hour of one month of the year straight from cleaned rows.

    The month is asked of its own column, by which silver is partitioned, so other months' folders are not read.
    """
    return f"""
        SELECT hour({quoted(time)}) AS {quoted(prefix + '_hour')},
               count(*) AS trips,
               round(avg({quoted(value)}), {digits}) AS {quoted(alias)}
        FROM {quoted(view)}
        WHERE {quoted(prefix + '_month')} = {month} AND {quoted(value)} > 0
        GROUP BY 1
        ORDER BY 1
    """


def answers(spark: SparkSession, spec: DatasetSpec, lake: str, *, fmt: str = "parquet") -> dict[str, DataFrame]:
    """One result per mart of the spec, read with SQL from the gold layer."""
    register_views(spark, spec, lake, fmt=fmt)
    return {mart.name: spark.sql(mart_query(mart, f"gold_{spec.mart_table(mart)}")) for mart in spec.marts}
