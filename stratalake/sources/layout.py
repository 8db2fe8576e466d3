"""Folder names of a lake. ``lake`` is any root Spark can read: a local path or an object-store URI."""

from __future__ import annotations

# Layer folders.
LANDING = "landing"
BRONZE = "bronze"
SILVER = "silver"
GOLD = "gold"
DQ = "dq"

CHECK_RESULTS = "check_results"
MANIFEST = "manifest"


def landing_key(dataset: str, month: str) -> str:
    """Key of one monthly delivery, relative to the lake. A delivery may also be a folder of that name."""
    year, mm = month.split("-")
    return f"{LANDING}/{dataset}/year={year}/month={mm}/{dataset}_tripdata_{month}.parquet"


def landing_root(lake: str, dataset: str) -> str:
    return join(lake, LANDING, dataset)


def landing_month(lake: str, dataset: str, month: str) -> str:
    year, mm = month.split("-")
    return join(landing_root(lake, dataset), f"year={year}", f"month={mm}")


def landing_glob(lake: str, dataset: str) -> str:
    return join(landing_root(lake, dataset), "year=*", "month=*", "*.parquet")


def table_path(lake: str, layer: str, name: str) -> str:
    return join(lake, layer, name)


def join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *[p.strip("/") for p in parts if p]])
