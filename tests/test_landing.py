from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pytest
from golden import SPEC, land_golden

from stratalake.sources import landing
from stratalake.sources.layout import landing_glob, landing_key, landing_month, landing_root, table_path


def months(df):
    return sorted(r["month"] for r in df.collect())


def statuses(df):
    return {r["month"]: r["status"] for r in df.collect()}


def parquet_paths(lake):
    return sorted(Path(landing_root(lake, "yellow")).rglob("*.parquet/*.parquet"))


def test_month_ranges(spark):
    assert months(landing.month_spine(spark, "2019-07", "2019-09")) == ["2019-07", "2019-08", "2019-09"]
    assert months(landing.month_spine(spark, "1999-12", "2000-03")) == ["1999-12", "2000-01", "2000-02", "2000-03"]
    assert months(landing.month_spine(spark, "2020-02", "2020-02")) == ["2020-02"]
    assert len(months(landing.month_spine(spark, "1995-06", "2005-05"))) == 120


def test_layout():
    key = "landing/yellow/year=2023/month=01/yellow_tripdata_2023-01.parquet"
    assert landing_key("yellow", "2023-01") == key
    assert landing_glob("s3a://lake/", "yellow") == "s3a://lake/landing/yellow/year=*/month=*/*.parquet"
    assert landing_month("s3a://lake", "yellow", "2023-01") == "s3a://lake/landing/yellow/year=2023/month=01"
    assert table_path("s3a://lake", "silver", "yellow_trips") == "s3a://lake/silver/yellow_trips"


def test_listing_ignores_sidecars_and_empty_source_fails(spark, lake):
    with pytest.raises(FileNotFoundError, match="ingest first"):
        landing.landing_files(spark, lake, "yellow")
    with pytest.raises(FileNotFoundError, match="ingest first"):
        landing.read_conformed(spark, lake, "yellow", SPEC.columns, "b")
    land_golden(spark, lake)
    folder = Path(landing_month(lake, "yellow", "2023-01"))
    (folder / "yellow_tripdata_2023-01.parquet.manifest.json").write_text("{}")
    (row,) = landing.landing_files(spark, lake, "yellow").collect()
    assert row["month"] == "2023-01" and row["length"] > 0
    assert row["key"].startswith("landing/yellow/year=2023/month=01/yellow_tripdata_2023-01.parquet/part-")
    assert landing.read_conformed(spark, lake, "yellow", SPEC.columns, "b").count() == 12


def test_folder_with_only_sidecars_fails_clearly(spark, lake):
    folder = Path(landing_month(lake, "yellow", "2023-01"))
    folder.mkdir(parents=True)
    (folder / "x.manifest.json").write_text("{}")
    with pytest.raises(FileNotFoundError, match="ingest first"):
        landing.read_conformed(spark, lake, "yellow", SPEC.columns, "b")


def test_manifest_hashes_every_file(spark, lake):
    land_golden(spark, lake)
    (row,) = landing.landing_manifest(spark, lake, "yellow", "https://example.org/trip-data/").collect()
    (path,) = parquet_paths(lake)
    assert row["sha256"] == hashlib.sha256(path.read_bytes()).hexdigest()
    assert row["bytes"] == path.stat().st_size
    assert row["url"] == f"https://example.org/trip-data/{path.name}"
    assert (row["dataset"], row["month"]) == ("yellow", "2023-01")


def test_a_file_beyond_two_gigabytes_is_hashed(spark, lake):
    """A sparse file: its zeros take no disk, and no row could hold it."""
    land_golden(spark, lake)
    (small,) = parquet_paths(lake)
    big = small.parent / "part-big.parquet"
    size = (1 << 31) + 12_345
    with big.open("wb") as f:
        f.truncate(size)
    want = hashlib.sha256()
    for _ in range(size >> 20):
        want.update(bytes(1 << 20))
    want.update(bytes(size & ((1 << 20) - 1)))
    found = {r["key"].rsplit("/", 1)[1]: (r["bytes"], r["sha256"]) for r in landing.landing_manifest(spark, lake, "yellow").collect()}
    assert found["part-big.parquet"] == (size, want.hexdigest())
    assert found[small.name] == (small.stat().st_size, hashlib.sha256(small.read_bytes()).hexdigest())
    big.unlink()


def test_stores_that_python_cannot_open_are_hashed_by_spark(spark, lake, monkeypatch):
    land_golden(spark, lake)
    streamed = landing.landing_manifest(spark, lake, "yellow").collect()
    monkeypatch.setattr(landing, "can_open", lambda path: False)
    assert landing.landing_manifest(spark, lake, "yellow").collect() == streamed


def test_ingest_skips_registered_months(spark, lake):
    land_golden(spark, lake, "2023-01")
    land_golden(spark, lake, "2023-02")
    first = landing.ingest(spark, lake, "yellow", "2023-01", "2023-01")
    assert statuses(first) == {"2023-01": "ingested"}
    second = landing.ingest(spark, lake, "yellow", "2023-01", "2023-03")
    assert statuses(second) == {"2023-01": "skipped", "2023-02": "ingested", "2023-03": "missing"}
    assert landing.registered_files(spark, lake, "yellow").count() == 2
    totals = landing.ingest_totals(second).collect()
    assert [tuple(r) for r in totals] == [("ingested", 1), ("missing", 1), ("skipped", 1)]


def test_forced_ingest_registers_each_month_once(spark, lake):
    land_golden(spark, lake)
    landing.ingest(spark, lake, "yellow", "2023-01", "2023-01")
    again = landing.ingest(spark, lake, "yellow", "2023-01", "2023-01", force=True)
    assert statuses(again) == {"2023-01": "ingested"}
    assert landing.registered_files(spark, lake, "yellow").count() == 1


def test_sidecar_manifests_count_as_registered(spark, lake):
    land_golden(spark, lake)
    manifest = {
        "dataset": "yellow", "month": "2023-01", "url": "u", "key": landing_key("yellow", "2023-01"),
        "bytes": 1, "sha256": "0" * 64,
    }
    sidecar = Path(landing_month(lake, "yellow", "2023-01")) / "yellow_tripdata_2023-01.parquet.manifest.json"
    sidecar.write_text(json.dumps(manifest, indent=2))
    found = landing.ingest(spark, lake, "yellow", "2023-01", "2023-01")
    assert statuses(found) == {"2023-01": "skipped"}
