from __future__ import annotations

import pytest

from stratalake.operators.conform import union_by_name
from stratalake.sources import drift, landing
from stratalake.sources.drift import schema_groups, scan_conformed
from stratalake.sources.layout import landing_month, landing_root

COLUMNS = {"id": "int", "p": "double"}


def deliver(spark, lake, month, *selects, mode="overwrite"):
    folder = landing_month(lake, "x", month)
    for i, select in enumerate(selects):
        df = spark.range(i * 10, i * 10 + 10).selectExpr(*select).coalesce(1)
        df.write.mode(mode if i == 0 else "append").parquet(folder)
    return folder


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "p").collect())


def test_integer_and_double_deliveries(spark, lake):
    for month in ("2023-01", "2023-02", "2023-03"):
        deliver(spark, lake, month, ["id", "cast(id AS bigint) AS p"])
    deliver(spark, lake, "2023-04", ["id", "cast(id AS double) AS p", "'x' AS extra"])
    root = [landing_root(lake, "x")]
    with pytest.raises(Exception, match="MERGE|MISMATCH|merge"):
        spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*root).collect()
    groups = schema_groups(spark, root, COLUMNS)
    assert sorted(len(paths) for _, paths in groups) == [1, 3]
    out = scan_conformed(spark, root, COLUMNS)
    assert rows(out) == sorted([(i, float(i)) for i in range(10)] * 4)


def test_drift_inside_one_delivery(spark, lake):
    folder = deliver(spark, lake, "2023-01", ["id", "cast(id AS bigint) AS p"], ["id", "cast(id AS double) AS p"])
    assert len(schema_groups(spark, [folder], COLUMNS)) == 2
    assert rows(scan_conformed(spark, [folder], COLUMNS)) == [(i, float(i)) for i in range(20)]


def test_column_found_in_some_files_of_a_delivery_only(spark, lake):
    folder = deliver(spark, lake, "2023-01", ["id"], ["id", "cast(id AS double) AS p"])
    expected = [(i, float(i) if i >= 10 else None) for i in range(20)]
    assert rows(scan_conformed(spark, [folder], COLUMNS)) == expected


def test_folder_with_files_and_folders_is_read_once(spark, lake):
    outer = deliver(spark, lake, "2023-01", ["id", "cast(id AS double) AS p"])
    spark.range(10, 20).selectExpr("id", "cast(id AS double) AS p").write.parquet(f"{outer}/late")
    assert rows(scan_conformed(spark, [landing_root(lake, "x")], COLUMNS)) == [(i, float(i)) for i in range(20)]


def test_delivery_without_any_wanted_column(spark, lake):
    folder = deliver(spark, lake, "2023-01", ["'z' AS other"])
    assert rows(scan_conformed(spark, [folder], COLUMNS)) == [(None, None)] * 10


def test_plan_has_one_scan_per_variant(spark, lake):
    for m in range(1, 7):
        deliver(spark, lake, f"2023-0{m}", ["id", f"cast(id AS {'bigint' if m % 2 else 'double'}) AS p"])
    plan = scan_conformed(spark, [landing_root(lake, "x")], COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_merges_grow_with_variants_and_the_logarithm_of_deliveries(spark, lake, monkeypatch):
    for m in range(1, 33):
        kind = "bigint" if m <= 11 else "double" if m <= 27 else "string"
        deliver(spark, lake, f"{2000 + m}-01", ["id", f"cast(id AS {kind}) AS p"])
    merges = []
    whole = drift._merged_schema
    monkeypatch.setattr(drift, "_merged_schema", lambda session, paths: merges.append(paths) or whole(session, paths))
    groups = schema_groups(spark, [landing_root(lake, "x")], COLUMNS)
    assert sorted(len({p for p in paths}) for _, paths in groups) == [5, 11, 16]
    assert len(merges) <= 3 * 2 * 6
    assert scan_conformed(spark, [landing_root(lake, "x")], COLUMNS).count() == 320


def test_alternating_types_need_one_footer_job(spark, lake, monkeypatch):
    """Halving would need a merge per delivery here; footers are read once, whatever the order of the types."""
    for m in range(1, 33):
        deliver(spark, lake, f"{2000 + m}-01", ["id", f"cast(id AS {'bigint' if m % 2 else 'double'}) AS p"])
    jobs, merges = [], []
    read = drift.file_types
    monkeypatch.setattr(drift, "file_types", lambda files, columns: jobs.append(1) or read(files, columns))
    monkeypatch.setattr(drift, "_merged_schema", lambda session, paths: merges.append(paths))
    groups = schema_groups(spark, [landing_root(lake, "x")], COLUMNS)
    assert sorted(len(paths) for _, paths in groups) == [16, 16] and len(jobs) == 1 and merges == []
    assert rows(scan_conformed(spark, [landing_root(lake, "x")], COLUMNS)) == sorted([(i, float(i)) for i in range(10)] * 32)


def test_uniform_years_are_one_folder_each(spark, lake):
    for year, kind in ((2021, "bigint"), (2022, "double"), (2023, "double")):
        for m in (1, 2, 3):
            deliver(spark, lake, f"{year}-{m:02d}", ["id", f"cast(id AS {kind}) AS p"])
    deliver(spark, lake, "2023-04", ["id", "cast(id AS string) AS p"])
    groups = {s["p"].dataType.simpleString(): [p.split("/x/")[1] for p in paths] for s, paths in schema_groups(spark, [landing_root(lake, "x")], COLUMNS)}
    assert groups == {
        "bigint": ["year=2021"],
        "double": ["year=2022", "year=2023/month=01", "year=2023/month=02", "year=2023/month=03"],
        "string": ["year=2023/month=04"],
    }
    one_type = schema_groups(spark, [landing_month(lake, "x", "2023-01"), landing_month(lake, "x", "2023-02")], COLUMNS)
    assert [len(paths) for _, paths in one_type] == [2]


def test_stores_that_python_cannot_open_are_merged_by_spark(spark, lake, monkeypatch):
    for m in range(1, 6):
        deliver(spark, lake, f"2023-0{m}", ["id", f"cast(id AS {'bigint' if m < 3 else 'double'}) AS p"])
    whole = schema_groups(spark, [landing_root(lake, "x")], COLUMNS)
    monkeypatch.setattr(drift, "file_types", lambda files, columns: files.selectExpr("path", "cast(null AS string) AS types"))
    halved = schema_groups(spark, [landing_root(lake, "x")], COLUMNS)
    assert {s["p"].dataType.simpleString() for s, _ in whole} == {s["p"].dataType.simpleString() for s, _ in halved} == {"bigint", "double"}
    assert rows(scan_conformed(spark, [landing_root(lake, "x")], COLUMNS)) == sorted([(i, float(i)) for i in range(10)] * 5)


def test_types_stored_alike_are_told_apart(spark, lake):
    """An interval is stored as a plain 64-bit integer; Spark's own note in the footer says which it is."""
    deliver(spark, lake, "2023-01", ["id", "cast(id AS bigint) AS p"])
    deliver(spark, lake, "2023-02", ["id", "make_dt_interval(0, 0, 0, id) AS p"])
    assert len(schema_groups(spark, [landing_root(lake, "x")], COLUMNS)) == 2


def test_one_file_with_two_spellings_of_a_column(spark, lake):
    folder = deliver(spark, lake, "2023-01", ["id", "1.5D AS p"])
    spark.range(10, 20).selectExpr("id AS ID", "cast(id AS double) AS P").coalesce(1).write.mode("append").parquet(folder)
    assert rows(scan_conformed(spark, [folder], COLUMNS)) == [(i, 1.5) for i in range(10)] + [(i, float(i)) for i in range(10, 20)]


def test_file_names_beyond_the_broadcast_bound(spark, lake, monkeypatch):
    deliver(spark, lake, "2023-01", ["id", "cast(id AS double) AS p"])
    joined = landing.read_conformed(spark, lake, "x", COLUMNS, "b")
    monkeypatch.setattr(landing, "MAX_BROADCAST_FILES", 0)
    plain = landing.read_conformed(spark, lake, "x", COLUMNS, "b")
    assert "Join" not in plain._jdf.queryExecution().executedPlan().toString()
    assert joined.drop("_ingested_at").exceptAll(plain.drop("_ingested_at")).isEmpty()
    assert plain.count() == joined.count() == 10


def test_union_of_many_frames_is_flat(spark):
    out = union_by_name([spark.range(1).selectExpr("id", f"1 AS c{i % 2}") for i in range(5)])
    assert out.columns == ["id", "c0", "c1"] and out.count() == 5
