"""Scan files whose column types differ between deliveries.

Parquet stores 64-bit integers and doubles differently, and no single read schema fits both, so one scan over all
files fails. Files are grouped by the types they really have and each group gets one scan: the plan grows with the
number of variants, not with the number of files. One job reads every footer once, in whatever order types change.
Where Python cannot open the files' store, Spark's own merges of footers find the groups by halving.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.conform import conform, union_by_name
from stratalake.sources.footers import file_types, uniform_folders, variants

SOURCE_PATH = "_source_path"
MERGE_THREADS = 8


def parquet_files(spark: SparkSession) -> DataFrameReader:
    """Parquet files below a folder at any depth; sidecar files and folder columns are ignored."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")


def listed_files(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``path``, ``length`` and the path as rows of a scan have it, of every parquet file; no file is opened."""
    files = parquet_files(spark).format("binaryFile").load(list(folders))
    return files.select("path", "length", F.col("_metadata.file_path").alias(SOURCE_PATH))


def schema_groups(
    spark: SparkSession, folders: Sequence[str], columns: Mapping[str, str], files: DataFrame | None = None
) -> list[tuple[T.StructType, list[str]]]:
    """Schemas of the wanted columns, each with the folders, or single files, that have it. ``files`` is their listing,
    where the caller has it.

    Schemas that agree on the columns they share are one group: a column that a file lacks reads as NULL.
    """
    wanted = {name.lower() for name in columns}
    files = listed_files(spark, folders) if files is None else files
    types = file_types(files, columns).cache()
    try:
        found = variants(types)
        if any(row["types"] is None for row in found):
            return _merged_groups(spark, folders, wanted)
        with ThreadPoolExecutor(MERGE_THREADS) as pool:
            # Spark names the types of a variant itself, from one of its files.
            schemas = pool.map(lambda row: parquet_files(spark).parquet(row["path"]).schema, found)
        groups: list[tuple[T.StructType, list[str]]] = []
        for row, schema in sorted(zip(found, schemas, strict=True), key=lambda pair: (-pair[0]["files"], pair[0]["path"])):
            fields = _wanted_fields(schema, wanted)
            for i, (known, members) in enumerate(groups):
                united = _united(known, fields)
                if united is not None:
                    groups[i] = united, [*members, row["types"]]
                    break
            else:
                groups.append((fields, [row["types"]]))
        if len(groups) < 2:
            return [(schema, list(folders)) for schema, _ in groups]
        names = [(t, i) for i, (_, members) in enumerate(groups) for t in members]
        numbered = types.join(F.broadcast(spark.createDataFrame(names, "types string, variant int")), "types")
        tops = uniform_folders(numbered, [_qualified(spark, f) for f in folders]).collect()
        return [(schema, sorted(r["folder"] for r in tops if r["variant"] == i)) for i, (schema, _) in enumerate(groups)]
    finally:
        types.unpersist()


def _wanted_fields(schema: T.StructType, wanted: set[str]) -> T.StructType:
    return T.StructType(sorted((f for f in schema.fields if f.name.lower() in wanted), key=lambda f: f.name.lower()))


def _united(one: T.StructType, two: T.StructType) -> T.StructType | None:
    """Both schemas' columns, or None if a column that they share has two types."""
    kinds = {f.name.lower(): f.dataType.simpleString() for f in one.fields}
    if any(kinds.get(f.name.lower(), f.dataType.simpleString()) != f.dataType.simpleString() for f in two.fields):
        return None
    return T.StructType([*one.fields, *(f for f in two.fields if f.name.lower() not in kinds)])


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as file listings spell it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _merged_groups(spark: SparkSession, folders: Sequence[str], wanted: set[str]) -> list[tuple[T.StructType, list[str]]]:
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    for schema, paths in _proven_schemas(spark, _deliveries(spark, folders)):
        fields = _wanted_fields(schema, wanted)
        key = tuple((f.name.lower(), f.dataType.simpleString()) for f in fields)
        groups.setdefault(key, (fields, []))[1].extend(paths)
    return list(groups.values())


def scan_conformed(
    spark: SparkSession, folders: Sequence[str], columns: Mapping[str, str], files: DataFrame | None = None
) -> DataFrame:
    """``columns`` conformed over all files below ``folders``, and the path of the file of each row."""
    frames = []
    for schema, paths in schema_groups(spark, folders, columns, files):
        raw = parquet_files(spark).schema(schema).parquet(*paths)
        with_path = raw.select(*raw.columns, F.col("_metadata.file_path").alias(SOURCE_PATH))
        frames.append(conform(with_path, columns, keep=[SOURCE_PATH]))
    if not frames:
        raise FileNotFoundError(f"no landed parquet files under {', '.join(folders)}; ingest first")
    return union_by_name(frames)


def _proven_schemas(spark: SparkSession, deliveries: list[str]) -> Iterator[tuple[T.StructType, list[str]]]:
    """Runs of deliveries, in order, whose files one schema fits, found by halving what does not fit together.

    Deliveries that follow each other mostly have the same types, so the merges grow with the number of variants and
    the logarithm of the number of deliveries. A folder whose own files disagree is halved by files. The merges of a
    level run side by side; each is a distributed job over footers.
    """
    level = [deliveries] if deliveries else []
    with ThreadPoolExecutor(MERGE_THREADS) as pool:
        while level:
            split: list[list[str]] = []
            for paths, schema in zip(level, pool.map(lambda p: _merged_schema(spark, p), level), strict=True):
                if schema is not None:
                    yield schema, paths
                    continue
                parts = paths if len(paths) > 1 else _files(spark, paths[0])
                if len(parts) > 1:
                    split += [parts[: len(parts) // 2], parts[len(parts) // 2 :]]
                else:
                    yield parquet_files(spark).parquet(*parts).schema, parts
            level = split


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """Schema of all files below ``paths`` from one distributed read of their footers, None when they conflict."""
    try:
        schema = parquet_files(spark).option("mergeSchema", True).parquet(*paths).schema
    except Exception as error:  # the client wraps this condition in different classes
        if "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise
    # A column that is spelled in two cases comes out twice, and no read schema fits both spellings.
    return schema if len({name.lower() for name in schema.names}) == len(schema.names) else None


def _deliveries(spark: SparkSession, folders: Sequence[str]) -> list[str]:
    """Folders that hold parquet files themselves, in order.

    A folder that also has such folders below it is given as its own files, since reading it would read those too.
    Only folder names are collected.
    """
    holding = parquet_files(spark).format("binaryFile").load(list(folders)).select(_parent("path").alias("folder"))
    found = sorted(row["folder"] for row in holding.distinct().collect())
    outer = {folder[:i] for folder in found for i, c in enumerate(folder) if c == "/"}
    out = []
    for folder in found:
        out.extend(_files(spark, folder, direct=True) if folder in outer else [folder])
    return out


def _files(spark: SparkSession, folder: str, direct: bool = False) -> list[str]:
    files = parquet_files(spark).format("binaryFile").load(folder).select("path")
    if direct:
        files = files.filter(_parent("path") == folder)
    return sorted(row["path"] for row in files.collect())


def _parent(path: str) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)
