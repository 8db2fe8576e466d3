"""Tables that change together and all at once: versions in folders of their own, and a pointer written last.

A table's rows lie below ``version=…`` folders, in partition folders if it has any. The pointer of a group of tables
says for each partition folder which version holds it, so a run writes the partitions that it changes and nothing else.
Readers follow the newest pointer. It is a new file each time, put in place by one rename, so a run that fails anywhere
before leaves every table of the group as it was, and of two runs at once the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratalake.sources.layout import join

POINTERS = "_published"
VERSION = "version"
#: Pointers that are kept, so that readers of the one before still find their files.
KEPT = 2


class ConcurrentRunError(RuntimeError):
    """Another run has published since this one looked."""


@dataclass(frozen=True)
class Pointer:
    """``tables``: of each table, the version of each partition folder ("" for a table without). ``note``: anything a
    later run needs to know about how the tables were made."""

    number: int = 0
    tables: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    note: Mapping[str, object] = field(default_factory=dict)


def new_version() -> str:
    return uuid.uuid4().hex


def version_path(path: str, version: str) -> str:
    return f"{path}/{VERSION}={version}"


def write_version(df: DataFrame, path: str, version: str, partition_by: Sequence[str] = ()) -> None:
    """Rows beside the published ones; nobody sees them yet."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(version_path(path, version))


def written_folders(spark: SparkSession, path: str, version: str, partition_by: Sequence[str] = ()) -> dict[str, str]:
    """The partition folders that a version has, each with the version. Only folders are listed."""
    if not partition_by:
        return {"": version}
    root = version_path(path, version)
    found = _list(spark, "/".join([root, *[f"{c}=*" for c in partition_by]]))
    return {"/".join(f.split("/")[-len(partition_by) :]): version for f in found}


def current(spark: SparkSession, layer: str, group: str) -> Pointer | None:
    """The newest pointer of a group of tables in a layer's folder."""
    numbered = _pointers(spark, layer, group)
    if not numbered:
        return None
    number, path = numbered[-1]
    held = _read(spark, path)
    return Pointer(number, held["tables"], held["note"])


def publish(
    spark: SparkSession,
    layer: str,
    group: str,
    tables: Mapping[str, Mapping[str, str]],
    before: Pointer | None,
    note: Mapping[str, object] | None = None,
) -> Pointer:
    """Make ``tables`` what readers see; those of the group that are not given stay. Then what no reader
    finds any more is removed."""
    number = before.number + 1 if before else 1
    pointer = Pointer(number, {**(before.tables if before else {}), **tables}, dict(note or {}))
    text = json.dumps({"tables": pointer.tables, "note": pointer.note}, sort_keys=True)
    target = join(layer, POINTERS, f"{group}.{number:08d}.json")
    draft = join(layer, POINTERS, f".{group}.{uuid.uuid4().hex}")
    system, place = _system(spark, draft)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    there = spark._jvm.org.apache.hadoop.fs.Path(target)
    if system.exists(there) or not system.rename(place, there):
        system.delete(place, False)
        raise ConcurrentRunError(f"{group}: version {number} is there already")
    _drop_old(spark, layer, group)
    return pointer


def live_paths(spark: SparkSession, path: str) -> list[str] | None:
    """Folders that hold a table's published rows, ``[]`` if versions were written but none is published, or None for
    a table without versions."""
    folders = _published_folders(spark, path)
    if folders is None:
        return [] if _list(spark, f"{path}/{VERSION}=*") else None
    return _paths(spark, path, folders)


def read_published(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A table's published rows; None for a table without versions. One that is not published yet is missing."""
    folders = _published_folders(spark, path)
    if folders is None and not _list(spark, f"{path}/{VERSION}=*"):
        return None
    return _rows(spark, path, folders, T.StructType.fromDDL(schema) if schema else None)


def read_table_of(spark: SparkSession, layer: str, group: str, name: str, schema: T.StructType) -> DataFrame:
    """The published rows of a table by the name of its group."""
    pointer = current(spark, layer, group)
    return _rows(spark, join(layer, name), pointer.tables[name] if pointer else None, schema)


def _rows(spark: SparkSession, path: str, folders: Mapping[str, str] | None, schema: T.StructType | None) -> DataFrame:
    if folders is not None and not folders and schema is not None:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*(_paths(spark, path, folders or {}) or [f"{path}/{VERSION}=none"])).drop(VERSION)


def _paths(spark: SparkSession, path: str, folders: Mapping[str, str]) -> list[str]:
    """One folder for a version whose partition folders all count, else each that does."""
    out = []
    for version in sorted(set(folders.values())):
        own = {f for f, v in folders.items() if v == version}
        depth = len(next(iter(own)).split("/"))
        root = version_path(path, version)
        there = {"/".join(f.split("/")[-depth:]) for f in _list(spark, "/".join([root, *["*=*"] * depth]))}
        out += [root] if own in ({""}, there) else [f"{root}/{f}" for f in sorted(own)]
    return out


def _published_folders(spark: SparkSession, path: str) -> Mapping[str, str] | None:
    """A table belongs to the group of its own name, or of a name that its own begins with."""
    layer, _, name = path.rstrip("/").rpartition("/")
    groups = {f.rsplit("/", 1)[-1].rsplit(".", 2)[0] for f in _list(spark, join(layer, POINTERS, "*.json"))}
    for group in sorted((g for g in groups if name == g or name.startswith(f"{g}_")), key=len, reverse=True):
        tables = current(spark, layer, group).tables
        if name in tables:
            return tables[name]
    return None


def _pointers(spark: SparkSession, layer: str, group: str) -> list[tuple[int, str]]:
    found = _list(spark, join(layer, POINTERS, f"{group}.*.json"))
    return sorted((int(f.rsplit(".", 2)[1]), f) for f in found if f.rsplit("/", 1)[-1].rsplit(".", 2)[0] == group)


def discard(spark: SparkSession, path: str, version: str) -> None:
    """Remove a version that was not published."""
    system, place = _system(spark, version_path(path, version))
    system.delete(place, True)


def _drop_old(spark: SparkSession, layer: str, group: str) -> None:
    """Older pointers, and the folders that they name and no newer one does. What a run has written but not published
    is in no pointer, so it is not touched."""
    numbered = [path for _, path in _pointers(spark, layer, group)]
    kept = {entry for path in numbered[-KEPT:] for entry in _entries(spark, path)}
    versions = {entry[:2] for entry in kept}
    for path in numbered[:-KEPT]:
        for name, version, folder in _entries(spark, path) - kept:
            root = version_path(join(layer, name), version)
            system, place = _system(spark, f"{root}/{folder}" if (name, version) in versions else root)
            system.delete(place, True)
        system, place = _system(spark, path)
        system.delete(place, False)


def _entries(spark: SparkSession, path: str) -> set[tuple[str, str, str]]:
    tables = _read(spark, path)["tables"]
    return {(name, version, folder) for name, folders in tables.items() for folder, version in folders.items()}


def _read(spark: SparkSession, path: str) -> dict:
    system, place = _system(spark, path)
    stream = system.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _list(spark: SparkSession, pattern: str) -> list[str]:
    system, place = _system(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(place) or []]


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
