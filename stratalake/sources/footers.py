"""Files read by the tasks themselves, where a row per file would not do: footers alone, and digests of any size."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Mapping
from functools import partial
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Schemes that Spark's file systems and Arrow's spell differently.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
CHUNK = 1 << 20
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def file_types(files: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``path`` and ``types`` of each of ``files`` (path): one text for all wanted columns and their types.

    Footers are read where the tasks run, each once, and nothing but the footer. ``types`` is null where Python has no
    way to the file's store, or cannot read the footer.
    """
    return files.select("path").mapInArrow(partial(_read, {name.lower() for name in columns}), "path string, types string")


def _read(wanted: set[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    closed: set[str] = set()  # schemes that this task could not open
    for batch in batches:
        paths = batch.column("path").to_pylist()
        types = []
        for path in paths:
            scheme = path.split(":", 1)[0]
            found = None
            if scheme not in closed:
                try:
                    found = _types(path, wanted)
                except (OSError, ValueError, pa.ArrowException):
                    closed.add(scheme)
            types.append(found)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(types, pa.string())], ["path", "types"])


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a path as Spark spells it, and the path within; an error where Arrow has none."""
    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{quote(rest, safe='/:@')}")


def can_open(path: str) -> bool:
    """Whether Python reaches the store of ``path``."""
    try:
        system, place = store(path)
        return system.get_file_info(place).type != pafs.FileType.NotFound
    except (OSError, ValueError, pa.ArrowException):
        return False


def hashed(files: DataFrame) -> DataFrame:
    """``path`` and ``sha256`` of each of ``files`` (path). A file is read as a stream, a megabyte at a time, where its
    task runs, so a file of any size takes no more memory."""
    return files.select("path").mapInArrow(_hash, "path string, sha256 string")


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            system, place = store(path)
            with system.open_input_stream(place) as stream:
                while part := stream.read(CHUNK):
                    digest.update(part)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()])], ["path", "sha256"])


def _types(path: str, wanted: set[str]) -> str:
    system, place = store(path)
    footer = pq.read_metadata(place, filesystem=system)
    # What Spark noted about its own columns tells apart types that are stored alike.
    noted = json.loads((footer.metadata or {}).get(SPARK_SCHEMA, b"{}")).get("fields", [])
    out = [f"{f['name'].lower()}={json.dumps(f['type'], sort_keys=True)}" for f in noted if f["name"].lower() in wanted]
    for i in range(footer.num_columns):
        c = footer.schema.column(i)
        if c.path.split(".")[0].lower() in wanted:
            out.append(f"{c.path.lower()}:{c.physical_type}:{c.logical_type}:{c.converted_type}:{c.max_repetition_level}:{c.length}")
    return "\n".join(sorted(out))


def variants(types: DataFrame) -> list[Row]:
    """One row for each text of types: ``types``, one ``path`` that has it, and how many ``files`` do."""
    return types.groupBy("types").agg(F.min("path").alias("path"), F.count("*").alias("files")).collect()


def uniform_folders(files: DataFrame, roots: list[str]) -> DataFrame:
    """The highest folders, at or below ``roots``, whose files all have one ``variant``; a lone file where its folder
    has several. ``files``: path and variant. One row for each folder: folder, variant.

    A zone whose types never change is one folder, whatever the number of its files.
    """
    parts = F.split("path", "/")
    depth = F.size(F.split(F.element_at(F.filter(F.array(*map(F.lit, roots)), _holds), 1), "/"))
    ends = F.sequence(F.coalesce(depth, F.size(parts)), F.size(parts))
    above = files.select("path", "variant", F.explode(ends).alias("depth"), parts.alias("parts"))
    above = above.select("path", "variant", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("folder"))
    one = above.groupBy("folder").agg(F.min("variant").alias("variant"), F.max("variant").alias("other"))
    one = one.filter("variant = other").drop("other")
    highest = above.join(one, ["folder", "variant"]).groupBy("path").agg(F.min_by(F.struct("folder", "variant"), "depth").alias("top"))
    return highest.select("top.*").distinct()


def _holds(root: Column) -> Column:
    return (F.col("path") == root) | F.startswith(F.col("path"), F.concat(root, F.lit("/")))
