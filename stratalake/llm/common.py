"""Helpers shared by the operators: document keys, tables written between jobs, sizes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A null doc_id takes this value inside an operator, after every other id.
NULL_ID = (1 << 63) - 1
#: Columns that name a row inside an operator: the id, and a hash of the text for rows that repeat an id.
KEY = ("_id", "_hash")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Without that setting a local session gets a temporary folder, and a cluster an error: its machines would each see
    a folder of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame written to a shared folder and read back: computed once, with its lineage cut and its size known."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that run inside send at most ``most`` rows at once to Python, or fewer where the session says so."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_hash`` and ``_text`` of each row; a null text is empty. Every other column stays behind, so none of
    any name can clash. Rows equal in id and text share a key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col), F.lit(NULL_ID)).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text")
    )


def with_key(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the key of each row and its own columns under neutral names, and the way back to those columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    column = dict(zip(docs.columns, names, strict=True))
    held = docs.toDF(*names).withColumns(
        {
            KEY[0]: F.coalesce(F.col(column["doc_id"]), F.lit(NULL_ID)),
            KEY[1]: F.xxhash64(F.coalesce(F.col(column["text"]), F.lit(""))),
        }
    )
    return held, lambda df: df.select(*names).toDF(*docs.columns)


def public_id(column: str = "_id") -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def repeated(df: DataFrame, count: str, nth: str, most: int = 4096, counts: DataFrame | None = None) -> DataFrame:
    """Each row of ``df`` as often as its column ``count`` says, numbered from 0 by ``nth``.

    A row that is repeated more often than ``most`` is dealt out to many tasks first, in runs of ``most``; ``df`` is
    read twice for that, or once if ``counts``, a table that has all its counts, shows no such row.
    """
    few = df.filter(F.col(count).between(1, most)).withColumn(nth, F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
    if counts is not None and counts.filter(F.col(count) > most).isEmpty():
        return few
    run = F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / most)))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = df.filter(F.col(count) > most).withColumn("_run", run).repartition(n, *df.columns[:1], "_run")
    begin = F.col("_run") * most
    own = F.sequence(begin, F.least(begin + most, F.col(count)) - 1)
    return few.unionByName(many.withColumn(nth, F.explode(own)).drop("_run"))


def word_count(text: Column, word: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(word))


def partitions_for(spark: SparkSession, units: int, per_partition: int) -> int:
    """Enough partitions for ``units`` at ``per_partition`` each, never fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-units // per_partition))
