"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed size. Distinct blocks are sorted and numbered, which gives each an
integer name; then adjacent pairs of names are named in the same way, until each document has one name. Two documents
have equal (level, name) if and only if their texts are equal: names come from compared blocks, never from hashes.

A block's 64-bit signature only carries it to its name: distinct blocks are gathered by signature, compared as text,
and where one signature has several blocks, all of them are found by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, keyed, public_id, repeated, written

SPACE = r"[\x20\x09-\x0D]+"
BLOCK = 16_384
#: Signatures with more than one block that are broadcast at most; more are joined with a shuffle.
BROADCAST_ROWS = 100_000


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """An integer name for each row, rising in sorted order within the partition that holds the row."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _block_names(blocks: DataFrame) -> DataFrame:
    """Keys, ``pos``, ``n`` and the ``name`` of each block."""
    variants = blocks.groupBy("sig").agg(F.array_sort(F.collect_set("block")).alias("variants"))
    several = F.size("variants") > 1
    distinct = variants.select("sig", F.when(several, F.lit(True)).alias("several"), F.explode("variants").alias("block"))
    names = _numbered(distinct, "sig", "block").select(
        "sig", F.when(F.col("several"), F.col("block")).otherwise("").alias("exact"), "name", "several"
    )
    names = written(names)
    clashes = names.filter("several").select("sig").distinct()
    found = clashes.count()
    if found:
        clashes = clashes.withColumn("clash", F.lit(True))
        blocks = blocks.join(F.broadcast(clashes) if found <= BROADCAST_ROWS else clashes, "sig", "left")
        blocks = blocks.withColumn("exact", F.when(F.col("clash"), F.col("block")).otherwise(""))
    else:
        blocks = blocks.withColumn("exact", F.lit(""))
    placed = blocks.select(*KEY, "pos", "n", "sig", "exact")
    return placed.join(names.drop("several"), ["sig", "exact"]).select(*KEY, "pos", "n", "name")


def block_identities(texts: DataFrame, block: int = BLOCK, signature=F.xxhash64) -> DataFrame:
    """``level`` and ``name`` for each key of ``texts`` (``_id``, ``_hash``, ``_text``), equal exactly for equal texts.

    Runs one round for each doubling of the longest text. An empty text is one empty block. Rows with equal keys give
    one row.
    """
    cut = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    cut = F.when(F.col("_text") == "", F.array(F.lit(""))).otherwise(cut)
    listed = texts.select(*KEY, cut.alias("blocks"))
    blocks = listed.select(*KEY, F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block"))
    names = written(_block_names(blocks.withColumn("sig", signature(F.col("block")))))
    level, done = 0, []
    while True:
        done.append(names.filter("n = 1").select(*KEY, F.lit(level).alias("level"), "name"))
        rest = names.filter("n > 1")
        if rest.isEmpty():
            break
        side = [F.max(F.when(F.col("pos") % 2 == k, F.col("name"))) for k in (0, 1)]
        pairs = rest.groupBy(*KEY, F.expr("pos div 2").cast("int").alias("pos"), F.expr("cast((n + 1) div 2 as int)").alias("n"))
        pairs = written(pairs.agg(side[0].alias("a"), F.coalesce(side[1], F.lit(-1)).alias("b")))
        pair_names = written(_numbered(pairs.select("a", "b").distinct(), "a", "b"))
        names = written(pairs.join(pair_names, ["a", "b"]).select(*KEY, "pos", "n", "name"))
        level += 1
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.groupBy(*KEY).agg(F.max("level").alias("level"), F.max("name").alias("name"))


def exact_groups(docs: DataFrame, block: int = BLOCK, normalised: Column | None = None, signature=F.xxhash64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are compared without white space unless ``normalised`` gives another expression over ``_text``. Of equal
    texts the row with the most code points in the original stays, then the one with the smallest doc_id. A null text
    is empty; empty texts are equal. A null doc_id comes after every other and stays null. Of rows that repeat an id
    and a text, one can stay. An empty table gives no rows; other columns are not read.
    """
    text = F.regexp_replace("_text", SPACE, "") if normalised is None else normalised
    # A row is known by its id and a digest of its text, wide enough that no two texts share one.
    rows = keyed(docs).withColumn("_hash", F.unhex(F.sha2("_text", 256)))
    rows = rows.withColumns({"_chars": F.length("_text"), "_text": text})
    identities = block_identities(rows, block, signature)
    about = rows.groupBy(*KEY).agg(
        F.count("*").alias("_rows"), F.first("_chars").alias("_chars"), F.first(F.sha2("_text", 256)).alias("text_sha256")
    )
    about = written(about.join(identities, list(KEY)))
    order = F.struct((-F.col("_chars")).alias("c"), F.col("_id").alias("i"), F.col("_hash").alias("h"))
    groups = about.groupBy("level", "name").agg(F.sum("_rows").alias("group_size"), F.min(order).alias("_best"))
    best = (F.col("_best.i") == F.col("_id")) & (F.col("_best.h") == F.col("_hash"))
    out = repeated(written(about.join(written(groups), ["level", "name"])), "_rows", "_nth")
    return out.select(
        public_id().alias("doc_id"),
        public_id("_best.i").alias("keep_id"),
        "group_size",
        (best & (F.col("_nth") == 0)).alias("kept"),
        "text_sha256",
    )
