"""Repeated lines: two Bloom filters, for lines seen once and seen twice, pick the few lines worth comparing.

Tasks mark the lines of their documents in a "once" filter, and those met again in a "twice" filter. Merging ORs both,
and adds to "twice" what two tasks both have in "once", so no repeat is missed. Only lines found in "twice" are
shuffled, to be compared as text. A filter is a table of 64-bit words; each line owns four bits of one word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, keyed, partitions_for, public_id, written

LEAST_CHARS = 10
BITS_PER_LINE = 16
#: The "twice" filter goes to every task up to this size; beyond it, lines' words are joined with the filter's.
BROADCAST_BYTES = 64 << 20
SHARD_WORDS = 1 << 15
EDGES = " \t\n\v\f\r"
UPPER = re.compile("[A-Z]+")


def line_key(line: str) -> str:
    """White space stripped at both ends, A-Z lower-cased."""
    line = line.strip(EDGES)
    return line.lower() if line.isascii() else UPPER.sub(lambda m: m[0].lower(), line)


def _hashes(text: str, least: int) -> tuple[list[int], list[str], np.ndarray]:
    """Numbers, keys and hashes of the lines of a text that are long enough to count."""
    at, keys = [], []
    for i, line in enumerate(text.split("\n")):
        if len(line) >= least and len(key := line_key(line)) >= least:
            at.append(i)
            keys.append(key)
    return at, keys, np.fromiter((xxhash.xxh64_intdigest(k.encode()) for k in keys), np.uint64, len(keys))


def _places(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each hash, and its four bits there."""
    mask = np.zeros(len(h), np.uint64)
    mixed = h * np.uint64(0x9E3779B97F4A7C15)
    for shift in (0, 6, 12, 18):
        mask |= np.uint64(1) << ((mixed >> np.uint64(shift + 32)) & np.uint64(63))
    return (h % np.uint64(words)).astype(np.int64), mask


def _merge(word: np.ndarray, once: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of equal words joined: what two entries have in ``once`` goes to ``twice``."""
    order = np.argsort(word, kind="stable")
    word, once, twice = word[order], once[order], twice[order]
    start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    if not len(word):
        return word, once, twice
    length = np.diff(np.r_[start, len(word)])
    all_once, all_twice = once[start].copy(), np.bitwise_or.reduceat(twice, start)
    for k in range(1, int(length.max())):
        has = np.flatnonzero(length > k)
        more = once[start[has] + k]
        all_twice[has] |= all_once[has] & more
        all_once[has] |= more
    return word[start], all_once, all_twice


def _mark(words: int, least: int):
    """Entries (shard, word, once, twice) of a task's documents, one for each word that they touch in a batch run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0
        for batch in batches:
            for text in batch.column("_text").to_pylist():
                held.append(np.unique(_hashes(text, least)[2]))
                count += len(held[-1])
                if count > 1_000_000:
                    yield from flush(held)
                    held, count = [], 0
        yield from flush(held)

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, seen = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        word, mask = _places(h, words)
        word, once, twice = _merge(word, mask, np.where(seen > 1, mask, np.uint64(0)))
        for i in range(0, len(word), 65_536):
            part = slice(i, i + 65_536)
            columns = [word[part] // SHARD_WORDS, word[part], once[part].view(np.int64), twice[part].view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["shard", "word", "once", "twice"])

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the "twice" filter that are not zero, for the shards of a task."""
    shards: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        shard, word, once, twice = (batch.column(i).to_numpy() for i in range(4))
        word, once, twice = _merge(word, once.view(np.uint64), twice.view(np.uint64))
        shard, inside = word // SHARD_WORDS, word % SHARD_WORDS
        for s in np.unique(shard).tolist():
            mine = shard == s
            a, b = shards.setdefault(s, (np.zeros(SHARD_WORDS, np.uint64), np.zeros(SHARD_WORDS, np.uint64)))
            at = inside[mine]
            b[at] |= twice[mine] | (a[at] & once[mine])
            a[at] |= once[mine]
    for s, (_, b) in shards.items():
        at = np.flatnonzero(b)
        columns = [pa.array(at + s * SHARD_WORDS, pa.int64()), pa.array(b[at].view(np.int64), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["word", "twice"])


def seen_twice(texts: DataFrame, words: int, least: int = LEAST_CHARS) -> DataFrame:
    """The filter of lines seen twice: (word, twice), words of zero left out. Documents of one id may mark a line twice;
    the comparison that follows settles it."""
    entries = texts.select("_text").mapInArrow(_mark(words, least), "shard long, word long, once long, twice long")
    n = partitions_for(texts.sparkSession, words, 16 * SHARD_WORDS)
    return written(entries.repartition(n, "shard").mapInArrow(_gather, "word long, twice long"))


SUSPECT = "_id long, _hash long, line int, key string"


def _probe(filter_words, words: int, least: int):
    """Lines whose four bits are all in the broadcast filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.zeros(words, np.uint64)
        at, bits = filter_words.value
        twice[at] = bits
        for batch in batches:
            rows: list[tuple] = []
            for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_hash", "_text")), strict=True):
                lines, keys, hashes = _hashes(text, least)
                word, mask = _places(hashes, words)
                hit = np.flatnonzero((twice[word] & mask) == mask)
                rows += [(i, h, lines[k], keys[k]) for k in hit.tolist()]
                if len(rows) > 20_000:
                    yield _suspects(rows)
                    rows = []
            yield _suspects(rows)

    return run


def _suspects(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["_id", "_hash", "line", "key"]
    )


def _place_lines(words: int, least: int):
    """Word and bits of every line, for a join with a filter that is too large to broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_hash", "_text")), strict=True):
                lines, _, hashes = _hashes(text, least)
                word, mask = _places(hashes, words)
                n = len(lines)
                arrays = [np.full(n, i, np.int64), np.full(n, h, np.int64), np.array(lines, np.int32), word, mask.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["_id", "_hash", "line", "word", "mask"])

    return run


def _keys_of(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("_id", "_hash", "_text", "lines"))
            for i, h, text, lines in zip(*columns, strict=True):
                split = text.split("\n")
                rows += [(i, h, k, line_key(split[k])) for k in sorted(lines)]
            yield _suspects(rows)

    return run


def suspected_lines(texts: DataFrame, least: int = LEAST_CHARS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every line that may repeat: the row's key, the line's number and its key. All repeats are among them."""
    lines = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1
    total = texts.agg(F.sum(lines).alias("n")).collect()[0]["n"] or 0
    words = max(1024, total * BITS_PER_LINE // 64)
    twice = seen_twice(texts, words, least)
    if twice.count() * 16 <= broadcast_bytes and words * 8 <= broadcast_bytes:
        found = twice.toArrow()
        value = (found["word"].to_numpy(), found["twice"].to_numpy().view(np.uint64))
        return texts.mapInArrow(_probe(texts.sparkSession.sparkContext.broadcast(value), words, least), SUSPECT)
    placed = texts.mapInArrow(_place_lines(words, least), "_id long, _hash long, line int, word long, mask long")
    hits = placed.join(twice, (placed["word"] == twice["word"]) & (F.col("mask").bitwiseAND(F.col("twice")) == F.col("mask")))
    lines_of = hits.groupBy(*KEY).agg(F.collect_set("line").alias("lines"))
    return texts.join(lines_of, list(KEY)).mapInArrow(_keys_of(least), SUSPECT)


def repeated_lines(texts: DataFrame, least: int = LEAST_CHARS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Lines to drop, as ``lines`` for each key of ``texts``: those of a key that a document with a smaller id has."""
    suspects = written(suspected_lines(texts, least, broadcast_bytes))
    kept_by = suspects.groupBy("key").agg(F.min("_id").alias("first"), F.max("_id").alias("last"))
    kept_by = written(kept_by.filter("first < last").select("key", "first"))
    drops = suspects.join(kept_by, "key").filter("_id > first")
    return drops.groupBy(*KEY).agg(F.collect_set("line").alias("lines"))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for i, text, lines in zip(*(batch.column(c).to_pylist() for c in ("_id", "_text", "lines")), strict=True):
            split = text.split("\n")
            gone = set(lines or ())
            kept = "\n".join(line for k, line in enumerate(split) if k not in gone) if gone else text
            out.append((i, kept, len(split), len(gone)))
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["_id", "text", "n_lines", "n_dropped"]
        )


def without_repeated_lines(docs: DataFrame, least: int = LEAST_CHARS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text (what stays), n_lines, n_dropped.

    A line counts by its key (see ``line_key``) if that has ``least`` code points. A key found in two documents or
    more stays only in the smallest doc_id that holds it, there as often as it occurs. A null or empty text is one
    empty line. A null doc_id is one document after all others; rows that share an id are one document, so none of
    them drops a line for the other's sake. A text of which every line is dropped becomes empty. An empty table gives
    no rows; other columns are not read.
    """
    texts = keyed(docs)
    drops = repeated_lines(texts, least, broadcast_bytes)
    rows = texts.join(drops, list(KEY), "left").select("_id", "_text", "lines")
    out = rows.mapInArrow(_rewrite, "_id long, text string, n_lines long, n_dropped long")
    return out.select(public_id().alias("doc_id"), "text", "n_lines", "n_dropped")
