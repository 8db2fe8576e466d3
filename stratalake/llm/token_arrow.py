"""Token ids as Arrow files of equal-length sequences.

A shard is one Arrow IPC file. Its record batches hold ``ids``, fixed-size lists; ``mask``, fixed-size lists of bytes that
are 0 over the padding at the shard's end, kept once in a dictionary; and ``docs``, the documents that begin in a sequence. Sequences follow each
other without gaps, so sequence i of a shard is row i % ROWS of batch i // ROWS, read without a copy from a memory map.

Spark's text writer commits the shards: a shard is one row and one file, and the row separator is the magic string that
ends an Arrow file. So files appear only when their task is committed, in any store that Spark writes to. A task writes
as many shards as its texts take, so a worker holds one shard's ids at a time, whatever falls to its task.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_rows, keyed, partitions_for, public_id, shared_folder, written

SEQUENCE = 2048
#: Sequences in a record batch.
ROWS = 64
END_ID = 1
MAGIC = "ARROW1"
#: Bytes of text for each task, on average; a shard's ids take as many at most, besides its last document's.
SHARD_BYTES = 16 << 20
#: Texts that travel to a worker at once.
TEXTS = 256
#: Pieces of text whose ids a worker keeps: entries of a generation, at most about 40 MB.
MEMO = 200_000
#: Characters of an entry at most.
LONGEST = 40

# What the vocabulary's pre-tokenizer makes of lower-cased Latin-1 text; other text goes to the library whole.
LATIN_PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]"
    r"|[^\t-\r \x85\xa0a-z0-9ªµºß-öø-ÿ²³¹¼-¾]+"
)
ODD_SPACE = re.compile("[\x1c-\x1f]")
# Byte-level spelling: bytes that are no visible Latin-1 character stand for the characters from 256 on, in order.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(_HIDDEN)}


class Memo(dict):
    """What was asked for lately: two generations of at most ``MEMO`` entries. When the young one is full it becomes
    the old one, and what is asked for again comes back from there, so frequent entries stay for as long as a worker
    lives, in bounded memory."""

    def __init__(self) -> None:
        super().__init__()
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.made(key)
        if len(key) <= LONGEST:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids

    def made(self, key: str) -> bytes:
        raise NotImplementedError


class WordIds(Memo):
    """Ids of a piece of text as bytes, asked from the tokenizer once: pieces are encoded apart from each other."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "u4")
        self.code = self.dtype.char

    def made(self, key: str) -> bytes:
        # The vocabulary spells bytes as characters; its model takes a piece in that spelling, without the steps before.
        spelled = key.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()


_encoders: dict[str, WordIds] = {}


def encoder(path: str):
    """``encode(text)`` gives the ids as an array; equal to the library's on the whole text. One memo for a worker."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    words = _encoders[path]

    def encode(text: str) -> np.ndarray:
        try:
            text.encode("latin-1")
            plain = "<|" not in text and not ODD_SPACE.search(text)
        except UnicodeEncodeError:
            plain = False
        # One look-up for each piece: what white space parts is too varied for a memo.
        ids = b"".join(map(words.__getitem__, LATIN_PIECE.findall(text.lower()))) if plain else words.whole(text)
        return np.frombuffer(ids, words.dtype)

    return encode


def _lists(flat: np.ndarray, length: int, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(flat, kind), length)


DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())]))


def shard_bytes(ids: np.ndarray, docs: list[tuple], length: int = SEQUENCE, rows: int = ROWS) -> bytes:
    """The file of one shard. ``docs``: (doc_id, first id's place in the shard, number of ids), in order."""
    return shard_buffer(ids, docs, length, rows).to_pybytes()


def shard_buffer(ids: np.ndarray, docs: list[tuple], length: int = SEQUENCE, rows: int = ROWS) -> pa.Buffer:
    """As ``shard_bytes``. Ids are copied into the file only; the last batch is padded."""
    n = -(-len(ids) // length)
    kind = pa.uint16() if ids.dtype.itemsize == 2 else pa.uint32()
    # A shard has two masks at most, which its batches share: of a full sequence, and of the last one.
    last = np.arange(length) < len(ids) - (n - 1) * length
    masks = _lists(np.r_[np.ones(length, np.uint8), last.astype(np.uint8)], length, pa.uint8())
    which = pa.array((np.arange(n) == n - 1).astype(np.int8))
    starts = np.searchsorted([d[1] for d in docs], np.arange(n + 1) * length)
    schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.dictionary(pa.int8(), pa.list_(pa.uint8(), length))), ("docs", DOCS)])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as writer:
        for i in range(0, n, rows):
            j = min(n, i + rows)
            here = [docs[a:b] for a, b in zip(starts[i:j], starts[i + 1 : j + 1], strict=True)]
            part = ids[i * length : j * length]
            if len(part) < (j - i) * length:
                part = np.r_[part, np.zeros((j - i) * length - len(part), ids.dtype)]
            columns = [_lists(part, length, kind), pa.DictionaryArray.from_arrays(which[i:j], masks), pa.array(here, DOCS)]
            writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
    return sink.getvalue()


def _file_row(shard: pa.Buffer) -> pa.RecordBatch:
    """One row with the shard's file up to its end string, which the text writer adds; the bytes are not copied."""
    size = shard.size - len(MAGIC)
    file = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, size], np.int32)), shard.slice(0, size)])
    return pa.RecordBatch.from_arrays([file], ["file"])


def _encode_shards(path: str, length: int, end_id: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        kind = encode("").dtype
        end = np.array([end_id], kind).tobytes()
        flat, docs = bytearray(), []
        for batch in batches:
            for i, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_text")), strict=True):
                ids = encode(text)
                docs.append((i, len(flat) // kind.itemsize, len(ids) + 1))
                flat += ids.data
                flat += end
                if len(flat) >= most:
                    yield _file_row(shard_buffer(np.frombuffer(flat, kind), docs, length))
                    flat, docs = bytearray(), []
        if docs:
            yield _file_row(shard_buffer(np.frombuffer(flat, kind), docs, length))

    return run


def write_shards(docs: DataFrame, tokenizer: str, path: str, length: int = SEQUENCE, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text and write shards below ``path``; shard k's documents all come before those of shard k + 1,
    where shards follow each other by the number of their task and then their number within it (``-c``) in their names.

    Ascending doc_id orders the documents, null last; rows that repeat an id follow in the order of a hash of their
    text. A null or empty text has the end id only. An empty table writes no shard.
    """
    texts = keyed(docs)
    size = texts.agg(F.sum(F.octet_length("_text")).alias("n")).collect()[0]["n"] or 0
    n = partitions_for(docs.sparkSession, size, shard_bytes)
    ordered = texts.repartitionByRange(n, "_id", "_hash").sortWithinPartitions("_id", "_hash")
    files = ordered.mapInArrow(_encode_shards(tokenizer, length, end_id, shard_bytes), "file binary")
    files = files.select(F.col("file").cast("string"))
    with arrow_rows(docs.sparkSession, TEXTS):
        files.write.option("lineSep", MAGIC).option("maxRecordsPerFile", 1).text(path)


def open_shard(data) -> pa.RecordBatchFileReader:
    """A reader over a shard's bytes or memory map; ``get_batch(i)`` copies nothing."""
    return pa.ipc.open_file(data if isinstance(data, (pa.NativeFile, pa.Buffer)) else pa.py_buffer(data))


def sequence(reader: pa.RecordBatchFileReader, i: int, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``i``; both are views of the file."""
    batch = reader.get_batch(i // rows)
    masks = batch.column("mask")
    ids, mask = batch.column("ids")[i % rows].values, masks.dictionary[masks.indices[i % rows].as_py()].values
    return ids.to_numpy(), mask.to_numpy().view(np.bool_)


def shard_documents(data) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, place in the shard, ids) of every document in a shard, a batch in memory besides the document."""
    reader = open_shard(data)
    held: list[np.ndarray] = []
    begin = end = 0  # places in the shard of what ``held`` has
    waiting: list[dict] = []
    for k in range(reader.num_record_batches):
        batch = reader.get_batch(k)
        ids = batch.column("ids").flatten().to_numpy()
        held.append(ids)
        end += len(ids)
        waiting += [d for here in batch.column("docs").to_pylist() for d in here]
        flat = held[0] if len(held) == 1 else None
        done = 0
        for d in waiting:
            if d["at"] + d["n_tokens"] > end:
                break
            flat = np.concatenate(held) if flat is None else flat
            yield d["doc_id"], d["at"], flat[d["at"] - begin : d["at"] - begin + d["n_tokens"]]
            done += 1
        waiting = waiting[done:]
        if waiting and done:
            flat = flat[waiting[0]["at"] - begin :]
            held, begin = [flat], waiting[0]["at"]
        elif not waiting:
            held, begin = [], end


READ = "path string, _id long, at long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            buffer = content.as_buffer()
            found = shard_documents(buffer) if buffer.size else ()  # Spark leaves an empty file where there are no rows
            rows = [(path, i, at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))) for i, at, ids in found]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), *[pa.int64()] * 4)
            names = ["path", "_id", "at", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """From the shards below ``path``: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A shard's place in the whole is the sum of the shards before it; there is one such row for each file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    with arrow_rows(spark, 1):
        found = written(files.mapInArrow(_read, READ))
    per_shard = found.groupBy("path").agg(F.sum("n_tokens").alias("n"))
    name = F.element_at(F.split("path", "/"), -1)
    order = [F.regexp_extract(name, number, 1).cast("long") for number in (r"^part-(\d+)", r"-c(\d+)")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = per_shard.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    out = found.join(written(base), "path")
    return out.select(public_id().alias("doc_id"), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokens_round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Shards of ``docs`` written to a shared folder, and what is read back from them."""
    path = shared_folder(docs.sparkSession)
    write_shards(docs, tokenizer, path, **options)
    return read_documents(docs.sparkSession, path)
