from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stratalake.llm import token_arrow
from stratalake.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_memo_equals_the_library(library):
    rng = random.Random(3)
    encode = token_arrow.encoder(vocabulary())
    alphabets = [[chr(i) for i in range(256)], list("abC 's'tre'd.,!09é\n\t|"), [chr(i) for i in range(32, 0x3000, 7)], list("Σσς İıA á")]
    texts = ["", " ", "<|endoftext|> a", "don't WE'LL x's''s", "½²3\x85\xa0\xad", "ß\x1cß"]
    texts += ["".join(rng.choice(a) for _ in range(rng.randrange(80))) for a in alphabets for _ in range(400)]
    for text in texts:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_round_trip(awkward, library):
    rows = [(r["doc_id"], r["text"] or "") for r in awkward.collect()]
    want, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = token_arrow.tokens_round_trip(awkward, vocabulary(), length=32).orderBy("start").collect()
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got)
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))


@pytest.mark.parametrize("sizes", [[1], [31, 1, 64, 200, 3], [5000], [1] * 300])
def test_shard_is_a_file_of_equal_sequences(sizes, tmp_path):
    ids = np.arange(sum(sizes), dtype="<u2")
    docs, at = [], 0
    for k, n in enumerate(sizes):
        docs.append((k if k else None, at, n))
        at += n
    data = token_arrow.shard_bytes(ids, docs, length=32, rows=4)
    assert data.endswith(token_arrow.MAGIC.encode())
    for i, place, got in token_arrow.shard_documents(data):
        assert (i, place, len(got)) in docs and got.tolist() == ids[place : place + len(got)].tolist()
    assert len(list(token_arrow.shard_documents(data))) == len(sizes)
    path = tmp_path / "shard"
    path.write_bytes(data)
    reader = token_arrow.open_shard(pa.memory_map(str(path)))
    k = (len(ids) - 1) // 32
    before = pa.total_allocated_bytes()
    sequence, mask = token_arrow.sequence(reader, k, rows=4)
    assert sequence[mask].tolist() == ids[32 * k :].tolist() and len(sequence) == 32
    assert pa.total_allocated_bytes() - before < 4096  # ids stay in the map


def test_a_task_writes_as_many_shards_as_its_texts_take(frame, library, tmp_path):
    """Ids of one shard are in memory at a time, even where an id has most of the text."""
    rows = [(i, "1 2 3 4 " * (400 if 40 <= i < 44 else 1 + i % 5)) for i in range(60)]
    path, most = f"{tmp_path}/shards", 1000
    token_arrow.write_shards(frame(rows).coalesce(1), vocabulary(), path, length=32, shard_bytes=most)
    token_counts = {i: len(library.encode(text, add_special_tokens=False).ids) + 1 for i, text in rows}
    found, files = [], sorted(tmp_path.glob("shards/part-*-c*.txt"))
    for file in files:
        docs = [(i, len(ids)) for i, _, ids in token_arrow.shard_documents(file.read_bytes())]
        assert sum(n for _, n in docs[:-1]) * 2 < most
        found += docs
    assert sorted(found) == sorted(token_counts.items())


def test_shards_of_a_task_follow_each_other(spark, frame, library, monkeypatch):
    """More shards of a task than its three-digit numbers tell apart as text."""
    rows = [(i, f"text {i}") for i in range(1100)]
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch_rows)
    monkeypatch.setattr(token_arrow, "partitions_for", lambda *_: 1)
    got = token_arrow.tokens_round_trip(frame(rows), vocabulary(), length=8, shard_bytes=1).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == list(range(1100)) and spark.conf.get(batch_rows) == before
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(1100)]


def test_a_task_hands_on_its_shards_one_by_one():
    import itertools

    batch = pa.RecordBatch.from_pydict({"_id": list(range(50)), "_text": ["seven words in each of these texts"] * 50})
    taken = itertools.count()
    shards = token_arrow._encode_shards(vocabulary(), 32, 1, 100)(batch for _ in range(20) if next(taken) >= 0)
    first = next(shards).column("file")[0].as_py() + token_arrow.MAGIC.encode()
    assert next(taken) == 1 and 1 < len(list(token_arrow.shard_documents(first))) <= 8
    assert sum(1 for _ in shards) > 100


def test_empty_table(nothing):
    assert token_arrow.tokens_round_trip(nothing, vocabulary()).collect() == []
