from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratalake.llm import warc
from stratalake.llm.common import shared_folder


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 400
    rows = [
        (1, "http://a/1", long, 0),
        (2, "http://a/2\r\nX: y", long, 0),
        (3, None, long, 0),
        (3, None, long, 0),
        (4, "u", None, 0),
        (5, "u", "", 0),
        (6, "u", "short", 0),
        (7, "u", "short", 0),
        (None, "u", long, 0),
        (None, "u", "z" * 5000, 0),
        (8, "u", "ends\r\n\r\n", 0),
        (9, "u", "y" * 200_000, 0),
        (10, "u", "x" * 999, 0),
        (11, "u", "x" * 999, 0),
        (12, "u", "x" * 1000, 0),
        (13, "u", "x" * 1000, 0),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, block int")


def expected(rows):
    last = {}
    for r in rows:
        if len((r["html"] or "").encode()) >= 1000 and r["page_id"] is not None:
            last[r["html"]] = max(last.get(r["html"], r["page_id"]), r["page_id"])
    out = Counter()
    for r in rows:
        data = (r["html"] or "").encode()
        refers = last.get(r["html"])
        refers = None if refers == r["page_id"] else refers
        kind = "response" if refers is None else "revisit"
        out[(r["page_id"], kind, refers, len(data), hashlib.sha1(data).hexdigest(), True)] += 1
    return out


@pytest.mark.parametrize("segment", [50, 16_384])
def test_round_trip(pages, segment):
    rows = warc.archive_round_trip(pages, segment).collect()
    names = ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "complete")
    assert Counter(tuple(r[c] for c in names) for r in rows) == expected(pages.collect())
    texts = {r["page_id"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response" and r["page_id"]}
    for r in pages.collect():
        if r["page_id"] in texts:
            assert texts[r["page_id"]] == (r["html"] or "").encode()


def test_segments_in_any_file_and_order(spark, pages):
    path = shared_folder(spark)
    warc.write_archives(pages, path, 100)
    found = warc.read_records(spark, path)
    mixed = found.repartition(9, F.rand(1)).sortWithinPartitions(F.rand(2))
    want = Counter(map(str, warc.reassembled(found).collect()))
    assert Counter(map(str, warc.reassembled(mixed).collect())) == want
    assert found.filter("type = 'continuation'").count() > 100


@pytest.mark.parametrize("broken", ["segment <> 2 OR segment IS NULL", "total IS NULL", "segment <> 1 OR segment IS NULL"])
def test_lost_segments_are_told(spark, pages, broken):
    path = shared_folder(spark)
    warc.write_archives(pages.filter("page_id = 9"), path, 1000)
    whole = warc.reassembled(warc.read_records(spark, path).filter(broken))
    assert [r["complete"] for r in whole.collect()] == [False]
    assert [r["complete"] for r in whole.mapInArrow(warc._decode, warc.PAGE).collect()] == [False]


def test_chunked_framing():
    for data in (b"", b"a", b"x" * 10_000):
        assert warc.unchunked(warc.chunked(data, 7)) == data
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\nabc\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"3\r\nabc\r\n"):
        assert warc.unchunked(bad) is None


def test_empty_table(spark, pages):
    assert warc.archive_round_trip(pages.limit(0)).collect() == []
