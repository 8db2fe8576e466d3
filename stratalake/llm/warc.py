"""WARC archives: written with revisit and continuation records, and put together again.

Records go through Spark's text writer, whose row separator is the two line ends that close a WARC record, so archives
appear only when their task is committed, in any store that Spark writes to. A reader parses files apart from each
other; segments of a record meet by the id of the record they continue, wherever they were written.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import shared_folder, written

#: Payloads of at least so many bytes are kept once.
LEAST_REVISIT = 1000
#: Bytes of a record's block; longer ones are continued in further records.
SEGMENT = 16 << 10
#: Payloads above one chunk are sent in chunks.
CHUNK = 4096
RECORDS_PER_FILE = 2048
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of chunked framing (extensions and trailers are skipped); nothing if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if len(out[-1]) < size or body[at : at + 2] != b"\r\n":
            return None
        at += 2


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + END).encode()


def records(number: int, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, segment: int) -> Iterator[bytes]:
    """The records of one page, without the line ends that close each. ``number`` is unique in the archive."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = f"<urn:page:{'' if page_id is None else page_id}:{number}>"
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    plain = b"%bContent-Length: %d\r\n\r\n" % (status, len(payload))
    if refers_to is not None:
        block = plain
    elif len(payload) > CHUNK:
        block = status + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    else:
        block = plain + payload
    uri = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    for k, part in enumerate(parts, 1):
        first, several = k == 1, len(parts) > 1
        fields = [
            ("WARC-Type", "continuation" if not first else "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", name if first else f"{name[:-1]}:{k}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", uri),
            ("Content-Type", "application/http; msgtype=response" if first else None),
            ("WARC-Payload-Digest", digest if first else None),
            ("WARC-Profile", PROFILE if first and refers_to is not None else None),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>" if first and refers_to is not None else None),
            ("WARC-Segment-Number", k if several else None),
            ("WARC-Segment-Origin-ID", None if first else name),
            ("WARC-Segment-Total-Length", len(block) if several and k == len(parts) else None),
            ("Content-Length", len(part)),
        ]
        yield _header(fields) + part


def _write(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            columns = (batch.column(c).to_pylist() for c in ("number", "page_id", "url", "html", "refers_to"))
            for number, page_id, url, html, refers_to in zip(*columns, strict=True):
                new = list(records(number, page_id, url, html.encode(), refers_to, segment))
                out += new
                size += sum(map(len, new))
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return run


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, least: int = LEAST_REVISIT) -> None:
    """Write the pages (page_id, url, html) below ``path``. Of equal payloads of ``least`` bytes the largest page_id's
    is kept as response and others refer to it; rows that repeat that id are responses too. A null html is empty. A row
    without page_id is never referred to while another has an id, and refers to nothing where none has."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"))
    payload = F.when(F.octet_length("html") >= least, F.sha2("html", 256))
    rows = rows.withColumn("payload", payload)
    shared = rows.filter("payload IS NOT NULL").groupBy("payload").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    shared = written(shared.filter("n > 1").select("payload", "largest"))
    rows = rows.join(shared, "payload", "left")
    refers = F.when(~F.col("largest").eqNullSafe(F.col("page_id")), F.col("largest"))
    rows = rows.select("page_id", "url", "html", refers.alias("refers_to"), F.monotonically_increasing_id().alias("number"))
    out = rows.mapInArrow(_write(segment), "record binary").select(F.col("record").cast("string"))
    out.write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(data: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    raw, at = bytes(data), 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        if end < 0 or not raw.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = raw[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        block = end + 4
        at = block + int(fields["content-length"])
        yield fields, data[block:at]
        at += len(END)


RAW = "id string, origin string, segment int, total long, type string, uri string, refers string, digest string, block binary"
_KINDS = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
_NAMES = ["id", "origin", "segment", "total", "type", "uri", "refers", "digest", "block"]


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(_KINDS)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    for batch in batches:
        for content in batch.column("content"):
            rows: list[tuple] = []
            size = 0
            for f, block in parse(memoryview(content.as_buffer())):
                rows.append(
                    (
                        f.get("warc-record-id"), f.get("warc-segment-origin-id"), number(f.get("warc-segment-number")),
                        number(f.get("warc-segment-total-length")), f.get("warc-type"), f.get("warc-target-uri"),
                        f.get("warc-refers-to"), f.get("warc-payload-digest"), bytes(block),
                    )
                )
                size += len(block)
                if size > 8 << 20:
                    yield flush(rows)
                    rows, size = [], 0
            yield flush(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, as it is stored."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_parse_files, RAW)


def reassembled(found: DataFrame) -> DataFrame:
    """Records with their whole blocks: id, type, uri, refers, digest, block, complete.

    Segments are gathered by the id of their first record and ordered by number. A record is complete if its numbers
    run from 1 without a gap or a repeat and its bytes are as many as the last segment says; if not, it is kept with
    what there is. Continuations without a first record have no type.
    """
    whole = found.filter("segment IS NULL").select(
        "id", "type", "uri", "refers", "digest", "block", F.lit(True).alias("complete")
    )
    parts = found.filter("segment IS NOT NULL").withColumn("of", F.coalesce("origin", "id"))
    first = {c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("type", "uri", "refers", "digest")}
    ordered = F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts")
    joined = parts.groupBy(F.col("of").alias("id")).agg(*first.values(), F.max("total").alias("total"), ordered)
    # Binary arrays cannot be joined; strings hold any bytes here.
    block = F.expr("cast(array_join(transform(parts, p -> cast(p.block AS string)), '') AS binary)")
    joined = joined.withColumn("block", block)
    in_order = F.expr("forall(transform(parts, (p, i) -> p.segment = i + 1), x -> x)")
    complete = in_order & (F.octet_length("block") == F.col("total"))
    return whole.unionByName(joined.select("id", "type", "uri", "refers", "digest", "block", F.coalesce(complete, F.lit(False)).alias("complete")))


PAGE = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, complete boolean"


def _page_number(name: str | None) -> int | None:
    if name is None:
        return None
    digits = name.removeprefix("<urn:page:").rstrip(">").split(":")[0]
    return int(digits) if digits else None


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_())
    names = [c.split()[0] for c in PAGE.split(", ")]
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("id", "type", "uri", "refers", "digest", "block", "complete"))
        for name, kind, uri, refers, digest, block, complete in zip(*columns, strict=True):
            head, _, body = block.partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
            stated = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None
            if kind == "revisit":
                size, payload, computed = int(fields[b"content-length"]), None, stated
            else:
                payload = unchunked(body) if fields.get(b"transfer-encoding", b"").lower() == b"chunked" else body
                size = None if payload is None else len(payload)
                computed = None if payload is None else hashlib.sha1(payload).hexdigest()
            sound = complete and computed is not None and computed == stated
            rows.append((_page_number(name), uri, kind, _page_number(refers), payload, size, computed, sound))
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives below ``path``: page_id, url, record_type, refers_to, payload, payload_bytes,
    payload_digest (SHA-1 in hex), complete.

    Segments are joined and chunked framing is taken off. A revisit has no payload; its size and digest are those that
    it states for the page it refers to. ``complete`` says that all segments, the framing and the digest are right.
    """
    return reassembled(read_records(spark, path)).mapInArrow(_decode, PAGE)


def archive_round_trip(pages: DataFrame, segment: int = SEGMENT, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` written as archives to a shared folder, and what is read back. An empty table gives no pages; columns
    other than page_id, url and html are not read; rows that repeat are all written."""
    path = shared_folder(pages.sparkSession)
    write_archives(pages, path, segment, least)
    return read_pages(pages.sparkSession, path)
