"""Web archives: records in segments, written and put together again.

The writer makes one record for each page. A payload is sent in chunked transfer framing;
a block above the segment limit is cut into a first record and continuation records. Of
pages with equal payloads one is a response, the others are revisit records that refer to
it. Files are uncompressed WARC 1.1, written by Spark's text sink with the record end as
line end; the sink and the reader use Spark's own file systems.

The reader takes any WARC file, whole or gzip-compressed by record: it groups
continuation records by origin identifier, orders them by segment number, verifies
numbers and total length, and decodes the transfer framing.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
import gzip
import hashlib
import io
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.common import strings_of, texts_of
from gleanery.session import shared_dir, written

RECORD_END = "\r\n\r\n"
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 8 * 1024
RECORDS_PER_FILE = 2048
DATE = "2020-01-01T00:00:00Z"  # the pages carry none
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def framed(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes:
    """The payload inside chunked transfer framing; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk has another length than stated")
        out.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One WARC record without its end."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:unknown")


def records_of(page: dict, name: str, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page. ``name`` makes identifiers differ between repeated rows.

    ``refers_name`` and ``refers_url`` are those of the page that a revisit refers to.
    """
    payload, refers = page["payload"], page["refers_to"]
    own = "" if page["page_id"] is None else page["page_id"]
    uri = _uri(page["url"])
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{page['digest']}"), ("Content-Type", "application/http;msgtype=response")]
    origin = f"<urn:page:{own}:{name}>"
    if page["is_revisit"]:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", origin), ("WARC-Profile", IDENTICAL), ("WARC-Refers-To", f"<urn:page:{refers}:{page['refers_name']}>"), ("WARC-Refers-To-Target-URI", _uri(page["refers_url"])), ("WARC-Refers-To-Date", DATE), *common], block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + framed(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", origin), *common]
    if len(parts) > 1:
        first.append(("WARC-Segment-Number", 1))
    yield record(first, parts[0])
    for i, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{own}:{name}:{i}>"), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", i)]
        if i == len(parts):
            more.append(("WARC-Segment-Total-Length", len(block)))
        yield record(more, part)


def originals(keyed: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``key``, largest page_id and the ``name`` and url of one row that has it, of payloads of at least ``min_bytes`` that several rows have.

    Counts and maxima are combined before the shuffle, so a payload that a third of the
    rows share is one row from each task.
    """
    seen = keyed.filter(F.octet_length("payload") >= min_bytes)
    # of rows with the largest id, that of the first name; a null id is below all others
    last = F.max(F.struct("page_id", (-F.col("name")).alias("first"), "url")).alias("last")
    groups = seen.groupBy("key").agg(last, F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("last.page_id").isNotNull())
    return groups.select("key", F.col("last.page_id").alias("original"), (-F.col("last.first")).alias("refers_name"), F.col("last.url").alias("refers_url"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record or chain of segments for each row.

    A null html is an empty payload, a null url a placeholder, a null page_id stays null.
    Of rows with equal payloads those with the largest page_id are responses (several,
    if that id is repeated), the others revisits; where all ids of a group are null,
    all are responses. Other columns are not looked at. Rows are numbered where they lie, twice, so
    ``pages`` should be a stored table, which gives its rows in the same order each time.
    """
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    keyed = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"), F.sha1(html).alias("key"), F.monotonically_increasing_id().alias("name"))
    joined = keyed.join(written(originals(keyed, min_bytes), "warc-originals"), "key", "left")
    _written_records(joined, segment_bytes).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _written_records(joined: DataFrame, segment_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[bytes] = []
            others = zip(b.column("page_id").to_pylist(), strings_of(b, "url"), texts_of(b, "payload"), b.column("original").to_pylist(), b.column("name").to_pylist(), b.column("refers_name").to_pylist(), strings_of(b, "refers_url"), strict=True)
            for page_id, url, payload, original, name, refers_name, refers_url in others:
                revisit = original is not None and page_id != original
                page = {"page_id": page_id, "url": url, "payload": payload, "refers_to": original, "refers_name": refers_name, "refers_url": refers_url, "is_revisit": revisit, "digest": digest(payload)}
                out += records_of(page, str(name), segment_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows = joined.select("page_id", "url", "payload", "original", "name", "refers_name", "refers_url").mapInArrow(run, "record binary")
    return rows.select(F.col("record").cast("string").alias("value"))


def parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(size := int(headers["content-length"]))
        if len(block) != size:
            raise ValueError("a block is shorter than stated")
        yield headers, block


SEGMENTS = "kind string, origin string, number int, total bigint, uri string, digest string, refers string, block binary"


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    for b in batches:
        for content in b.column("content"):
            data = content.as_py()
            stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
            rows, held = [], 0
            for h, block in parsed(stream):
                if h["warc-type"] not in ("response", "revisit", "continuation"):
                    continue
                total = h.get("warc-segment-total-length")
                rows.append((h["warc-type"], h.get("warc-segment-origin-id", h["warc-record-id"]), int(h.get("warc-segment-number", 1 if h["warc-type"] == "continuation" else 0)), None if total is None else int(total),
                             h.get("warc-target-uri"), h.get("warc-payload-digest"), h.get("warc-refers-to"), block))
                held += len(block)
                if held > 4 << 20:  # hand on a few megabytes at a time
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The response, revisit and continuation records of all archives below ``path``.

    ``number`` is 0 for a record that is not segmented. A file is read by one task.
    """
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse_files, SEGMENTS)


def reassembled(segments: DataFrame) -> DataFrame:
    """Whole records: ``kind``, ``origin``, ``uri``, ``digest``, ``refers``, ``block``, ``complete``.

    Records that are not segmented pass as they are. Segments are grouped by origin and
    put together by number; ``complete`` says that numbers run from 1 without gap or
    repetition, that the last states a total, and that lengths add up to it. A chain's
    size is that of one record, so a group is bounded by the largest record.
    """
    alone = segments.filter("number = 0").select("kind", "origin", "uri", "digest", "refers", "block", F.lit(True).alias("complete"))
    chains = segments.filter("number > 0").groupBy("origin").agg(
        F.max(F.when(F.col("kind") != "continuation", F.col("kind"))).alias("kind"),
        F.max("digest").alias("digest"), F.max("refers").alias("refers"), F.max("uri").alias("uri"), F.max("total").alias("total"), F.count("*").alias("n"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
    )
    numbers = F.transform("parts", lambda p: p["number"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # one chain at a time: its blocks are copied once
                whole = b"".join(p.as_py() for p in b.column("parts")[i].values.field("block"))
                one = b.slice(i, 1).drop_columns(["parts"])
                yield one.append_column("block", pa.array([whole], pa.binary()))

    chains = chains.withColumn("numbers", numbers)
    plain = [f for f in chains.schema if f.name != "parts"]
    chains = chains.select(*[f.name for f in plain], "parts").mapInArrow(joined, T.StructType([*plain, T.StructField("block", T.BinaryType())]))
    chains = chains.withColumn(
        "complete", F.col("kind").isNotNull() & (F.col("numbers") == F.sequence(F.lit(1), F.col("n").cast("int"))) & F.coalesce(F.col("total") == F.octet_length("block"), F.lit(False))
    )
    return alone.unionByName(chains.select("kind", "origin", "uri", "digest", "refers", "block", "complete"))


PAYLOADS = "page_id bigint, kind string, uri string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string, intact boolean"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = re.compile(r"<urn:page:(-?\d+)[:>]")
    schema = pa.schema([("page_id", pa.int64()), ("kind", pa.string()), ("uri", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_())])
    for b in batches:
        rows = []
        for r in b.to_pylist():
            head, _, body = r["block"].partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
            stated = (r["digest"] or "").removeprefix("sha1:")
            page, refers = number.match(r["origin"]), number.match(r["refers"] or "")
            if r["kind"] == "revisit":
                payload, size, found, intact = None, int(fields.get(b"content-length", b"0")), stated, r["complete"]
            else:
                try:
                    payload = unframed(body) if fields.get(b"transfer-encoding", b"").lower() == b"chunked" else body
                    intact = r["complete"]
                except ValueError:
                    payload, intact = body, False
                size, found = len(payload), digest(payload)
                intact = intact and stated in ("", found)
            rows.append({"page_id": int(page[1]) if page else None, "kind": r["kind"], "uri": r["uri"], "refers_to": int(refers[1]) if refers else None, "payload": payload, "payload_bytes": size, "payload_digest": found, "intact": intact})
        yield pa.RecordBatch.from_pylist(rows, schema)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payloads of all archives below ``path``, with the transfer framing taken off.

    ``intact`` is false for a chain that is incomplete, framing that is broken or a
    payload that its stated digest does not fit. A revisit has no payload of its own;
    its size is that in the HTTP header it keeps, its digest the stated one.
    """
    return reassembled(read_segments(spark, path)).mapInArrow(_decode, PAYLOADS)


def round_trip(pages: DataFrame, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the pages to archives in the shared folder and read these back."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes, segment_bytes)
    return read_payloads(pages.sparkSession, path)
