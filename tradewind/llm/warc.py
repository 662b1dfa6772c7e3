"""WARC archives with an index (operator 7).

Writing: each task writes one archive into the shared folder, a gzip member per record, and returns for
every record the file, offset, length, URL and payload digest. That index is a table of its own and is
kept as Parquet. A task that is run again writes a file of another name; only files in the index are
ever read.

Reading: the index is filtered first, sorted by file and offset, and neighbouring byte ranges are joined
into one read, up to a size that bounds what a task holds; gaps up to a limit are read over.

Of records with equal payloads of at least ``MIN_PAYLOAD`` bytes the one of the largest id is a response
and the others revisit it; equal means an equal SHA-1. Rows that share that largest id are all responses.
Null ids are smaller than any other; a payload that only has null ids is all responses. Null html is
an empty payload, a null URL is written without target. An empty table gives an empty index. Other columns
are not written.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import column
from tradewind.operators.lineage import written
from tradewind.session import scratch_path

MIN_PAYLOAD = 1000
# One read covers at most so many bytes (or one longer record), and gaps of at most so many.
READ_BYTES, GAP_BYTES = 8 << 20, 64 << 10
# Archive bytes that one task reads.
TASK_BYTES = 16 << 20
INDEX = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("id", pa.int64()), ("url", pa.string()),
    ("digest", pa.string()), ("record_type", pa.string())])
RECORD = pa.schema([
    ("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
# The parts of a record by the format's standard.
VERSION, BREAK = b"WARC/1.1", b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


def _one_line(text: str) -> str:
    return "".join("%{:02X}".format(ord(c)) if c in "\r\n" else c for c in text)


def record(id_: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit with the headers alone."""
    http = HTTP % len(payload)
    body = http + payload if refers_to is None else http
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{id_} {url} {digest}')}>",
        "WARC-Date": date, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(body)),
    }
    if url is not None:
        head["WARC-Target-URI"] = _one_line(url)
    if id_ is not None:
        head["X-Page-ID"] = str(id_)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "X-Refers-To-Page-ID": str(refers_to)}
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in head.items()]]
    return BREAK.join(lines) + BREAK * 2 + body + BREAK * 2


def parse(data: bytes) -> dict:
    """The record's fields; a response's payload is checked against its digest."""
    head, _, rest = data.partition(BREAK * 2)
    version, *lines = head.split(BREAK)
    fields = dict(line.decode().split(": ", 1) for line in lines)
    if version != VERSION:
        raise ValueError(f"not a record: {version[:20]!r}")
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(BREAK * 2)
    size = int(http.rsplit(b"Content-Length: ", 1)[1].split(BREAK)[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": number("X-Refers-To-Page-ID"), "digest": digest, "payload_bytes": size,
            "payload": payload if response else None}


def _members(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, place = _filesystem(path)
        out, offset = None, 0
        for batch in batches:
            rows = []
            for id_, url, html, digest, refers in zip(*(batch.column(c) for c in ("id", "url", "html", "digest", "refers_to"))):
                id_, url, digest, refers = id_.as_py(), url.as_py(), digest.as_py(), refers.as_py()
                member = _members(record(id_, url, html.as_py(), digest, refers, date))
                if out is None:  # a task without rows writes no file
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(place, compression=None)
                out.write(member)
                rows.append((path, offset, len(member), id_, url, digest, "response" if refers is None else "revisit"))
                offset += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)], schema=INDEX)
        if out is not None:
            out.close()
    return write


def write_archives(pages: DataFrame, folder: str | None = None, id_column: str = "page_id", url: str = "url",
                   html: str = "html", min_payload: int = MIN_PAYLOAD, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every row of ``pages`` as a record below ``folder``, a folder all executors share, and return
    the index. ``date`` is the capture time that the records carry."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(column(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(column(id_column).cast("long").alias("id"), column(url).cast("string").alias("url"),
                        payload.alias("html"), F.sha1(payload).alias("digest"))
    # Only digests that occur under more than one id; written, so that Spark knows how few they are.
    largest = written(
        rows.filter(F.octet_length("html") >= min_payload).groupBy("digest")
        .agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND largest IS NOT NULL").drop("n"),
        "payloads")
    revisits = (F.octet_length("html") >= min_payload) & F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest"))
    typed = rows.join(largest, "digest", "left").select(
        "id", "url", "html", "digest", F.when(revisits, F.col("largest")).alias("refers_to"))
    schema = "file string, offset long, length long, id long, url string, digest string, record_type string"
    return written(typed.mapInArrow(_writer(folder, date), schema), "warc-index")


def _ranges(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Runs of index rows, sorted by file and offset, that one read covers."""
    run: list[tuple[str, int, int]] = []
    for file, offset, length in rows:
        if run:
            start, (last, at, size) = run[0][1], run[-1]
            if file != last or offset - at - size > GAP_BYTES or offset + length - start > READ_BYTES:
                yield run
                run = []
        run.append((file, offset, length))
    if run:
        yield run


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    opened, source = None, None
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
        for run in _ranges(rows):
            file, start, _ = run[0]
            if file != opened:
                if source is not None:
                    source.close()
                system, place = _filesystem(file)
                opened, source = file, system.open_input_file(place)
            block = memoryview(source.read_at(run[-1][1] + run[-1][2] - start, start))
            found = [parse(zlib.decompress(block[at - start:at - start + size], 31)) for _, at, size in run]
            if not with_payload:
                for one in found:
                    one["payload"] = None
            yield pa.RecordBatch.from_pylist(found, schema=RECORD)
    if source is not None:
        source.close()


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` (or what is left of it) names, in no particular order. A revisit has
    the size and digest of the payload it refers to, but no payload. ``with_payload=False`` reads and
    checks payloads without returning them. Tasks read some ``TASK_BYTES`` of archives each."""
    schema = "id long, url string, record_type string, refers_to long, digest string, payload_bytes long, payload binary"
    wanted = index.select("file", "offset", "length")
    # Given, because the index that is shuffled is far smaller than the archives that are read by it.
    tasks = math.ceil((wanted.agg(F.sum("length")).first()[0] or 0) / TASK_BYTES)
    return (
        wanted.repartitionByRange(max(1, tasks), "file", "offset")
        .sortWithinPartitions("file", "offset")
        .mapInArrow(lambda batches: _read(batches, with_payload), schema))
