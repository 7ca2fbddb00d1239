"""WARC archives written and read as chunked record tables.

Writing: a row becomes one record, and a payload over the chunk size becomes a
record of the standard's segmented form: a first segment and continuation
records. Each segment is one row for Spark's text writer, so the archive goes
through whatever file system Spark writes to.

Reading: archives are gzip files, which Spark reads from their start in one
task each, row by row. A small state machine turns the rows into a chunk
table: one row per record and chunk number, each with the running SHA-1 of the
payload up to and with it. A record is never held whole: memory is one chunk
and the longest stretch without a line feed, which in archives written here is
at most a chunk.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.llm.tables import stored

CHUNK_BYTES = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
CHUNKS = "file string, record_no bigint, record_id string, chunk bigint, record_type string, target_uri string, refers_to string, declared_digest string, n_bytes bigint, payload_end bigint, payload binary, sha1 string, last boolean"


def base32(digest: bytes) -> str:
    """Upper-case base32, as WARC headers carry digests."""
    return base64.b32encode(digest).decode()


def mark_revisits(rows: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """``rows`` with ``_sha1`` (hex) and ``_refers_to``: the largest id with the same payload, null for itself.

    Payloads under ``min_bytes`` are never revisits. Null ids are smaller than
    all others; a payload that only null ids have is a response each time.
    Digests are counted with map-side combining and come back by a join that
    adaptive execution splits, so one payload may be a third of all rows.
    """
    sized = rows.withColumn("_sha1", F.sha1(F.col(payload_col))).withColumn("_len", F.octet_length(F.col(payload_col)))
    newest = stored(sized.where(F.col("_len") >= min_bytes).groupBy("_sha1", "_len").agg(F.max(id_col).alias("_newest")), "newest")
    joined = sized.join(newest, ["_sha1", "_len"], "left")
    itself = F.col(id_col).eqNullSafe(F.col("_newest"))
    return joined.withColumn("_refers_to", F.when(~itself, F.col("_newest"))).drop("_newest", "_len")


def _headers(kind: str, record: str, uri: str | None, length: int, extra: list[str]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + "".join(c for c in uri if c not in "\r\n"))
    lines += [*extra, f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record_segments(record: str, uri: str | None, payload: bytes, refers_to: str | None, chunk_bytes: int) -> Iterator[bytes]:
    """The record's segments without their last line feed, which the writer adds."""
    digest = f"WARC-Payload-Digest: sha1:{base32(hashlib.sha1(payload).digest())}"
    if refers_to is not None:
        extra = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {refers_to}", digest, "Content-Type: application/http; msgtype=response"]
        yield _headers("revisit", record, uri, 0, extra) + b"\r\n\r"
        return
    http = _HTTP % len(payload)
    extra = [digest, "Content-Type: application/http; msgtype=response"]
    if len(payload) <= chunk_bytes:
        yield _headers("response", record, uri, len(http) + len(payload), extra) + http + payload + b"\r\n\r"
        return
    for n, at in enumerate(range(0, len(payload), chunk_bytes), 1):
        part = payload[at : at + chunk_bytes]
        segment = [f"WARC-Segment-Number: {n}"]
        if n == 1:
            yield _headers("response", record, uri, len(http) + len(part), [*extra, *segment]) + http + part + b"\r\n\r"
            continue
        segment.append(f"WARC-Segment-Origin-ID: {record}")
        if at + chunk_bytes >= len(payload):
            segment.append(f"WARC-Segment-Total-Length: {len(http) + len(payload)}")
        own = f"{record[:-1]}#{n}>"
        yield _headers("continuation", own, uri, len(part), segment) + part + b"\r\n\r"


def write_warc(rows: DataFrame, path: str, record_col: str, uri_col: str, payload_col: str, refers_col: str, chunk_bytes: int = CHUNK_BYTES) -> str:
    """Writes one record per row: a response, or a revisit where ``refers_col`` is set.

    ``record_col`` and ``refers_col`` are WARC record ids (``<urn:...>``). A
    null payload is empty. A null URI is left out of the headers.
    """
    used = rows.select(F.col(record_col).alias("r"), F.col(uri_col).alias("u"), F.coalesce(F.col(payload_col), F.lit(b"")).alias("p"), F.col(refers_col).alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for r, u, p, f in zip(*(batch[n] for n in "rupf"), strict=True):
                for segment in record_segments(r.as_py(), u.as_py(), p.as_py(), f.as_py(), chunk_bytes):
                    out.append(segment)
                    size += len(segment)
                    if size >= 8 * chunk_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = used.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", "\n").option("compression", "gzip").text(path)
    return path


class RecordReader:
    """Turns the lines of one archive into chunk rows, in order."""

    def __init__(self, file: str, chunk_bytes: int):
        self.file, self.chunk_bytes = file, chunk_bytes
        self.state, self.head, self.left = "start", {}, 0
        self.http = False
        self.held = bytearray()
        self.origin: str | None = None
        self.sha, self.chunk, self.bytes, self.number = hashlib.sha1(), 0, 0, -1

    def line(self, line: bytes) -> Iterator[tuple]:
        """``line`` without its line feed."""
        if self.state == "start":
            if line.startswith(b"WARC/"):
                self.state, self.head = "head", {}
            elif line.strip():
                raise ValueError(f"{self.file}: no WARC record begins at {line[:80]!r}")
        elif self.state == "head":
            text = line.rstrip(b"\r")
            if text:
                name, _, value = text.decode("utf-8", "replace").partition(":")
                self.head[name.strip().lower()] = value.strip()
            else:
                self._begin()
                if not self.left:
                    yield from self._end()
        else:
            yield from self._block(line + b"\n")

    def _begin(self) -> None:
        head = self.head
        kind = head.get("warc-type", "")
        self.left = int(head.get("content-length", "0"))
        self.http = kind == "response" and "msgtype=response" in head.get("content-type", "")
        if kind != "continuation" or head.get("warc-segment-origin-id") != self.origin:
            self.origin = head.get("warc-segment-origin-id") or head.get("warc-record-id")
            self.sha, self.chunk, self.bytes = hashlib.sha1(), 0, 0
            self.number += 1
            self.kind, self.first = kind, head
        self.state = "block"

    def _block(self, data: bytes) -> Iterator[tuple]:
        inside, self.left = data[: self.left], max(0, self.left - len(data))
        if self.http:
            if inside in (b"\r\n", b"\n"):
                self.http = False
        else:
            self.held += inside
            while len(self.held) > self.chunk_bytes:
                yield self._row(bytes(self.held[: self.chunk_bytes]), False)
                del self.held[: self.chunk_bytes]
        if not self.left:
            yield from self._end()

    def _end(self) -> Iterator[tuple]:
        self.http = False
        more = "warc-segment-number" in self.head and "warc-segment-total-length" not in self.head
        yield self._row(bytes(self.held), not more)
        self.held.clear()
        self.state = "start"

    def _row(self, part: bytes, last: bool) -> tuple:
        self.sha.update(part)
        self.chunk += 1
        self.bytes += len(part)
        head = self.first
        declared = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return (self.file, self.number, self.origin, self.chunk - 1, self.kind, head.get("warc-target-uri"), head.get("warc-refers-to"), declared, len(part), self.bytes, part, base32(self.sha.digest()), last)

    def finish(self) -> None:
        if self.state != "start":
            raise ValueError(f"{self.file}: the last record is cut off")


def read_warc(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, payloads: bool = True) -> DataFrame:
    """The chunk table of all ``*.gz`` archives in ``path``.

    Columns: ``file``, ``record_no`` (from 0 in each file), ``record_id`` (of
    the first segment), ``chunk`` (from 0), ``record_type``, ``target_uri``, ``refers_to``, ``declared_digest``,
    ``n_bytes``, ``payload_end`` (bytes up to and with this chunk), ``payload``
    (null unless ``payloads``), ``sha1`` (base32, of those bytes), ``last``. A record without payload is
    one row of 0 bytes. A folder without archives gives no rows; text between
    records and a record cut off at the end of a file raise ``ValueError``.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    kinds = pa.schema([("file", pa.string()), ("record_no", pa.int64()), ("record_id", pa.string()), ("chunk", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("declared_digest", pa.string()), ("n_bytes", pa.int64()), ("payload_end", pa.int64()), ("payload", pa.binary()), ("sha1", pa.string()), ("last", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: RecordReader | None = None
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

        for batch in batches:
            files, values = batch["file"], batch["line"]
            for i in range(len(batch)):
                file = files[i].as_py()
                if reader is None or reader.file != file:
                    if reader is not None:
                        reader.finish()
                    reader = RecordReader(file, chunk_bytes)
                for row in reader.line(values[i].as_py()):
                    rows.append(row if payloads else (*row[:10], None, *row[11:]))
                    size += row[8] if payloads else 0
                    if size >= 8 * chunk_bytes or len(rows) >= 5000:
                        yield flush()
                        rows.clear()
                        size = 0
        if reader is not None:
            reader.finish()
        yield flush()

    return lines.mapInArrow(run, CHUNKS)


def resolve_revisits(chunks: DataFrame) -> DataFrame:
    """One row per record: ``record_id``, ``record_type``, ``refers_to``, ``payload_bytes``, ``payload_digest``.

    The last chunk of a record carries its length and digest. A revisit takes
    both from the response that it refers to and whose digest it declares;
    they are null if the archives lack that response. The last chunks' rows are
    stored, so that the archives are parsed once, and so are the responses: a
    page that many others repeat is a hot key, which only a join of two plain
    shuffles splits.
    """
    records = stored(chunks.where("last").select("record_id", "record_type", "refers_to", "declared_digest", "payload_end", "sha1"), "records")
    revisit = F.col("record_type") == "revisit"
    responses = stored(records.where(~revisit).select(F.col("record_id").alias("_r"), F.col("sha1").alias("_s"), F.col("payload_end").alias("_n")).distinct(), "responses")
    found = records.where(revisit).join(responses, (F.col("refers_to") == F.col("_r")) & (F.col("declared_digest") == F.col("_s")), "left")
    columns = ["record_id", "record_type", "refers_to"]
    return found.select(*columns, F.col("_n").alias("payload_bytes"), F.col("_s").alias("payload_digest")).unionByName(
        records.where(~revisit).select(*columns, F.col("payload_end").alias("payload_bytes"), F.col("sha1").alias("payload_digest"))
    )


def record_name(id_col: str) -> Column:
    """``<urn:almenara:record:ID>``; a null id is written as ``null``."""
    return F.when(F.col(id_col).isNull(), F.lit("<urn:almenara:record:null>")).otherwise(F.concat(F.lit("<urn:almenara:record:"), F.col(id_col).cast("string"), F.lit(">")))


def id_of(record: Column) -> Column:
    """The id inside a record's name; null for a null id."""
    return F.nullif(F.regexp_extract(record, r"^<urn:almenara:record:(.*)>$", 1), F.lit("null"))
