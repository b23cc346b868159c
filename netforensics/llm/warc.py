"""WARC archives: writing captures, reading records, and assembling transactions (operator 8).

A capture is written as three records: response (or revisit), request and metadata. The last two
name the first one in WARC-Concurrent-To. Reading yields one row per record; `transactions` joins
the three through that identifier into one nested row per capture.

Payloads that occur before are written as revisit records of the profile "identical payload
digest": among equal payloads of at least `least` bytes the smallest key is the response. Which
one that is comes from an aggregate of digests, so no group of copies meets in one task.

Archives are gzip with one member per record. A task writes its archive under a name of its own
and only names it in its result once it is complete, so what a lost or repeated attempt left
behind is never read. Null payloads count as empty. The identifiers are made from the keys;
rows with a null key get theirs from their digest and place (partition and row) and come back with
an empty capture-key. They are written whole, and no revisit refers to them.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import slices

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 64 << 20
BLOCK = 1 << 20
RECORD = StructType(
    [
        StructField("record_id", StringType()),
        StructField("kind", StringType()),
        StructField("concurrent_to", StringType()),
        StructField("refers_to", StringType()),
        StructField("target_uri", StringType()),
        StructField("date", StringType()),
        StructField("payload_digest", StringType()),
        StructField("payload_bytes", LongType()),
        StructField("fields", StringType()),
        StructField("payload", BinaryType()),
    ]
)


def record_id(key: object, kind: str) -> str:
    """A name-based identifier: a repeated attempt writes the same records."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'capture:{key}:{kind}')}>"


def with_revisits(captures: DataFrame, key: str, payload: str, least: int = 100) -> DataFrame:
    """`captures` with payload_digest, payload_bytes and refers_to (the key of the response; null for responses)."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = captures.withColumn("payload_digest", F.sha2(data, 256)).withColumn("payload_bytes", F.octet_length(data).cast("long"))
    heads = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min(key).alias("_head"), F.count("*").alias("_copies"))
        .where("_copies > 1")
        .select(F.col("payload_digest").alias("_digest"), "_head")
    )
    joined = rows.join(heads, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= least), "left")
    refers = F.when(F.col("_head") != F.col(key), F.col("_head"))
    return joined.withColumn("refers_to", refers).drop("_digest", "_head")


def _record(headers: list[tuple[str, str]], body: bytes) -> bytes:
    head = "".join(f"{n}: {v}\r\n" for n, v in [*headers, ("Content-Length", str(len(body)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n", compresslevel=1, mtime=0)


def _capture(key: object, uri: str, date: str, payload: bytes, digest: str, size: int, refers_to: object, place: int) -> bytes:
    """The three records of a capture."""
    uri = "".join((uri or "").split())
    name = f"null:{digest}:{place}" if key is None else key
    own = record_id(name, "response")
    common = [("WARC-Date", date)] + ([("WARC-Target-URI", uri)] if uri else [])
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", own),
        *common,
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        headers += [("WARC-Refers-To", record_id(refers_to, "response")), ("WARC-Profile", PROFILE)]
    asked = f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode()
    joined = ("WARC-Concurrent-To", own)
    request = [("WARC-Type", "request"), ("WARC-Record-ID", record_id(name, "request")), *common, joined, ("Content-Type", "application/http; msgtype=request")]
    notes = f"capture-key: {'' if key is None else key}\r\nrefers-to-key: {'' if refers_to is None else refers_to}\r\n".encode()
    metadata = [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id(name, "metadata")), *common, joined, ("Content-Type", "application/warc-fields")]
    return _record(headers, http + (payload if refers_to is None else b"")) + _record(request, asked) + _record(metadata, notes)


def write(captures: DataFrame, folder: str, key: str, uri: str, payload: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write archives below `folder` (any file system pyarrow knows); one row per archive: path, records, bytes.

    Evaluating the returned rows writes; collect them once (a few bytes per archive).
    """
    rows = captures.select(
        F.col(key).alias("key"),
        F.col(uri).cast("string").alias("uri"),
        F.when(F.col("refers_to").isNull(), F.col(payload).cast("binary")).alias("payload"),
        "payload_digest",
        "payload_bytes",
        "refers_to",
        F.monotonically_increasing_id().alias("place"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        system.create_dir(base, recursive=True)
        out, done = None, []

        def close() -> None:
            out[0].close()
            done.append((out[1], out[2], out[3]))

        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                data = _capture(row["key"], row["uri"], date, row["payload"] or b"", row["payload_digest"], row["payload_bytes"], row["refers_to"], row["place"])
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out = [system.open_output_stream(path, compression=None), path, 0, 0]
                    out[0].write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)], b"format: WARC File Format 1.1\r\n"))
                out[0].write(data)
                out[2] += 3
                out[3] += len(data)
                if out[3] >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "records": n, "bytes": b} for p, n, b in done],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return rows.mapInArrow(run, "path string, records long, bytes long")


class _Members:
    """A buffered reader over the gzip members of a stream (or over a plain stream), in bounded memory."""

    def __init__(self, stream) -> None:
        self.stream, self.data, self.raw, self.ended = stream, b"", b"", False
        self.raw = stream.read(BLOCK)
        self.zipped = self.raw[:2] == b"\x1f\x8b"
        self.unzip = zlib.decompressobj(31)

    def more(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(BLOCK)
        if not self.raw:
            return False
        if not self.zipped:
            self.data, self.raw = self.data + self.raw, b""
            return True
        self.data += self.unzip.decompress(self.raw)
        self.raw = self.unzip.unused_data
        if self.unzip.eof:
            self.unzip = zlib.decompressobj(31)
        return True

    def line(self) -> bytes | None:
        while b"\n" not in self.data:
            if not self.more():
                return None
        text, _, self.data = self.data.partition(b"\n")
        return text.rstrip(b"\r")

    def read(self, size: int) -> bytes:
        parts, have = [], 0
        while have < size:
            if not self.data and not self.more():
                raise EOFError("a record is cut off")
            part, self.data = self.data[: size - have], self.data[size - have :]
            parts.append(part)
            have += len(part)
        return b"".join(parts)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record."""
    source = _Members(stream)
    while True:
        line = source.line()
        if line is None:
            return
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while line := source.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, source.read(int(headers.get("content-length", "0")))


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    kind = headers.get("warc-type", "")
    row = {
        "record_id": headers.get("warc-record-id"),
        "kind": kind,
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
    }
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        if kind == "response":  # taken from the bytes that were read, not from the header
            row |= {"payload_digest": hashlib.sha256(body).hexdigest(), "payload_bytes": len(body), "payload": body if with_payload else None}
        else:
            size = next((v for n, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if n.lower() == b"content-length"), b"0")
            row |= {"payload_digest": headers.get("warc-payload-digest", "").rpartition(":")[2], "payload_bytes": int(size)}
        row["fields"] = head.decode("utf-8", "replace")
    else:
        row["fields"] = block.decode("utf-8", "replace")
    return row


def read(paths: DataFrame, with_payload: bool = True, column: str = "path") -> DataFrame:
    """One row per record of the archives named in `paths`; archives are streamed, a record is held at a time."""
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(f.name, kinds.get(f.name, pa.string())) for f in RECORD])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                rows, held = [], 0
                with system.open_input_stream(place, compression=None) as stream:
                    for headers, block in records(stream):
                        rows.append(_row(headers, block, with_payload))
                        held += len(block) if with_payload else 200
                        if held > 8 * BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return paths.select(F.col(column).alias("path")).mapInArrow(run, RECORD)


def transactions(rows: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and metadata records.

    Requests and metadata are keyed by what they are concurrent to, the response by its own
    identifier; they meet in one aggregate. Captures without a response are kept with a null one,
    repeated records of a kind are reduced to the smallest by record identifier.
    """
    part = F.struct("record_id", "target_uri", "date", "fields")
    main = F.struct("record_id", "kind", "refers_to", "target_uri", "date", "payload_digest", "payload_bytes", "payload")
    capture = F.when(F.col("kind").isin("response", "revisit"), F.col("record_id")).otherwise(F.col("concurrent_to"))
    return (
        rows.where(F.col("kind").isin("response", "revisit", "request", "metadata"))
        .groupBy(capture.alias("capture_id"))
        .agg(
            F.min(F.when(F.col("kind").isin("response", "revisit"), main)).alias("response"),
            F.min(F.when(F.col("kind") == "request", part)).alias("request"),
            F.min(F.when(F.col("kind") == "metadata", part)).alias("metadata"),
        )
    )


def note(metadata: str, name: str) -> F.Column:
    """A field of the metadata record."""
    return F.nullif(F.regexp_extract(F.col(f"{metadata}.fields"), rf"(?m)^{name}: ([^\r\n]*)", 1), F.lit(""))


