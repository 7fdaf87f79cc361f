"""WARC archives: write, read back, and resolve records with equal payloads to revisits.

Only headers (id, digest, length) are shuffled to decide who is the original; revisit headers are
then joined to it, and archives are written with fresh headers. Every record is a gzip
member of its own, as is usual. The archives' table (Parquet) names the files that count: a task
that ran twice, or was lost, leaves a file that no row names.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.llm.shared import file_system, materialise, shared_folder, task_file

LEAST_BYTES = 1000
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of URLs in RFC 4122
# Fixed values of the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "record_key long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def resolve_revisits(headers: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Add record_type and refers_to to headers (record_key, payload_digest, payload_bytes, ...).

    Of records with one digest and length of at least `least` bytes, the largest record_key is the
    response; the others revisit it. Shorter ones, and those without a key or digest, are all
    responses. Rows that share the largest key are all responses. Digests of one record are not
    joined at all; those of many are aggregated before the shuffle, and the join's hot side can be
    split, as each digest has one original.
    """
    known = F.col("record_key").isNotNull() & F.col("payload_digest").isNotNull() & (F.col("payload_bytes") >= least)
    originals = (
        headers.where(known).groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"))
        .agg(F.max("record_key").alias("_original"), F.min("record_key").alias("_least"))
        .where("_original <> _least").select(F.concat_ws("/", "_digest", "_bytes").alias("_group"), "_original")
    )
    # A row outside the join gets a group of its own, so that they don't all meet in one task.
    own = F.concat_ws("/", F.lit("-"), F.col("record_key").cast("string"), F.col("payload_digest"))
    grouped = headers.withColumn("_group", F.when(known, F.concat_ws("/", "payload_digest", "payload_bytes")).otherwise(own))
    revisit = F.col("_original").isNotNull() & (F.col("_original") != F.col("record_key"))
    return grouped.join(originals, "_group", "left").select(
        *headers.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_original")).alias("refers_to"),
    )


def payload_columns(payload: str) -> tuple[Column, Column]:
    """SHA-1 (lower-case hex) and length in bytes of a text column as UTF-8; a null is empty."""
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    return F.sha1(data).alias("payload_digest"), F.octet_length(data).cast("long").alias("payload_bytes")


def record_urn(key: int | None) -> str:
    """The record id of a key: the same key always has the same one."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'record:{key}')}>"


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def build_record(key: int | None, url: str | None, kind: str, digest: str, size: int, refers_to: int | None, payload: bytes, date: str) -> bytes:
    """One record with fresh headers; a revisit has no payload and names its original.

    The target is percent-encoded, so that no text can break the header.
    """
    body = payload if kind == "response" else b""
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_urn(key)), ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if kind == "revisit" else None),
        ("WARC-Refers-To", record_urn(refers_to) if kind == "revisit" else None),
        # Extension fields: keys as numbers, and the length of the payload that a revisit leaves out.
        ("Record-Key", key), ("Refers-To-Key", refers_to if kind == "revisit" else None), ("Payload-Length", size),
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(body)),
    ]
    return _header(fields) + body + b"\r\n\r\n"


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and bodies of a decompressed WARC stream, one record at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        body = stream.read(size)
        if len(body) != size:
            raise ValueError("a record is cut off")
        yield fields, body


def write_archives(records: DataFrame, folder: str | None = None, date: datetime | None = None) -> DataFrame:
    """Write records (record_key, url, payload, payload_digest, payload_bytes, record_type, refers_to), an archive per task.

    Returns the archives' table: path, records, bytes.
    """
    folder = folder or shared_folder(records.sparkSession, "archives")
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches):
        out, n = None, 0
        for batch in batches:
            if out is None and batch.num_rows:
                name = task_file(folder, ".warc.gz")
                system, path = file_system(name)
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(path, compression=None)
            for i in range(0, batch.num_rows, 100):
                for r in batch.slice(i, 100).to_pylist():
                    payload = (r["payload"] or "").encode() if r["record_type"] == "response" else b""
                    record = build_record(r["record_key"], r["url"], r["record_type"], r["payload_digest"], r["payload_bytes"], r["refers_to"], payload, stamp)
                    out.write(gzip.compress(record, 6, mtime=0))
                    n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": pa.array([name]), "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    columns = ("record_key", "url", "payload", "payload_digest", "payload_bytes", "record_type", "refers_to")
    written = records.select(*columns).mapInArrow(write, "path string, records long, bytes long")
    return materialise(written, "archive-table")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Read archives back, a task per few files, a record at a time.

    The digest and length of a response are computed from its payload anew and must agree with
    its header. `payload` is null for revisits, and null throughout unless asked for.
    """
    n = max(1, archives.count())

    def read(batches):
        for batch in batches:
            for name in batch.column("path").to_pylist():
                rows = []
                system, path = file_system(name)
                with system.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for h, body in parse_records(stream):
                        digest, size = h["warc-payload-digest"].removeprefix("sha1:"), int(h["payload-length"])
                        if h["warc-type"] == "response" and (digest, size) != (hashlib.sha1(body).hexdigest(), len(body)):
                            raise ValueError(f"{name}: a payload differs from its header")
                        key, other = h.get("record-key"), h.get("refers-to-key")
                        rows.append((
                            int(key) if key else None, h.get("warc-target-uri"), h["warc-type"], digest, size, int(other) if other else None,
                            body if with_payload and h["warc-type"] == "response" else None,
                        ))
                        if len(rows) == 200:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    return archives.select("path").repartition(n, "path").mapInArrow(read, RECORDS)


def _rows(rows: list) -> pa.RecordBatch:
    names = ("record_key", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows))})


def deduplicated_archives(pages: DataFrame, least: int = LEAST_BYTES, folder: str | None = None) -> DataFrame:
    """Archives of pages (page_id, url, html): repeated payloads are written once and revisited otherwise.

    Null html is an empty payload, null urls have no target, null page_ids are responses. Other
    columns are ignored.
    """
    digest, size = payload_columns("html")
    records = pages.select(F.col("page_id").cast("long").alias("record_key"), "url", F.col("html").alias("payload"), digest, size)
    return write_archives(resolve_revisits(records, least), folder)
