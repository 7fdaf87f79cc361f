import gzip
import hashlib

import pytest
from llm_helpers import SF
from pyspark.sql import functions as F

from chromasea.llm import warc
from chromasea.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


def expected(rows):
    out, groups = [], {}
    for key, _, html in rows:
        data = (html or "").encode()
        if key is not None and len(data) >= 1000:
            groups[data] = max(key, groups.get(data, key))
    for key, _, html in rows:
        data = (html or "").encode()
        first = groups.get(data) if key is not None else None
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if first not in (None, key) else "response", first if first != key else None))
    return sorted(out, key=str)


def read(df):
    return sorted(((r.record_key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip(spark):
    big = "é" * 600
    rows = [(1, "http://a/ü\r\nX: y", big), (2, None, big), (3, "http://b", big + "x"), (4, "http://c", None), (5, "http://d", "tiny"), (6, "http://e", "tiny"),
            (None, "http://n", big), (2, "http://again", big), (7, "http://f", "\r\n\r\nWARC/1.1\r\n" * 100)]
    df = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit("clash")).withColumn("record_type", F.lit(1))
    archives = warc.deduplicated_archives(df)
    assert read(warc.read_archives(archives)) == expected(rows)
    payloads = {(r.record_key, bytes(r.payload)) for r in warc.read_archives(archives, with_payload=True).collect() if r.payload is not None}
    assert (2, big.encode()) in payloads and (1, big.encode()) not in payloads and (7, rows[-1][2].encode()) in payloads


def test_every_record_is_a_gzip_member_with_headers(spark):
    path = warc.deduplicated_archives(spark.createDataFrame([(1, "u", "p" * 2000), (2, "u", "p" * 2000)], PAGES).coalesce(1)).first().path
    text = gzip.open(path.removeprefix("file://"), "rt", newline="").read()
    assert text.count("WARC/1.1\r\n") == 2 and warc.record_urn(2) in text and text.count("p" * 2000) == 1
    assert open(path.removeprefix("file://"), "rb").read().count(b"\x1f\x8b\x08") >= 2


def test_orphans_and_ties(spark):
    headers = spark.createDataFrame([(1, "d", 2000), (1, "d", 2000), (2, "e", 2000), (3, None, 2000), (4, "d", 2001)], "record_key long, payload_digest string, payload_bytes long")
    assert {r.record_type for r in warc.resolve_revisits(headers).collect()} == {"response"}


def test_empty(spark):
    assert warc.read_archives(warc.deduplicated_archives(spark.createDataFrame([], PAGES))).count() == 0


def test_broken_archives_are_refused():
    import io

    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc")))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op1_warc_revisits"](spark, SF).withColumnRenamed("page_id", "record_key")
    assert read(got) == expected(rows)
