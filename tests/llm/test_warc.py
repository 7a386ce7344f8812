import gzip
import hashlib
import io
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioframe.llm import warc as W


def archive(payloads, members=1):
    raw = [W.record({"WARC-Type": "response", "WARC-Payload-Digest": "sha1:" + hashlib.sha1(p).hexdigest(), "X-Payload-Bytes": str(len(p)), "X-Page-Id": str(i)}, p) for i, p in enumerate(payloads)]
    step = max(1, -(-len(raw) // members))
    return raw, b"".join(gzip.compress(b"".join(raw[i : i + step])) for i in range(0, len(raw), step)) if raw else gzip.compress(b"")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=8), st.integers(1, 3))
def test_normalise_round_trip(payloads, members):
    raw, data = archive(payloads, members)
    out = io.BytesIO()
    index = W.normalise(io.BytesIO(data), out)
    clean = out.getvalue()
    assert len(index) == len(raw)
    for (at, n), want in zip(index, raw, strict=True):
        assert zlib.decompress(clean[at : at + n], 31) == want
        fields, payload, end = W.parse(want)
        assert end == len(want) and int(fields["X-Payload-Bytes"]) == len(payload)
    assert gzip.decompress(clean) == b"".join(raw) if raw else clean == b""


def test_chunks_end_anywhere(monkeypatch):
    raw, data = archive([b"\r\n\r\n" * 50, b"", b"x" * 10_000, b"WARC/1.1\r\n\r\n"])
    for n in (1, 2, 7, 64):
        monkeypatch.setattr(W, "_CHUNK", n)
        assert list(W.records_of_stream(io.BytesIO(data))) == raw


def test_broken_archives():
    _, data = archive([b"abc"])
    with pytest.raises(ValueError, match="inside a record"):
        list(W.records_of_stream(io.BytesIO(gzip.compress(gzip.decompress(data)[:-4]))))
    _, data = archive([b"abc", b"x" * 3000, b"", b"q"] * 10)
    for n in range(1, len(data)):  # every cut is noticed
        with pytest.raises((ValueError, zlib.error)):
            list(W.records_of_stream(io.BytesIO(data[:n])))
    with pytest.raises(ValueError, match="no WARC record"):
        W.parse(b"HTTP/1.1\r\n\r\n")


def test_pages(spark, small):
    big = "é" * 600
    rows = [(1, "u", big), (5, None, big), (3, "u\r\nX: y", big), (9, "u", "short"), (10, "u", "short"), (11, "u", None), (12, "u", ""), (13, "u", "z" * 1000), (13, "u", "z" * 1000), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS record_type")
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.round_trip(pages).collect())
    sha = lambda s: hashlib.sha1((s or "").encode()).hexdigest()
    kind = {1: ("revisit", 5), 3: ("revisit", 5), None: ("revisit", 5)}
    assert got == sorted((i or 0, len((h or "").encode()), sha(h), *kind.get(i, ("response", None))) for i, _, h in rows)
    assert W.round_trip(pages.limit(0)).count() == 0


def test_records_are_counted(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(20)], "page_id long, url string, html string")
    archives = W.stored(W.write_archives(pages.coalesce(1), f"file://{tmp_path}/raw"), "test-archives")
    assert W.normalise_archives(archives, f"file://{tmp_path}/raw", f"file://{tmp_path}/a").agg({"records": "sum"}).head()[0] == 20
    with pytest.raises(Exception, match="records where its writer counted"):
        W.normalise_archives(archives.selectExpr("path", "records + 1 AS records"), f"file://{tmp_path}/raw", f"file://{tmp_path}/b").collect()


def test_large_payloads(spark, monkeypatch):
    rows = [(i, "u", ("y%d " % i) * 2_000_000) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.payload_bytes for r in W.round_trip(pages).collect()} == {i: len(h) for i, _, h in rows}


def test_file_systems():
    assert W.open_filesystem("file:/a/b")[1] == "/a/b" == W.open_filesystem("/a/b")[1]
    with pytest.raises(ValueError, match="no file system"):
        W.open_filesystem("viewfs://x/y")


def test_payloads_come_back(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    back = {r.page_id: bytes(r.payload) for r in W.round_trip(pages, archive_bytes=50_000).where("record_type = 'response'").collect()}
    want = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert all(want[i] == p for i, p in back.items()) and len(set(want.values())) == len(set(back.values()))
