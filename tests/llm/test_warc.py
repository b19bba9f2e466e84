import gzip
import hashlib
import io
import random

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from quarry.llm import warc as W
from quarry.llm.common import scratch


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i % 3}.org/p/{i}", f"<html>{'x' * (i * 37 % 900)} é {i % 20}</html>") for i in range(120)]
    rows += [(500, "http://a/ b\r\nX-Bad: 1", None), (501, None, ""), (502, "u", ""), (None, "n", "only here"),
             (503, "big", "0123456789" * 100_000), (504, "r", "again"), (504, "r", "again")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("size", F.lit(1)).withColumn("member", F.lit("m")).withColumn("sha1", F.lit("s"))


def expected(rows):
    top = {}
    for r in rows:
        k = r["html"] or ""
        if r["page_id"] is not None:
            top[k] = max(top.get(k, r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        raw, t = (r["html"] or "").encode(), top.get(r["html"] or "")
        revisit = t is not None and r["page_id"] != t
        out.append((r["page_id"], len(raw), W.sha1_base32(raw), "revisit" if revisit else "response", t if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [700, 5_000, 8 << 20])
def test_round_trip(pages, split):
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in W.round_trip(pages, split_bytes=split).collect()]
    assert sorted(got, key=str) == expected(pages.collect())


def test_payloads_and_urls_come_back(spark, pages):
    manifest = W.write_archives(pages, scratch(spark, "warc-test"), file_bytes=4_000)
    assert manifest.agg(F.sum("records")).first()[0] == pages.count()
    got = W.read_archives(spark, manifest, 3_000, with_payload=True).where("record_type = 'response'").collect()
    html = {str(r["page_id"]): (r["url"], (r["html"] or "").encode()) for r in pages.collect()}
    for r in got:
        url, raw = html[str(r["record_id"])]
        assert bytes(r["payload"]) == raw and r["target_uri"] == url


def test_files_are_plain_gzip_members(spark, pages):
    row = W.write_archives(pages.limit(3), scratch(spark, "warc-test")).first()
    files, path = fs.FileSystem.from_uri(row["path"])
    text = gzip.GzipFile(fileobj=io.BytesIO(files.open_input_file(path).read())).read()
    assert text.count(b"WARC/1.1\r\n") == row["records"]


def test_least_bytes_and_empty_table(spark, pages):
    rows = W.round_trip(pages, least_bytes=10**9).collect()
    assert {r["record_type"] for r in rows} == {"response"}
    assert W.round_trip(pages.limit(0)).collect() == []


def test_magic_inside_a_record_is_no_record():
    inner = gzip.compress(b"not an archive")
    block = W._http(len(inner)) + inner + b"\x1f\x8b\x08 noise"
    head = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("Content-Type", "application/http")]
    raw = b"".join(W._member(head, block, 0) for _ in range(3))  # stored, so the magic shows
    f = io.BytesIO(raw)
    starts = [r["offset"] for r in W.read_range(f, 0, len(raw))]
    assert len(starts) == 3
    cuts = [r["offset"] for a in range(0, len(raw), 50) for r in W.read_range(f, a, min(a + 50, len(raw)))]
    assert cuts == starts


def test_broken_member_is_an_error():
    raw = W._member([("WARC-Type", "response"), ("Content-Type", "application/http")],
                    W._http(5000) + hashlib.sha256(b"x").digest() * 5000, 6)[:-400]
    with pytest.raises(Exception, match="inside a member"):
        list(W.read_range(io.BytesIO(raw), 0, len(raw)))


@pytest.mark.parametrize("split", [50_000, 8 << 20])
def test_urls_of_any_length_come_back(spark, split):
    noise = random.Random(1).randbytes(900_000).hex()
    rows = [(1, "http://a/", "one"), (2, "data:" + noise, "two"), (3, "http://b/" + " " * 1_200_000, "three"),
            (4, "data:" + noise[::-1], "two"), (5, "http://c/", "five")]
    got = W.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), split_bytes=split)
    assert {r["page_id"]: r["target_uri"] for r in got.collect()} == {i: url for i, url, _ in rows}


def test_a_member_broken_in_its_header_is_an_error():
    uri = random.Random(2).randbytes(900_000).hex()
    raw = W._member([("WARC-Type", "response"), ("WARC-Target-URI", uri)], b"x", 6)[:-100_000]
    with pytest.raises(Exception, match="inside a member"):
        list(W.read_range(io.BytesIO(raw), 0, len(raw)))


@pytest.mark.parametrize("rows", [0, 1, 4])
def test_more_shared_digests_than_may_be_broadcast(pages, rows):
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in W.round_trip(pages, broadcast_rows=rows).collect()]
    assert sorted(got, key=str) == expected(pages.collect())


def test_long_enough_payloads_alone_are_revisits(spark):
    pages = spark.createDataFrame([(i, "u", "x" * (600 if i % 2 else 300)) for i in range(12)],
                                  "page_id long, url string, html string")
    for rows in (0, 1, 100):
        got = W.round_trip(pages, broadcast_rows=rows, least_bytes=500).collect()
        assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got) == [
            (i, "revisit", 11) if i % 2 and i < 11 else (i, "response", None) for i in range(12)]
