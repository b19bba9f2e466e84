"""WARC archives: a deduplicating writer and a splittable reader.

Writer: one gzip member per record.  Pages with equal payloads (by SHA-1)
share one ``response`` record, that of the largest page id; the others become
``revisit`` records without payload.  Payloads that only one page has need no
decision.  Of those that several share, a table of digest and largest id is
written and, as far as a broadcast may hold it, most shared first, brought to
the pages: their records are decided before they are compressed, and no payload
moves.  Only pages of the digests beyond that are joined by a shuffle, which
carries compressed bytes, and whose hot digests Spark can split.
Each task writes files of its own name; only files that a finished task has
returned are in the manifest, so a lost or repeated task leaves no trace in it.

Reader: files are cut into byte ranges.  A task scans its range for the gzip
magic, takes a place for a member only if the bytes there inflate to a WARC
header, and owns the records whose first byte lies in its range, reading past
the range's end where the last one does.  Payloads stream; a record is held
whole only if its payload is asked for.  A header may have any length and is held whole.

Files are opened with ``pyarrow.fs`` (file, hdfs, s3, gs addresses).

Defined results: a null html is the empty payload; payloads are whole; pages
with the same id and payload as the largest id are responses all; null page
ids sort below all others (alone, they are responses); an empty table gives
empty archives; other columns are left out.  A member that starts well and
does not inflate to its end raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import SMALL_ROWS, scratch, written

_MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 18
_ID = "<urn:quarry:record:{}>"


# -- records -------------------------------------------------------------------

def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    head += f"Content-Length: {len(block)}\r\n\r\n"
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return gz.compress(head.encode() + block + b"\r\n\r\n") + gz.flush()


def _http(payload_bytes: int) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()


def _headers(kind: str, key: str | None, url: str | None, digest: str, size: int, date: str,
             refers_to: str | None = None) -> list[tuple[str, str | None]]:
    # Fixed value: the revisit profile of the format's standard.
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return [("WARC-Type", kind), ("WARC-Record-ID", _ID.format("" if key is None else quote(key, safe=""))),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~")),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(size)),
            ("WARC-Profile", profile if refers_to is not None else None),
            ("WARC-Refers-To", None if refers_to is None else _ID.format(quote(refers_to, safe="")))]


def _record(key: str | None, url: str | None, digest: str, size: int, payload: bytes | None, top: str | None,
            least_bytes: int, date: str, level: int) -> bytes:
    """The member of a page: a revisit of page ``top`` if that is another one and
    the payload long enough, else the response (nothing without its payload)."""
    if top is not None and key != top and size >= least_bytes:
        return _member(_headers("revisit", key, url, digest, size, date, top), _http(size), level)
    if payload is None:
        return b""
    return _member(_headers("response", key, url, digest, size, date), _http(size) + payload, level)


# -- writer --------------------------------------------------------------------

def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 6,
                   file_bytes: int = 1 << 30, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", broadcast_rows: int = SMALL_ROWS) -> DataFrame:
    """Write all pages; returns the manifest (path, bytes, records).

    Payloads under ``least_bytes`` are never made revisits; a file is closed
    once it passes ``file_bytes``; at most ``broadcast_rows`` shared digests are
    decided without a shuffle."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("string").alias("key"), F.col(url_col).alias("url"),
                        F.sha1(html).alias("sha1"), html.alias("html"))
    shared = written(pages.select(F.sha1(html).alias("sha1"), F.col(id_col).alias("id")).groupBy("sha1").agg(
        F.max("id").cast("string").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1"), "warc-shared")
    few = shared.limit(broadcast_rows + 1).count() <= broadcast_rows
    most = shared if few else written(shared.orderBy(F.desc("n"), "sha1").limit(broadcast_rows), "warc-most-shared")

    def compress(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "url", "sha1", "size", "member", "decided"]
        for batch in batches:
            out, held = [], 0
            for key, url, sha1, payload, top, decided in batch.itertuples(index=False):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                out.append((key, url, sha1, len(payload),
                            _record(key, url, digest, len(payload), payload, top, least_bytes, date, level), decided))
                held += len(out[-1][-2])
                if held > 8_000_000:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=columns)

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder)
        scheme = folder[:-len(base)] if folder.endswith(base) else ""
        out = path = None
        size = records = 0
        for batch in batches:
            for key, url, sha1, length, member, top in batch[
                    ["key", "url", "sha1", "size", "member", "best"]].itertuples(index=False):
                if top is not None and key != top:
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    member = _record(key, url, digest, length, None, top, least_bytes, date, level) or member
                if out is None:
                    files.create_dir(base, recursive=True)
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, size, records = files.open_output_stream(path, compression=None), 0, 0
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    yield pd.DataFrame([(scheme + path, size, records)], columns=["path", "bytes", "records"])
                    out = None
        if out is not None:
            out.close()
            yield pd.DataFrame([(scheme + path, size, records)], columns=["path", "bytes", "records"])

    rows = rows.join(F.broadcast(most.select("sha1", "best", F.lit(True).alias("decided"))), "sha1", "left").select(
        "key", "url", "sha1", "html", "best", "decided")  # at most broadcast_rows narrow rows
    members = rows.mapInPandas(
        compress, "key string, url string, sha1 string, size long, member binary, decided boolean")
    if few:
        placed = members.withColumn("best", F.lit(None).cast("string"))
    else:
        others = shared.join(F.broadcast(most.select("sha1")), "sha1", "left_anti").select("sha1", "best")
        # No digest: rows that need no decision any more stay out of the hot keys.
        wanted = F.when(F.col("decided").isNull(), F.col("sha1"))
        placed = members.withColumn("wanted", wanted).join(
            others.withColumnRenamed("sha1", "wanted"), "wanted", "left")
    return written(placed.mapInPandas(store, "path string, bytes long, records long"), "warc-manifest")


# -- reader --------------------------------------------------------------------

def _inflate(f, at: int) -> Iterator[tuple[bytes, int | None]]:
    """Chunks of the member at ``at``; the last comes with the offset behind it."""
    gz = zlib.decompressobj(31)
    f.seek(at)
    read = 0
    while not gz.eof:
        raw = gz.unconsumed_tail
        if not raw:
            raw = f.read(_CHUNK)
            if not raw:
                raise zlib.error("the file ends inside a member")
            read += len(raw)
        yield gz.decompress(raw, 4 * _CHUNK), None
    yield b"", at + read - len(gz.unused_data)


def _header(f, at: int) -> dict[str, str] | None:
    """The WARC header of a member at ``at``, whatever its length; None if there is
    no such member.  One that starts well and does not inflate raises an error."""
    head = bytearray()
    try:
        for chunk, _ in _inflate(f, at):
            seen = max(len(head) - 3, 0)
            head += chunk
            if not (head[:7] == b"WARC/1." or len(head) < 7):
                return None
            end = head.find(b"\r\n\r\n", seen)
            if end >= 0:
                lines = head[:end].decode("utf-8", "replace").split("\r\n")
                named = (line.partition(":") for line in lines[1:])
                return {k.strip().lower(): v.strip() for k, _, v in named} | {"": str(end + 4)}
    except zlib.error:
        if head[:7] == b"WARC/1.":
            raise
    return None


def _candidates(f, start: int, end: int) -> Iterator[int]:
    """Offsets in [start, end) that hold the gzip magic."""
    at = start
    while at < end:
        f.seek(at)
        block = f.read(min(_CHUNK, end - at) + len(_MAGIC) - 1)
        hit = block.find(_MAGIC)
        if hit < 0:
            at += _CHUNK
            continue
        yield at + hit
        at += hit + 1


def read_range(f, start: int, end: int, with_payload: bool = False) -> Iterator[dict]:
    """Records whose first byte is in [start, end) of an open file."""
    at = start
    while at < end:
        found = next(((c, h) for c in _candidates(f, at, end) if (h := _header(f, c))), None)
        if found is None:
            return
        at, head = found
        begin = int(head[""])
        left = int(head.get("content-length", 0))
        http = head.get("content-type", "").startswith("application/http")
        record = {"offset": at, "head": head}
        digest, size, parts = hashlib.sha1(), 0, []
        lead = b""  # bytes before the payload: the HTTP header, until its end is seen
        skip = begin
        for chunk, behind in _inflate(f, at):
            drop = min(skip, len(chunk))
            skip -= drop
            chunk = chunk[drop:drop + left] if not skip else b""
            left -= len(chunk)
            if http and chunk:
                lead += chunk
                cut = lead.find(b"\r\n\r\n")
                chunk = b"" if cut < 0 else lead[cut + 4:]
                http = cut < 0
            digest.update(chunk)
            size += len(chunk)
            if with_payload:
                parts.append(chunk)
            if behind is not None:
                record["next"] = behind
        if left:
            raise ValueError(f"record at {at}: its block ends {left} bytes early")
        record |= {"size": size, "digest": base64.b32encode(digest.digest()).decode(),
                   "payload": b"".join(parts) if with_payload else None}
        yield record
        at = record["next"]


def _record_key(urn: str | None) -> str | None:
    head, tail = _ID.split("{}")
    if not urn or not (urn.startswith(head) and urn.endswith(tail)):
        return urn
    return unquote(urn[len(head):-len(tail)]) or None


_RECORD = ("path string, offset long, record_type string, record_id string, target_uri string, "
           "refers_to string, payload_digest string, payload_bytes long, payload binary")


def read_archives(spark: SparkSession, manifest: DataFrame, split_bytes: int = 8 << 20,
                  with_payload: bool = False) -> DataFrame:
    """All records of the files of a manifest (path, bytes).

    ``payload_digest`` and ``payload_bytes`` of a response are those of the
    bytes read (a header that says otherwise is an error); of a revisit, those
    its header states."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for path, start, end in batch.itertuples(index=False):
                files, local = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with files.open_input_file(local) as f:
                    for r in read_range(f, start, end, with_payload):
                        head = r["head"]
                        stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        digest, size = r["digest"], r["size"]
                        if head.get("warc-type") == "revisit":
                            digest = stated
                            size = int(head["warc-payload-length"]) if "warc-payload-length" in head else None
                        elif stated not in (None, digest):
                            raise ValueError(f"{path} at {r['offset']}: the payload is not that of its digest")
                        uri = head.get("warc-target-uri")
                        rows.append((path, r["offset"], head.get("warc-type"), _record_key(head.get("warc-record-id")),
                                     uri and unquote(uri), _record_key(head.get("warc-refers-to")), digest, size,
                                     r["payload"]))
                        held += 200 + len(r["payload"] or b"")
                        if held > 8_000_000:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
                yield pd.DataFrame(rows, columns=columns)

    columns = [c.split()[0] for c in _RECORD.split(", ")]
    ranges = manifest.where("bytes > 0").select("path", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"), "bytes")
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    tasks = max(1, min(ranges.count(), 10_000))  # narrow rows, one per range
    return ranges.repartition(tasks).mapInPandas(run, _RECORD)


def round_trip(pages: DataFrame, folder: str | None = None, split_bytes: int = 8 << 20,
               id_col: str = "page_id", **options) -> DataFrame:
    """Write the pages, read the archives back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, target_uri."""
    spark = pages.sparkSession
    manifest = write_archives(pages, folder or scratch(spark, "warc"), id_col=id_col, **options)
    kind = pages.schema[id_col].dataType
    return read_archives(spark, manifest, split_bytes).select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "target_uri")
