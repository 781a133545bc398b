"""WARC archives: monolithic gzip in, one member per record and a sidecar index out.

``write_monolithic`` writes whole-file gzip streams, ``normalize`` inflates each stream once and
rewrites every record as its own gzip member next to a ``.idx`` file of offsets, and
``read_indexed`` reads records by offset. Files are written under an attempt's name and renamed,
and the lists of files come from tasks that ended, so lost executors and repeated tasks leave
only unused files. One record is held in memory at a time.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the largest id is the
response and the others revisit it; repeated rows that share that id are responses too. A null
payload is empty, a null id is ranked below all others; extra columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SharedFiles, materialize, new_dir, short_batches, small_side, table, text_or_empty, unique_name

PIECE = 1 << 16
#: Index entries that one read task opens.
READ_ENTRIES = 4096
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    at = urn.strip("<>").rpartition(":")[2]
    return None if at == "null" else int(at)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    sha1 = hashlib.sha1(payload).digest()
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    uri = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Target-URI", uri),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()), ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body))),
    ]
    if revisit:
        fields[3:3] = [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _header(fields) + body + b"\r\n\r\n"


def parse_header(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def inflate(stream) -> Iterator[bytes]:
    """The bytes of a gzip stream of any number of members, piece by piece."""
    z = zlib.decompressobj(31)
    while piece := stream.read(PIECE):
        while piece:
            yield z.decompress(piece)
            piece = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
            elif not piece:
                break


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, record) of each record of an inflated stream."""
    buf = bytearray()
    more = True

    def fill(n: int) -> bool:
        nonlocal more
        while more and len(buf) < n:
            piece = next(pieces, None)
            more = piece is not None
            buf.extend(piece or b"")
        return len(buf) >= n

    while True:
        at, seen = -1, 0
        while at < 0:
            at = buf.find(b"\r\n\r\n", max(0, seen - 3))
            seen = len(buf)
            if at < 0 and not fill(seen + 1):
                if buf:
                    raise ValueError("truncated WARC header")
                return
        head = parse_header(bytes(buf[:at]))
        end = at + 4 + int(head["content-length"]) + 4
        if not fill(end):
            raise ValueError("truncated WARC record")
        yield head, bytes(buf[:end])
        del buf[:end]


def write_monolithic(pages: DataFrame, base: str) -> DataFrame:
    """pages(page_id, url, payload, keep_id, revisit) -> file, n: one gzip stream a partition."""

    def write(batches):
        store, made = SharedFiles(base), []
        name, n = unique_name("mono", ".warc.gz"), 0

        def fill(out):
            nonlocal n
            with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=6, mtime=0) as gz:
                for b in batches:
                    for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "keep_id", "revisit")), strict=True):
                        gz.write(record_bytes(*row))
                        n += 1

        store.create(name, fill)
        made.append({"file": name, "n": n})
        yield pa.RecordBatch.from_pylist(made, pa.schema([("file", pa.string()), ("n", pa.int64())]))

    return pages.select("page_id", "url", "payload", "keep_id", "revisit").mapInArrow(write, "file string, n long")


def normalize(files: DataFrame, base: str) -> DataFrame:
    """files(file) of gzip streams -> file, idx, lo, hi: ranges of the sidecar's entries."""

    def rewrite(batches):
        store = SharedFiles(base)
        for b in batches:
            for mono in b.column("file").to_pylist():
                name, entries, at = unique_name("member", ".warc.gz"), [], 0

                def fill(out, mono=mono, entries=entries):
                    nonlocal at
                    at = 0
                    with store.open_stream(mono) as stream:
                        for head, raw in records(inflate(stream)):
                            z = zlib.compressobj(6, zlib.DEFLATED, 31)
                            member = z.compress(raw) + z.flush()
                            out.write(member)
                            entries.append(json.dumps({"offset": at, "length": len(member), "id": head["warc-record-id"], "type": head["warc-type"], "digest": head["warc-payload-digest"]}))
                            at += len(member)

                store.create(name, fill)
                store.create(name + ".idx", lambda out, entries=entries: out.write("\n".join(entries).encode()))
                rows = [{"file": name, "lo": lo, "hi": min(lo + READ_ENTRIES, len(entries))} for lo in range(0, len(entries), READ_ENTRIES)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("lo", pa.int64()), ("hi", pa.int64())]))

    return files.select("file").mapInArrow(rewrite, "file string, lo long, hi long")


def read_member(f, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    f.seek(offset)
    raw = gzip.decompress(f.read(length))
    at = raw.index(b"\r\n\r\n")
    head = parse_header(raw[:at])
    return head, raw[at + 4 : at + 4 + int(head["content-length"])]


def read_indexed(ranges: DataFrame, base: str) -> DataFrame:
    """Records by offset; a response's payload is checked against its digest."""

    def read(batches):
        store = SharedFiles(base)
        for b in batches:
            for name, lo, hi in zip(*(b.column(c).to_pylist() for c in ("file", "lo", "hi")), strict=True):
                with store.open(name + ".idx") as f:
                    entries = [json.loads(x) for x in f.read().decode().split("\n")[lo:hi]]
                out = []
                with store.open(name) as f:
                    for e in entries:
                        head, body = read_member(f, e["offset"], e["length"])
                        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                        size, kind = int(head["x-payload-length"]), head["warc-type"]
                        if kind == "response":
                            payload = body[body.index(b"\r\n\r\n") + 4 :]
                            if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
                                raise ValueError(f"{name}: payload at {e['offset']} differs from its digest")
                        out.append((_page(head["warc-record-id"]), size, digest, kind, _page(head["warc-refers-to"]) if kind == "revisit" else None))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*out, strict=True), types, strict=True)], names=[x.split()[0] for x in RECORD.split(", ")])

    return ranges.select("file", "lo", "hi").mapInArrow(read, RECORD)


def archive_pages(pages: DataFrame, base: str, min_bytes: int = 1000) -> DataFrame:
    """Write pages(page_id, url, html) through both archive forms; the ranges of the index."""
    spark = pages.sparkSession
    html = text_or_empty("html")
    full = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.cast("binary").alias("payload"), F.sha1(html.cast("binary")).alias("digest"))
    long_enough = full.where(F.octet_length("payload") >= min_bytes)
    # SHA-1 is the archive's own notion of an equal payload
    groups = long_enough.groupBy("digest").agg(F.max("page_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1").select("digest", "keep_id")
    groups = materialize(groups, "groups")
    keep_other = ~F.col("page_id").eqNullSafe(F.col("keep_id")) & F.col("keep_id").isNotNull() & (F.octet_length("payload") >= min_bytes)
    typed = full.join(small_side(groups), "digest", "left").withColumn("revisit", keep_other)
    with short_batches(spark, 64):
        mono = materialize(write_monolithic(typed, base), "mono")
        ranges = normalize(mono.where("n > 0").repartition(max(1, mono.count())), base)
        return materialize(ranges, "ranges")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_dir(spark, "warc")
    ranges = archive_pages(table(spark, sf_dir, "pages"), base)
    return read_indexed(ranges.repartition(max(1, ranges.count())), base)


OP3_SQL = """
with p as (select page_id, coalesce(html, '') html from pages),
q as (select page_id, octet_length(encode(html)) payload_bytes, sha1(html) payload_digest from p),
r as (select *, max(page_id) over (partition by payload_digest) keep_id from q)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 1000 and page_id <> keep_id then 'revisit' else 'response' end record_type,
  case when payload_bytes >= 1000 and page_id <> keep_id then keep_id end refers_to from r
"""
