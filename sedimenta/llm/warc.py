"""WARC archives: one gzip member a record, written by tasks and read back by byte ranges.

Writing: equal payloads of at least LEAST bytes become one response (that of the largest page_id) and revisits of it.
The decision is made on (digest, page_id) rows alone, then joined to the pages by id. Each task writes its own archive
under a name that no other attempt uses; only archives that a finished task reports are in the manifest.

Reading: a split is a byte range of an archive. Its task looks for the gzip magic, checks each candidate by inflating its
start and reading a WARC header from it, and owns the records that start inside its range, wherever they end.

Defined results: a null html is an empty payload; rows that repeat id and payload are written each, with equal records; null ids come
first in the order of ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import blobs, materialise, read, shared_dir, small_text_batches

LEAST = 1000
MAGIC = b"\x1f\x8b\x08"
#: Bytes of a split, and of one read.
SPLIT, CHUNK = 16 << 20, 1 << 20
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member with the record of a page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", re.sub(r"\s", "%20", url or "")),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
    head.append(("Content-Length", str(len(block))))
    text = VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(text) + pack.flush()


def verdicts(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of each revisit, once for rows that repeat."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("n")).where(F.col("n") >= LEAST)
    rows = materialise(rows.select("page_id", F.unhex("digest").alias("digest")), "warc-digests")
    groups = rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min(F.coalesce("page_id", F.lit(-(2**63)))).alias("low"))
    groups = materialise(groups.where("low < refers_to").select("digest", "refers_to"), "warc-groups")
    found = rows.join(groups, "digest").where("not (page_id <=> refers_to)")
    return found.select("page_id", F.lower(F.hex("digest")).alias("digest"), "refers_to").distinct()


def write(pages: DataFrame, path: str) -> DataFrame:
    """Archives below path; returns the manifest (file, bytes, records)."""
    spark = pages.sparkSession
    small_text_batches(spark)
    revisits = materialise(verdicts(pages), "warc-revisits").withColumnRenamed("page_id", "id")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    marked = pages.select("page_id", "url", html.alias("payload"), F.sha1(html).alias("sha"))
    marked = marked.join(revisits, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("digest")), "left")
    marked = marked.select("page_id", "url", "payload", "sha", "refers_to", F.col("digest").isNotNull().alias("revisit"))
    where = path.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, n, size = f"{where}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.warc.gz", 0, 0
        out = None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "refers_to", "revisit")]
            for page_id, url, payload, sha, refers_to, revisit in zip(*cols, strict=True):
                if out is None:
                    files, at = opened(name)
                    files.create_dir(at.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(at, compression=None)
                member = record(page_id, url, payload, sha, refers_to, revisit)
                out.write(member)
                n, size = n + 1, size + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["file", "bytes", "records"])

    return materialise(marked.mapInArrow(run, "file string, bytes long, records long"), "warc-manifest")


class Source:
    """A file as a window of bytes that moves forward; reads CHUNK bytes at a time."""

    def __init__(self, path: str):
        files, at = opened(path)
        self.file = files.open_input_file(at)
        self.size, self.begin, self.data = self.file.size(), 0, b""

    def at(self, place: int, n: int) -> bytes:
        """n bytes from place on, fewer at the end of the file."""
        if place < self.begin or place + n > self.begin + len(self.data):
            self.begin, self.data = place, self.file.read_at(min(max(n, CHUNK), self.size - place), place) if place < self.size else b""
        return self.data[place - self.begin : place - self.begin + n]

    def find(self, place: int, stop: int) -> int:
        """The first gzip magic that starts in place..stop, else -1."""
        while place < stop:
            chunk = self.at(place, min(CHUNK, stop + len(MAGIC) - 1 - place))
            found = chunk.find(MAGIC)
            if found >= 0:
                return place + found
            if len(chunk) < len(MAGIC):
                return -1
            place += len(chunk) - len(MAGIC) + 1
        return -1


def member(source: Source, place: int) -> tuple[bytes, int] | None:
    """The WARC record in the gzip member at place and the place after it; None where no such member starts."""
    unpack, out, at, checked = zlib.decompressobj(31), [], place, False
    try:
        while not unpack.eof:
            chunk = source.at(at, 65536)
            if not chunk:
                return None
            out.append(unpack.decompress(chunk))
            at += len(chunk)
            if not checked and sum(map(len, out)) >= len(VERSION):
                checked = True
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
    except zlib.error:
        return None
    data = b"".join(out)
    return (data, at - len(unpack.unused_data)) if data.startswith(b"WARC/1.") else None


def parsed(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (lower-case names) and block of a record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    fields = {k.lower(): v for k, v in fields.items()}
    size = fields.get("content-length", "")
    return (fields, rest[: int(size)]) if gap and size.isdigit() and len(rest) >= int(size) else None


def records(path: str, low: int, high: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records that start in low..high of an archive."""
    source, at = Source(path), low
    while 0 <= (at := source.find(at, min(high, source.size))):
        got = member(source, at)
        record = got and parsed(got[0])
        if record:
            yield record
            at = got[1]
        else:
            at += 1


ROWS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(manifest: DataFrame, split: int = SPLIT, payload: bool = True) -> DataFrame:
    """A row a record; payload null for revisits (and everywhere unless asked for)."""
    parts = manifest.selectExpr("file", f"explode(sequence(0L, greatest(bytes - 1, 0L), {split}L)) AS low").selectExpr("file", "low", f"low + {split}L AS high")
    # About as many splits a task as there are tasks; a split is a range, not data.
    parts = parts.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "low")

    def page(urn: str) -> int | None:
        number = urn.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ROWS.split(", ")]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for part in batch.to_pylist():
                rows: list[tuple] = []
                for fields, block in records(part["file"], part["low"], part["high"]):
                    http, _, body = block.partition(b"\r\n\r\n")
                    revisit = fields["warc-type"] == "revisit"
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if not revisit and hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"{part['file']}: a payload differs from its digest")
                    size = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
                    rows.append((page(fields["warc-record-id"]), fields["warc-target-uri"], size, digest, fields["warc-type"], page(fields["warc-refers-to"]) if revisit else None, None if revisit or not payload else body))
                    if len(rows) >= 500:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return parts.mapInArrow(run, ROWS)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write(read(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return read_archives(manifest, payload=False).drop("payload", "url")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
     g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""
