"""WARC archives of pages, read back into one globally ordered capture index."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_RFC32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
ENTRY = (
    "urlkey string, captured long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "file string, record_start long, record_bytes long"
)
_FIELDS = [f.split()[0] for f in ENTRY.split(", ")]
_ENTRY = pa.struct([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in ENTRY.split(", ")])


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: ten hexadecimal digits at a time are eight of base 32."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _DIGITS32, _RFC32)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query; no scheme, ``www.`` or fragment."""
    try:
        u = urlsplit((url or "").strip())
        host = (u.hostname or "").lower()
        port = f":{u.port}" if u.port not in (None, 80, 443) else ""
    except ValueError:
        return (url or "").strip().lower()
    host = host.removeprefix("www.")
    query = f"?{u.query}" if u.query else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/").lower() + query.lower()


def records(pages: DataFrame, min_bytes: int = 0, epoch: int = 1_577_836_800) -> DataFrame:
    """(page_id, record): the text of one WARC record for each row of (page_id, url, html).

    Among rows with equal payloads of at least ``min_bytes`` the one with the
    largest page_id is the response and the others are revisits without a
    block; rows that share that largest page_id are all responses. A null html
    is an empty payload, a null url an empty target. A row without page_id is a
    revisit if any equal row has one. Only the largest id of a payload is
    shuffled against the pages; adaptive execution splits a hot payload.
    The capture time is ``epoch`` plus page_id seconds.
    """
    rows = pages.select(
        "page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html")
    ).select("*", F.sha2("html", 256).alias("same"), F.octet_length("html").cast("long").alias("bytes"))
    first = rows.filter(F.col("bytes") >= min_bytes).groupBy("same").agg(F.max("page_id").alias("response"))
    rows = rows.join(first, "same", "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "bytes", F.lit("\r\n\r\n"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    date = F.date_format(F.timestamp_seconds(F.lit(epoch) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("page_id"), F.lit("\r\nWARC-Date: "), date, F.lit("\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(F.col("html")), F.lit("\r\nX-Payload-Length: "), "bytes",
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name("response"),
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.octet_length(http) + F.col("bytes")), F.lit("\r\n\r\n"),
    )
    return rows.select("page_id", F.concat(head, F.when(revisit, "").otherwise(F.concat(http, "html"))).alias("record"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Gzipped archives, one for each task, written by Spark wherever ``path`` leads.

    The blank lines that end a record are the line separator of the writer.
    """
    records(pages, min_bytes).select("record").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse(stream, file: str) -> Iterator[dict]:
    """Index entries of the records of an unzipped archive; lengths come from the headers."""
    at = 0
    while True:
        line = stream.readline()
        if not line:
            return
        start, fields = at, {}
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{file}: no record at byte {start}")
        at += len(line)
        while (line := stream.readline()) not in (b"\r\n", b""):
            at += len(line)
            k, _, v = line.decode().rstrip("\r\n").partition(":")
            fields[k.lower()] = v.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        at += 2 + size + len(stream.read(4))
        if len(block) < size:
            raise ValueError(f"{file}: record at byte {start} is cut off")
        page = lambda k: int(v) if (v := fields.get(k, "").removeprefix("<urn:page:").rstrip(">")) else None
        digest, length = fields["warc-payload-digest"].partition(":")[2], int(fields["x-payload-length"])
        if fields["warc-type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            length, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        date = fields["warc-date"]
        yield {
            "urlkey": url_key(fields.get("warc-target-uri")), "captured": int("".join(c for c in date if c.isdigit())),
            "page_id": page("warc-record-id"), "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": page("warc-refers-to"),
            "file": file, "record_start": start, "record_bytes": at - start,
        }


def order_of(entry: dict) -> tuple:
    p = entry["page_id"]
    return entry["urlkey"], entry["captured"], p is not None, p or 0, entry["file"], entry["record_start"]


class LoserTree:
    """Merge of k sorted sequences: each inner node keeps the loser of its match, so one path is replayed per item."""

    def __init__(self, runs: list[Iterator[dict]]):
        self.runs = [iter(r) for r in runs]
        self.k = len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [self._key(i) for i in range(self.k)]
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _key(self, i: int) -> tuple:
        return (1, i) if self.heads[i] is None else (0, order_of(self.heads[i]), i)

    def _replay(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:  # first one here: it waits for its match
                self.tree[node] = i
                return
            if self.keys[other] < self.keys[i]:
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator[dict]:
        while self.k and self.heads[self.tree[0]] is not None:
            i = self.tree[0]
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            self.keys[i] = self._key(i)
            self._replay(i)


def range_bounds(pages: DataFrame, entries_per_range: int, sample: int = 4096, epoch: int = 1_577_836_800) -> list[tuple]:
    """Keys that cut the index into ranges of about ``entries_per_range``, from a sample of ``sample`` pages, or 20 for each range if that is more.

    A key holds URL, time and page, so that the captures of a hot URL are cut by time.
    """
    n = pages.count()
    parts = max(1, -(-n // entries_per_range))
    sample = max(sample, 20 * parts)
    if parts == 1:
        return []
    captured = F.date_format(F.timestamp_seconds(F.lit(epoch) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyyMMddHHmmss")
    some = pages.orderBy(F.xxhash64("page_id", "url"), "page_id").limit(sample).select("url", "page_id", captured.alias("captured")).collect()
    keys = sorted((url_key(r["url"]), int(r["captured"]), r["page_id"] is not None, r["page_id"] or 0) for r in some)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)})


def capture_index(spark: SparkSession, path: str, bounds: list[tuple]) -> DataFrame:
    """Entries of all archives under ``path``, in global order by (part, place).

    Each archive gives a run, sorted where it is read and cut at ``bounds``; the
    slices of one range meet in one task, which merges them with a loser tree.
    The order is URL key, capture time, page_id (null first), place in the archive.
    """

    def runs(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                with gzip.open(io.BufferedReader(pa.BufferReader(content.as_buffer())), "rb") as stream:
                    run = sorted(parse(stream, file.rpartition("/")[2]), key=order_of)
                cuts = [0, *(bisect.bisect_left(run, b, key=lambda e: order_of(e)[:4]) for b in bounds), len(run)]
                parts = [(k, run[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in parts], pa.int32()), pa.array([s for _, s in parts], pa.list_(_ENTRY))], ["part", "slice"]
                )

    def merge(table: pa.Table) -> pa.Table:
        slices = table.column("slice")
        merged = list(LoserTree([(e.as_py() for e in s.values) for s in slices]))
        cols = [pa.array([e[f] for e in merged], _ENTRY.field(f).type) for f in _FIELDS]
        part = pa.array([table.column("part")[0].as_py()] * len(merged), pa.int32())
        return pa.Table.from_arrays([part, pa.array(range(len(merged)), pa.int64()), *cols], ["part", "place", *_FIELDS])

    struct = ", ".join(f"{f.split()[0]}: {f.split()[1]}" for f in ENTRY.split(", "))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(runs, f"part int, slice array<struct<{struct}>>").groupBy("part").applyInArrow(merge, f"part int, place long, {ENTRY}")


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0, entries_per_range: int = 5000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and read their ordered index back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return capture_index(spark, path, range_bounds(pages.select("page_id", "url"), entries_per_range))


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    index = archive_pages(spark.read.parquet(f"{sf}/pages.parquet"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS response
    FROM pages
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
    translate({" || ".join(f"upper(lpad(to_base(('0x' || substr(h, {i}, 10))::BIGINT, 32), 8, '0'))" for i in (1, 11, 21, 31))},
        '{_DIGITS32}', '{_RFC32}') AS payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM response OR response IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM p
"""
