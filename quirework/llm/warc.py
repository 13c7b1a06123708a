"""WARC archives: writing, reading back, and capture histories by an external index merge.

``write`` puts one record per page into gzip archives through Spark's own text writer (the record
separator is WARC's), so that any store Spark reaches will do. ``read`` parses archives by their
content lengths into one capture per record; each archive is a run sorted by (URL key, timestamp,
page_id). ``merged`` deals the runs to ranges of that key, so many that a range holds about ``RANGE``
captures, and merges the k runs of each range with a loser tree: the result is globally ordered, and a URL
with very many captures spreads over ranges.

Null html is an empty payload; a null url is left out of its record and sorts first; of equal payloads
the largest page_id is the response (all rows that repeat that id are) and the others revisit it; a null
page_id is never revisited nor a revisit. A very long payload makes an archive longer than ``ARCHIVE_BYTES``
by itself; a worker holds one archive's captures and one record's payload at a time. Extra columns of pages
are left out. An empty table makes archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm._common import shuffle_partitions, spooled
from quirework.sources import scratch

#: Payload bytes in one archive, by the mean payload, and records in one at most.
ARCHIVE_BYTES, RECORDS = 64 << 20, 5000
#: Captures in one range of the merge.
RANGE = 100_000
#: Date of page 0; page n was captured n seconds later where the table has no ``captured``.
EPOCH = "2024-01-01T00:00:00Z"

# Fixed values of the WARC format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BREAK = "\r\n\r\n"
_CAPTURE = "urlkey string, ts string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, record_at long, sound boolean"


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes: 8 groups of 20 bits, 4 digits each."""
    groups = [F.lpad(F.conv(F.substring(F.sha1(text), 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to and ``value``, the text of the record without its last separator."""
    payload = F.coalesce(F.col("html"), F.lit("")).alias("payload")
    rows = pages.select("page_id", "url", payload).withColumn("digest", base32_sha1(F.col("payload"))).withColumn("size", F.octet_length("payload").cast("long"))
    # the responses that some record revisits; a spooled table, so that Spark knows its size and can split a skewed join
    shared = rows.where(F.col("page_id").isNotNull()).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.min("page_id").alias("least"))
    shared = spooled(shared.where("kept > least").drop("least"), "responses")
    rows = rows.join(shared, ["digest", "size"], "left")
    revisit = F.col("kept").isNotNull() & (F.col("page_id") < F.col("kept"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(_BREAK))
    rows = rows.select("page_id", "url", "payload", "digest", F.coalesce(revisit, F.lit(False)).alias("again"), "kept", http.alias("http"))
    block = F.concat("http", F.when(F.col("again"), "").otherwise(F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    date = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.to_timestamp(F.lit(EPOCH))) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")), F.lit("\r\nWARC-Date: "), date,
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", "[\\x00-\\x20]", "%20")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("again"), F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), name(F.col("kept")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(_BREAK),
    )
    return rows.select(F.concat(header, block).alias("value"))


def write(pages: DataFrame, path: str, per_archive: int | None = None) -> None:
    """A folder of .gz archives with one record per page; by default each has about ``ARCHIVE_BYTES`` of payload at most."""
    if per_archive is None:
        mean = pages.agg(F.avg(F.octet_length(F.coalesce("html", F.lit(""))))).first()[0] or 0
        per_archive = int(min(RECORDS, max(1, ARCHIVE_BYTES // (mean + 1))))
    records(pages).write.option("lineSep", _BREAK).option("compression", "gzip").option("maxRecordsPerFile", per_archive).text(path)


def _inflate(content: bytes) -> Iterator[bytes]:
    """The archive's bytes by and by; a gzip file may have many members."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        d = zlib.decompressobj(31)
        while not d.eof and at < len(view):
            part = view[at : at + (1 << 20)]
            out = d.decompress(part)
            at += len(part) - len(d.unused_data)
            if out:
                yield out


def parse(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset (in the inflated archive), headers and block of each record."""
    buffer, base = bytearray(), 0
    source = _inflate(content)

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = next(source, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                return
        lines = bytes(buffer[:end]).decode("utf-8").split("\r\n")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        if not lines[0].startswith("WARC/") or not fill(end + 4 + size):
            raise ValueError(f"no whole WARC record at {base}")
        yield base, head, bytes(buffer[end + 4 : end + 4 + size])
        fill(step := end + 8 + size)
        del buffer[:step]
        base += step


def url_key(url: str | None) -> str:
    """The sort-friendly form of a URL: host labels from the last on, then path and query; '' for none."""
    if not url:
        return ""
    try:
        p = urlsplit(url.strip().lower())
        host, port = (p.hostname or ""), p.port
    except ValueError:
        return url.lower()
    labels = host.removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + (f":{port}" if port and port not in (80, 443) else "") + ")" + (p.path or "/") + (f"?{p.query}" if p.query else "")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One capture per record; those of an archive come sorted by (urlkey, ts, page_id)."""

    def page(name: str | None) -> int | None:
        return int(name[len("<urn:x-page:") : -1]) if name and name != "<urn:x-page:none>" else None

    def captures(archive: str, content: bytes) -> list[tuple]:
        rows = []
        for at, head, block in parse(content):
            http, _, payload = block.partition(b"\r\n\r\n")
            size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            kind = head["warc-type"]
            sound = not payload if kind == "revisit" else len(payload) == size and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
            rows.append((url_key(head.get("warc-target-uri")), head["warc-date"], page(head["warc-record-id"]), kind, size, digest, page(head.get("warc-refers-to")), archive, at, sound))
        rows.sort(key=order)
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = captures(batch.column("path")[i].as_py(), batch.column("content")[i].as_py())
                if rows:
                    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split(" ")[0] for f in _CAPTURE.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(run, _CAPTURE)


def order(row: tuple) -> tuple:
    """(urlkey, ts, page_id, archive, offset), a null page_id first."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8]


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list[tuple]], key=order):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [self._head(i) for i in range(len(runs))]
        k = max(1, len(runs))
        self.losers = [-1] * k
        self.winner = self._build(1) if len(runs) > 1 else 0

    def _head(self, i: int):
        return self.key(self.runs[i][self.at[i]]) if self.at[i] < len(self.runs[i]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _build(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.runs)
        while k and self.heads[self.winner] is not None:
            win = self.winner
            yield self.runs[win][self.at[win]]
            self.at[win] += 1
            self.heads[win] = self._head(win)
            node = (win + k) // 2
            while node >= 1:
                if not self._beats(win, self.losers[node]):
                    win, self.losers[node] = self.losers[node], win
                node //= 2
            self.winner = win


def merged(captures: DataFrame) -> DataFrame:
    """The captures in one global order by (urlkey, ts, page_id), partition after partition.

    ``captures`` is read twice, to find the ranges and to deal the runs: give a settled table."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs: dict[str, list[tuple]] = {}
        columns = None
        for frame in frames:
            columns = frame.columns
            frame = frame.astype(object).where(frame.notna(), None)
            for row in frame.itertuples(index=False, name=None):
                runs.setdefault(row[7], []).append(row)
        if columns is None:
            return
        for own in runs.values():  # a run's rows arrive in its order; sorting a sorted list is one pass over it
            own.sort(key=order)
        rows = list(LoserTree([runs[a] for a in sorted(runs)]))
        yield pd.DataFrame(rows, columns=columns)

    ranges = max(shuffle_partitions(captures.sparkSession), -(-captures.count() // RANGE))
    dealt = captures.repartitionByRange(ranges, "urlkey", "ts", "page_id", "archive", "record_at")
    return dealt.mapInPandas(run, _CAPTURE)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.folder(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    captures = spooled(read(spark, path), "captures")
    return merged(captures).select("urlkey", "ts", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, lower(url) AS url, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex,
        max(page_id) OVER (PARTITION BY html) AS kept FROM p),
u AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*:([0-9]+)', 1) AS port,
        regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*[?]([^#]+)', 1) AS query FROM d)
SELECT CASE WHEN url IS NULL THEN '' ELSE
    array_to_string(list_reverse(string_split(CASE WHEN host LIKE 'www.%' THEN host[5:] ELSE host END, '.')), ',')
    || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END || ')' || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS urlkey,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 1000000000), '%Y-%m-%dT%H:%M:%SZ') AS ts,
  page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1) FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < kept THEN kept END AS refers_to
FROM u
"""
