"""WARC archives and their merged index.

Records are gzip members of their own, so ``offset`` and ``length`` in the
index address one record.  Between two members the files hold an empty gzip
member, which every gzip reader skips.  Of records with equal payloads the one
with the smallest page id is the response, the others are revisits without a
payload that refer to it.

Index merge: reading an archive gives one run, sorted by (URL key, timestamp,
page id).  Runs are cut at common key ranges, and each range merges its slices
of all runs with a loser tree, so the ranges in order are the global capture
history.  The timestamp and the page id are part of the range key, so one very
frequent URL or host spreads over many ranges.

Defined cases: null html is an empty payload; a null url has the empty key;
null page ids sort last within equal payloads and are responses only where the
whole group is null; rows that repeat the smallest page id of their payload
are all responses; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import cut, load, read_binary, shuffle_parts, write_binary
from staylens.session import scratch_path

EPOCH = 946_684_800      # captures without a time: this second plus the page id
MIN_REVISIT_BYTES = 0
FILE_RECORDS = 20_000
ID = "urn:page:"
FIELDS = ("page_id long, url string, urlkey string, timestamp string, record_type string, refers_to long, "
          "payload_bytes long, payload_digest string, offset long, length long")


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


EMPTY_MEMBER = gzip_member(b"")


def members(data):
    """(offset, length, content) of the gzip members of a file, empty ones left out."""
    at, end = 0, len(data)
    while at < end:
        d, pos, parts = zlib.decompressobj(31), at, []
        while not d.eof:
            if pos >= end:
                raise ValueError("archive cut off")
            chunk = data[pos:pos + 65536]
            parts.append(d.decompress(chunk))
            pos += len(chunk)
        pos -= len(d.unused_data)
        content = b"".join(parts)
        if content:
            yield at, pos - at, content
        at = pos


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then path and query, lower case."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip().lower())
        host = u.hostname or ""
        port = f":{u.port}" if u.port and u.port not in (80, 443) else ""
    except ValueError:  # not a URL: its own text is its key
        return url.strip().lower()
    path = (u.path or "/") + (f"?{u.query}" if u.query else "")
    return ",".join(reversed(host.split("."))) + port + ")" + path


def record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    when = datetime.fromtimestamp(EPOCH + (page_id or 0) % 10 ** 9, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    safe = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID}{page_id}>",
            f"WARC-Date: {when}", f"WARC-Target-URI: {safe}", f"WARC-Payload-Digest: sha1:{digest}",
            f"Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{ID}{refers_to}>"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(content: bytes) -> tuple:
    """Index fields of a record; a response's digest is checked against its payload."""
    head, _, rest = content.partition(b"\r\n\r\n")
    field = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = field["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload digest differs: {field['WARC-Record-ID']}")
    number = lambda x: None if x is None or x == f"<{ID}None>" else int(x[len(ID) + 1:-1])
    url = field.get("WARC-Target-URI", "")
    stamp = "".join(c for c in field["WARC-Date"] if c.isdigit())
    return (number(field["WARC-Record-ID"]), url, url_key(url), stamp, kind, number(field.get("WARC-Refers-To")),
            size, digest)


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   file_records: int = FILE_RECORDS) -> None:
    """One WARC record per row of ``pages`` (page_id, url, html)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                         F.sha1(F.encode(html, "UTF-8")).alias("sha"))
    groups = keyed.where(F.octet_length("html") >= min_revisit_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = cut(groups.where("n > 1").select(F.col("sha").alias("g_sha"), "first"), "warc-groups")
    rows = keyed.join(groups, F.col("sha") == F.col("g_sha"), "left").select("page_id", "url", "html", "first")

    def run(batches):
        for b in batches:
            out = []
            for p, u, h, first in zip(*(b.column(c) for c in ("page_id", "url", "html", "first"))):
                p, first = p.as_py(), first.as_py()
                revisit = first is not None and p != first
                out.append(gzip_member(record(p, u.as_py(), h.as_py().encode("utf-8"), first, revisit)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    spark = pages.sparkSession
    df = rows.mapInArrow(run, "record binary")
    (df.select(F.col("record").cast("string").alias("value")).write.option("maxRecordsPerFile", file_records)
     .option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of all records, one sorted run per archive file: FIELDS plus
    ``run`` (file) and ``seq`` (place in the run)."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column("file").to_pylist(), b.column("content")):
                rows = [parse(c) + (at, n) for at, n, c in members(memoryview(data.as_buffer()))]
                rows.sort(key=sort_key)
                cols = list(zip(*rows)) or [()] * 10
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(),
                         pa.string(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(cols, types)]
                yield pa.RecordBatch.from_arrays(
                    arrays + [pa.array([name] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64())],
                    names=[f.split()[0] for f in FIELDS.split(", ")] + ["run", "seq"])

    return read_binary(spark, path).mapInArrow(run, FIELDS + ", run string, seq long")


def sort_key(row: tuple) -> tuple:
    """(URL key, timestamp, page id): strings by code point; null ids first."""
    return row[2].encode("utf-8"), row[3], -1 if row[0] is None else row[0], row[8]


class LoserTree:
    """Merges k sorted runs.  Each inner node keeps the loser of its match, the
    winner moves up; the next row costs one path of log2 k matches."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.at = [0] * self.k
        self.head = [self._key(r) for r in range(self.k)]
        self.losers = [-1] * self.k
        self.winner = self._build(1)

    def _key(self, r: int):
        return self.key(self.runs[r][self.at[r]]) if r < len(self.runs) and self.at[r] < len(self.runs[r]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self):
        while self.head[self.winner] is not None:
            r = self.winner
            yield self.runs[r][self.at[r]]
            self.at[r] += 1
            self.head[r] = self._key(r)
            node = (r + self.k) // 2
            while node >= 1:
                other = self.losers[node]
                if self._beats(other, r):
                    self.losers[node], r = r, other
                node //= 2
            self.winner = r


def merge_index(runs: DataFrame) -> DataFrame:
    """Global index: the rows of all runs with ``block`` (key range) and
    ``slot`` (place in it); ordered by (block, slot) they are the capture
    histories of all URLs.  A task holds one key range of slim rows."""
    n = shuffle_parts(runs.sparkSession)
    keys = ["urlkey", "timestamp", "page_id", "offset"]
    ranges = runs.repartitionByRange(n, *keys).sortWithinPartitions("run", "seq")
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches):
        parts: dict[str, list] = {}
        types = None
        for b in batches:
            types = types or [b.schema.field(c).type for c in names + ["run"]]
            for row in zip(*(b.column(c).to_pylist() for c in names + ["run"])):
                parts.setdefault(row[-1], []).append(row)
        if not parts:
            return
        block, out, slot = TaskContext.get().partitionId(), [], 0

        def batch(rows, first):
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(
                arrays + [pa.array([block] * len(rows), pa.int32()), pa.array(range(first, first + len(rows)), pa.int64())],
                names=names + ["run", "block", "slot"])

        for row in LoserTree(list(parts.values()), sort_key):
            out.append(row)
            if len(out) == 10_000:
                yield batch(out, slot)
                slot += len(out)
                out = []
        if out:
            yield batch(out, slot)

    return ranges.mapInArrow(run, FIELDS + ", run string, block int, slot long")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(load(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    runs = cut(read_archives(spark, path), "warc-runs")
    return merge_index(runs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                    "urlkey", "timestamp", F.col("run").alias("file"), "offset", "length", "block", "slot")
