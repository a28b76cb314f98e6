"""WARC archives and a globally ordered capture index.

Captures are written as WARC 1.1 records, each a gzip member of its own, by Spark's
own text writer: a row is a member without its last byte, and the line separator is
that byte, so archives land on any Hadoop file system, through its commit protocol.
A ``response`` record holds an HTTP response whose body is the payload; records
whose payload another record holds are written as revisits without it.

Reading takes whole archive files (their number of records is bounded when they
are written), inflates one member at a time, and writes each archive's captures as
one locally sorted *run*, with the byte offset at which its member can be read
alone.  The index is an external merge: rows are dealt to ranges of (URL key,
timestamp, page), and each range merges its k runs with a loser tree, which gives
every URL's capture history in global order.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.plans.scratch import Scratch

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
INDEX = "url_key string, ts string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, offset long"


def base32(digest: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: eight groups of 20 bits, four letters each."""
    groups = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        groups += [F.substring(F.lit(ALPHABET), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*groups)


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed and comma-joined, then the path; without scheme, 'www.', port and fragment."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, "#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*", 0), r"(?i)^www\.|:\d+$", ""))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(rest, r"^[^/?]*", ""))


def plan_records(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """Decide each page's record type: of records with equal payloads the largest page_id is the response.

    Payloads shorter than ``min_bytes`` are always responses.  A null html is an
    empty payload.  If rows share the largest page_id, all of them are responses;
    a null page_id is smaller than any other.  Pages meet by the hex digest, which is
    never null: of base32 the join would test that first, and hash a page for each letter.
    """
    html = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html.cast("binary")).alias("_sha1"))
    top = scratch.keep(p.groupBy("_sha1", "payload_bytes").agg(F.max("page_id").alias("top")).withColumnsRenamed({"_sha1": "_d", "payload_bytes": "_b"}), "responses")
    p = p.join(top.hint("merge"), (F.col("_sha1") == F.col("_d")) & (F.col("payload_bytes") == F.col("_b")))
    first = F.col("page_id").eqNullSafe(F.col("top")) | (F.col("payload_bytes") < min_bytes)
    return p.select("page_id", "url", "html", "payload_bytes", base32(F.col("_sha1")).alias("payload_digest"), F.when(first, "response").otherwise("revisit").alias("record_type"), F.when(~first, F.col("top")).alias("refers_to"))


def _header(value: Column) -> Column:
    """A header value on one line: percent-encode what would break it."""
    return F.replace(F.replace(F.replace(value, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member without its last byte, 0.

    That byte is the highest of the record's size, 0 below 16 MB; behind a larger
    record stands an empty member, which ends in 0.
    """
    empty = gzip.compress(b"", mtime=0)
    for b in batches:
        for at in range(0, b.num_rows, 64):
            out = []
            for r in b.column(0).slice(at, 64).to_pylist():
                m = gzip.compress(r, 6, mtime=0)
                out.append((m + empty if m[-1] else m)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_archives(records: DataFrame, path: str, per_archive: int = 1000) -> None:
    """Write WARC files of at most ``per_archive`` records under ``path``, each record a gzip member.

    The capture time is 2020-01-01 plus page_id seconds, as pages carry none.
    Spark names the files ``part-*.txt``; their content is that of a ``.warc.gz``.
    """
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    ts = F.date_format(F.timestamp_seconds(F.lit(1577836800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(F.col("record_type") == "response", F.concat(http, F.col("html"))).otherwise("")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), ts),
        F.concat(F.lit("WARC-Target-URI: "), _header(F.coalesce("url", F.lit("")))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(F.col("record_type") == "revisit", F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.lit(CRLF), F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block, F.lit(CRLF * 2))
    members = records.select(record.cast("binary").alias("value")).mapInArrow(_members, "value binary")
    members.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", per_archive).option("compression", "none").option("lineSep", "\0").text(path)


def _inflated(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member, one at a time."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, pieces, to = zlib.decompressobj(31), [], at
        while not member.eof:
            if to >= len(view):
                raise ValueError(f"gzip member at {at} is cut off")
            pieces.append(member.decompress(view[to : to + (1 << 16)]))
            to = min(len(view), to + (1 << 16))
        yield at, b"".join(pieces)
        at = to - len(member.unused_data)


def parse_archive(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, payload) of each record, from an archive or from its bytes at any record's offset on; raises on a malformed one."""
    for at, record in _inflated(data):
        if not record:
            continue
        end = record.index(CRLF.encode() * 2)
        first, *rest = record[:end].decode().split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        head = dict(x.split(": ", 1) for x in rest)
        stop = end + 4 + int(head["Content-Length"])
        if record[stop:] != CRLF.encode() * 2:
            raise ValueError(f"record at {at} is cut off")
        body = end + 4
        if body < stop and head["Content-Type"].startswith("application/http"):
            body = record.index(CRLF.encode() * 2, body) + 4
        yield at, head, record[body:stop]


def _page(value: str | None) -> int | None:
    return None if value is None or value == "<urn:page:none>" else int(value[10:-1])


def read_runs(spark, path: str) -> DataFrame:
    """One run of captures for each archive, sorted by URL key, time and page; each payload's digest and length are checked."""
    import base64
    import hashlib

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for name, content in zip(rb.column(0).to_pylist(), rb.column(1)):
                rows = []
                for offset, head, body in parse_archive(content.as_py()):
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                    kind = head["WARC-Type"]
                    if kind == "response" and (len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
                        raise ValueError(f"{name} at {offset}: payload differs from its digest")
                    uri = head["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    rows.append((head["WARC-Date"], _page(head["WARC-Record-ID"]), uri, kind, size, digest, _page(head.get("WARC-Refers-To")), name.rsplit("/", 1)[-1], offset))
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["ts", "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "archive", "offset"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    schema = ", ".join(x.strip() for x in INDEX.split(", ") if not x.startswith("url_key"))
    captures = files.mapInArrow(per_batch, schema)
    cols = [x.split()[0] for x in INDEX.split(", ")]
    return captures.withColumn("url_key", url_key(F.col("url"))).select(cols).sortWithinPartitions("archive", "url_key", "ts", "page_id", "offset")


class LoserTree:
    """k-way merge: each inner node keeps the loser of its match, so a pop replays one path."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.k
        self.winner = self._build(1)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator:
        while (top := self.heads[self.winner]) is not None:
            yield top
            w = self.winner
            self.heads[w] = next(self.runs[w], None)
            node = (w + self.k) // 2
            while node >= 1:
                if not self._beats(w, self.losers[node]):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def merge_runs(runs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Globally ordered captures: range by (url_key, ts, page_id), then a loser-tree merge in each range.

    A URL with most of the captures is cut by time and page over many ranges.
    Each range holds the index entries of one task, not payloads.  Dealing mixes
    the runs' rows, so each run's share of a range is sorted again where it arrives.
    """
    spark = runs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = runs.columns
    dealt = runs.repartitionByRange(n, "url_key", "ts", "page_id", "archive", "offset").sortWithinPartitions("archive", "url_key", "ts", "page_id", "offset")

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.RecordBatch]] = {}
        for rb in batches:
            ends, at = pc.run_end_encode(rb.column(cols.index("archive"))), 0
            for stop, name in zip(ends.run_ends.to_pylist(), ends.values.to_pylist()):
                held.setdefault(name, []).append(rb.slice(at, stop - at))
                at = stop
        if not held:
            return
        parts = [p for run in held.values() for p in run]
        schema, first = parts[0].schema, 0

        def entries(lo: int, hi: int) -> Iterator[tuple]:
            for n in range(lo, hi):
                url, ts, page, offset = (parts[n].column(cols.index(c)).to_pylist() for c in ("url_key", "ts", "page_id", "offset"))
                for i, (u, t, p, o) in enumerate(zip(url, ts, page, offset)):
                    yield u, t, -(1 << 63) if p is None else p, o, n, i

        runs_ = []
        for run in held.values():
            runs_.append(entries(first, first + len(run)))
            first += len(run)
        rows, starts = pa.Table.from_batches(parts, schema), np.cumsum([0, *map(len, parts)])
        merged = iter(LoserTree(runs_))
        while some := list(islice(merged, 4096)):
            yield from rows.take(pa.array([starts[e[4]] + e[5] for e in some])).combine_chunks().to_batches()

    return dealt.mapInArrow(per_partition, INDEX)


def archive_pages(pages: DataFrame, min_bytes: int = 0, per_archive: int = 1000) -> tuple[DataFrame, str]:
    """Write pages (page_id, url, html) as WARC files, read them back, and return the capture index and their folder."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    folder = scratch.path("archives")
    write_archives(plan_records(pages, scratch, min_bytes), folder, per_archive)
    return merge_runs(scratch.keep(read_runs(spark, folder), "runs")), folder


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archives."""
    index, _ = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_HEX = "sha1(coalesce(html, ''))"
_GROUP = "CAST('0x' || substr(h, {0}, 5) AS INTEGER)"
_LETTERS = " || ".join(f"substr('{ALPHABET}', (({_GROUP.format(5 * i + 1)} >> {s}) & 31) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0))
OP4_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, {_HEX} AS h FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_LETTERS} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM t
"""
