"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

Reference blocks are cut by content.  In each run of ``window`` words the
``gram``-word shingle with the smallest hash is the run's *anchor*; consecutive
windows with one anchor form a block, so equal passages are cut into equal blocks
wherever they stand, and a window's occurrences all lie in blocks of its anchor.
The index keeps, for each distinct block, the place where it starts first; blocks
that share an anchor but differ are indexed window by window.

A document is parsed greedily against the index: a factor goes on while the next
window's earliest place follows the last one's, and at each factor's end the
windows across the boundary are looked up as well.  Factors of at least
``window`` words whose place is earlier are duplicate spans.

Blocks whose anchor occurs once in the corpus hold no repeated window and leave
after one count by anchor (about an eighth of the words, summed before the
shuffle); only the rest is joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.words import WORD_BASE, Block, block_of, in_blocks, span_hashes
from spindrift.plans.scratch import Scratch

PLACES = "doc_id long, row int"
FACTORS = "array<struct<start:int,length:int,ref_doc:long,ref_start:int>>"


def _windows(b: Block, window: int) -> np.ndarray:
    """First words of the windows that lie within one document."""
    n = len(b.starts)
    i = np.arange(max(0, n - window + 1))
    if not len(i):
        return i
    ends = np.repeat(b.doc_to, b.doc_to - b.doc_from)
    return i[ends[i] >= i + window]


def blocks_of(b: Block, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Content-defined blocks: document, first window, number of windows, anchor hash, body hash."""
    wh = b.word_hashes()
    s = _windows(b, window)
    if not len(s):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none
    at = np.arange(len(wh) - gram + 1)
    g = span_hashes(wh, at, at + gram, WORD_BASE)
    view = np.lib.stride_tricks.sliding_window_view(g, window - gram + 1)
    anchor = np.empty(len(s), dtype=np.int64)
    for i in range(0, len(s), 1 << 16):
        anchor[i : i + (1 << 16)] = s[i : i + (1 << 16)] + view[s[i : i + (1 << 16)]].argmin(axis=1)
    head = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (s[1:] != s[:-1] + 1))))
    count = np.diff(np.concatenate((head, [len(s)])))
    first = s[head]
    body = span_hashes(wh, first, first + count + window - 1, WORD_BASE)
    doc = np.searchsorted(b.doc_to, first, side="right")
    return doc, first - b.doc_from[doc], count, g[anchor[head]].view(np.int64), body.view(np.int64)


def _bytes(column: pa.Array) -> list[bytes]:
    return [t.encode() if t is not None else b"" for t in column.to_pylist()]


def index_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """One row for each block: anchor, body, doc_id, row, start, n (windows)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids, rows, texts = rb.column(0), rb.column(1), _bytes(rb.column(2))
            for at, part in in_blocks(texts):
                doc, start, count, anchor, body = blocks_of(block_of(part), window, gram)
                where = pa.array(doc + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(body), ids.take(where), rows.take(where), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["anchor", "body", "doc_id", "row", "start", "n"],
                )

    return docs.mapInArrow(per_batch, f"anchor long, body long, {PLACES}, start int, n int")


def window_rows(joined: DataFrame, window: int) -> DataFrame:
    """One row for each window of the listed blocks: anchor, body, i, win, doc_id, start."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids, texts = rb.column(0), _bytes(rb.column(1))
            lists = rb.column(2).to_pylist()
            for at, part in in_blocks(texts):
                b = block_of(part)
                wh = b.word_hashes()
                asked = [(k, x["start"], x["n"], x["anchor"], x["body"]) for k in range(len(part)) for x in lists[at + k]]
                doc, start, count, anchor, body = (np.array(x, dtype=np.int64) for x in zip(*asked))
                many = np.repeat(np.arange(len(doc)), count)
                i = np.arange(len(many)) - np.repeat(np.cumsum(count) - count, count)
                s = (b.doc_from[doc] + start)[many] + i
                win = span_hashes(wh, s, s + window, WORD_BASE).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[many]), pa.array(body[many]), pa.array(i.astype(np.int32)), pa.array(win), ids.take(pa.array((doc + at)[many])), pa.array((start[many] + i).astype(np.int32))],
                    names=["anchor", "body", "i", "win", "doc_id", "start"],
                )

    return joined.mapInArrow(per_batch, "anchor long, body long, i int, win long, doc_id long, start int")


def parse(starts: np.ndarray, ref_docs: list, ref_starts: np.ndarray, window: int) -> list[tuple[int, int, object, int]]:
    """Greedy factors (start, words, ref_doc, ref_start) from repeated windows in order of start.

    Windows follow each other in one factor while their places do; a window
    across a factor's boundary opens the next factor.
    """
    out: list[list] = []
    for s, d, r in zip(starts.tolist(), ref_docs, ref_starts.tolist()):
        if out and d == out[-1][2] and s == out[-1][0] + out[-1][1] - window + 1 and r == out[-1][3] + s - out[-1][0]:
            out[-1][1] += 1
        else:
            out.append([s, window, d, r])
    return [tuple(x) for x in out]


def duplicate_spans(docs: DataFrame, scratch: Scratch, window: int = 20, gram: int = 5) -> DataFrame:
    """(doc_id, row, factors) for the documents that repeat a window which starts earlier."""
    rows = index_rows(docs.select("doc_id", "row", "text"), window, gram)
    shared = scratch.keep(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"), "shared-anchors")
    scratch.free()
    cand = scratch.keep(rows.join(shared, "anchor", "left_semi"), "blocks")
    scratch.drop(shared)
    scratch.free()
    # a missing id is the smallest; structs order their fields so
    place = F.struct("doc_id", "start", "row", "n")
    blocks = scratch.keep(cand.groupBy("anchor", "body").agg(F.min(place).alias("first")), "distinct-blocks")
    mixed = scratch.keep(blocks.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"), "mixed-anchors")
    differing = blocks.join(mixed, "anchor", "left_semi").select(F.col("first.doc_id").alias("_d"), F.col("first.row").alias("_r"), F.struct(F.col("first.start").alias("start"), F.col("first.n").alias("n"), "anchor", "body").alias("x"))
    asked = scratch.keep(differing.groupBy("_d", "_r").agg(F.collect_list("x").alias("xs")), "asked")
    scratch.drop(mixed)
    texts = docs.select("doc_id", "row", "text")
    found = texts.join(asked.hint("merge"), texts["doc_id"].eqNullSafe(asked["_d"]) & (texts["row"] == asked["_r"])).select("doc_id", "text", "xs")
    wins = scratch.keep(window_rows(found, window), "windows")
    scratch.drop(asked)
    scratch.free()
    least = scratch.keep(wins.groupBy("anchor", "win").agg(F.min(F.struct("doc_id", "start")).alias("w")), "first-windows")
    refs = wins.join(least, ["anchor", "win"]).groupBy("anchor", "body").agg(F.array_sort(F.collect_set(F.struct("i", "w"))).alias("ws"))
    refs = scratch.keep(refs, "block-windows")
    scratch.drop(wins, least)
    index = scratch.keep(blocks.join(refs, ["anchor", "body"], "left").select("anchor", "body", "first", F.col("ws.w").alias("ws")), "index")
    scratch.drop(blocks, refs)
    scratch.free()
    hits = cand.join(index, ["anchor", "body"])
    # a block no other differs from repeats as a whole; else each of its windows has its own first place
    own = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.struct(
            (F.col("start") + i).alias("s"),
            F.when(F.col("ws").isNull(), F.col("first.doc_id")).otherwise(F.get("ws", i)["doc_id"]).alias("d"),
            F.when(F.col("ws").isNull(), F.col("first.start") + i).otherwise(F.get("ws", i)["start"]).alias("r"),
        ),
    )
    repeated = F.filter(own, lambda x: ~(x["d"].eqNullSafe(F.col("doc_id")) & (x["r"] == x["s"])))
    hits = hits.select("doc_id", "row", repeated.alias("rep")).where(F.size("rep") > 0)
    out = scratch.keep(hits.groupBy("doc_id", "row").agg(F.sort_array(F.flatten(F.collect_list("rep"))).alias("rep")), "repeats")
    scratch.drop(cand, index)
    scratch.free()
    return out


def dedup_substrings(docs: DataFrame, window: int = 20, gram: int = 5) -> DataFrame:
    """Add n_words, n_removed, kept (words joined by one space) and factors to (doc_id, text).

    A word is removed if a window of ``window`` words that covers it also starts
    earlier: in a smaller doc_id (null is the smallest), or earlier in the same
    document.  Texts of fewer words keep everything; null has no words.  Rows
    that share a doc_id are one document whose windows are placed by start, so
    exactly repeated rows keep what one of them keeps.  Extra columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(F.coalesce("text", F.lit(""))).alias("row"), F.col("text").cast("string").alias("text"))
    spans = duplicate_spans(own, scratch, window, gram).withColumnsRenamed({"doc_id": "_d", "row": "_r"})
    joined = own.join(spans.hint("merge"), own["doc_id"].eqNullSafe(spans["_d"]) & (own["row"] == spans["_r"]), "left").select("doc_id", "text", "rep")

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            n_words, n_removed, kept, factors = [], [], [], []
            for text, rep in zip(rb.column(1), rb.column(2)):
                words = (text.as_py() or "").encode().split()
                found: list = []
                if rep.is_valid:
                    flat = rep.values
                    s, d, r = flat.field("s").to_numpy(), flat.field("d").to_pylist(), flat.field("r").to_numpy()
                    once = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
                    found = parse(s[once], [d[i] for i in once], r[once], window)
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    for start, length, _, _ in found:
                        edge[start] += 1
                        edge[start + length] -= 1
                    stays = np.cumsum(edge[:-1]) == 0
                    left = [w for w, k in zip(words, stays) if k]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                factors.append([dict(zip(("start", "length", "ref_doc", "ref_start"), f)) for f in found])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(factors, kind)],
                names=["doc_id", "n_words", "n_removed", "kept", "factors"],
            )

    return joined.mapInArrow(per_batch, f"doc_id long, n_words long, n_removed long, kept string, factors {FACTORS}")


def digest(kept: str) -> str:
    """SHA-256 of kept text, as the query reports it."""
    return hashlib.sha256(kept.encode()).hexdigest()


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words removed from each document and the digest of the rest."""
    out = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
again AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM again),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
