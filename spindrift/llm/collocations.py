"""Phrase collocations from exact n-gram counts.

Texts are cut into pieces at punctuation and line ends, and identical pieces of a
language become one row with a multiplicity.  N-grams are counted level by level.  A
task hashes the n-grams of its pieces in numpy, adds up those that repeat, and sends
each with its weight to a hash bucket; a bucket is summed by duckdb, which spills to
disk beyond its memory limit, and keeps what is frequent enough.  A phrase is never
more frequent than its parts, so a level only sends n-grams whose two parts of one word
less are frequent; that is looked up in a bitmap of fixed size, whose chance hits cost
work but change no count, as buckets count n-grams by their text.

The frequencies of a phrase's parts come from the same table: each phrase sends a
request for every part to the part's bucket, where the two meet, and the answers go
back to the phrase.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrift.llm.lines import LOWER, UPPER
from spindrift.llm.words import _SPACE, WORD_BASE, Block, block_of, mix, span_hashes
from spindrift.plans.scratch import Scratch

#: What ends a piece.
ENDS = r"[.,;:!?\x0A-\x0D]"
GRAMS = "lang string, gram string, weight long"
_U = np.uint64


def pieces_of(docs: DataFrame) -> DataFrame:
    """(lang, piece, n): the distinct pieces that hold a word and how often each stands in the texts; words one space apart, and a line end."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    cut = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.explode(F.split(text, ENDS)).alias("piece"))
    cut = cut.select("lang", F.btrim("piece", F.lit(" \t")).alias("piece")).where("piece <> ''")
    loose = F.col("piece").contains("  ") | F.col("piece").contains("\t")
    cut = cut.withColumn("piece", F.when(loose, F.regexp_replace("piece", "[ \t]+", " ")).otherwise(F.col("piece")))
    return cut.select("lang", F.concat("piece", F.lit("\n")).alias("piece")).groupBy("lang", "piece").agg(F.count(F.lit(1)).alias("n"))


def _gram_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return span_hashes(words, starts, starts + size, WORD_BASE)


def _lang_hashes(langs: list[str]) -> dict[str, np.uint64]:
    return {x: span_hashes(np.frombuffer(b"/" + x.encode(), dtype=np.uint8).astype(_U), np.array([0]), np.array([len(x.encode()) + 1]), WORD_BASE)[0] for x in set(langs)}


def _slots(hashes: np.ndarray, langs: np.ndarray, bits: int) -> np.ndarray:
    """Places in a bitmap of ``2**bits`` bits."""
    return (mix(hashes ^ langs) >> _U(64 - bits)).astype(np.int64)


def _block(pieces: pa.StringArray) -> Block:
    """The words of pieces that each end with a line end, in the bytes as they stand."""
    _, offsets, data = pieces.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]]
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(starts, at - at[0])
    return Block(raw, starts, ends, first[:-1], first[1:])


def _texts(block: Block, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The texts from word ``first`` to word ``last`` each."""
    lo, n = block.starts[first], block.ends[last] - block.starts[first]
    ends = np.cumsum(n)
    data = block.data[np.repeat(lo - (ends - n), n) + np.arange(int(n.sum()))]
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())


def _summed(first: np.ndarray, second: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one index, summed weight) of each run of equal pairs of hashes, ordered by the first."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    at = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, dtype=np.int64)
    return order[at], np.add.reduceat(weight[order], at) if len(at) else weight[:0]


def _level(size: int, bitmap, bits: int, most: int):
    """N-grams of ``size`` words of a task's pieces, added up over about ``most`` bytes of text.

    At the first level a row without a gram has the words of each language.
    """

    def grams(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        lang = table.column(0).combine_chunks().dictionary_encode()
        which, weight = lang.indices.to_numpy(), table.column(2).to_numpy()
        block = _block(table.column(1).combine_chunks())
        per = block.doc_to - block.doc_from
        doc = np.repeat(np.arange(len(per)), per)
        start = np.flatnonzero(np.arange(len(doc)) + size <= block.doc_to[doc])  # where so many words follow in the piece
        name = _lang_hashes(names := lang.dictionary.to_pylist())
        mark = np.array([name[x] for x in names], dtype=_U)[which][doc]
        words = block.word_hashes()
        if size > 1:
            seen, n = bitmap.value, max(len(words) - size + 2, 0)
            part = _slots(_gram_hashes(words, np.arange(n), size - 1), mark[:n], bits)
            hit = (seen[part >> 6] >> (part & 63).astype(_U)) & _U(1) != 0
            start = start[hit[start] & hit[start + 1]]
        own = _gram_hashes(words, start, size) ^ mix(mark[start])
        other = _gram_hashes(block.word_hashes(1), start, size)
        one, total = _summed(own, other, weight[doc[start]])
        at = start[one]
        for lo in range(0, len(at), 200_000):
            some = at[lo : lo + 200_000]
            its = pa.DictionaryArray.from_arrays(pa.array(which[doc[some]]), lang.dictionary).cast(pa.string())
            yield pa.RecordBatch.from_arrays([its, _texts(block, some, some + size - 1), pa.array(total[lo : lo + 200_000])], names=["lang", "gram", "weight"])
        if size == 1:
            held = np.zeros(len(names), dtype=np.int64)
            np.add.at(held, which, per * weight)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.nulls(len(names), pa.string()), pa.array(held)], names=["lang", "gram", "weight"])

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bytes_held = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                bytes_held += b.column(1).nbytes
            if bytes_held >= most:
                yield from grams(held)
                held, bytes_held = [], 0
        if held:
            yield from grams(held)

    return per_task


def _buckets(least: int, memory: str):
    """Sum a bucket's weights in duckdb, which spills beyond ``memory``; rows below ``least`` go, those without a gram stay."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("weight", pa.int64())])
        with tempfile.TemporaryDirectory() as spill, duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": spill}) as db:
            sent = pa.RecordBatchReader.from_batches(schema, (b.cast(schema) for b in batches))
            db.register("sent", sent)
            total = db.execute("SELECT lang, gram, CAST(sum(weight) AS BIGINT) AS weight FROM sent GROUP BY ALL HAVING gram IS NULL OR sum(weight) >= ?", [least])
            for b in total.to_arrow_reader(50_000):
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(pa.string()), b.column(2).cast(pa.int64())], schema=schema)

    return per_task


def _bitmap(spark: SparkSession, grams: DataFrame, bits: int):
    """A broadcast bitmap of ``2**bits`` bits, whatever the number of grams."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            langs = b.column(0).to_pylist()
            block = block_of(b.column(1).cast(pa.binary()).to_pylist())
            name = _lang_hashes(langs)
            slot = _slots(span_hashes(block.word_hashes(), block.doc_from, block.doc_to, WORD_BASE), np.array([name[x] for x in langs], dtype=_U), bits)
            yield pa.RecordBatch.from_arrays([pa.array(slot >> 6), pa.array((slot & 63).astype(np.int32))], names=["cell", "bit"])

    cells = grams.select("lang", "gram").mapInArrow(places, "cell long, bit int")
    cells = cells.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("held"))
    table = cells.toArrow()  # at most 2**bits / 64 rows of 16 bytes
    seen = np.zeros(1 << (bits - 6), dtype=_U)
    seen[table["cell"].to_numpy()] = table["held"].to_numpy().view(_U)
    return spark.sparkContext.broadcast(seen)


def count_grams(pieces: DataFrame, scratch: Scratch, least: int = 30, longest: int = 4, bits: int = 25, memory: str = "256MB", most: int = 4 << 20) -> list[DataFrame]:
    """(lang, gram, weight) for each number of words up to ``longest``: n-grams that occur at least ``least`` times.

    The first table also has a row without a gram for each language: its words.
    ``bits`` and ``memory`` bound the bitmap and a bucket's sums; they change no result.
    """
    spark, levels = pieces.sparkSession, []
    for size in range(1, longest + 1):
        bitmap = _bitmap(spark, levels[-1].where("gram is not null"), bits) if levels else None
        sent = pieces.select("lang", "piece", "n").mapInArrow(_level(size, bitmap, bits, most), GRAMS)
        summed = sent.repartition(F.col("lang"), F.col("gram")).mapInArrow(_buckets(least, memory), GRAMS)
        levels.append(scratch.keep(summed, f"grams-{size}"))
        if bitmap:
            bitmap.unpersist()
    return levels


def _words_of(gram: Column) -> Column:
    return F.split(gram, " ")


def _joined(start: Column | int, size: Column) -> Column:
    """``size`` of the words from ``start`` on, as a phrase."""
    return F.array_join(F.slice("words", start, size), " ")


def scored(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of every frequent phrase of two words or more, by its lowest-scoring cut."""
    grams = levels[0].where("gram is not null")
    for x in levels[1:]:
        grams = grams.unionByName(x)
    phrases = levels[1]
    for x in levels[2:]:
        phrases = phrases.unionByName(x)
    phrases = phrases.select("lang", F.col("gram").alias("phrase"), F.col("weight").alias("a"), _words_of(F.col("gram")).alias("words"))
    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    sides = F.array(
        F.struct(F.lit("l").alias("side"), _joined(1, F.col("k")).alias("part")),
        F.struct(F.lit("r").alias("side"), _joined(F.col("k") + 1, F.size("words")).alias("part")),
    )
    requests = cuts.select("lang", "phrase", "a", "k", F.explode(sides).alias("s")).select("lang", "phrase", "a", "k", "s.side", F.col("s.part").alias("gram"))
    answers = requests.join(grams, ["lang", "gram"])
    f = lambda side: F.max(F.when(F.col("side") == side, F.col("weight")))
    both = answers.groupBy("lang", "phrase", "a", "k").agg(f("l").alias("l"), f("r").alias("r"))
    both = both.withColumn("score", F.expr("cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    lowest = F.min(F.struct("score", "k", "l", "r"))
    return both.groupBy("lang", "phrase", "a").agg(lowest.alias("x")).select("lang", "phrase", _words_of(F.col("phrase")).alias("words"), "a", "x.l", "x.r", "x.score")


def maximal(phrases: DataFrame, percent: int = 80) -> DataFrame:
    """Phrases that stand in no longer one with at least ``percent`` hundredths of their frequency."""
    n = F.size("words")
    inner = phrases.where(n > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), n - 1)).alias("size"))
    inner = inner.select("lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), n - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", _joined(F.col("at"), F.col("size")).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    wide = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by).cast("decimal(10,0)")
    out = phrases.join(longer, ["lang", "phrase"], "left")
    return out.where(F.col("_longer").isNull() | (wide("_longer", 100) < wide("a", percent))).drop("_longer")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, percent: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    ``docs`` has text and lang; other columns are ignored.  A null text is empty, a
    null lang is ``und``.  A repeated row counts again.  Phrases occur at least
    ``least`` times.  Ties of score go to the larger frequency, then to
    the phrase in byte order.  A language without phrases has no rows.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    pieces = scratch.keep(pieces_of(docs), "pieces")
    levels = count_grams(pieces, scratch, least, longest)
    total = levels[0].where("gram is null").select("lang", F.col("weight").alias("n"))
    phrases = scratch.keep(scored(levels), "phrases")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # the first rows of each task are cut off before they meet
    ranked = maximal(phrases, percent).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """Each language's leading phrases."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS MATERIALIZED (
  SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS gram, count(*) AS f FROM pieces, range(1, 5) z(s), unnest(range(1, greatest(len(w) - s + 2, 1))) t(i) GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, s, gram AS phrase, string_split(gram, ' ') AS w, f AS a FROM grams WHERE s > 1),
parts AS MATERIALIZED (
  SELECT lang, s, phrase, a, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:], ' ') AS two FROM cand, range(1, 4) t(k) WHERE k < s),
cuts AS (
  SELECT p.lang, p.s, p.phrase, p.a, p.k, x.f AS l, y.f AS r, CAST((2000000 * CAST(p.a AS HUGEINT)) // (x.f + y.f) AS BIGINT) AS score
  FROM parts p JOIN grams x ON x.lang = p.lang AND x.gram = p.one JOIN grams y ON y.lang = p.lang AND y.gram = p.two),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, max(a) AS longer FROM cand, range(2, 4) q(z), range(1, 4) t(i) WHERE z < s AND i <= s - z + 1 GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""
