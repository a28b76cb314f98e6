"""Line dedup over levelled sorted runs of line hashes.

The index is a log-structured set of *runs*.  A run is a table of
(h1, h2, docs, newest): a 128-bit hash of a line key, the number of documents
that hold it and the largest of their ids, sorted by hash within its partitions.
Adding a batch of documents makes one run at level 0; when a level holds
``fan_in`` runs they are merged into one run of the next level, so a key is
rewritten once per level.  A batch's keys are merge-anti-joined with the runs:
a key is *settled* once enough documents hold it and a newer document than the
batch's has it, and settled keys add nothing.  Batches go from the newest
documents to the oldest, so each common line is soon settled; the rest of the
batch becomes its own run.

Documents are then rewritten by a join of their own lines' hashes with the keys
that enough documents hold; a key keeps its lines in the newest document only.
Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.columns import set_aside
from spindrift.plans.scratch import Scratch

#: Stripped at both ends of a line: space, tab, newline, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ("h1", "h2")


def line_key(line: Column) -> Column:
    """A line without blanks at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row, pos, h1, h2) of each line whose key is long enough.

    The length is tested on the stripped line, which lower-casing A-Z keeps, so
    short lines never reach the slower functions.  Casing applies to the lines
    that have capitals only.
    """
    text = F.coalesce("text", F.lit(""))
    at = docs.select("doc_id", row_hash().alias("row"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    at = at.select("doc_id", "row", "pos", F.btrim("line", F.lit(BLANKS)).alias("line")).where(F.length("line") >= min_chars)
    at = at.select("doc_id", "row", "pos", F.translate("line", UPPER, LOWER).alias("key"))
    return at.select("doc_id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def row_hash() -> Column:
    """Tells rows with the same doc_id but other texts apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


class LineRuns:
    """Levelled sorted runs of line hashes."""

    def __init__(self, scratch: Scratch, min_chars: int = 20, min_docs: int = 3, fan_in: int = 4):
        self.scratch, self.min_chars, self.min_docs, self.fan_in = scratch, min_chars, min_docs, fan_in
        self.levels: list[list[DataFrame]] = []

    def add(self, docs: DataFrame) -> None:
        """Add a batch of documents; no document may come in two batches."""
        keys = _lines(docs, self.min_chars).select(*HASH, "doc_id").distinct()
        run = keys.groupBy(*HASH).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("newest"))
        if any(self.levels):
            settled = self.merged().where(F.col("docs") >= self.min_docs).select(*HASH, F.col("newest").alias("_newest"))
            s = settled.alias("s")
            run = run.alias("r").join(s, [F.col(f"r.{h}") == F.col(f"s.{h}") for h in HASH] + [F.col("s._newest") >= F.col("r.newest")], "left_anti")
        self._place(0, run)

    def _place(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self.scratch.keep(run.sortWithinPartitions(*HASH), f"run-{level}"))
        if len(self.levels[level]) >= self.fan_in:
            held, self.levels[level] = self.levels[level], []
            self._place(level + 1, self._fold(held))
            for r in held:
                self.scratch.drop(r)

    @staticmethod
    def _fold(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy(*HASH).agg(F.sum("docs").alias("docs"), F.max("newest").alias("newest"))

    def merged(self) -> DataFrame:
        """All runs folded: (h1, h2, docs, newest)."""
        return self._fold([r for held in self.levels for r in held])


def split_batches(docs: DataFrame, batches: int) -> list[DataFrame]:
    """Ranges of doc_id, largest first, which a scan of an ordered table can skip by; nulls come last."""
    if batches <= 1:
        return [docs]
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return [docs]
    first = [docs.where(F.col("doc_id").isNull() | (F.col("doc_id") <= cuts[0]))]
    parts = first + [docs.where((F.col("doc_id") > lo) & (F.col("doc_id") <= hi)) for lo, hi in zip(cuts, cuts[1:])] + [docs.where(F.col("doc_id") > cuts[-1])]
    return parts[::-1]


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fan_in: int = 4) -> DataFrame:
    """Add ``n_lines``, ``n_dropped`` and ``kept`` to the columns of ``docs``.

    Keys of at least ``min_chars`` code points that at least ``min_docs``
    documents (distinct non-null doc_ids) hold lose all their lines but those of
    the largest doc_id.  A null or empty text is one empty line; a document all
    of whose lines go has an empty ``kept``.  Rows that share a doc_id count as
    one document; each is rewritten by its own lines.  Lines of a null doc_id do
    not count and stay.  Columns of ``docs`` with the names of the added ones are
    replaced.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    docs, back = set_aside(docs, ("doc_id", "text"))
    runs = LineRuns(scratch, min_chars, min_docs, fan_in)
    named = docs.select("doc_id", "text").where("doc_id is not null")
    for batch in split_batches(named, batches):
        runs.add(batch)
    common = scratch.keep(runs.merged().where(F.col("docs") >= min_docs).select(*HASH, "newest"), "common")
    gone = _lines(named, min_chars).join(common, list(HASH)).where("doc_id <> newest")
    gone = gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("_gone")).withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    gone = scratch.keep(gone, "gone")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    # one plan at every size: the texts are always dealt by document, never met by a broadcast that a larger input would lose
    joined = docs.join(gone.hint("merge"), (docs["doc_id"] == gone["_id"]) & (row_hash() == gone["_row"]), "left")
    kept = F.when(F.col("_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(_without(lines, F.col("_gone")), "\n"))
    out = joined.select(*[docs[c] for c in docs.columns], F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.array_size("_gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
    return back(out, "n_lines", "n_dropped", "kept")


def _without(lines: Column, gone: Column) -> Column:
    """The lines at positions other than these, in order."""
    return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The columns of ``docs`` with repeated lines taken out of ``text`` (and n_chars counted anew); every document stays."""
    inside, back = set_aside(docs, ("doc_id", "text", "n_chars"))
    out = dedup_lines(inside, min_chars, min_docs)
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))
    cols = [text.alias("text") if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in inside.columns]
    return back(out.select(*cols))


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Line counts and digest of what is kept, for every document."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS newest FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.newest AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
