"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark item gives windows of ``window`` words (a shorter item is one
window).  A document contains a window only if it contains every token of it, so
the necessary prefix of a window, its tokens ordered by rarity in the corpus, is
its single rarest token.  Document words meet the prefix tokens in an equi-join;
the position of the token in the window gives the only place where the window can
start, the length bound and the document's ends discard places that can't hold
it, and what is left is verified word by word.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.columns import set_aside
from spindrift.plans.scratch import Scratch

#: Between words, once A-Z are lower-cased; and the same before that.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text: Column) -> Column:
    """Lower-cased words in order; a text that starts or ends with a break has an empty string there, which no window holds."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAKS)


def item_windows(items: DataFrame, window: int = 13) -> DataFrame:
    """(win, len, items): the distinct windows and the ids of the items that hold them."""
    w = items.select("item_id", F.filter(word_array(F.col("text")), lambda x: x != "").alias("w")).where("size(w) > 0")
    w = w.withColumn("len", F.least(F.lit(window), F.size("w"))).withColumn("i", F.explode(F.expr("sequence(1, size(w) - len + 1)")))
    return w.select("item_id", F.slice("w", F.col("i"), F.col("len")).alias("win"), "len").groupBy("win", "len").agg(F.collect_set("item_id").alias("items"))


def prefixes(windows: DataFrame, words: DataFrame, scratch: Scratch, bound: int) -> DataFrame:
    """Add each window's rarest token and its offset from 0; ``words``: one column, every word of the corpus."""
    vocabulary = scratch.keep(windows.select(F.explode("win").alias("token")).distinct(), "vocabulary")
    small = vocabulary.count() <= bound
    counts = words.join(F.broadcast(vocabulary) if small else vocabulary, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = scratch.keep(counts, "rarity")
    at = windows.select("win", "len", "items", F.posexplode("win").alias("offset", "token")).join(counts, "token", "left")
    # a token that the corpus lacks can't occur: such windows leave with it
    first = at.groupBy("win", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("p"), F.first("items").alias("items"))
    return first.where("p.n > 0").select("win", "len", "items", F.col("p.token").alias("token"), F.col("p.offset").alias("offset"))


def find_windows(docs: DataFrame, items: DataFrame, scratch: Scratch, window: int = 13, bound: int = 200_000) -> DataFrame:
    """(doc_id, row, start, len, items) of every occurrence of an item's window in ``docs`` (doc_id, row, text).

    Windows and vocabulary are broadcast up to ``bound`` rows; beyond that the
    candidates are shuffled by token and verified by a join with their texts.
    """
    windows = scratch.keep(item_windows(items, window), "windows")
    texts = docs.select("doc_id", "row", word_array(F.col("text")).alias("words"))
    keys = scratch.keep(prefixes(windows, texts.select(F.explode("words").alias("token")), scratch, bound), "prefixes")
    fits = (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("len") <= F.col("n"))
    start = F.col("pos") - F.col("offset")
    if keys.count() <= bound:
        at = texts.select("doc_id", "row", "words", F.size("words").alias("n"), F.posexplode("words").alias("pos", "token"))
        found = at.join(F.broadcast(keys), "token").where(fits).where(F.slice("words", start + 1, F.col("len")) == F.col("win"))
        return found.select("doc_id", "row", start.alias("start"), "len", "items")
    at = texts.select("doc_id", "row", F.size("words").alias("n"), F.posexplode("words").alias("pos", "token"))
    cand = at.join(keys, "token").where(fits).select("doc_id", "row", F.struct(start.alias("start"), "len", "win", "items").alias("c"))
    cand = cand.groupBy("doc_id", "row").agg(F.collect_list("c").alias("cs")).withColumnsRenamed({"doc_id": "_d", "row": "_r"})
    both = texts.join(cand, texts["doc_id"].eqNullSafe(cand["_d"]) & (texts["row"] == cand["_r"]))
    true = F.filter("cs", lambda c: F.slice(F.col("words"), c["start"] + 1, c["len"]) == c["win"])
    return both.select("doc_id", "row", F.explode(true).alias("c")).select("doc_id", "row", "c.start", "c.len", "c.items")


def covered(spans: Column) -> Column:
    """Words covered by a set of (start, len), each counted once."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc, s):
        end = s["start"] + s["len"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], s["start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, per: int = 20, bound: int = 200_000) -> DataFrame:
    """Add n_words, n_hit, items (array of item_id) and contaminated to the columns of ``docs``.

    contaminated: some word is hit, and at least one in ``per`` words.  Null and
    empty texts have no words; items without words give no window; items that
    share an item_id count as one id.  Repeated rows each get the same result;
    rows that share a doc_id are judged each by its own text.  Columns of ``docs``
    with the names of the added ones are replaced.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    docs, back = set_aside(docs, ("doc_id", "text"))
    row = F.xxhash64(F.coalesce("text", F.lit("")))
    own = docs.select("doc_id", row.alias("row"), "text")
    found = find_windows(own, items.select("item_id", "text"), scratch, window, bound)
    hits = found.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "len")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"))
    hits = scratch.keep(hits.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), covered(F.col("spans")).alias("_hit"), "_items"), "hits")
    n_words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_ANY_CASE)).cast("long")
    full = docs.withColumns({"_n": n_words, "_row": row})
    out = full.join(hits, full["doc_id"].eqNullSafe(F.col("_d")) & (F.col("_row") == F.col("_r")), "left")
    out = out.withColumns({"_hit": F.coalesce("_hit", F.lit(0)).cast("long"), "_items": F.coalesce("_items", F.expr("cast(array() as array<bigint>)"))})
    out = out.select(*[full[c] for c in docs.columns], F.col("_n").alias("n_words"), F.col("_hit").alias("n_hit"), F.col("_items").alias("items"), ((F.col("_hit") > 0) & (F.col("_hit") * per >= F.col("_n"))).alias("contaminated"))
    return back(out, "n_words", "n_hit", "items", "contaminated")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    inside, back = set_aside(docs, ("doc_id", "text"))
    return back(contamination(inside, items).where("not contaminated"))


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark."""
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i+l-1], ' ') AS k FROM
  (SELECT item_id, w, least(13, len(w)) AS l, unnest(range(1, CAST(len(w) - least(13, len(w)) + 2 AS BIGINT))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT l FROM wins),
dw AS (SELECT doc_id, l, i, array_to_string(w[i:i+l-1], ' ') AS k FROM
  (SELECT doc_id, w, l, unnest(range(1, CAST(len(w) - l + 2 AS BIGINT))) AS i FROM d, lens WHERE len(w) >= l)),
m AS (SELECT dw.doc_id, dw.i, dw.l, wins.item_id FROM dw JOIN wins ON dw.k = wins.k AND dw.l = wins.l),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
