"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of slots of equally many words.  Slot ``j`` takes the point
``frac((j + 1) / golden ratio)``, and the source whose share of the unit interval
holds the point; consecutive slots therefore follow the target shares closely at
every prefix of the schedule.  A source with too few points for its target shares
further slots, spread evenly, with their own sources.  A source's slots are
ranked, and slot rank ``r`` takes the source's ``r``-th block: its documents stand
in a shuffled order (by hash), their words form one stream that may be repeated up
to ``max_repeats`` times, and the stream up to the target is cut into as many
equal blocks as the source has slots.  Every target is met to a word.

Prefix sums are two-level (source and hash bucket), so a source with most of the
rows is spread over many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrift.plans.scratch import Scratch

#: Fractional part of the golden ratio.
GOLDEN = 0.6180339887498949
#: Repeating weights of the sources in code point order, null last.
WEIGHTS = (1, 2, 3)


@dataclass(frozen=True)
class Share:
    source: str | None
    size: int
    target: float


def fill_targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, max_repeats: int = 3) -> list[Share]:
    """Share the sum of all sizes by weight; no target above ``max_repeats`` sizes.

    The excess is shared again by weight among the sources below their limit.
    Sources stand in code point order, null last; sizes of 0 get a target of 0.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    total = sum(n for _, n in order)
    weight = [weights[i % len(weights)] for i in range(len(order))]
    target, left, free = [0.0] * len(order), float(total), set(range(len(order)))
    while free:
        level = left / sum(weight[i] for i in free)
        full = {i for i in free if level * weight[i] > max_repeats * order[i][1]}
        for i in full or free:
            target[i] = float(max_repeats * order[i][1]) if full else level * weight[i]
        if not full:
            break
        left -= sum(target[i] for i in full)
        free -= full
    return [Share(s, n, t) for (s, n), t in zip(order, target)]


def _prefix_sums(docs: DataFrame, scratch: Scratch, buckets: int) -> DataFrame:
    """Add ``at``: the words that stand before a document in its source's shuffled order."""
    keyed = docs.withColumn("_h", F.xxhash64("doc_id", "_row")).withColumn("_b", F.pmod("_h", F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("_s", "_b").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    start = scratch.keep(sums.select(F.col("_s").alias("_s2"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from")), "starts")
    inside = Window.partitionBy("_s", "_b").orderBy("_h", "doc_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(start, (F.col("_s") == F.col("_s2")) & (F.col("_b") == F.col("_b2")))
    return joined.withColumn("at", F.col("_from") + F.col("_in")).drop("_s2", "_b2", "_from", "_in", "_h", "_b")


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    max_repeats: int = 3,
    slots: int = 1 << 20,
    buckets: int = 1024,
    max_sources: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """Return (documents, schedule).

    documents: a row for each input row with doc_id, source, size, source_size,
    target and taken.  schedule: (slot, source, rank, doc_id, start, length,
    copy), the words of each document that each slot takes, ``start`` from 0.

    size is the number of ``[^\\x20\\x09-\\x0D]+`` in the text, 0 for null.  A null
    source is a source of its own.  Rows that share a doc_id are mixed each for
    itself.  Without any words nothing is taken.  ``slots`` sets the schedule's
    resolution, not how well targets are met.  The sources' totals (at most
    ``max_sources``, one row each) are the only thing the driver reads; more
    sources raise an error.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(
        F.col("doc_id"),
        F.col("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(text).alias("_row"),
    )
    sized = scratch.keep(sized, "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(max_sources + 1).collect()
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources; raise max_sources")
    shares = fill_targets([(r["source"], r["n"]) for r in totals], weights, max_repeats)
    total = sum(x.size for x in shares)
    block = max(1, math.ceil(total / slots))
    n_slots = math.ceil(total / block)
    rows, at = [], 0.0
    for i, x in enumerate(shares):
        end = at + (x.target / total if total else 0.0)
        rows.append((i, x.source, x.size, x.target, math.floor(x.target + 0.5), at, 2.0 if i == len(shares) - 1 else end))
        at = end
    table = spark.createDataFrame(rows, "_s int, _source string, source_size long, target double, words long, lo double, hi double")
    shared = F.broadcast(table)  # at most max_sources rows
    known = sized.join(shared, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "size", "_row", "_s", "source_size", "target", "words")

    point = F.expr(f"(cast(id + 1 as double) * {GOLDEN!r}) % 1.0D")
    schedule = spark.range(n_slots).withColumn("u", point)
    schedule = schedule.join(F.broadcast(table.select("_s", "lo", "hi")), (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("id", "_s")
    # points miss a target by a few slots: what is still needed, at most a block of words a slot, is added
    had = schedule.groupBy("_s").agg(F.count(F.lit(1)).alias("_had"))
    need = F.expr(f"(words + {block - 1}) div {block}")
    per = table.join(had, "_s", "left").select("_s", "words", "lo", F.coalesce("_had", F.lit(0)).cast("long").alias("_had"), need.alias("_need"))
    per = scratch.keep(per, "slots")
    more = per.where("_need > _had").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_need") - F.col("_had"))))
    more = more.select(F.expr(f"least(cast(((lo + i * {GOLDEN!r}) % 1.0D) * {n_slots} as long), {max(n_slots - 1, 0)}L)").alias("id"), "_s")
    schedule = scratch.keep(schedule.unionByName(more), "schedule")
    # ranks are two-level too: a source's slots are counted by runs of slots first
    run = 1 << 14
    schedule = schedule.withColumn("_g", F.expr(f"id div {run}"))
    counts = schedule.groupBy("_s", "_g").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_s").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    first = scratch.keep(counts.select("_s", "_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from")), "slot-runs")
    within = Window.partitionBy("_s", "_g").orderBy("id")
    ranked = schedule.withColumn("_k", F.row_number().over(within) - 1).join(first, ["_s", "_g"]).select("_s", F.col("id").alias("slot"), (F.col("_from") + F.col("_k")).alias("rank"))

    placed = scratch.keep(_prefix_sums(known.where("size > 0"), scratch, buckets), "placed")
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    copies = copies.withColumn("lo", F.col("at") + F.col("copy") * F.col("source_size")).withColumn("hi", F.col("lo") + F.col("size"))
    # rank r of c takes the words from words * r div c of the repeated stream
    cuts = F.broadcast(per.select("_s", F.greatest("_had", "_need").alias("_c")))  # at most max_sources rows
    copies = copies.where("lo < words").withColumn("hi", F.least("hi", "words")).join(cuts, "_s")
    pieces = copies.withColumn("rank", F.explode(F.expr("sequence(((lo + 1) * _c - 1) div words, (hi * _c - 1) div words)")))
    first_word, end_word = F.expr("words * rank div _c"), F.expr("words * (rank + 1) div _c")
    used = pieces.join(ranked, ["_s", "rank"]).select(
        "slot",
        "source",
        "rank",
        "doc_id",
        "_row",
        "_s",
        "at",
        "copy",
        (F.greatest("lo", first_word) - F.col("lo")).alias("start"),
        (F.least("hi", end_word) - F.greatest("lo", first_word)).alias("length"),
    )
    taken = used.groupBy("_s", "at").agg(F.sum("length").alias("_taken")).withColumnsRenamed({"_s": "_s2", "at": "_at"})
    some = placed.join(taken, (F.col("_s") == F.col("_s2")) & (F.col("at") == F.col("_at")), "left")
    cols = ["doc_id", "source", "size", "source_size", "target"]
    out = some.select(*cols, F.coalesce("_taken", F.lit(0)).alias("taken")).unionByName(known.where("size = 0").select(*cols, F.lit(0).cast("long").alias("taken")))
    return out, used.select("slot", "source", "rank", "doc_id", "start", "length", "copy")


def op9_source_mix(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    out, _ = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
