"""Barcodes assigned to the nearest sequence of a reference set."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.functions.seq import hamming, one_hot
from spindrift.operators import plain
from spindrift.plans.scratch import Scratch, dealt


def block_pairs(sequence: Column, max_distance: int) -> Column:
    """Keys of a sequence: of ``max_distance + 2`` blocks every two, with their places and the length.

    Sequences of one length with at most ``max_distance`` differing positions share at
    least one key.
    """
    k, n = max_distance + 2, F.length(sequence)
    edge = lambda i: F.floor(n * i / k).cast("int")
    blocks = [F.substr(sequence, edge(i) + 1, edge(i + 1) - edge(i)) for i in range(k)]
    return F.array(*[F.xxhash64(F.lit(i * k + j), n, blocks[i], blocks[j]) for i, j in combinations(range(k), 2)])


def nearest_reference(probes: DataFrame, references: DataFrame, max_distance: int = 1, column: str = "vbc_read", reference: str = "vbc_read") -> DataFrame:
    """(sequence, reference, distance) of the distinct probes that have a reference within ``max_distance``.

    Distances count differing positions of sequences of one length.  The nearest
    reference wins, of several the smallest.  Equal sequences meet in one join; only
    what is left is looked up under its pairs of blocks, so neither side is ever joined
    with itself.  The references' index has a row for every pair of blocks; Spark
    broadcasts it while it is below its threshold and shuffles it beyond.
    """
    refs = references.select(F.col(reference).alias("reference")).where("reference is not null").distinct()
    seqs = probes.select(F.col(column).alias("sequence")).where("sequence is not null").distinct()
    found = seqs.join(refs.select(F.col("reference").alias("sequence")), "sequence", "left_semi").select("sequence", F.col("sequence").alias("reference"), F.lit(0).alias("distance"))
    if max_distance < 1:
        return found
    rest = seqs.join(refs.select(F.col("reference").alias("sequence")), "sequence", "left_anti")
    index = refs.select("reference", one_hot(F.col("reference")).alias("_b"), F.explode(block_pairs(F.col("reference"), max_distance)).alias("_key"))
    asked = rest.select("sequence", one_hot(F.col("sequence")).alias("_a"), F.explode(block_pairs(F.col("sequence"), max_distance)).alias("_key"))
    met = asked.join(index, "_key").where(F.length("sequence") == F.length("reference"))
    same = F.aggregate(F.zip_with("_a", "_b", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda acc, x: acc + x)
    near = met.withColumn("distance", F.coalesce(F.length("sequence") - same, hamming(F.col("sequence"), F.col("reference"))))
    near = near.where(F.col("distance") <= max_distance).groupBy("sequence").agg(F.min(F.struct("distance", "reference")).alias("x"))
    return found.unionByName(near.select("sequence", "x.reference", F.col("x.distance").cast("int").alias("distance")))


def nearest_plain(seqs: DataFrame, max_distance: int = 1) -> DataFrame:
    """(seq, reference) of the probes of ``seqs`` (seq, probe, ref) that have a reference within ``max_distance``.

    As :func:`nearest_reference`, by numbers (see ``plain``): ``seqs`` is written and
    holds each once, with what it is, so equal sequences need no join.  A row that is
    looked up carries the number and which blocks it is looked up by.
    """
    found = seqs.where("probe and ref").select("seq", F.col("seq").alias("reference"))
    if max_distance < 1:
        return found
    masks = plain.block_masks(max_distance + 2, max_distance)
    under = lambda df: df.select("seq", F.explode(F.expr(f"sequence(0, {len(masks) - 1})")).alias("n"))
    listed = ", ".join(f"{m}L" for m in masks)
    key = lambda side: F.expr(f"xxhash64({side}.n, {side}.seq & get(array({listed}), {side}.n))")
    differ = "(l.seq ^ r.seq)"
    distance = plain.places(differ)
    # of one length if their first bit goes; what else is under the key is told by the distance
    cond = (key("l") == key("r")) & F.expr(f"{differ} < l.seq and {differ} < r.seq") & (distance <= max_distance)
    met = under(seqs.where("probe and not ref")).alias("l").hint("merge").join(under(seqs.where("ref")).alias("r"), cond)
    met = met.select(F.col("l.seq").alias("seq"), F.col("r.seq").alias("reference"), distance.alias("d"))
    least = [F.min(F.when(F.col("d") == d, F.col("reference"))).alias(f"_{d}") for d in range(1, max_distance + 1)]
    near = met.groupBy("seq").agg(*least)
    return found.unionByName(near.select("seq", F.coalesce(*[f"_{d}" for d in range(1, max_distance + 1)]).alias("reference")))


def molecules(rows: DataFrame) -> DataFrame:
    """(seq, raw, label, site, umi_count) of rows (vbc_read, label, site, umi): distinct molecules, barcodes by number (see ``plain.numbered``)."""
    rows = dealt(plain.numbered(rows.select("vbc_read", "label", "site", "umi")), "seq", "raw", "label")
    return rows.groupBy("seq", "raw", "label", "site").agg(F.count_distinct("umi").alias("umi_count"))


def matched_counts(counts: DataFrame, references: DataFrame, scratch: Scratch, max_distance: int = 1, value: str = "umi_count") -> DataFrame:
    """:func:`reference_counts` of written ``counts`` (seq, raw, label, value), a row for each barcode and label, and ``references`` (seq, raw).

    If one of them has no number, all are matched as texts.
    """
    if not counts.where("raw is not null").isEmpty() or not references.where("raw is not null").isEmpty():
        texts = lambda df: df.withColumn("vbc_read", F.coalesce("raw", plain.text("seq")))
        to = nearest_reference(texts(counts), texts(references), max_distance).withColumnRenamed("sequence", "vbc_read")
        out = texts(counts).join(to, "vbc_read", "left")
        return out.groupBy("reference", "label").agg(F.count("vbc_read").alias("n_vbcs"), F.sum(value).alias(value))
    both = counts.select("seq", F.lit(True).alias("probe"), F.lit(False).alias("ref")).unionByName(references.select("seq", F.lit(False).alias("probe"), F.lit(True).alias("ref")))
    seqs = scratch.keep(both.where("seq is not null").groupBy("seq").agg(F.max("probe").alias("probe"), F.max("ref").alias("ref")), "sequences")
    out = counts.select("seq", "label", value).join(nearest_plain(seqs, max_distance), "seq", "left")
    out = out.groupBy("reference", "label").agg(F.count("seq").alias("n_vbcs"), F.sum(value).alias(value))
    return out.withColumn("reference", plain.text("reference"))


def reference_counts(counts: DataFrame, references: DataFrame, max_distance: int = 1, value: str = "umi_count") -> DataFrame:
    """(reference, label, n_vbcs, value): counts (vbc_read, label) by assigned reference; rows without one have a null reference."""
    scratch = Scratch(counts.sparkSession, "matched")
    sums = plain.numbered(counts.select("vbc_read", "label", value)).groupBy("seq", "raw", "label").agg(F.sum(value).alias(value))
    refs = plain.numbered(references.select("vbc_read")).distinct()
    return matched_counts(scratch.keep(sums, "counts"), scratch.keep(refs, "references"), scratch, max_distance, value)
