"""Random draws over whole tables: without replacement to an exact size, and by weight with replacement.

Every choice is a digest of a seed and the row's own key, so a row that a lost executor
takes with it is drawn again the same way, and other engines can repeat the draw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.operators import ranks
from spindrift.plans.scratch import Scratch

#: Bits of a drawn number, and of its first part, by which draws are counted.
BITS, CELL_BITS = 60, 16


def drawn_number(*key: Column) -> Column:
    """A number of 60 bits: the first 15 hex digits of the md5 of the key's parts, joined by dashes."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *[k.cast("string") for k in key])), 1, 15), 16, 10).cast("long")


def exact_draws(rows: DataFrame, key: Sequence[str], level: str, levels: int, size: int, draws: int, seed: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``draws`` times, and for each level, ``size`` of the distinct rows of that level and lower ones, without replacement.

    ``level`` is a column of whole numbers from 0 to ``levels - 1``.  Returns the drawn
    rows with run_id and at_level, and (run_id, at_level, n), the rows there were to draw
    from; if these are fewer than ``size``, all are drawn.  A draw is the rows with the
    smallest numbers: they are counted by their first bits, which tells the cell that
    the last one falls in, and only that cell's rows are ranked.
    """
    named = rows.select(*key, level).withColumn("run_id", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    named = scratch.keep(named.withColumn("_x", drawn_number(F.lit(seed), F.col("run_id"), *[F.col(k) for k in key])), "numbers")
    cell = F.shiftright("_x", BITS - CELL_BITS)
    counted = named.groupBy("run_id", level, cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("at_level", F.explode(F.sequence(F.col(level).cast("int"), F.lit(levels - 1)))).groupBy("run_id", "at_level", "_cell").agg(F.sum("_n").alias("_n"))
    up = Window.partitionBy("run_id", "at_level").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)  # at most 2**16 rows
    sums = scratch.keep(counted.withColumn("_to", F.sum("_n").over(up)), "cells")
    total = sums.groupBy("run_id", "at_level").agg(F.max("_to").alias("n"))
    last = sums.where(F.col("_to") - F.col("_n") < size).groupBy("run_id", "at_level").agg(F.max("_cell").alias("_last"), F.max(F.when(F.col("_to") < size, F.col("_to"))).alias("_full"))
    last = F.broadcast(last.withColumnRenamed("run_id", "_run"))  # a row for each run and level
    near = named.join(last, (F.col("run_id") == F.col("_run")) & (F.col(level) <= F.col("at_level")) & (cell <= F.col("_last")))
    inside = near.where(cell < F.col("_last"))
    edge = near.where(cell == F.col("_last")).withColumn("_nth", F.row_number().over(Window.partitionBy("run_id", "at_level").orderBy("_x", *key)))
    edge = edge.where(F.col("_nth") <= F.lit(size) - F.coalesce("_full", F.lit(0)))
    columns = [*key, "run_id", "at_level"]
    return inside.select(columns).unionByName(edge.select(columns)), total


def blacklist_rates(df: DataFrame, max_umis: Sequence[int] = (1, 2, 3, 4, 5, 10, 20, 50), sample: int = 100_000, draws: int = 10, seed: int = 1) -> DataFrame:
    """(run_id, max_umi, n_vbcs, n_dupes, samplesize, p_dupes) of a virus library's reads (vbc_read, umi).

    For each bound, barcodes with more molecules are left out, and ``sample`` of the
    remaining n_vbcs distinct pairs of barcode and molecule are drawn, ``draws`` times;
    n_dupes barcodes are drawn more than once.  Fewer pairs than ``sample`` are all
    drawn; samplesize is what was drawn.  A bound that leaves no pair has no rows.
    """
    scratch = Scratch(df.sparkSession, "blacklist")
    bounds = sorted(set(max_umis))
    pairs = df.select("vbc_read", "umi").na.drop().distinct()
    many = pairs.groupBy("vbc_read").agg(F.count(F.lit(1)).alias("_n"))
    level = F.array_position(F.transform(F.array(*[F.lit(b) for b in bounds]), lambda b: F.col("_n") <= b), F.lit(True)) - 1  # the first bound that lets it in
    some = pairs.join(many.withColumn("_level", level.cast("int")).where("_level >= 0"), "vbc_read")
    drawn, total = exact_draws(some, ("vbc_read", "umi"), "_level", len(bounds), sample, draws, seed, scratch)
    per = drawn.groupBy("run_id", "at_level", "vbc_read").agg(F.count(F.lit(1)).alias("_n"))
    out = per.groupBy("run_id", "at_level").agg(F.count_if(F.col("_n") > 1).alias("n_dupes"), F.sum("_n").alias("samplesize"))
    out = total.join(out, ["run_id", "at_level"])
    bound = F.element_at(F.array(*[F.lit(b) for b in bounds]), F.col("at_level") + 1)
    return out.select("run_id", bound.cast("long").alias("max_umi"), F.col("n").alias("n_vbcs"), "n_dupes", "samplesize", (F.col("n_dupes") / F.col("samplesize")).alias("p_dupes"))


def weighted_draws(library: DataFrame, draws: DataFrame, key: str, weight: str, seed: int, scratch: Scratch, per_bucket: int = 64) -> DataFrame:
    """``draws`` (name, n) with replacement by weight: (name, draw, key), draw from 1 to n.

    Weights are whole numbers; rows without a positive one are never drawn.  Each row
    owns as many of the numbers below the weights' sum as its weight says, in the
    order of keys, and a draw takes the owner of its number.  Owners and numbers meet
    in buckets of about ``per_bucket`` owners; the pool is never written out.
    """
    some = library.where(F.col(weight) > 0).groupBy(F.col(key).alias("value")).agg(F.sum(weight).cast("long").alias("n"))
    owned = scratch.keep(ranks.running_sums(some, [F.asc("value")], "n", scratch), "owners")
    size = owned.agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_rows")).withColumn("_width", F.greatest(F.lit(1), F.expr(f"_all * {per_bucket} div _rows")))
    size = F.broadcast(size)  # one row
    stands = owned.crossJoin(size).withColumn("_bucket", F.explode(F.expr("sequence(before div _width, (before + n - 1) div _width)")))
    asked = draws.withColumn("draw", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long")))).select("name", "draw").crossJoin(size)
    asked = asked.withColumn("_x", drawn_number(F.lit(seed), F.col("name"), F.col("draw")) % F.col("_all")).withColumn("_bucket", F.expr("_x div _width"))
    met = asked.select("name", "draw", "_x", "_bucket").join(stands.select("_bucket", "value", "before", "n"), "_bucket").where("before <= _x and _x < before + n")
    return met.select("name", "draw", F.col("value").alias(key))


def reused_barcodes(library: DataFrame, neurons: DataFrame, seed: int = 1) -> DataFrame:
    """(brain, other, n_reused): barcodes that two brains, or the neurons of one, would share by chance.

    ``library`` has vbc_read and umi_count, ``neurons`` brain and n, how many neurons
    take a barcode each from the library, by its counts.  Within a brain n_reused is the
    draws beyond distinct barcodes; between two it is the barcodes in both, each pair of
    brains with draws of its own.  A brain without neurons has 0.
    """
    scratch = Scratch(library.sparkSession, "reused")
    n = neurons.select("brain", "n")
    two = n.join(F.broadcast(n.select(F.col("brain").alias("other"), F.col("n").alias("_m"))), F.col("brain") <= F.col("other"))  # the sheet's brains
    sides = two.select("brain", "other", F.explode(F.when(F.col("brain") == F.col("other"), F.array(F.struct(F.lit(1).alias("side"), "n"))).otherwise(F.array(F.struct(F.lit(1).alias("side"), "n"), F.struct(F.lit(2).alias("side"), F.col("_m").alias("n"))))).alias("s"))
    sides = scratch.keep(sides.select("brain", "other", "s.side", "s.n", F.concat_ws("/", "brain", "other", F.col("s.side").cast("string")).alias("name")), "sides")
    drawn = weighted_draws(library, sides.where("n > 0").select("name", "n"), "vbc_read", "umi_count", seed, scratch)
    per = drawn.join(F.broadcast(sides.drop("n")), "name").groupBy("brain", "other", "vbc_read").agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("side").alias("_sides"))
    shared = F.sum(F.when(F.col("brain") == F.col("other"), F.col("_n") - 1).otherwise((F.col("_sides") == 2).cast("long")))
    out = per.groupBy("brain", "other").agg(shared.alias("n_reused"))
    return two.select("brain", "other").join(out, ["brain", "other"], "left").select("brain", "other", F.coalesce("n_reused", F.lit(0)).cast("long").alias("n_reused"))
