"""How far apart the sequences of a component are, without looking at all its pairs.

Distances to a pivot bound all others: two members are no farther apart than the sum of
theirs.  A member whose distance to some pivot, plus the largest one to that pivot, is
no more than a distance found already, can't be in a farther pair and is left out.
Rounds take some of the members that remain as pivots, until none do.  It holds for any
distance, so for differing positions as for steps along the edges.

Most components need no pivots: where each two members share an edge, the edges tell all
distances, and where one member shares an edge with all others, none are more than two
steps apart.  Counts of edges tell both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.functions.seq import hamming, one_hot
from spindrift.plans.scratch import Scratch

KEY = ["grp", "comp"]


def _farthest(rows: DataFrame, measure: Callable[[DataFrame, DataFrame], DataFrame], scratch: Scratch, pivots: int) -> DataFrame:
    """(grp, comp, most) of ``rows`` (grp, comp, seq, ...).

    ``measure`` gives (grp, comp, seq, pivot, d) for rows and pivots, which are rows with
    ``pivot`` in place of ``seq``.  A component's first pivot is the member it is named by.
    """
    alive = scratch.keep(rows.withColumn("bound", F.lit(1 << 30)), "alive")
    chosen = scratch.keep(alive.where("seq = comp").drop("bound").withColumnRenamed("seq", "pivot"), "pivots")
    found = None
    while True:
        far = scratch.keep(measure(alive, chosen), "distances")
        reach = far.groupBy(*KEY, "pivot").agg(F.max("d").alias("_reach"))
        most = reach.groupBy(*KEY).agg(F.max("_reach").alias("most"))
        now = scratch.keep(most if found is None else found.unionByName(most).groupBy(*KEY).agg(F.max("most").alias("most")), "found")
        own = far.join(reach, [*KEY, "pivot"]).withColumn("_b", F.when(F.col("seq") == F.col("pivot"), F.lit(0)).otherwise(F.col("d") + F.col("_reach")))
        bound = own.groupBy(*KEY, "seq").agg(F.min("_b").alias("_b"))
        left = alive.join(bound, [*KEY, "seq"]).join(now, KEY).withColumn("bound", F.least("bound", "_b")).where(F.col("bound") > F.col("most"))
        left = scratch.keep(left.select(*rows.columns, "bound"), "alive")
        scratch.drop(alive, chosen, far, *([] if found is None else [found]))
        alive, found = left, now
        if not alive.head(1):
            return found
        order = Window.partitionBy(*KEY).orderBy(F.desc("bound"), "seq")  # the first rows of each task are cut off before they meet
        chosen = alive.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= pivots)
        chosen = scratch.keep(chosen.drop("_n", "bound").withColumnRenamed("seq", "pivot"), "pivots")


def _shapes(edges: DataFrame, comps: DataFrame) -> DataFrame:
    """(grp, comp, n_seq, most_edges, n_edges, top_degree, farthest) of all components; ``edges`` (grp, a, b, distance) hold each pair once."""
    ends = edges.select("grp", F.explode(F.array("a", "b")).alias("seq"), "distance")
    degrees = ends.groupBy("grp", "seq").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_d"))
    out = comps.join(degrees, ["grp", "seq"], "left").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_seq"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_ends"), F.max("_n").alias("top_degree"), F.max("_d").alias("farthest"))
    return out.withColumn("n_edges", F.expr("_ends div 2")).withColumn("most_edges", F.expr("n_seq * (n_seq - 1) div 2")).drop("_ends")


def _differing(a: str, code_a: str, b: str, code_b: str) -> Column:
    same = F.aggregate(F.zip_with(code_a, code_b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda acc, x: acc + x)
    return F.coalesce(F.length(a) - same, hamming(F.col(a), F.col(b))).cast("int")


def farthest_pairs(comps: DataFrame, scratch: Scratch, pivots: int = 16) -> DataFrame:
    """(grp, comp, max_ham): the largest number of differing positions of two sequences of a component, which have one length.

    ``comps`` (grp, comp, seq) may have numbers for sequences, which then are its ``text``.
    """

    def measure(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        both = rows.join(chosen.withColumnsRenamed({"code": "_code", "text": "_text"}), KEY)
        return both.select(*KEY, "seq", "pivot", _differing("text", "code", "_text", "_code").alias("d"))

    text = F.col("text" if "text" in comps.columns else "seq")
    rows = comps.select(*KEY, "seq", text.alias("text"), one_hot(text).alias("code"))
    return _farthest(rows, measure, scratch, pivots).withColumnRenamed("most", "max_ham")


def component_diameter(edges: DataFrame, comps: DataFrame, pivots: int = 16) -> DataFrame:
    """(grp, comp, diameter): the most steps along edges between two members of a component, by searches from all pivots of a round at once."""
    scratch = Scratch(comps.sparkSession, "diameter")
    pairs = scratch.keep(edges.where("a <> b").select("grp", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    shapes = scratch.keep(_shapes(pairs.withColumn("distance", F.lit(1)), comps), "shapes")
    known = F.when(F.col("n_seq") == 1, 0).when(F.col("n_edges") == F.col("most_edges"), 1).when(F.col("top_degree") == F.col("n_seq") - 1, 2)
    shapes = shapes.select(*KEY, known.cast("int").alias("diameter"))
    rest = scratch.keep(comps.join(shapes.where("diameter is null").select(*KEY), KEY, "left_semi").select(*KEY, "seq"), "rest")
    both = F.array(F.struct(F.col("a").alias("seq"), F.col("b").alias("_to")), F.struct(F.col("b").alias("seq"), F.col("a").alias("_to")))
    steps = pairs.join(rest.select("grp", F.col("seq").alias("a")), ["grp", "a"], "left_semi").select("grp", F.explode(both).alias("_e")).select("grp", "_e.seq", "_e._to")
    steps = scratch.keep(steps, "steps")

    def measure(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        front = scratch.keep(chosen.select(*KEY, "pivot", F.col("pivot").alias("seq"), F.lit(0).alias("d")), "reached")
        reached, far = front, 0
        while front.head(1):
            far += 1
            fresh = front.join(steps, ["grp", "seq"]).select(*KEY, "pivot", F.col("_to").alias("seq")).distinct()
            front = scratch.keep(fresh.join(reached, [*KEY, "pivot", "seq"], "left_anti").withColumn("d", F.lit(far)), "reached")
            reached = reached.unionByName(front)
        return reached.join(rows.select(*KEY, "seq"), [*KEY, "seq"], "left_semi")

    far = _farthest(rest, measure, scratch, pivots).withColumnRenamed("most", "diameter")
    return shapes.where("diameter is not null").unionByName(far)


def component_spread(comps: DataFrame, edges: DataFrame, max_distance: int = 3, sequences: DataFrame | Column | None = None) -> DataFrame:
    """(grp, comp, n_seq, max_ham, n_pairs, n_exceed, good_prop) of components of two sequences or more.

    ``edges`` are all pairs within ``max_distance``, each once, so n_exceed, the pairs beyond it, is
    what is left of a component's n_pairs.  If components and edges have numbers for
    sequences, ``sequences`` (seq, text) are those, or an expression that makes them of ``seq``.
    """
    scratch = Scratch(comps.sparkSession, "spread")
    shapes = scratch.keep(_shapes(edges.where(F.col("distance") <= max_distance), comps).where("n_seq > 1"), "shapes")
    rest = comps.join(shapes.where("n_edges < most_edges").select(*KEY), KEY, "left_semi").select(*KEY, "seq")
    if isinstance(sequences, Column):
        rest = rest.withColumn("text", sequences)
    elif sequences is not None:
        rest = rest.join(sequences, "seq")
    rest = scratch.keep(rest, "rest")
    out = shapes.join(farthest_pairs(rest, scratch), KEY, "left")
    out = out.withColumn("max_ham", F.coalesce("max_ham", "farthest")).withColumn("n_pairs", F.col("most_edges")).withColumn("n_exceed", F.col("n_pairs") - F.col("n_edges"))
    return out.select(*KEY, "n_seq", "max_ham", "n_pairs", "n_exceed", (1 - F.col("n_exceed") / F.col("n_pairs")).alias("good_prop"))
