"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the edge list, all on plain
columns; labels never travel to the driver.  The aggregated minima are written
before they are joined, so both sides of the join are ordinary shuffles that
adaptive execution may split when a hub holds many edges.  No side is broadcast:
what a round leaves may be small on disk and still large on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrift.plans.scratch import Scratch


def _star(edges: DataFrame, scratch: Scratch, large: bool, within: tuple[str, ...] = ()) -> DataFrame:
    """One star operation over edges (u, v) with v < u; nodes are named within the groups of the columns ``within``."""
    both = edges.select(*within, "u", "v")
    if large:
        both = both.unionByName(edges.select(*within, F.col("v").alias("u"), F.col("u").alias("v")))
    low = scratch.keep(both.groupBy(*within, "u").agg(F.min("v").alias("m")).select(*within, "u", F.least("u", "m").alias("m")), "minima")
    joined = both.hint("merge").join(low, [*within, "u"])
    if large:
        out = joined.where("v > u").select(*within, F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(*within, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(*within, "u", F.col("m").alias("v")))
    out = scratch.keep(out.where("u <> v").distinct(), "star")
    scratch.drop(low)
    return out


def _settled(edges: DataFrame, within: tuple[str, ...] = ()) -> bool:
    """Whether all edges (u, v) are stars: no node has two smaller ends, or one while it is another's."""
    ends = edges.select(*within, F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e"))
    seen = ends.groupBy(*within, "e.x").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return seen.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def _rounds(e: DataFrame, scratch: Scratch, max_rounds: int, within: tuple[str, ...] = ()) -> DataFrame:
    """Stars of written edges (u, v), of which nothing is left afterwards."""
    for _ in range(max_rounds):
        if _settled(e, within):
            return e
        big = _star(e, scratch, True, within)
        scratch.drop(e)
        e = _star(big, scratch, False, within)
        scratch.drop(big)
    raise RuntimeError("components did not settle")


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b", max_rounds: int = 60, once: bool = False) -> DataFrame:
    """Return (node, component) for every node of an edge list; component is the smallest node.

    Edges with a null end and self-loops are ignored; an empty edge list gives an
    empty result.  Nodes may be of any orderable type.  ``once`` says that the edges are
    written already and hold each pair once.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    if not once:
        e = scratch.keep(e.distinct(), "edges")
    small = _star(e, scratch, large=False)
    scratch.drop(e)
    e = _rounds(small, scratch, max_rounds)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def grouped_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(grp, seq, comp) of written edges (grp, a, b) of similar sequences, each once, a and b not equal; comp is the smallest node.

    Most components are cliques or nearly so, and stars after one small-star step.  Those
    are set aside, and only the edges of others go through rounds.  The first step deals
    the edges to their larger node and is done there, since a sequence has a bounded
    number of similar ones; rounds, where hubs may grow without bound, join.
    """
    within = ("grp",)
    e = edges.select("grp", F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    e = e.withColumn("m", F.min("v").over(Window.partitionBy("grp", "u")))
    e = e.select("grp", F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    e = e.repartition("grp", "u").distinct()  # dealt by the larger node, which is then counted where it is
    stars = scratch.keep(e.withColumn("tied", F.count(F.lit(1)).over(Window.partitionBy("grp", "u")) > 1), "stars")
    ends = F.array(
        F.struct(F.col("u").alias("x"), F.col("v").alias("p"), F.lit(False).alias("hub"), F.lit(False).alias("tied")),
        F.struct(F.col("v").alias("x"), F.lit(None).cast(stars.schema["v"].dataType).alias("p"), F.lit(True).alias("hub"), F.col("tied").alias("tied")),
    )
    nodes = stars.select("grp", F.explode(ends).alias("e")).groupBy("grp", "e.x").agg(F.min("e.p").alias("p"), F.max("e.hub").alias("hub"), F.max("e.tied").alias("tied"))
    nodes = scratch.keep(nodes, "nodes")
    # a hub with a larger one above it or a node of two hubs below it is open, and so is the hub above an open one
    bad = nodes.where("hub and (p is not null or tied)")
    bad = bad.select("grp", F.explode(F.array("x", F.coalesce("p", "x"))).alias("v")).distinct()
    bad = scratch.keep(bad, "open")
    rest = scratch.keep(stars.join(bad, ["grp", "v"], "left_semi").select("grp", "u", "v"), "rest")
    scratch.drop(stars)
    rest = _rounds(rest, scratch, max_rounds, within)
    rest = rest.select("grp", F.col("u").alias("seq"), F.col("v").alias("comp"))
    done = nodes.select("grp", F.col("x").alias("seq"), F.coalesce("p", "x").alias("comp"))
    done = done.join(bad.withColumnRenamed("v", "comp"), ["grp", "comp"], "left_anti").select("grp", "seq", "comp")
    return done.unionByName(rest).unionByName(rest.select("grp", F.col("comp").alias("seq"), "comp").distinct())
