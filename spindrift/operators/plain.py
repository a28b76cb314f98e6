"""Sequences of at most 31 plain bases as numbers that tell the sequence: a 1, then two bits a base.

Numbers of one length are in the sequences' order, so what is made of them (smallest
members, ties) is the same as of sequences, and no table is needed to put the
sequences back.  Everything is per group (``grp``), which travels beside the number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.operators.components import grouped_components
from spindrift.plans.scratch import Scratch

LONGEST = 31


def code(sequence: Column) -> Column:
    """The number of a plain sequence, else null."""
    plain = (F.length(sequence) <= LONGEST) & sequence.rlike("^[ACGT]*\\z")
    return F.when(plain, F.conv(F.concat(F.lit("1"), F.translate(sequence, "ACGT", "0123")), 4, 10).cast("long"))


def text(number: Column | str) -> Column:
    """The sequence of a number."""
    return F.translate(F.substr(F.conv(F.col(number) if isinstance(number, str) else number, 10, 4), F.lit(2)), "0123", "ACGT")


def numbered(df: DataFrame, column: str = "vbc_read") -> DataFrame:
    """``df`` with ``seq`` and ``raw`` in place of ``column``: its number, or the sequence itself if it has none.

    Digits are read up to the first other letter, so a number with all places tells that
    the sequence is plain, and no pattern is looked for besides.
    """
    digits = F.translate(F.col(column), "ACGT0123", "0123NNNN")
    rows = df.withColumn("seq", F.when(F.length(column) <= LONGEST, F.conv(F.concat(F.lit("1"), digits), 4, 10).cast("long")))
    plain = F.expr(f"shiftright(seq, 2 * length(`{column}`)) = 1")
    rows = rows.withColumns({"seq": F.when(plain, F.col("seq")), "raw": F.when(F.coalesce(plain, F.lit(False)), None).otherwise(F.col(column))})
    return rows.drop(column)


def counted(df: DataFrame, column: str = "vbc_read", group: str = "brain", parent: str = "read_count") -> DataFrame:
    """(grp, seq, raw, n, weight): distinct sequences of each group with their rows and summed reads; ``raw`` is a sequence that has no number."""
    rows = df.select(F.col(group).alias("grp"), code(F.col(column)).alias("seq"), F.col(column).alias("_s"), F.col(parent).alias("_w"))
    rows = rows.select("grp", "seq", F.when(F.col("seq").isNull(), F.col("_s")).alias("raw"), "_w")
    return rows.groupBy("grp", "seq", "raw").agg(F.count(F.lit(1)).alias("n"), F.sum("_w").alias("weight"))


def block_masks(blocks: int, max_distance: int) -> list[int]:
    """The bits of every ``blocks - max_distance`` of so many blocks, to which places are dealt in turn; numbers that differ in ``max_distance`` places agree under one of them."""
    chosen = combinations(range(blocks), blocks - max_distance)
    return [sum(3 << 2 * at for at in range(LONGEST) if at % blocks in some) for some in chosen]


def places(differ: str) -> Column:
    """How many bases differ, by the differing bits of two numbers of one length."""
    return F.expr(f"bit_count(({differ} | shiftrightunsigned({differ}, 1)) & {sum(1 << 2 * i for i in range(LONGEST))}L)")


def plain_edges(seqs: DataFrame, max_distance: int = 3) -> DataFrame:
    """(grp, a, b, distance) for all pairs a < b of one group and length that differ in 1..max_distance places; ``seqs`` (grp, seq) are distinct.

    The search is that of :func:`spindrift.operators.barcodes.similarity_edges`.  A row
    carries the number and which blocks it is looked up by; the hash that rows are dealt
    and sorted by is made of these two and doesn't travel.
    """
    masks = block_masks(max(5, max_distance + 2), max_distance)
    rows = seqs.select("seq", F.explode(F.expr(f"sequence(0, {len(masks) - 1})")).alias("n"), "grp")
    listed = ", ".join(f"{m}L" for m in masks)
    key = lambda side: F.expr(f"xxhash64({side}.n, {side}.grp, {side}.seq & get(array({listed}), {side}.n))")
    differ = "(l.seq ^ r.seq)"
    apart = places(differ)
    under = "case " + " ".join(f"when ({differ} & {m}L) = 0 then {n}" for n, m in enumerate(masks)) + " end"
    # not equations, which would be sorted by; numbers of one length have their first bit in common
    same = F.expr(f"l.n <= r.n and l.n >= r.n and l.grp <= r.grp and l.grp >= r.grp and {differ} < l.seq")
    cond = (key("l") == key("r")) & F.expr("l.seq < r.seq") & (apart <= max_distance) & same & F.expr(f"{under} <= l.n and {under} >= l.n")
    met = rows.alias("l").hint("merge").join(rows.alias("r"), cond)
    return met.select(F.col("l.grp").alias("grp"), F.col("l.seq").alias("a"), F.col("r.seq").alias("b"), apart.cast("int").alias("distance"))


@dataclass(frozen=True)
class Clusters:
    """Counted sequences, edges and components by numbers; ``names(df, *columns)`` puts the sequences in place of these."""

    sequences: DataFrame
    edges: DataFrame
    components: DataFrame
    names: Callable[..., DataFrame]
    sequence: Column | None  #: of ``seq``, if no table is needed for it


def named(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: text(c) for c in columns})


def plain_clusters(seqs: DataFrame, scratch: Scratch, max_distance: int = 3, seen: Callable[[str, DataFrame], DataFrame] | None = None) -> Clusters:
    """:class:`Clusters` of written ``seqs`` (grp, seq, ...) that all have numbers.  ``seen`` as for ``align_collapse``."""
    look = seen or (lambda name, x: x)
    edges = scratch.keep(look("edges", plain_edges(seqs, max_distance)), "edges")
    parts = grouped_components(edges, scratch)
    if seen:
        parts = scratch.keep(seen("components", parts), "components")
    return Clusters(seqs, edges, parts, named, text("seq"))
