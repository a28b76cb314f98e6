"""Ranks, running sums and order statistics over a whole table, without one task that sees it all.

Rows are dealt to ranges of the order and sorted within them, so a row's place is the
number of rows in earlier ranges and its place in its own.  The first is a sum over one
row a range; the second is known when the sorted rows are written, from the row numbers
Spark gives within a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.plans.scratch import Scratch

#: Spark numbers a partition's rows from ``partition << 33``.
_SHIFT = 33


def _sorted(df: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """``df`` written in order, with ``_range`` and the place ``_at`` in it, from 0."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    written = scratch.keep(dealt, "sorted")
    return written.withColumns({"_range": F.shiftright("_id", _SHIFT), "_at": F.col("_id").bitwiseAND(F.lit((1 << _SHIFT) - 1))}).drop("_id")


def _before(per_range: DataFrame, value: str) -> DataFrame:
    """(_range, _before): the sum of ``value`` over earlier ranges; one row a range, so one small window."""
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select("_range", F.coalesce(F.sum(value).over(w), F.lit(0)).alias("_before"))


def global_rank(df: DataFrame, order: list[Column], scratch: Scratch, by: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """``df`` with each row's number, from 1, in the order, or in its group's order.

    ``order`` decides; rows that tie in all of it are numbered in any order.  Groups are
    neighbours in one order over the whole table, so a group of any size is spread over
    ranges.  A null key is a group of its own.
    """
    full = [*[F.asc_nulls_first(c) for c in by], *order]
    placed = _sorted(df, full, scratch)
    offsets = F.broadcast(_before(placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")), "_n"))  # a row for each range
    numbered = placed.join(offsets, "_range").withColumn("_place", F.col("_before") + F.col("_at"))
    if not by:
        return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_place") + 1).alias(name))
    first = numbered.groupBy(*by).agg(F.min("_place").alias("_first")).withColumnsRenamed({c: f"_by_{i}" for i, c in enumerate(by)})
    same = [F.col(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)]
    return numbered.join(first, same).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_place") - F.col("_first") + 1).alias(name))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, n): how many rows have each value; nulls are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def running_sums(df: DataFrame, order: list[Column], n: str, scratch: Scratch) -> DataFrame:
    """``df`` with ``before``: the sum of ``n`` over the rows that come earlier in the order, which has no ties."""
    placed = _sorted(df, order, scratch)
    offsets = F.broadcast(_before(placed.groupBy("_range").agg(F.sum(n).alias("_n")), "_n"))  # a row for each range
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_in", F.coalesce(F.sum(n).over(within), F.lit(0)))
    return own.join(offsets, "_range").select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_in")).alias("before"))


def running_counts(df: DataFrame, column: str, scratch: Scratch, descending: bool = True) -> DataFrame:
    """(value, n, before): rows of each distinct value, and rows of all values that come earlier."""
    return running_sums(histogram(df, column), [F.desc("value") if descending else F.asc("value")], "n", scratch)


def value_at(df: DataFrame, column: str, fraction: float, scratch: Scratch, descending: bool = True) -> DataFrame:
    """(value): the one at position int(n * fraction), from 0, of the non-null values in order; no row if there is none there.

    Exact: values are counted, and the counts summed over ranges of values.
    """
    counted = running_counts(df, column, scratch, descending)
    total = df.agg(F.count(column).alias("_total"))
    at = (F.col("_total") * F.lit(fraction)).cast("long")
    found = counted.crossJoin(F.broadcast(total)).where((F.col("before") <= at) & (at < F.col("before") + F.col("n")))  # one row
    return found.select("value")
