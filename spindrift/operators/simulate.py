"""Simulated barcodes: random parents and copies with random changes.

All randomness is a digest of a seed and the row's own key, so a row that a lost
executor takes with it comes back the same, and DuckDB can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.functions.seq import has_repeat


def _letters(key: Column, n: int, alphabet: str) -> Column:
    """``n`` letters drawn by the digests of a key; the alphabet has 1, 2, 4, 8 or 16."""
    if not alphabet or 16 % len(alphabet):
        raise ValueError("an alphabet has 1, 2, 4, 8 or 16 letters")
    digests = F.concat(*[F.md5(F.concat(key, F.lit(f"/{i}"))) for i in range(-(-n // 32))])
    return F.translate(F.substring(digests, 1, n), "0123456789abcdef", alphabet * (16 // len(alphabet)))


def _number(key: Column, below: Column) -> Column:
    """A number from 0 to ``below - 1`` by the first 28 bits of a key's digest."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("long"), below).cast("int")


def random_sequences(spark: SparkSession, n: int = 1000, n_bases: int = 30, alphabet: str = "CAGT", max_repeats: int = 7, seed: int = 1) -> DataFrame:
    """(sequence, read_count, parent_idx): random sequences drawn once, without long runs of one base."""
    drawn = spark.range(n).select(F.col("id").alias("parent_idx"), _letters(F.concat(F.lit(f"{seed}-"), F.col("id").cast("string")), n_bases, alphabet).alias("sequence"))
    once = drawn.groupBy("sequence").agg(F.count(F.lit(1)).alias("read_count"), F.min("parent_idx").alias("parent_idx")).where("read_count = 1")
    return once.where(~has_repeat(F.col("sequence"), max_repeats)).select("sequence", "read_count", "parent_idx")


def mutated(sequence: Column, key: Column, max_mismatch: int = 3, alphabet: str = "CAGT") -> Column:
    """1 to ``max_mismatch`` letters, each count as likely, replaced by drawn ones, which may be the same; empty sequences stay."""
    edits = _number(F.concat(key, F.lit("/n")), F.lit(max_mismatch)) + 1
    out = sequence
    for j in range(max_mismatch):
        at = _number(F.concat(key, F.lit(f"/p{j}")), F.length(sequence))
        one = F.concat(F.substr(out, F.lit(1), at), _letters(F.concat(key, F.lit(f"/c{j}")), 1, alphabet), F.substr(out, at + 2, F.length(sequence)))
        out = F.when((edits > j) & (F.length(sequence) > 0), one).otherwise(out)
    return out


def replicate(df: DataFrame, key: str, n_copies: int = 5, n_cycles: int = 5, max_mismatch: int = 3, alphabet: str = "CAGT", seed: int = 1) -> DataFrame:
    """Cycles in which every sequence stays and leaves ``n_copies`` changed copies; the other columns go with them.

    A cycle is one projection; ``key`` names the rows (unique values), and a copy's
    name is its parent's with the copy's number.
    """
    out = df.withColumn("_key", F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    for _ in range(n_cycles):
        out = out.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n_copies))))
        out = out.withColumn("_key", F.concat("_key", F.lit("."), F.col("_copy").cast("string")))
        out = out.withColumn("sequence", F.when(F.col("_copy") > 0, mutated(F.col("sequence"), F.col("_key"), max_mismatch, alphabet)).otherwise(F.col("sequence")))
    return out.drop("_key", "_copy")


def expand_rows(df: DataFrame, key: str, copies: int = 32, umi_length: int = 12, alphabet: str = "ACGT", seed: int = 1) -> DataFrame:
    """Every row ``copies`` times, each with a molecule id of its own drawing."""
    out = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    name = F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"), F.lit("."), F.col("_copy").cast("string"))
    return out.withColumn("umi", _letters(name, umi_length, alphabet)).drop("_copy")


def simulated_vbcreads(spark: SparkSession, n_parents: int = 100, n_copies: int = 5, n_cycles: int = 5, max_mismatch: int = 3, seed: int = 1) -> DataFrame:
    """(sequence, read_count, parent_idx) after all cycles, from random parents."""
    return replicate(random_sequences(spark, n_parents, seed=seed), "parent_idx", n_copies, n_cycles, max_mismatch, seed=seed)
