"""Column expressions over nucleotide strings and labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASES = "ACGT"


def field(col: Column, start: int, end: int) -> Column:
    """The half-open slice [start, end); shorter where the string ends."""
    return F.substring(col, start + 1, max(0, end - start))


def split_fields(df: DataFrame, fields: Iterable[tuple[str, int, int]], column: str = "sequence", drop: bool = True) -> DataFrame:
    """Add every named slice of ``column`` in one projection."""
    out = df.withColumns({name: field(F.col(column), s, e) for name, s, e in fields})
    return out.drop(column) if drop else out


def n_count(col: Column) -> Column:
    return F.length(col) - F.length(F.replace(col, F.lit("N"), F.lit("")))


def has_repeat(col: Column, longest: int) -> Column:
    """True if one base runs longer than ``longest``."""
    return col.rlike("|".join(f"{b}{{{longest + 1}}}" for b in BASES))


def starts_like(col: Column, pattern: str) -> Column:
    """Match at the start only, as the reference's pattern tests do."""
    return col.rlike(f"^(?:{pattern})")


def reverse_complement(col: Column) -> Column:
    return F.translate(F.reverse(col), "ACGT", "TGCA")


def hamming(a: Column, b: Column, both_strands: bool = False) -> Column:
    """Differing positions of two strings of one length (null otherwise); optionally the lesser of both strands."""
    def one(y: Column) -> Column:
        return F.size(F.filter(F.sequence(F.lit(1), F.length(a)), lambda i: F.substr(a, i, F.lit(1)) != F.substr(y, i, F.lit(1))))

    d = F.when(F.length(a) == 0, 0).otherwise(one(b))
    if both_strands:
        d = F.least(d, F.when(F.length(a) == 0, 0).otherwise(one(reverse_complement(b))))
    return F.when(F.length(a) == F.length(b), d)


def one_hot(col: Column) -> Column:
    """Each base of a sequence as one of four bits, 15 bases a long; null for sequences of other letters and empty ones."""
    coded = F.translate(col, BASES, "1248")
    parts = F.sequence(F.lit(0), F.floor((F.length(col) - 1) / 15).cast("int"))
    return F.when(col.rlike(f"^[{BASES}]+$"), F.transform(parts, lambda i: F.conv(F.substr(coded, i * 15 + 1, F.lit(15)), 16, 10).cast("long")))


def difference(a: Column, b: Column) -> Column:
    """'|' where two strings agree and '-' where they differ."""
    n = F.least(F.length(a), F.length(b))
    marks = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1)), "|").otherwise("-"))
    return F.when(n > 0, F.array_join(marks, "")).otherwise("")


def neighbours(col: Column, alphabet: str = BASES) -> Column:
    """All strings at Hamming distance one."""
    def at(i: Column) -> Column:
        letters = F.array(*[F.lit(c) for c in alphabet])
        others = F.filter(letters, lambda c: c != F.substr(col, i, F.lit(1)))
        return F.transform(others, lambda c: F.concat(F.substr(col, F.lit(1), i - 1), c, F.substr(col, i + 1, F.length(col))))

    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(col)), at))


def natural_key(col: Column) -> Column:
    """Sort key under which BC2 precedes BC10."""
    return F.struct(F.regexp_extract(col, r"^(\D*)", 1), F.try_to_number(F.nullif(F.regexp_extract(col, r"^\D*(\d{1,18})", 1), F.lit("")), F.lit("999999999999999999")), col)


def label_of(primer: Column) -> Column:
    """Numeric primers become BC<int>; anything else is a label already."""
    return F.when(primer.rlike(r"^[0-9.]+$"), F.concat(F.lit("BC"), primer.cast("double").cast("int").cast("string"))).otherwise(primer)


def as_number(col: Column, kind: str = "double") -> Column:
    """A cast that gives null instead of an error."""
    return col.try_cast(kind)


def log_scaled(col: Column, base: int = 2) -> Column:
    """Logarithm with 0 for values that have none."""
    return F.when(col > 0, F.log2(col) if base == 2 else F.log10(col)).otherwise(F.lit(0.0))


def phred(col: Column) -> Column:
    """Quality scores of a FASTQ quality string."""
    return F.transform(F.split(col, ""), lambda c: F.ascii(c) - 33)


def digits_to_bases(cols: list[str]) -> Column:
    """Digit-encoded bases: fixed code 1 G, 2 T, 3 A, 4 C."""
    return F.concat(*[F.translate(F.col(c).cast("string"), "1234", "GTAC") for c in cols])
