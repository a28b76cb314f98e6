"""Product codes of vectors in integers, found by partial-distance search.

A vector's components become integers, its eight equal parts are each named by the
nearest entry of that part's codebook, and the codebooks follow from a few rounds
of averaging.  All arithmetic is exact, so a rerun, another partitioning and a lost
executor give the same codes.

A task takes its vectors in Arrow batches.  For every part it goes through the
dimensions in descending variance of the codebook; a first few give the entry that
looks best, whose distance is completed, and masks then drop every other entry as
soon as its accumulated distance strictly exceeds that one.  A round sends one row
of sums for each task, part, entry and position; the driver holds codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.plans.scratch import Scratch


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``; 64-bit integers, or Python's where those could overflow."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.reshape(-1)).encode()).hexdigest()


def scan_order(book: np.ndarray) -> list[int]:
    """The dimensions by descending variance of the entries, ties in their own order."""
    exact = book.astype(object)
    spread = len(book) * (exact * exact).sum(axis=0) - exact.sum(axis=0) ** 2
    return sorted(range(book.shape[1]), key=lambda i: (-spread[i], i))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry for each row, ties to the lower index."""
    n, order = len(x), scan_order(book)
    few = max(1, len(order) // 4)
    seen = np.zeros((n, len(book)), dtype=x.dtype)
    for j in order[:few]:
        step = x[:, j, None] - book[None, :, j]
        seen += step * step
    first = seen.argmin(axis=1)
    best = seen[np.arange(n), first]
    for j in order[few:]:
        step = x[:, j] - book[first, j]
        best = best + step * step
    row, entry = np.nonzero(seen <= best[:, None])
    total = seen[row, entry]
    for j in order[few:]:
        step = x[row, j] - book[entry, j]
        total = total + step * step
        alive = total <= best[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    # every row still has its first entry; entries of a row stand in ascending order
    least = np.minimum.reduceat(total, np.searchsorted(row, np.arange(n)))
    tied = total == least[row]
    return entry[tied][np.searchsorted(row[tied], np.arange(n))], least


def _wide(x: np.ndarray, books: np.ndarray) -> bool:
    """True if a squared distance could leave 64 bits."""
    most = max(int(np.abs(a).max(initial=0)) if a.dtype != object else max(map(abs, a.reshape(-1)), default=0) for a in (x, books))
    return books.shape[2] * (2 * most) ** 2 >= 1 << 63


def _batches(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch with (rows, parts, positions) and the codebooks, both of one kind of integers."""
    parts, _, width = books.shape
    for b in batches:
        if not b.num_rows:
            continue
        flat = b.column(b.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(b.num_rows, parts, width)
        yield (b, x.astype(object), books.astype(object)) if _wide(x, books) else (b, x, books)


def _sums(books: np.ndarray):
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = books.shape
        total, count = np.zeros((parts, k, width), dtype=object), np.zeros((parts, k), dtype=np.int64)
        for _, x, book in _batches(batches, books):
            for p in range(parts):
                code, _ = nearest(x[:, p], book[p])
                order = np.argsort(code, kind="stable")
                used, at, n = np.unique(code[order], return_index=True, return_counts=True)
                total[p, used] += np.add.reduceat(x[order, p], at, axis=0).astype(object)
                count[p, used] += n
        p, e, i = (a.reshape(-1) for a in np.indices((parts, k, width)))
        some = count[p, e] > 0
        p, e, i = p[some], e[some], i[some]
        values = [Decimal(int(v)) for v in total[p, e, i]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()), pa.array(values, pa.decimal128(38, 0)), pa.array(count[p, e], pa.int64())],
            names=["part", "entry", "pos", "total", "n"],
        )

    return per_task


def _codes(books: np.ndarray):
    hexes = np.array([f"{i:02x}".encode() for i in range(256)], dtype="S2")

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x, book in _batches(batches, books):
            found = [nearest(x[:, p], book[p]) for p in range(len(book))]
            digits = np.ascontiguousarray(hexes[np.stack([f[0] for f in found], axis=1)]).view(f"S{2 * len(book)}")[:, 0]
            error = sum(f[1] for f in found)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digits.astype(str), pa.string()), pa.array([int(v) for v in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    return per_batch


def integer_vectors(df: DataFrame, parts: int = 8, scale: int = 4096) -> DataFrame:
    """(vec_id, label, x): components times ``scale``, rounded down.

    Rows whose vector is null or empty, holds null or non-finite components, or
    can't be cut into ``parts`` equal parts are left out.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = df.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & fine)
    return some.select("vec_id", "label", F.transform(v, lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def compress(df: DataFrame, parts: int = 8, size: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, Codebooks | None]:
    """Return ((vec_id, label, code, error, label_error), codebooks) for the vectors of ``df``.

    ``df`` has vec_id, label and embedding; other columns are ignored.  Vectors
    that :func:`integer_vectors` leaves out have no row, nor have vectors of
    another dimension than that of the smallest vec_id.  The codebooks start as the
    parts of the ``size`` (at most 256) smallest vec_ids, rows of one vec_id by their
    components, null ids last; fewer rows make fewer entries.  Repeated rows count
    each.  An empty table gives an empty result and no codebooks.  A squared error
    beyond a long is an error.
    """
    if not 1 <= size <= 256:
        raise ValueError("a code has two hex digits, so a codebook has 1 to 256 entries")
    scratch = Scratch(df.sparkSession, "codes")
    kept = scratch.keep(integer_vectors(df, parts, scale), "integers")
    start = kept.orderBy(F.asc_nulls_last("vec_id"), "x").limit(size).select("x").collect()
    if not start:
        empty = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty, None
    width = len(start[0]["x"])
    kept = kept.where(F.size("x") == width)
    books = np.array([r["x"] for r in start if len(r["x"]) == width], dtype=np.int64)
    books = books.reshape(len(books), parts, width // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = kept.select("x").mapInArrow(_sums(books), "part int, entry int, pos int, total decimal(38,0), n long")
        # parts x size x positions rows: as many as the codebooks have integers
        for r in sums.groupBy("part", "entry", "pos").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n")).collect():
            books[r["part"], r["entry"], r["pos"]] = int(r["total"]) // r["n"]
    kind = {f.name: f.dataType.simpleString() for f in kept.schema}
    out = kept.mapInArrow(_codes(books), f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")
    out = scratch.keep(out, "codes")
    by_label = out.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = out.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error"), Codebooks(books)


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Every vector's code and errors, with the digest of the final codebooks."""
    out, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = books.sha256() if books else hashlib.sha256(b"").hexdigest()
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(parts: int = 8, size: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds written out; every distance in full."""
    steps = f"""
WITH fine AS MATERIALIZED (
  SELECT vec_id, label, embedding AS e, len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (
  SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS pos, CAST(floor({scale} * CAST(e[i] AS DOUBLE)) AS BIGINT) AS x FROM fine, unnest(range(1, len(e) + 1)) t(i)),
k0 AS MATERIALIZED (
  SELECT part, entry, pos, x FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM fine QUALIFY entry < {size}) USING (vec_id))"""
    for r in range(rounds + 1):
        steps += f""",
a{r} AS MATERIALIZED (
  SELECT vec_id, v.part, entry, CAST(sum((v.x - k.x) * (v.x - k.x)) AS BIGINT) AS far FROM v JOIN k{r} k ON v.part = k.part AND v.pos = k.pos GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY vec_id, v.part ORDER BY far, entry) = 1)"""
        if r < rounds:
            steps += f""",
m{r} AS (SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} USING (vec_id, part) GROUP BY 1, 2, 3),
k{r + 1} AS MATERIALIZED (SELECT k.part, k.entry, k.pos, CASE WHEN n IS NULL THEN k.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM k{r} k LEFT JOIN m{r} USING (part, entry, pos))"""
    return f"""{steps},
one AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM k{rounds}) AS codebooks_sha256
FROM one JOIN fine USING (vec_id)"""


OP11_SQL = _sql()
