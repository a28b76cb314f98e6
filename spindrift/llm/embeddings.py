"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine c lie at squared distance 2 - 2c.  After a random
rotation the coordinates are split into blocks; two vectors within squared
distance D are within ``D * width / dims`` of each other in at least one block,
the block's proportional share of the budget.  So each block is range-joined
under its own budget, and the union of what the blocks find is verified with the
original vectors in double precision.

The range join of a block deals vectors into slabs along the block's first
coordinate (at quantiles; :func:`slabs_of` tells how many) and meets
every two slabs that the radius can bridge in one task of bounded size.  A pair
found in several blocks counts in the first only.  A task returns link counts and
a spanning forest, never the pairs, so tight groups stay linear in the output.

Isotropic vectors leave a quadratic share of slab pairs; the README has figures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.operators.components import connected_components
from spindrift.plans.scratch import Scratch


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_bounds(dims: int, blocks: int) -> list[tuple[int, int]]:
    """Coordinate ranges of the blocks."""
    cuts = np.linspace(0, dims, min(blocks, dims) + 1).astype(int)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def usable(v: str = "embedding"):
    """Vectors with finite components that aren't all zero."""
    x = F.col(v)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & ~bad & F.exists(x, lambda c: c != 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, matrix) of a batch's vectors, one for each dimension."""
    lists = batch.column("embedding")
    sizes = lists.value_lengths().to_numpy()
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)


def _as_binary(x: np.ndarray) -> pa.Array:
    """A row of a matrix as one binary value."""
    x = np.ascontiguousarray(x)
    offsets = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)])


def _from_binary(column: pa.ChunkedArray, d: int, dtype: str) -> np.ndarray:
    parts = []
    for c in column.chunks:
        width = d * np.dtype(dtype).itemsize
        first = np.frombuffer(c.buffers()[1], np.int32, 1, 4 * c.offset)[0] if len(c) else 0
        parts.append(np.frombuffer(c.buffers()[2], dtype, len(c) * d, first).reshape(len(c), d) if len(c) and width else np.empty((0, d), dtype))
    return np.concatenate(parts)


def pairs_within(x: np.ndarray, y: np.ndarray, bounds, block: int, budget: float, min_cos: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors with cosine of at least ``min_cos`` whose first block within its budget is ``block``.

    ``x``, ``y``: original vectors and their rotations side by side.
    """
    dims = x.shape[1] // 2
    lo, hi = bounds[block]
    share = np.float32(budget * (hi - lo) / dims * (1 + 1e-5) + 4e-6)
    a, b = x[:, dims + lo : dims + hi], y[:, dims + lo : dims + hi]
    # one product gives the squared distance: (-2a, |a|^2, 1) . (b, 1, |b|^2)
    left = np.column_stack([-2 * a, np.einsum("ij,ij->i", a, a), np.ones(len(a))]).astype(np.float32)
    right = np.column_stack([b, np.ones(len(b)), np.einsum("ij,ij->i", b, b)]).astype(np.float32).T.copy()
    for i in range(0, len(a), 256):
        for part in _parts(np.flatnonzero(left[i : i + 256] @ right <= share)):
            p, q = np.divmod(part, len(b))
            p = p + i
            if same:
                p, q = p[p < q], q[p < q]
            true = np.einsum("ij,ij->i", x[p, :dims], y[q, :dims]) >= min_cos
            p, q = p[true], q[true]
            gap = (x[p, dims:] - y[q, dims:]) ** 2
            # exact sums decide which block counts a pair; float32 above only found candidates
            inside = [gap[:, s:e].sum(axis=1) <= budget * (e - s) / dims * (1 + 1e-9) + 1e-12 for s, e in bounds[: block + 1]]
            first = inside[block]
            for earlier in inside[:block]:
                first = first & ~earlier
            yield p[first], q[first]


def _parts(p: np.ndarray, n: int = 1 << 17) -> Iterator[np.ndarray]:
    for i in range(0, len(p), n):
        yield p[i : i + n]


class Forest:
    """Union-find over the vectors of one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, p: np.ndarray, q: np.ndarray) -> None:
        for a, b in zip(p.tolist(), q.tolist()):
            a, b = self.find(a), self.find(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)


def slabs_of(n: int, slab_rows: int = 4096, at_once: int = 8, most_rows: int = 32768) -> int:
    """Into how many slabs a block deals ``n`` vectors.

    A vector travels once for each slab that it can meet, so there are no more than
    ``at_once`` slabs until one would outgrow a task's memory: a slab has ``slab_rows`` vectors
    at least and about ``most_rows`` at most.
    """
    return max(1, -(-n // max(min(slab_rows, most_rows), min(-(-n // at_once), most_rows))))


def embedding_links(vectors: DataFrame, scratch: Scratch, min_cos: float = 0.9, blocks: int = 4, slab_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(id, n) link counts and (a, b) a spanning forest for distinct usable vectors (id, embedding, copies).

    A vector's count sums the copies of the vectors that it links with.
    """
    budget = 2 - 2 * min_cos
    sizes = [r["d"] for r in vectors.select(F.size("embedding").alias("d")).distinct().collect()]  # one row per dimension
    radii = {(d, k): float(np.sqrt(budget * (hi - lo) / d)) + 1e-4 for d in sizes for k, (lo, hi) in enumerate(block_bounds(d, blocks))}

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, _, x in _by_size(b):
                r = _unit(x) @ rotation(d)
                for k, (lo, _) in enumerate(block_bounds(d, blocks)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), d, np.int32)), pa.array(np.full(len(r), k, np.int32)), pa.array(r[:, lo])], names=["d", "k", "x"])

    at = scratch.keep(vectors.select("embedding").mapInArrow(firsts, "d int, k int, x double"), "coordinates")
    n = at.groupBy("d", "k").agg(F.count(F.lit(1)).alias("n")).collect()
    cuts = {}
    for row in n:
        slabs = slabs_of(row["n"], slab_rows)
        here = at.where((F.col("d") == row["d"]) & (F.col("k") == row["k"]))
        q = here.select(F.percentile_approx("x", [i / slabs for i in range(1, slabs)], max(10_000, 10 * slabs))).first()[0] if slabs > 1 else []
        cuts[row["d"], row["k"]] = np.array(sorted(set(q)), dtype=np.float64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, copies = b.column("id").to_numpy(), b.column("copies").to_numpy()
            for d, rows, x in _by_size(b):
                r = _unit(x) @ rotation(d)
                for k, (lo, _) in enumerate(block_bounds(d, blocks)):
                    c, radius = cuts[d, k], radii[d, k]
                    home = np.searchsorted(c, r[:, lo], side="right")
                    low = np.searchsorted(c, r[:, lo] - radius, side="right")
                    met = np.searchsorted(c, r[:, lo] + radius, side="right") - low + 1
                    many = np.repeat(np.arange(len(x)), met)
                    other = low[many] + np.arange(len(many)) - np.repeat(np.cumsum(met) - met, met)
                    for s in range(0, len(many), 4096):
                        m, o = many[s : s + 4096], other[s : s + 4096]
                        h = home[m]
                        ints = [np.full(len(m), d), np.full(len(m), k), np.minimum(h, o), np.maximum(h, o), h]
                        yield pa.RecordBatch.from_arrays([*(pa.array(v.astype(np.int32)) for v in ints), pa.array(ids[rows[m]]), pa.array(copies[rows[m]]), _as_binary(x[m])], names=["d", "k", "i", "j", "home", "id", "copies", "vector"])

    dtype = "f8" if dict(vectors.dtypes)["embedding"] == "array<double>" else "f4"
    tiles = vectors.select("id", "embedding", "copies").mapInArrow(dealt, "d int, k int, i int, j int, home int, id long, copies long, vector binary")

    def meet(key: tuple[pa.Scalar, ...], g: pa.Table) -> pa.Table:
        d, k, i, j = (x.as_py() for x in key)
        ids = g.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, home, copies = ids[order], g.column("home").to_numpy()[order], g.column("copies").to_numpy()[order]
        u = _unit(_from_binary(g.column("vector"), d, dtype)[order])
        both = np.hstack([u, u @ rotation(d)])
        a = np.flatnonzero(home == i)
        b = a if i == j else np.flatnonzero(home == j)
        links, forest = np.zeros(len(ids), dtype=np.int64), Forest(len(ids))
        if len(a) and len(b):
            for p, q in pairs_within(both[a], both[b], block_bounds(d, blocks), k, budget, min_cos, i == j):
                p, q = a[p], b[q]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                forest.join(p, q)
        some = np.flatnonzero(links)
        root = np.array([forest.find(x) for x in some], dtype=np.int64)
        return pa.table({"id": ids[some], "n": links[some], "b": ids[root] if len(some) else ids[:0]})

    found = scratch.keep(tiles.groupBy("d", "k", "i", "j").applyInArrow(meet, "id long, n long, b long"), "links")
    return found.groupBy("id").agg(F.sum("n").alias("n")), found.where("id <> b").select(F.col("id").alias("a"), "b")


def embedding_components(df: DataFrame, min_cos: float = 0.9, blocks: int = 4, slab_rows: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``df`` (vec_id, embedding).

    Vectors link at a cosine of at least ``min_cos``, whatever other columns say.
    Null, empty, zero and non-finite vectors link with nothing; vectors of other
    dimensions link with nothing of this one.  Equal vectors are joined once and
    counted as often as they stand.  component_id is the smallest vec_id reachable;
    a null vec_id is never smallest.  Exact: every linked pair is met in a block.
    """
    scratch = Scratch(df.sparkSession, "embeddings")
    own = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    good = own.where(usable())
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.keep(classes.withColumn("id", F.xxhash64("embedding")), "distinct")
    counts, edges = embedding_links(classes, scratch, min_cos, blocks, slab_rows)
    parts = connected_components(edges, scratch)
    info = classes.select("id", "least", "copies").join(counts, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    info = scratch.keep(info.select("id", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("part")), "classes")
    smallest = scratch.keep(info.groupBy("part").agg(F.min("least").alias("component_id")), "smallest")
    done = scratch.keep(info.join(smallest, "part").select("id", "n_links", "component_id"), "results")
    out = own.select("vec_id", F.when(usable(), F.xxhash64("embedding")).alias("id")).join(done, "id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
