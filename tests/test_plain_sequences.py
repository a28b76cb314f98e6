"""Clusters of sequences that are numbers by themselves equal brute force, and those of numbered ones."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from spindrift.operators import barcodes as B
from spindrift.operators import components, plain
from spindrift.plans.scratch import Scratch

RNG = random.Random(8)


def _reads(letters, lengths=(12, 13, 31)):
    base = [(g, "".join(RNG.choice("ACGT") for _ in range(n))) for g in ("b1", "b2") for n in lengths for _ in range(4)]
    rows = [(g, s) for g, s in base for _ in range(3)]
    for g, s in base:
        for _ in range(9):
            t = list(s)
            for _ in range(RNG.randint(1, 5)):
                t[RNG.randrange(len(t))] = RNG.choice(letters)
            rows += [(g, "".join(t)), (RNG.choice(["b1", "b2", ""]), "".join(t))]
    rows += [("b1", None), (None, base[0][1]), ("", base[0][1]), ("b1", ""), ("b1", "A"), ("b1", "AA"), ("b1", "AAA")]
    return [(*r, RNG.randint(1, 9)) for r in rows]


def _pairs(rows):
    seqs = {r[:2] for r in rows if r[0] and r[1] is not None}
    return {(g, a, b): d for (g, a), (h, b) in combinations(sorted(seqs), 2) if g == h and len(a) == len(b) and 0 < (d := sum(x != y for x, y in zip(a, b))) <= 3}


def test_numbers_tell_their_sequences(spark):
    texts = ["", "A", "AA", "T" * 31, "ACGT", None, "A" * 32, "ACGN", "ACG\n", "acgt"]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, s string").select("i", plain.code(F.col("s")).alias("c")).withColumn("t", plain.text("c")).orderBy("i").collect()
    assert [r.t for r in got] == texts[:5] + [None] * 5 and got[3].c == 2**63 - 1


@pytest.mark.parametrize("letters", ["ACGT", "ACGTN"])
def test_clusters_equal_brute_force(spark, letters):
    rows = _reads(letters)
    want = _pairs(rows)
    near = {}
    for g, a, b in want:
        near.setdefault((g, a), set()).add(b)
        near.setdefault((g, b), set()).add(a)
    comp = {}
    for g, s in sorted(near):
        if (g, s) not in comp:
            todo = [s]
            for x in todo:
                if (g, x) not in comp:
                    comp[g, x] = s
                    todo += near[g, x]
    df = spark.createDataFrame(rows, "brain string, vbc_read string, read_count long")
    scratch = Scratch(spark, "t")
    x = B.clusters(scratch.keep(plain.counted(df)), scratch)
    assert (x.sequence is None) == (letters == "ACGTN")
    assert {(r.grp, r.seq): r.comp for r in x.names(x.components, "seq", "comp").collect()} == comp and x.components.count() == len(comp)
    assert x.edges.count() == len(want) and {r.distance for r in x.edges.collect()} == set(want.values())
    whole = B.align_collapse(df).groupBy("brain", "vbc_read").agg(F.count(F.lit(1)).alias("n"), F.sum("read_count").alias("reads"))
    got = B.collapsed_counts(df)
    assert got.columns == whole.columns and sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    sizes = {}
    for (g, _), c in comp.items():
        sizes[g, c] = sizes.get((g, c), 0) + 1
    top = sorted(((g, c, n) for (g, c), n in sizes.items()), key=lambda r: (-r[2], r[:2]))[:5]
    assert [tuple(r) for r in B.top_components(x.components, 5, x.names).collect()] == top


def test_plain_edges_by_rows_of_two_numbers(spark):
    seqs = plain.counted(spark.createDataFrame([("b1", "ACGT", 1)], "brain string, vbc_read string, read_count long")).drop("raw")
    lines = plain.plain_edges(seqs)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("SortMergeJoin" in x for x in lines) == 1
    sorts = [x for x in lines if "Sort [" in x]
    assert sorts and all(x.count(" ASC ") == 1 for x in sorts)


def test_closed_components_need_no_rounds(spark, monkeypatch):
    seen = []
    whole = components._rounds
    monkeypatch.setattr(components, "_rounds", lambda e, *more: (seen.append({(r.grp, r.u) for r in e.collect()}), whole(e, *more))[1])
    edges = [("a", 1, 2), ("a", 1, 3), ("a", 2, 3), ("a", 10, 11), ("a", 10, 12), ("b", 1, 4), ("b", 4, 7), ("b", 7, 9), ("a", 20, 22), ("a", 21, 22), ("a", 21, 23), ("a", 24, 23)]
    scratch = Scratch(spark, "t")
    got = components.grouped_components(scratch.keep(spark.createDataFrame(edges, "grp string, a long, b long")), scratch).collect()
    assert {(r.grp, r.seq): r.comp for r in got} == {("a", 1): 1, ("a", 2): 1, ("a", 3): 1, ("a", 10): 10, ("a", 11): 10, ("a", 12): 10, ("b", 1): 1, ("b", 4): 1, ("b", 7): 1, ("b", 9): 1} | {("a", n): 20 for n in range(20, 25)}
    assert len(got) == 15 and len(seen) == 1 and {g for g, u in seen[0] if u < 20} <= {"b"}


def test_random_graphs_in_groups(spark):
    rng = random.Random(3)
    edges = {(g, *sorted(rng.sample(range(120), 2))) for g in "xyz" for _ in range(70)}
    want = {}
    for g, a, b in edges:
        for s in (a, b):
            want.setdefault((g, s), s)
    for _ in range(120):
        for g, a, b in edges:
            want[g, a] = want[g, b] = min(want[g, a], want[g, b])
    scratch = Scratch(spark, "t")
    got = components.grouped_components(scratch.keep(spark.createDataFrame(sorted(edges), "grp string, a long, b long")), scratch).collect()
    assert {(r.grp, r.seq): r.comp for r in got} == want and len(got) == len(want)
