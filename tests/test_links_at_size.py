"""Work that the barcode links and clusters must not do twice, and what they must find."""

from itertools import combinations, product
import random

import pytest
from pyspark.sql import functions as F

from spindrift.operators import barcodes as B
from spindrift.operators import matrix as M
from spindrift.operators import spread
from spindrift.operators.components import connected_components
from spindrift.plans.scratch import Scratch


def _joins(df):
    return df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")


def _edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i] + [0] * len(b), row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_edges_are_found_once_for_both_directions(spark):
    seqs = spark.createDataFrame([("g", "ACGT"), ("g", "ACGA")], "grp string, seq string")
    edges = B.similarity_edges(seqs)
    assert _joins(edges) == 1
    assert _joins(B.node_degree(edges)) == 1 and _joins(M.adjacency(edges)) == 1


def test_codes_travel_in_place_of_sequences(spark):
    edges = B.similarity_edges(spark.createDataFrame([("g", "ACGT")], "grp string, seq string"))
    plan = edges._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sorts and all("key#" in line and "seq#" not in line for line in sorts)


@pytest.mark.parametrize("length", [1, 4, 29, 30, 31, 61, 95])
def test_similar_pairs_equal_brute_force_at_any_length_and_letters(spark, length):
    rng = random.Random(length)
    base = ["".join(rng.choice("ACGT") for _ in range(length)) for _ in range(6)]
    seqs = set(base)
    for s in base:
        for _ in range(12):
            t = list(s)
            for _ in range(rng.randint(1, 4)):
                t[rng.randrange(length)] = rng.choice("ACGTN\u00e9")
            seqs.add("".join(t))
    want = {(a, b): d for a, b in combinations(sorted(seqs), 2) if (d := sum(x != y for x, y in zip(a, b))) <= 3}
    df = B.numbered(spark.createDataFrame([("g", s) for s in seqs], "grp string, seq string"))
    rows = B.similarity_edges(Scratch(spark, "t").keep(df)).collect()
    assert {(r.a, r.b): r.distance for r in rows} == want and len(rows) == len(want)
    assert all(r.a_id < r.b_id for r in rows)


@pytest.mark.parametrize("distance", [1, 2])
def test_near_pairs_by_edits_equal_brute_force(spark, distance):
    rng = random.Random(distance)
    seqs = {"".join(x) for n in (0, 1, 2) for x in product("AC", repeat=n)} | {"".join(rng.choice("ACGT") for _ in range(rng.choice((5, 5, 5, 6, 7)))) for _ in range(150)} | {"ACNGT", "CNGTA", "NGTAC"}
    want = {(a, b): d for a, b in combinations(sorted(seqs), 2) if (d := _edit(a, b)) <= distance}
    rows = B.similarity_edges(spark.createDataFrame([("g", s) for s in seqs], "grp string, seq string"), distance, "levenshtein").collect()
    assert {(r.a, r.b): r.distance for r in rows} == want and len(rows) == len(want)


def test_edit_pairs_of_one_length_need_no_segments(spark):
    """Segments of four bases meet with a share of all pairs; strings one deletion away hardly do."""
    rng = random.Random(5)
    seqs = spark.createDataFrame([("g", "".join(rng.choice("ACGT") for _ in range(12))) for _ in range(40)], "grp string, seq string")
    lengths = seqs.select("grp", F.length("seq").alias("len")).distinct()
    assert B._segment_edges(seqs, 2, lengths).count() == 0


def test_stars_settle_at_once(spark):
    scratch = Scratch(spark, "t")
    edges = spark.createDataFrame([(5 * i, 5 * i + j) for i in range(20) for j in range(1, 5)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges, scratch).collect()}
    assert got == {5 * i + j: 5 * i for i in range(20) for j in range(5)}
    assert scratch._n <= 3  # edges, minima, stars


def test_cliques_and_hubs_need_no_pivots(spark, monkeypatch):
    seen = []
    whole = spread._farthest
    monkeypatch.setattr(spread, "_farthest", lambda rows, *more: (seen.append({r.comp for r in rows.collect()}), whole(rows, *more))[1])
    edges = [(1, 2, 1), (1, 3, 2), (2, 3, 1), (4, 5, 3), (4, 6, 3), (10, 11, 1), (11, 12, 1), (12, 13, 1)]
    comps = [(0, c, s) for c, members in ((1, (1, 2, 3)), (4, (4, 5, 6)), (10, (10, 11, 12, 13))) for s in members]
    edf = spark.createDataFrame([(0, *e) for e in edges], "grp int, a long, b long, distance int")
    cdf = spark.createDataFrame(comps, "grp int, comp long, seq long")
    assert {r.comp: r.diameter for r in spread.component_diameter(edf, cdf).collect()} == {1: 1, 4: 2, 10: 3}
    texts = {1: "AAAA", 2: "AAAC", 3: "AACC", 4: "AAAAAAA", 5: "CCCAAAA", 6: "AAACCCA", 10: "AAAAA", 11: "AAAAC", 12: "AAACC", 13: "AACCC"}
    got = spread.component_spread(cdf, edf.where("a < 4"), sequences=spark.createDataFrame(list(texts.items()), "seq long, text string"))
    assert {r.comp: (r.max_ham, r.n_exceed) for r in got.collect()} == {1: (2, 0), 4: (6, 3), 10: (3, 6)}
    assert seen == [{10}, {4, 10}]
