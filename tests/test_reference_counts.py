"""Counts by nearest reference: plain sequences meet as numbers, others as texts, both as brute force says."""

import random

import pytest

from spindrift.operators import plain, reference
from spindrift.plans import registry

RNG = random.Random(15)


def _mutants(bases, letters, each, most):
    out = []
    for s in bases:
        for _ in range(each):
            t = list(s)
            for _ in range(RNG.randint(0, most)):
                if t:
                    t[RNG.randrange(len(t))] = RNG.choice(letters)
            out.append("".join(t))
    return out


@pytest.mark.parametrize("letters", ["ACGT", "ACGTN0"])
def test_reference_counts_equal_brute_force(spark, letters):
    bases = ["".join(RNG.choice("ACGT") for _ in range(n)) for n in (4, 12, 30, 31) for _ in range(4)] + ["", "A", "AA", "AAA", "T" * 31]
    if "N" in letters:
        bases += ["ACGT" * 9, "A" * 32]
    refs = sorted(set(_mutants(bases, letters, 4, 2))) + [None]
    probes = [(s, f"L{RNG.randrange(3)}", RNG.randint(1, 9)) for s in [*_mutants(bases, letters, 12, 4), *refs[::3]]]
    probes += [(None, "L0", 5), (None, None, 7), (probes[0][0], None, 2), *probes[:20]]
    cdf, rdf = spark.createDataFrame(probes, "vbc_read string, label string, umi_count long"), spark.createDataFrame([(r,) for r in refs + refs[:5]], "vbc_read string")
    for most in (0, 1, 2):
        want = {}
        for s, label, n in probes:
            near = sorted((d, r) for r in refs if None not in (r, s) and len(r) == len(s) and (d := sum(x != y for x, y in zip(r, s))) <= most)
            seqs, total = want.setdefault((near[0][1] if near else None, label), (set(), []))
            seqs |= {s} - {None}
            total.append(n)
        got = reference.reference_counts(cdf, rdf, most)
        assert got.columns == ["reference", "label", "n_vbcs", "umi_count"]
        rows = got.collect()
        assert len(rows) == len(want) and {(r.reference, r.label): (r.n_vbcs, r.umi_count) for r in rows} == {k: (len(x), sum(n)) for k, (x, n) in want.items()}, most


def test_numbers_or_sequences(spark):
    texts = ["", "A", "T" * 31, "ACGT", None, "A" * 32, "ACGN", "NACG", "ACG\n", " ACG", "acgt", "0123", "A1", "-A", "ACGÄ"]
    got = plain.numbered(spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, s string"), "s").withColumn("t", plain.text("seq")).orderBy("i").collect()
    assert [r.t for r in got] == texts[:4] + [None] * 11 and [r.raw for r in got] == [None] * 4 + texts[4:]


def test_reference_match_deals_out_and_sorts_numbers(spark):
    """Barcodes are neither dealt out nor sorted as texts, and molecules are counted without sorting them."""
    plan = registry.reference_match(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "vbc_read" not in plan and "SortAggregate" not in plan and "BroadcastNestedLoopJoin" not in plan
    sorts = [x for x in plan.splitlines() if "Sort [" in x]
    assert all(x.count(" ASC ") == 1 for x in sorts)
    rows = spark.createDataFrame([("ACGT", "L1", "target", "u1"), ("ACGT", "L1", "target", "u1"), ("ACGT", "L1", "target", "u2"), ("ACGT", "L1", "target", None), ("ACGN", "L1", "injection", None)], "vbc_read string, label string, site string, umi string")
    counts = reference.molecules(rows)
    assert "SortAggregate" not in counts._jdf.queryExecution().executedPlan().toString()
    assert {(r.raw, r.label, r.site, r.umi_count) for r in counts.collect()} == {(None, "L1", "target", 2), ("ACGN", "L1", "injection", 0)} and counts.count() == 2
