"""Reference matches, farthest pairs, random draws and workbooks against plain Python."""

import hashlib
import random
import zipfile
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from spindrift.operators import barcodes as B
from spindrift.operators import draws, reference, spread
from spindrift.plans.scratch import Scratch
from spindrift.sources import files
from spindrift.sources.excel import read_sheet

RNG = random.Random(21)


def ham(a, b):
    return sum(x != y for x, y in zip(a, b))


def mutants(n, parents, size, most, letters="ACGT"):
    out = []
    for _ in range(n):
        s = list(RNG.choice(parents))
        for _ in range(RNG.randint(0, most)):
            s[RNG.randrange(size)] = RNG.choice(letters)
        out.append("".join(s))
    return out


def test_nearest_reference_equals_brute_force(spark):
    parents = ["".join(RNG.choice("ACGT") for _ in range(20)) for _ in range(8)]
    refs = sorted(set(mutants(40, parents, 20, 3, "ACGTN"))) + ["ACG", "", "ACGTACGTACGTACGTACG", None]
    probes = mutants(150, parents, 20, 5, "ACGTN") + ["ACG", "ACC", "TTT", "", None, refs[0], refs[0]]
    pdf, rdf = spark.createDataFrame([(x, 1) for x in probes], "vbc_read string, n int"), spark.createDataFrame([(r,) for r in refs], "vbc_read string")
    for most in (0, 1, 3):
        want = {}
        for p in {p for p in probes if p is not None}:
            near = sorted((ham(p, r), r) for r in refs if r is not None and len(r) == len(p) and ham(p, r) <= most)
            if near:
                want[p] = (near[0][1], near[0][0])
        got = reference.nearest_reference(pdf, rdf, most).collect()
        assert len(got) == len(want) and {r.sequence: (r.reference, r.distance) for r in got} == want
    counts = spark.createDataFrame([("ACC", "L1", 3), ("ACG", "L1", 4), ("GGG", "L2", 5)], "vbc_read string, label string, umi_count long")
    got = sorted(map(str, (tuple(r) for r in reference.reference_counts(counts, spark.createDataFrame([("ACG",)], "vbc_read string")).collect())))
    assert got == sorted(map(str, [("ACG", "L1", 2, 7), (None, "L2", 1, 5)]))
    assert reference.nearest_reference(pdf, rdf.limit(0), 1).count() == 0


def test_spread_and_diameter_equal_brute_force(spark):
    seqs = {"g": sorted(set(mutants(90, ["A" * 14, "C" * 14, "ACGTACGTACGTAC"], 14, 6))), "h": ["AAAA", "AAAT", "AATT", "ATTT", "TTTT", "GGGG", "GGGC"]}
    most = {"g": 3, "h": 1}
    edges = [(g, a, b, ham(a, b)) for g, ss in seqs.items() for a, b in combinations(sorted(ss), 2) if ham(a, b) <= most[g]]
    near = {}
    for g, a, b, _ in edges:
        near.setdefault((g, a), set()).add(b)
        near.setdefault((g, b), set()).add(a)
    comp, depth = {}, {}
    for node in sorted(near):
        seen, front = {node[1]: 0}, [node[1]]
        for x in front:  # grows on the way
            for y in near[node[0], x] - seen.keys():
                seen[y] = seen[x] + 1
                front.append(y)
        comp[node], depth[node] = min(seen), max(seen.values())
    members = {}
    for (g, s), c in comp.items():
        members.setdefault((g, c), []).append(s)
    cdf = spark.createDataFrame([(g, c, s) for (g, s), c in comp.items()], "grp string, comp string, seq string")
    edf = spark.createDataFrame(edges, "grp string, a string, b string, distance int")
    for pivots in (3,):
        got = {(r.grp, r.comp): r.max_ham for r in spread.farthest_pairs(cdf, Scratch(spark, "t"), pivots).collect()}
        assert got == {k: max(ham(a, b) for a, b in combinations(v, 2)) for k, v in members.items()}
    got = {(r.grp, r.comp): r.diameter for r in spread.component_diameter(edf, cdf, 2).collect()}
    assert got == {k: max(depth[k[0], s] for s in v) for k, v in members.items()} and got["h", "AAAA"] == 4
    full = {(r.grp, r.comp): tuple(r)[2:] for r in spread.component_spread(cdf.where("grp = 'g'"), edf.where("grp = 'g'"), 3).collect()}
    for k, v in members.items():
        if k[0] == "g":
            d = [ham(a, b) for a, b in combinations(v, 2)]
            assert full[k] == (len(v), max(d), len(d), sum(x > 3 for x in d), 1 - sum(x > 3 for x in d) / len(d))
    assert spread.component_diameter(edf.limit(0), cdf.limit(0)).count() == 0


def number(*key):
    return int(hashlib.md5("-".join(map(str, key)).encode()).hexdigest()[:15], 16)


def test_blacklist_rates_equal_plain_draws(spark):
    pairs = [(f"v{RNG.randint(0, 40)}", f"u{RNG.randint(0, 60)}") for _ in range(400)] + [("hot", f"u{i}") for i in range(90)]
    df = spark.createDataFrame([(*p, 2) for p in pairs] + [(None, "u", 1), ("v", None, 1)], "vbc_read string, umi string, read_count int")
    got = {(r.run_id, r.max_umi): tuple(r)[2:] for r in draws.blacklist_rates(df, [5, 12, 200, 1], 150, 3, seed=7).collect()}
    distinct = set(pairs)
    umis = Counter(v for v, _ in distinct)
    want = {}
    for run in range(3):
        for m in (1, 5, 12, 200):
            pool = sorted((number(7, run, v, u), v, u) for v, u in distinct if umis[v] <= m)
            if pool:
                drawn = Counter(v for _, v, _ in pool[:150])
                dupes = sum(c > 1 for c in drawn.values())
                want[run, m] = (len(pool), dupes, len(pool[:150]), dupes / len(pool[:150]))
    assert got == want and len({x[0] for x in want.values()}) > 2


def test_reused_barcodes_equal_plain_draws(spark):
    library = [(f"v{i:03d}", RNG.choice([0, 1, 1, 2, 5])) for i in range(200)] + [("hot", 700)]
    neurons = {"b1": 120, "b2": 40, "b3": 0}
    pool = [v for v, n in sorted(library) for _ in range(n)]
    want = {}
    for a in sorted(neurons):
        for b in sorted(neurons):
            if a <= b:
                one, two = ([pool[number(1, f"{a}/{b}/{side}", d) % len(pool)] for d in range(1, neurons[x] + 1)] for side, x in ((1, a), (2, b)))
                want[a, b] = len(one) - len(set(one)) if a == b else len(set(one) & set(two))
    ldf, ndf = spark.createDataFrame(library, "vbc_read string, umi_count long"), spark.createDataFrame(list(neurons.items()), "brain string, n long")
    got = draws.reused_barcodes(ldf, ndf).collect()
    assert {(r.brain, r.other): r.n_reused for r in got} == want and want["b1", "b1"] > 0 < want["b1", "b2"]


def workbook(path, cells, shared, name="Sample information"):
    """cells: XML of the second sheet's rows."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook {ns} xmlns:r="http://r"><sheets><sheet name="Notes" sheetId="1" r:id="rId1"/><sheet name="{name}" sheetId="2" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://x"><Relationship Id="rId1" Type="t" Target="worksheets/sheet1.xml"/><Relationship Id="rId7" Type="t" Target="/xl/worksheets/sheet2.xml"/><Relationship Id="rId9" Type="t" Target="theme.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<?xml version="1.0"?><sst {ns} count="9">' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1"><v>1</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<?xml version="1.0"?><worksheet {ns}><dimension ref="A1"/><sheetData>{cells}</sheetData></worksheet>')
        z.writestr("xl/theme.xml", "<a/>")
    return str(path)


def test_a_workbook_equals_its_tsv(spark, tmp_path):
    heads = ["Our Tube #", "Site information", "RT primers for MAPseq", "Brain ", "Spike-in Ratio"]
    shared = [f'<t xml:space="preserve">{h}</t>' for h in heads] + ["<t>injection</t>", "<r><rPr><b/></rPr><t>tar</t></r><r><t>get</t></r>", "<t>b &amp; 1</t>"]
    text = lambda ref, i: f'<c r="{ref}" s="3" t="s"><v>{i}</v></c>'
    rows = '<row r="1"><c r="A1" t="inlineStr"><is><t>Some title</t></is></c></row>'
    rows += '<row r="2">' + "".join(text(f"{c}2", i) for i, c in enumerate(["A", "B", "D", "AA", "AB"])) + "</row>"
    rows += f'<row r="3"><c r="A3"><v>12</v></c>{text("B3", 5)}<c r="D3"><v>1</v></c>{text("AA3", 7)}<c r="AB3"><v>2.5</v></c></row>'
    rows += f'<row r="4"><c r="A4" t="inlineStr"><is><t>x7</t></is></c>{text("B4", 6)}<c r="C4" t="b"><v>1</v></c><c r="D4" t="str"><f>A1</f><v>2</v></c><c r="AA4"/></row>'
    rows += '<row r="5"/><row r="6"><c r="A6"><v>9</v></c></row>'
    path = workbook(tmp_path / "s.xlsx", rows, shared)
    tsv = tmp_path / "s.tsv"
    tsv.write_text("\t".join(heads) + "\n12\tinjection\t1\tb & 1\t2.5\nx7\ttarget\t2\t\t\n9\t\t\t\t\n")
    got, want = files.read_samples(spark, path), files.read_samples(spark, str(tsv))
    assert got.schema == want.schema and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2
    assert [tuple(r) for r in read_sheet(spark, path, 0).collect()] == []
    with pytest.raises(ValueError, match="no sheet"):
        read_sheet(spark, path, "none")
    amp = workbook(tmp_path / "q.xlsx", '<row r="1"><c r="A1"><v>1</v></c></row><row r="4">' + "".join(text(f"{c}4", i) for i, c in enumerate("ABCDEF")) + '</row><row r="5"><c r="A5"><v>1</v></c><c r="B5" t="inlineStr"><is><t>A1</t></is></c><c r="C5"><v>4</v></c><c r="E5"><v>0.5</v></c></row>', [f"<t>{h}</t>" for h in files.AMPLIFICATION], "Amplification Data")
    assert [(r.well_id, r.cycle, r.rn, r.rn_delta) for r in files.read_amplification(spark, amp).collect()] == [("A1", 4, 0.5, None)]


def test_the_sheets_sample_barcode_of_a_tube(spark):
    rows = spark.createDataFrame([("AAA", "T1"), ("CCC", "T1"), ("CCC", "t2"), ("GGG", "t9"), (None, "t2")], "ssi string, ourtube string")
    samples = spark.createDataFrame([("t1", "BC1"), ("T2", "BC2")], "ourtube string, label string")
    barcodes = spark.createDataFrame([("BC1", "AAA"), ("BC2", "CCC"), ("BC3", "GGG")], "label string, ssi string")
    assert sorted(tuple(r) for r in B.keep_sheet_ssi(rows, samples, barcodes).collect()) == [("AAA", "T1"), ("CCC", "t2"), ("GGG", "t9")]
    assert rows.where(F.col("ssi").isNull()).count() == 1
