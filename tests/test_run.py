import json
import os
import random

import pytest
from pyspark.sql import functions as F

from spindrift.__main__ import main
from spindrift.operators import barcodes as B
from spindrift.operators import matrix as M
from spindrift.operators import qpcr, simulate
from spindrift.sources import files


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_edges_equal_brute_force(spark):
    rng = random.Random(5)
    seqs = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (12, 12, 20, 30, 30, 2)] + ["", "A", "ACN"]
    for s in list(seqs):
        for _ in range(5):
            t = list(s)
            for _ in range(rng.randint(1, 4)):
                at = rng.randrange(len(t) + 1)
                t[at : at + rng.randint(0, 1)] = rng.choice(["", "A", "C", "G", "T"])
            seqs.append("".join(t))
    seqs = sorted(set(seqs))
    df = spark.createDataFrame([(g, s) for g in ("g", None) for s in [*seqs, None]], "grp string, seq string")
    got = sorted((r.grp or "", r.a, r.b, r.distance) for r in B.similarity_edges(df, 3, "levenshtein").collect())
    assert got == sorted((g, a, b, edit_distance(a, b)) for g in ("g", "") for a in seqs for b in seqs if a < b and edit_distance(a, b) <= 3)


def test_hamming_edges_of_short_and_odd_sequences(spark):
    rng = random.Random(6)
    seqs = sorted({"".join(rng.choice("ACGTN") for _ in range(n)) for n in (0, 1, 3, 12, 12, 47) for _ in range(12)} | {"ACGTACGTACGT", "ACGTACGTACGA", "A" * 47, "A" * 46 + "C", "A" * 45 + "NC"})
    got = {(r.a, r.b): r.distance for r in B.similarity_edges(spark.createDataFrame([("g", s) for s in seqs], "grp string, seq string")).collect()}
    ham = lambda a, b: sum(x != y for x, y in zip(a, b))
    assert got == {(a, b): ham(a, b) for a in seqs for b in seqs if a < b and len(a) == len(b) and ham(a, b) <= 3}


def test_simulated_reads_collapse_to_their_parents(spark):
    reads = simulate.simulated_vbcreads(spark, 40, 2, 2).select("sequence", "read_count", "parent_idx", F.lit("b").alias("brain"))
    assert reads.count() == 9 * reads.select("parent_idx").distinct().count()
    out = B.align_collapse(reads, "sequence")
    kept = out.groupBy("sequence").agg(F.countDistinct("parent_idx").alias("n")).collect()
    assert kept and all(r.n == 1 for r in kept)  # random parents are far apart, so no two meet
    assert len(kept) < reads.select("sequence").distinct().count()
    assert out.where("sequence <> sequence_orig").count() > 0


def test_wells(spark):
    curve = lambda mid: [(c, 1 / (1 + 2.718281828 ** (-(c - mid)))) for c in range(1, 41)]
    rows = [(w, c, y) for w, mid in (("A1", 15), ("A2", 16), ("A3", 28)) for c, y in curve(mid)] + [("flat", c, 0.5) for c in range(1, 41)] + [("A1", None, 1.0), ("A1", 3, None)]
    got = {r.well_id: r for r in qpcr.cycle_report(spark.createDataFrame(rows, "well_id string, cycle int, rn double"), sensitivity=1.0).collect()}
    for w, mid in (("A1", 15), ("A2", 16), ("A3", 28)):
        assert mid - 6 <= got[w].low <= mid <= got[w].high <= mid + 6 and not got[w].error
    assert got["A1"].group_id == got["A2"].group_id != got["A3"].group_id
    assert got["flat"].error and got["flat"].group_id is None
    assert qpcr.check_wells(spark.createDataFrame([], "well_id string, cycle int, rn double")).count() == 0


def test_more_sources_and_sinks(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    fa = files.read_fasta_records(spark, put("a.fa", ">one x>y\nACG\nT\n>two\n\n>three\nGG"))
    assert [tuple(r) for r in fa.collect()] == [("one x>y", "ACGT"), ("two", ""), ("three", "GG")]
    line = "\t".join(["q", "0", "r", "7", "42", "4M", "*", "0", "0", "ACGT", "IIII", "AS:i:-6", "NM:i:1", "MD:Z:2:A1", "NM:i:9"])
    sam = files.read_alignments(spark, put("a.sam", f"@HD\tVN:1\n{line}\nshort\n")).collect()
    assert [(r.name_read, r.offset, r.score, r.distance, r.md, r.next, r.yt) for r in sam] == [("q", 7, -6, 1, "2:A1", None, None)]
    assert files.read_bowtie1(spark, put("b.tsv", "q\t+\tr\t3\tACGT\tII\"I\t0\t1:A>C\n")).first().mm_desc == "1:A>C"
    assert [r.item for r in files.read_list(spark, put("l.txt", "# no\n a \n\nb\n")).collect()] == ["a", "b"]
    assert [r["items"] for r in files.read_lists(spark, put("ll.txt", "['a', 'b']\n[]\n[\"c\"]\nnone\n")).collect()] == [["a", "b"], [], ["c"]]
    amp = files.read_amplification(spark, put("q.tsv", "Well\tWell Position\tCycle\tTarget Name\tRn\tDelta Rn\n1\tA1\t4\tt\t0.5\t0.1\n1\tA1\t\tt\t\t\n"))
    assert [(r.well_id, r.cycle, r.rn, r.rn_delta) for r in amp.collect()] == [("A1", 4, 0.5, 0.1)]
    mx = files.read_matrix(spark, put("m.tsv", "vbc_read\tBC1\tBC2\nAC\t1.0\t0.0\nGT\t0.0\t2.5\n"), "b")
    assert sorted(tuple(r) for r in mx.collect()) == [("b", "AC", "BC1", 1.0), ("b", "GT", "BC2", 2.5)]
    named = M.rename_labels(mx, spark.createDataFrame([("BC1", "7")], "matrixcolumn string, rtprimer string"))
    assert sorted(r.label for r in named.collect()) == ["BC2", "BC7"]
    table = str(tmp_path / "t.parquet")
    files.upsert(spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "x string, y int"), table)
    again = files.upsert(spark.createDataFrame([("a", "1", "new")], "x string, y string, z string"), table)
    assert sorted(tuple(r) for r in again.collect()) == [("", "2", ""), ("a", "1", ""), ("a", "1", "new")]
    files.write_demultiplexed(spark.createDataFrame([("ACG", "BC1"), ("TT", None)], "sequence string, label string"), str(tmp_path / "demux"))
    assert [r.value for r in spark.read.text(str(tmp_path / "demux" / "label=BC1")).collect()] == [">ACG", "ACG"]
    stats = files.add_stat(files.add_stat({}, "/a/b", "k", 1), "/a", "j", 2)
    assert files.render_report("{{ stats.a.b.k }}-{{stats['a']['j']}}-{{ conf.p.q }}-{{ stats.no.way }}", stats, {"p": {"q": "z"}}) == "1-2-z-"


def test_whole_run(spark, tmp_path):
    """Reads with planted barcodes, a template switch, an L1 molecule and an unknown sample barcode come out as the matrices say."""
    rng = random.Random(9)
    draw = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    ssi = {k: draw(8) for k in (1, 2, 3)}
    put = lambda name, text: (tmp_path / name).write_text(text)
    put("ssi.txt", "".join(f"SSI{k}\t{s}\n" for k, s in ssi.items()))
    heads = ["Our Tube #", "Site information", "RT primers for MAPseq", "Brain", "Region"]
    put("samples.tsv", "\n".join("\t".join(r) for r in [heads, ["1", "injection", "1", "b1", "inj"], ["2", "target", "2", "b1", "ctx"], ["3", "target", "3", "b1", "thal"]]) + "\n")
    real, near = "ACGTTGCAAGCTTACGGATCCATGCAATGC", "ACGTTGCAAGCTTACGGATCCATGCAATGA"
    reads = []

    def molecules(vbc, tag, sample, n, code=None):
        for _ in range(n):
            reads.extend([vbc + tag + draw(12) + (code or ssi[sample])] * 3)

    spike = draw(24) + "CGTCAG"
    molecules(real, "CT", 1, 12)
    molecules(real, "CT", 2, 5)
    molecules(near, "CT", 2, 1)  # collapses into the other
    molecules(real, "CT", 3, 1)
    molecules(draw(30), "AG", 2, 4)  # L1 in a target: a template switch
    molecules(real, "CT", 2, 2, "AAAAAAAC")
    for k, n in ((1, 4), (2, 4), (3, 2)):
        molecules(spike, "TC", k, n)
    for side, (a, b) in (("1", (0, 32)), ("2", (32, 52))):
        put(f"run1_R{side}.fastq", "".join(f"@r{i}\n{s[a:b]}\n+\n{'I' * (b - a)}\n" for i, s in enumerate(reads)))
    put("run.conf", "[vbcfilter]\ninj_min_umi = 10\n")
    out = str(tmp_path / "out")
    args = ["run", "-c", str(tmp_path / "run.conf"), "-s", str(tmp_path / "samples.tsv"), "-b", str(tmp_path / "ssi.txt"), "-O", out, str(tmp_path / "run1_R1.fastq"), str(tmp_path / "run1_R2.fastq")]
    main([*args[:1], "--halt", "filtered", *args[1:]])
    assert os.path.exists(f"{out}/filtered.parquet") and not os.path.exists(f"{out}/readtable.parquet")
    before = os.stat(f"{out}/reads.parquet/_SUCCESS").st_mtime_ns
    main(args)
    assert os.stat(f"{out}/reads.parquet/_SUCCESS").st_mtime_ns == before  # found, not made again
    read = lambda name: spark.read.csv(f"{out}/{name}.tsv", sep="\t", header=True)
    assert [r.source for r in spark.read.parquet(f"{out}/reads.parquet").select("source").distinct().collect()] == ["run1"]
    assert read("rejected/bad_ssi").count() == 2 and read("rejected/template_switch").count() == 4
    got = {r.vbc_read: (r.BC1, r.BC2, r.BC3) for r in read("matrices/b1.rbcm").collect()}
    assert got == {real: ("12.0", "6.0", "1.0")}
    normal = read("matrices/b1.nbcm").first()
    assert (normal.BC1, normal.BC2, normal.BC3) == ("12.0", "6.0", "2.0")
    with pytest.raises(SystemExit):
        main(["run", "--halt", "nowhere"])


def planted_run(tmp_path, rows, minima=("", "", ""), ratios=("", "", ""), conf=""):
    """Arguments of a run over reads of (barcode, tag, sample, molecules, reads a molecule)."""
    rng = random.Random(4)
    draw = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    ssi = {k: draw(8) for k in (1, 2, 3)}
    heads = ["Our Tube #", "Site information", "RT primers for MAPseq", "Brain", "Region", "Spike-in Ratio", "Read Count Minimum"]
    sheet = [heads, *[[str(k), site, str(k), "b1", reg, ratios[k - 1], minima[k - 1]] for k, site, reg in ((1, "injection", "inj"), (2, "target", "ctx"), (3, "target", "thal"))]]
    (tmp_path / "ssi.txt").write_text("".join(f"SSI{k}\t{s}\n" for k, s in ssi.items()))
    (tmp_path / "samples.tsv").write_text("\n".join("\t".join(r) for r in sheet) + "\n")
    reads = [s for vbc, tag, k, n, each in rows for _ in range(n) for s in [vbc + tag + draw(12) + ssi[k]] * each]
    for side, (a, b) in (("1", (0, 32)), ("2", (32, 52))):
        (tmp_path / f"run1_R{side}.fastq").write_text("".join(f"@r{i}\n{s[a:b]}\n+\n{'I' * (b - a)}\n" for i, s in enumerate(reads)))
    (tmp_path / "run.conf").write_text(conf)
    at = lambda name: str(tmp_path / name)
    return ["-c", at("run.conf"), "-s", at("samples.tsv"), "-b", at("ssi.txt"), "-O", at("out"), at("run1_R1.fastq"), at("run1_R2.fastq")]


REAL, OTHER, SPIKE = "ACGTTGCAAGCTTACGGATCCATGCAATGC", "TTGACCAGTAGGCATTACGCGATCTAGGCA", "GATTACAGGCTAACCGTTAGCTAA" + "CGTCAG"
ROWS = [(REAL, "CT", 1, 12, 5), (REAL, "CT", 2, 4, 5), (REAL, "CT", 2, 3, 3), (REAL, "CT", 3, 4, 3), (OTHER, "CT", 3, 2, 3), (SPIKE, "TC", 1, 4, 5), (SPIKE, "TC", 2, 4, 5), (SPIKE, "TC", 3, 2, 5)]


def normal(spark, tmp_path, kind="nbcm"):
    found = spark.read.csv(str(tmp_path / "out" / "matrices" / f"b1.{kind}.tsv"), sep="\t", header=True)
    return {r.vbc_read: {c: float(r[c]) for c in found.columns[1:]} for r in found.collect()}


def test_a_sample_keeps_reads_from_its_own_minimum_on(spark, tmp_path):
    main(["run", *planted_run(tmp_path, ROWS, minima=("", "4", ""))])
    got = {(r.label, r.type, r.vbc_read): r.umi_count for r in spark.read.parquet(str(tmp_path / "out" / "vbctable.parquet")).collect()}
    assert got == {("BC1", "real", REAL): 12, ("BC2", "real", REAL): 4, ("BC3", "real", REAL): 4, ("BC3", "real", OTHER): 2, ("BC1", "spike", SPIKE): 4, ("BC2", "spike", SPIKE): 4, ("BC3", "spike", SPIKE): 2}
    assert normal(spark, tmp_path) == {REAL: {"BC1": 12.0, "BC2": 4.0, "BC3": 8.0}}
    before = spark.read.csv(str(tmp_path / "out" / "spikeqc.prethresh.tsv"), sep="\t", header=True)
    assert {(r.label, r.n_umi) for r in before.collect()} == {("BC1", "4"), ("BC2", "4"), ("BC3", "2")}


def test_ratios_count_only_if_one_exceeds_1(spark, tmp_path):
    args = planted_run(tmp_path, ROWS, ratios=("1", "0.5", "1"))
    main(["run", *args])
    assert normal(spark, tmp_path)[REAL] == {"BC1": 12.0, "BC2": 7.0, "BC3": 8.0}
    sheet = tmp_path / "samples.tsv"
    sheet.write_text(sheet.read_text().replace("thal\t1\t", "thal\t2\t"))  # what depends on the sheet is made anew, the reads aren't
    stamp = os.stat(tmp_path / "out" / "reads.parquet" / "_SUCCESS").st_mtime_ns
    main(["run", *args])
    assert normal(spark, tmp_path)[REAL] == {"BC1": 12.0, "BC2": 3.5, "BC3": 16.0}
    assert os.stat(tmp_path / "out" / "reads.parquet" / "_SUCCESS").st_mtime_ns == stamp


def test_found_stages_changed_settings_force_and_numbers(spark, tmp_path):
    args = planted_run(tmp_path, [*ROWS, ("A" * 30, "CT", 2, 2, 3)])
    stages = ("reads", "aggregated", "filtered")
    stamps = lambda: {s: os.stat(tmp_path / "out" / f"{s}.parquet" / "_SUCCESS").st_mtime_ns for s in stages}
    changed = lambda a, b: {s for s in stages if a[s] != b[s]}
    main(["filtered", *args])
    first = stamps()
    main(["run", "--halt", "filtered", *args])
    assert changed(first, stamps()) == set()
    (tmp_path / "run.conf").write_text("[fastq]\nmax_repeats = 20\n")
    main(["filtered", *args])
    second = stamps()
    assert changed(first, second) == {"filtered"}
    main(["aggregated", "-f", *args])
    third = stamps()
    assert changed(second, third) == {"aggregated"}
    lines = (tmp_path / "run1_R1.fastq").read_text().splitlines(keepends=True)
    for side in "12":
        path = tmp_path / f"run1_R{side}.fastq"
        path.write_text("".join(path.read_text().splitlines(keepends=True)[: len(lines) - 4 * 3]))
    (tmp_path / "run.conf").write_text("[vbctable]\nmerge_samples = False\n")
    main(["run", *args])
    assert changed(third, stamps()) == set(stages)
    stats = json.loads((tmp_path / "out" / "stats.json").read_text())
    n = len(lines) // 4 - 3
    assert stats["fastq"] == {"pairs_handled": 1, "reads_handled": n, "pair1_len": n, "n_repeat_A": 1, "n_repeat_C": 0, "n_repeat_G": 0, "n_repeat_T": 0}
    assert stats["fastq_filter"] == {"num_initial": 36, "max_repeats": 7, "num_has_repeats": 1, "num_has_n": 0, "num_kept": 35}
    assert stats["readtable"] == {"n_initial": 35, "n_badssi": 0, "n_tswitch": 0, "n_lones": 0, "n_badtype": 0, "n_full_sequences": 35, "n_final": 35}
    assert stats["collapse"] == {"api_max_mismatch": 3, "n_thresholded_sequences": 35, "n_no_group": 0, "n_remerged": 0, "brain_b1": {"n_unique_sequences": 3, "n_edges": 0, "n_multi_components": 0}}
    assert stats["vbctable"] == {"n_vbcs": 7} and stats["matrices"] == {"brain_b1": {"n_vbcs_real": 1, "n_vbcs_spike": 1}}
    (tmp_path / "t.md").write_text("{{ stats.fastq.reads_handled }} reads, {{ conf.project.project_id }}")
    main(["report", "-O", str(tmp_path / "out"), "-t", str(tmp_path / "t.md"), "-o", str(tmp_path / "r.md")])
    assert (tmp_path / "r.md").read_text() == f"{n} reads, M000"
    (tmp_path / "run.conf").write_text("[vbctable]\nmerge_samples = True\n")
    main(["vbctable", *args])
    merged = spark.read.parquet(str(tmp_path / "out" / "vbctable.parquet")).select("label", "region", "ourtube").distinct().collect()
    assert [tuple(r) for r in merged] == [("BC100", "100", "100")]


def test_reads_of_other_samples_in_a_tube_go_while_reading(spark, tmp_path):
    args = planted_run(tmp_path, [(REAL, "CT", 2, 3, 2), (REAL, "CT", 3, 1, 2)], conf="[fastq]\nfilter_by_sampleinfo_ssi = True\n")
    for side in "12":
        os.rename(tmp_path / f"run1_R{side}.fastq", tmp_path / f"M1-2_R{side}.fastq")
    args = [a.replace("run1_R", "M1-2_R") for a in args]
    main(["reads", *args])
    assert spark.read.parquet(str(tmp_path / "out" / "reads.parquet")).count() == 6
    (tmp_path / "run.conf").write_text("[fastq]\nfilter_by_non_dominant = True\n")
    main(["reads", *args])
    assert spark.read.parquet(str(tmp_path / "out" / "reads.parquet")).count() == 6
    assert json.loads((tmp_path / "out" / "stats.json").read_text())["fastq"] == {"pairs_handled": 1, "pair1_len": 8, "reads_handled": 6}
