"""FASTQ pairs over many tasks, landing counts that survive replays, ranks and the matrix sink."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from spindrift.operators import barcodes as B
from spindrift.operators import matrix as M
from spindrift.operators import ranks
from spindrift.plans.scratch import Scratch
from spindrift.sources import fastq, files
from spindrift.streaming.landing import LandedCounts, Run, land_files

RNG = random.Random(11)


def put_fastq(path, seqs, end="\n", last=True, opener=open):
    text = end.join(f"@r{i} {'@' * (i % 3)}{end}{s}{end}+{end}{'@+IJ'[i % 4] * len(s)}" for i, s in enumerate(seqs)) + (end if last and seqs else "")
    with opener(path, "wt", newline="") as f:
        f.write(text)
    return str(path)


def draw(n):
    return "".join(RNG.choice("ACGTN") for _ in range(n))


def test_pairs_in_ranges_equal_a_line_by_line_reading(spark, tmp_path, monkeypatch):
    one, two = [draw(RNG.choice([0, 1, 40, 151])) for _ in range(3001)], [draw(RNG.randint(0, 60)) for _ in range(3001)]
    a, b = put_fastq(tmp_path / "x_R1.fastq", one, last=False), put_fastq(tmp_path / "x_R2.fastq", two, end="\r\n")
    index = fastq.index_files
    monkeypatch.setattr(fastq, "index_files", lambda s, p: [fastq.FileIndex(*short_stretches(f)) for f in p])
    want = [(0, i, x[2:34], y[:20]) for i, (x, y) in enumerate(zip(one, two))]
    for task_bytes in (1 << 30, 10_000, 997):
        df = fastq.fastq_pairs(spark, [(a, b)], (2, 34), (0, 20), task_bytes)
        assert df.rdd.getNumPartitions() == {1 << 30: 1}.get(task_bytes, len(fastq.record_ranges(spark, [(a, b)], task_bytes)))
        assert sorted(tuple(r) for r in df.collect()) == want
    monkeypatch.undo()
    assert index(spark, [a, b])[0].records == 3001 and index(spark, [a, b])[1].records == 3001
    assert sorted(tuple(r) for r in fastq.fastq_pairs(spark, [(a, b)], (2, 34), (0, 20)).collect()) == want


def short_stretches(path, stride=701):
    """The index of a file in stretches that end anywhere."""
    data = open(path, "rb").read()
    starts = list(range(0, len(data), stride))
    return starts, [data[:s].count(b"\n") for s in starts], data.count(b"\n") + (not data.endswith(b"\n"))


def test_a_plain_file_larger_than_a_stretch_is_counted_in_parts(spark, tmp_path):
    seqs = [draw(100)] * 9000
    a, b = put_fastq(tmp_path / "b_R1.fastq", seqs), put_fastq(tmp_path / "b_R2.fastq", seqs)
    index = fastq.index_files(spark, [a], stretch=1 << 20)[0]
    assert len(index.starts) == 2 and index.records == 9000
    df = fastq.fastq_pairs(spark, [(a, b)], (0, 4), (96, 100), 400_000)
    assert df.rdd.getNumPartitions() == 5
    got = df.groupBy("s1", "s2").agg(F.count(F.lit(1)), F.max("rec_no"), F.countDistinct("rec_no")).collect()
    assert [tuple(r) for r in got] == [(seqs[0][:4], seqs[0][96:], 9000, 8999, 9000)]


def test_odd_pairs(spark, tmp_path):
    a, short = put_fastq(tmp_path / "M1_R1.fastq", ["AA", "CC", "GG"]), put_fastq(tmp_path / "M1_R2.fastq", ["AA", "CC"])
    with pytest.raises(ValueError, match="differ in records"):
        fastq.fastq_pairs(spark, [(a, short)])
    packed = put_fastq(tmp_path / "M2_R2.fastq.gz", ["AA", "CC"], opener=gzip.open)
    with pytest.raises(Exception, match="differ in records"):
        fastq.fastq_pairs(spark, [(a, packed)]).collect()
    with pytest.raises(ValueError, match="come in pairs"):
        fastq.fastq_pairs(spark, [(a,)])
    with pytest.raises(FileNotFoundError):
        fastq.fastq_pairs(spark, [(a, str(tmp_path / "none.fastq"))])
    empty, none = put_fastq(tmp_path / "E_R1.fastq", []), put_fastq(tmp_path / "E_R2.fastq.gz", [], opener=gzip.open)
    assert fastq.fastq_pairs(spark, [(empty, empty), (empty, none)]).count() == 0
    whole = put_fastq(tmp_path / "W_R2.fastq.gz", ["TTA", "", "C"], opener=gzip.open)
    rows = files.read_fastq_pairs(spark, [(empty, empty), (a, whole)], (0, 1), (0, 2), number=True).collect()
    assert sorted(tuple(r) for r in rows) == [("ATT", "M1", 1), ("C", "M1", 1), ("GC", "M1", 1)]
    apart = files.read_fastq_pairs(spark, [(a, whole)], (0, 1), (0, 2), concat=False)
    assert sorted(r.sequence for r in apart.collect()) == ["", "A", "C", "C", "G", "TT"]


def test_landed_batches_equal_one_count_and_survive_replays(spark, tmp_path):
    rows = [(RNG.choice(["a", "b", "c", None]), RNG.choice(["s", "t"])) for _ in range(400)]
    batches = [rows[i : i + 40] for i in range(0, 400, 40)]
    frame = lambda b: spark.createDataFrame(b, "sequence string, source string")
    want = sorted(map(tuple, B.aggregate_reads(frame(rows)).collect()))
    table = LandedCounts(spark, str(tmp_path / "t"), fan_in=3)
    with pytest.raises(FileNotFoundError):
        table.table()
    assert table.table(frame(rows).schema).count() == 0
    for i, b in enumerate(batches):
        table.add(frame(b), i)
        table.add(frame(b), i)  # handed over again
    assert sorted(map(tuple, table.table().collect())) == want
    assert table.runs() == [Run(0, 8), Run(9, 9)]
    table.add(frame(batches[4]), 4)  # long merged
    # a kill after a merge and before its parts went, and one in the middle of a batch
    table._write(table.counted(frame(batches[9])), Run(7, 7))
    table.counted(frame(batches[0])).write.parquet(str(tmp_path / "t" / Run(10, 10).name))
    (tmp_path / "t" / Run(10, 10).name / "_SUCCESS").unlink()
    assert table.runs() == [Run(0, 8), Run(9, 9)] and sorted(map(tuple, table.table().collect())) == want
    table.add(frame([("z", "s")]), 10)
    assert not (tmp_path / "t" / Run(7, 7).name).exists()
    assert sorted(map(tuple, table.table().collect())) == sorted([*want, ("z", "s", 1)])


def test_files_that_land_later_are_added(spark, tmp_path):
    def land(name, rows):
        spark.createDataFrame(rows, "sequence string, source string, n int").coalesce(1).write.parquet(str(tmp_path / "in" / name))

    land("1", [("a", "s", 2), ("b", "s", 1)])
    land("2", [("a", "s", 5)])
    schema = spark.read.parquet(str(tmp_path / "in" / "1")).schema
    args = (spark, str(tmp_path / "in" / "*"), schema, str(tmp_path / "t"), str(tmp_path / "ck"))
    assert sorted(map(tuple, land_files(*args, count="n", files_per_batch=1).collect())) == [("a", "s", 7), ("b", "s", 1)]
    land("3", [("b", "t", 4), (None, "t", 4)])
    assert sorted(map(tuple, land_files(*args, count="n").collect())) == [("a", "s", 7), ("b", "s", 1), ("b", "t", 4)]


def test_ranks_and_positions(spark):
    rows = [(RNG.choice(["x", "y", None]), RNG.choice([1, 1, 1, 2, 5, 9]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(7)
    plan = ranks.global_rank(df, [F.desc("v"), F.asc("id")], Scratch(spark, "t"))
    assert [r.id for r in sorted(plan.collect(), key=lambda r: r.rank)] == [i for _, _, i in sorted(rows, key=lambda r: (-r[1], r[2]))]
    by = {}
    for r in ranks.global_rank(df, [F.desc("v"), F.asc("id")], Scratch(spark, "t"), by=("g",)).collect():
        by.setdefault(r.g, []).append((r["rank"], -r.v, r.id))
    for g, found in by.items():
        assert [x[1:] for x in sorted(found)] == sorted((-v, i) for h, v, i in rows if h == g)
        assert sorted(x[0] for x in found) == list(range(1, len(found) + 1))
    down = sorted((v for _, v, _ in rows), reverse=True)
    for f in (0.0, 0.1, 0.33, 0.999):
        assert [r.value for r in ranks.value_at(df, "v", f, Scratch(spark, "t")).collect()] == [down[int(500 * f)]]
        assert [r.threshold for r in M.freq_threshold(df, f, "v").collect()] == [down[int(500 * f)] + 1]
    assert ranks.value_at(df, "v", 1.0, Scratch(spark, "t")).count() == 0
    assert ranks.global_rank(df.limit(0), [F.asc("id")], Scratch(spark, "t")).count() == 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text.split("BroadcastExchange")[0]  # the only unpartitioned window is over one row a range


def test_matrices_of_all_brains_in_one_job(spark, tmp_path):
    rows = [("b1", "AC", "BC2", 1.0), ("b1", "AC", "BC10", 2.5), ("b1", "GT", "BC1", 3.0), ("b2", "AC", "BC3", 4.0)]
    long = spark.createDataFrame(rows, "brain string, vbc_read string, label string, value double")
    parts = {"real": long, "spike": long.where("brain = 'b1'"), "normalized": long}
    before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    paths = files.write_matrices(files.matrix_rows(parts), str(tmp_path / "m"))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["b1.nbcm.tsv", "b1.rbcm.tsv", "b1.sbcm.tsv", "b2.nbcm.tsv", "b2.rbcm.tsv"]
    for p in paths:
        kind = {"rbcm": "real", "sbcm": "spike", "nbcm": "normalized"}[p.split(".")[-2]]
        want = M.matrix_wide(parts[kind].where(F.col("brain") == p.rsplit("/", 1)[1].split(".")[0])).drop("brain")
        got = spark.read.csv(p, sep="\t", header=True)
        assert got.columns == want.columns
        assert sorted(tuple(map(str, r)) for r in got.collect()) == sorted(tuple(map(str, r)) for r in want.collect())
    files.write_matrices(files.matrix_rows({k: v.where("brain = 'b2'") for k, v in parts.items()}), str(tmp_path / "m"))  # again
    assert spark.read.csv(paths[3], sep="\t", header=True).count() == 1 and before >= 0
