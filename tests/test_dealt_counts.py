"""Counts are dealt out once, to a number of tasks that grows with the rows, and nothing is summed up before."""

import re

from spindrift.operators import barcodes as B
from spindrift.operators import matrix as M
from spindrift.plans import scratch as S
from spindrift.streaming.landing import LandedCounts

READS = "vbc_read string, label string, type string, umi string, read_count long, brain string, site string"


def _dealt(df):
    """Numbers of tasks that rows are dealt to, the last first."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan)]


def _reads(spark, tmp_path, monkeypatch, times):
    path = str(tmp_path / f"rows{times}")
    rows = [(f"v{i % 50}", f"BC{i % 3}", "real", f"u{i % 7}", 2, "b1", "target") for i in range(300)] * times
    spark.createDataFrame(rows, READS).write.parquet(path)
    monkeypatch.setattr(S, "TASK_BYTES", 400)
    return spark.read.parquet(path)


def test_tasks_of_counts_grow_with_the_rows(spark, tmp_path, monkeypatch):
    small, large = (_reads(spark, tmp_path, monkeypatch, n) for n in (1, 40))
    for make, most in ((B.vbc_table, 1), (lambda x: M.matrix_wide(M.matrix_long(B.vbc_table(x)), ["BC0", "BC1", "BC2"]), 2)):
        a, b = _dealt(make(small)), _dealt(make(large))
        assert len(a) == len(b) <= most and all(n > m >= 8 for m, n in zip(a, b)), (a, b)
    got = {tuple(r)[:5] for r in B.vbc_table(large).collect()}
    assert len(got) == 150 and got == {(f"v{i % 50}", f"BC{i % 3}", "real", 2 if len({j % 7 for j in range(i, 300, 150)}) == 2 else 1, 160) for i in range(150)}
    wide = M.matrix_wide(M.matrix_long(B.vbc_table(large)), ["BC0", "BC1", "BC2"]).collect()
    assert len(wide) == 50 and {tuple(r)[2:] for r in wide} <= {(x, y, z) for x in (1.0, 2.0) for y in (1.0, 2.0) for z in (1.0, 2.0)}


def test_landed_rows_are_dealt_out_by_size(spark, tmp_path, monkeypatch):
    table = LandedCounts(spark, f"file://{tmp_path}/counts", ("vbc_read", "label"))
    small, large = (_reads(spark, tmp_path, monkeypatch, n) for n in (1, 40))
    a, b = _dealt(table.counted(small)), _dealt(table.counted(large))
    assert len(a) == len(b) == 1 and b[0] > a[0]
    table.add(large, 0)
    table.add(small, 1)
    assert len(_dealt(table.table())) == 1
    assert {tuple(r) for r in table.table().collect()} == {(f"v{i % 50}", f"BC{i % 3}", 82) for i in range(150)}
