"""Work that the text operators must not do twice."""

from spindrift.llm import simhash, warc
from spindrift.plans.scratch import Scratch


def test_a_page_is_hashed_once(spark):
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None)], "page_id long, url string, html string")
    records = warc.plan_records(pages, Scratch(spark, "t"))
    assert records._jdf.queryExecution().optimizedPlan().toString().count("sha1(") == 1
    assert [(r.page_id, r.payload_digest, r.refers_to) for r in records.orderBy("page_id").collect()] == [(1, "CH3K3DWFFIUYJK5K7V6DWULFAN4FYIDS", 2), (2, "CH3K3DWFFIUYJK5K7V6DWULFAN4FYIDS", None), (3, "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ", None)]


def test_fingerprint_classes_never_pass_through_the_driver(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(20)], "doc_id long, text string")
    assert "BroadcastHashJoin" not in simhash.simhash_components(docs)._jdf.queryExecution().executedPlan().toString()


def test_marks_meet_their_copies_once(spark, monkeypatch):
    """What is compared is written; neither texts nor marks are matched with their copies each time they are read."""
    seen = []
    whole = simhash.set_components
    monkeypatch.setattr(simhash, "set_components", lambda docs, marks, *more: (seen.extend((docs, marks)), whole(docs, marks, *more))[1])
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text.upper()), (4, "other words stand here"), (None, text)], "doc_id long, text string")
    assert sorted(r.doc_id or 0 for r in simhash.near_dedup(docs).collect()) == [0, 1, 4]
    assert all("LeftAnti" not in x._jdf.queryExecution().optimizedPlan().toString() for x in seen)
    assert sorted(r.doc_id for r in seen[1].collect()) == [1, 4]
