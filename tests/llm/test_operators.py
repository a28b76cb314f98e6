"""Small cases with nulls, empty and very long texts, repeated rows and clashing columns, against plain Python."""

import gzip
import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spindrift.llm import chat, decontaminate, embeddings, language, licenses, lines, mixing, simhash, substrings, warc
from spindrift.plans.scratch import Scratch

RNG = random.Random(1)
VOCAB = [f"w{i}" for i in range(60)]
PASSAGE = " ".join(RNG.choice(VOCAB) for _ in range(60))
DOCS = [(i, " ".join(RNG.choice(VOCAB) for _ in range(RNG.randint(0, 60))) + ((" " + PASSAGE) if i % 3 == 0 else "")) for i in range(24)]
DOCS += [(30, None), (31, ""), (32, " \t\n"), (33, PASSAGE), (33, PASSAGE), (34, (PASSAGE + " ") * 200), (35, "Ünïcode Wörter ABC")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en" if d % 2 else "de", None if d % 5 == 0 else f"s{d % 3}", "x") for d, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row string")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(docs, spark):
    got = simhash.simhash_components(docs).collect()
    assert len(got) == len(DOCS)
    fps = {d: plain_fingerprint(t) for d, t in DOCS}
    assert all(r.fp & (2**64 - 1) == fps[r.doc_id] for r in got)
    part = {d: d for d in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4:
                    part[a] = part[b] = min(part[a], part[b])
    assert {r.doc_id: r.component_id for r in got} == part
    base = [RNG.getrandbits(64) for _ in range(40)]
    near = base + [x ^ sum(1 << b for b in RNG.sample(range(64), k)) for x in base for k in (1, 2, 3, 4, 5)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    near = sorted({signed(x) for x in near})
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in near], "fp long")).collect()
    want = {(a, b) for a in near for b in near if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert len(links) == len(want) and {(r.a, r.b) for r in links} == want


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_near_groups(texts):
    """Brute force: texts link if a segment differs in at most one bit and their sets' similarity is 0.8 or more."""
    sets = simhash.word_sets([t for _, t in texts], 5)
    bits = simhash.wide_bits(sets, simhash.PARTS * 2 * simhash.HALF).reshape(len(texts), simhash.PARTS, -1)
    sets = [set(h.tolist()) for h in sets]
    part = {d: d for d, _ in texts}
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and ((bits[i] != bits[j]).sum(axis=1) <= 1).any()]
    for _ in range(12):
        for i, j in links:
            x, y = texts[i][0], texts[j][0]
            part[x] = part[y] = min(part[x], part[y])
    return part


def test_near_dedup(docs, spark):
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain_near_groups(sorted({d: t for d, t in DOCS}.items())).values()))
    rng = random.Random(3)
    rows = []
    for g in range(12):  # a text and 30 near copies with two words changed, 300 words each
        words = [f"{g}x{rng.randrange(10**6)}" for _ in range(300)]
        for c in range(31):
            copy = list(words)
            for at in rng.sample(range(300), 2 if c else 0):
                copy[at] = f"new{rng.random()}"
            rows.append((g * 100 + c, " ".join(copy)))
    got = simhash.near_dedup(spark.createDataFrame([*rows, (None, "alone"), (None, "alone")], "doc_id long, text string"))
    assert sorted(r.doc_id or -1 for r in got.collect()) == [-1, -1, -1, *(g * 100 for g in range(1, 12))]
    assert simhash.near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("group_rows", [1 << 18, 8])
def test_near_dedup_equals_brute_force(spark, monkeypatch, group_rows):
    """Chains around the similarity of 0.8; also with groups that are passed on to the cluster."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    rng = random.Random(5)
    rows = []
    for g in range(60):
        words = [f"{g}y{rng.randrange(10**6)}" for _ in range(rng.randint(20, 400))]
        for c in range(4):
            copy = list(words)
            for at in rng.sample(range(len(words)), len(words) * rng.randint(1, 4) // 100 + 1 if c else 0):
                copy[at] = f"new{rng.random()}"
            rows.append((g * 10 + c, " ".join(copy) + (" " + PASSAGE if g % 3 == 0 else "")))
    rng.shuffle(rows)
    part = plain_near_groups(rows)
    kept = sorted(r.doc_id for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert 60 < len(set(part.values())) < 200
    assert kept == sorted(set(part.values()))


def test_near_dedup_recall_of_isolated_pairs(spark):
    """Of pairs of 200-word texts in each range of similarity, at least nine in ten are found; none below 0.8."""
    rng, rows, sims = random.Random(11), [], {}
    for g in range(900):
        words = [f"{rng.randrange(10**7)}" for _ in range(200)]
        copy = list(words)
        for at in rng.sample(range(200), rng.randint(0, 7)):
            copy[at] = f"new{rng.random()}"
        cut = rng.randint(0, 6)
        copy = copy[cut:]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
        x, y = (set(h.tolist()) for h in simhash.word_sets([" ".join(words), " ".join(copy)], 5))
        sims[g] = jaccard(x, y)
    kept = {r.doc_id for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(2 * g in kept for g in sims) and all(2 * g + 1 in kept for g, s in sims.items() if s < 0.8)
    for lo in (0.8, 0.85, 0.9, 0.95):
        found = [2 * g + 1 not in kept for g, s in sims.items() if lo <= s < lo + 0.05]
        assert len(found) > 40 and np.mean(found) >= 0.9, (lo, len(found), np.mean(found))


def test_chat(spark):
    texts = ["<|im_end|>", "<\\|x", "", None, "a\nb", "<|im_start|>assistant ok"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["user", "assistant", "we\\n\n<|ird", None, "assistant", "assistant"], texts))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("extra", F.lit(1))
    r = chat.format_rows(chat.turn_rows(df)).select("formatted", chat.read_back(F.col("formatted")).alias("t"), chat.under_loss(F.col("formatted"), F.col("loss")).alias("l")).first()
    assert [(x.role, x.text) for x in r.t] == [(a or "", b or "") for _, _, a, b in rows]
    assert r.l == "<\\|xa\nb<|im_start|>assistant ok"
    assert chat.format_rows(chat.turn_rows(df.limit(0))).count() == 0
    recs = spark.createDataFrame([(1, '{"messages":[{"role":"user","content":"a"}]}'), (2, '{"prompt":"p","response":null}'), (3, "{bad"), (4, None), (5, '{"zz":1}')], "id long, record string")
    got = {r.id: r for r in chat.canonical_records(recs).collect()}
    assert [got[i].layout for i in range(1, 6)] == ["messages", "prompt_response", None, None, None]
    assert [(t.role, t.text) for t in got[2].turns] == [("user", "p"), ("assistant", "")]


def test_chat_layouts_by_fingerprint(spark):
    recs = [
        (1, '{"messages":[]}', "messages", []),
        (2, '{"id":7,"messages":[{"role":"user","content":"a","name":"n"},{"role":"bot","content":null}]}', "messages", [("user", "a"), ("assistant", "")]),
        (3, '{"prompt":"p","response":"r","system":null,"source":{"x":1}}', "system_prompt_response", [("user", "p"), ("assistant", "r")]),
        (4, '{"messages":null,"prompt":"p","response":"r"}', "prompt_response", [("user", "p"), ("assistant", "r")]),
        (5, '{"messages":"x"}', None, None),
        (6, "[1]", None, None),
        (7, "", None, None),
        (8, '{"turns":[{"role":"user","text":"' + "y " * 50_000 + '"}]}', "dialog_text", [("user", "y " * 50_000)]),
    ]
    df = spark.createDataFrame([(i, r, "mine", 1) for i, r, _, _ in recs], "id long, record string, layout string, _print long")
    got = chat.canonical_records(df)
    assert got.columns == ["id", "record", "layout", "_print", "turns"]
    rows = {r.id: r for r in got.collect()}
    for i, _, layout, turns in recs:
        assert rows[i].layout == layout
        assert turns is None and rows[i].turns is None or [(t.role, t.text) for t in rows[i].turns] == turns
    assert chat.canonical_records(df.limit(0)).count() == 0
    table = spark.createDataFrame([(1, 2, "q2", None), (1, 1, "q1", "a1")], "conv_id long, turn long, question string, answer string").withColumn("more", F.lit(0))
    out = chat.format_rows(chat.turn_rows(table)).select(chat.read_back(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in out] == [("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "")]
    with pytest.raises(ValueError):
        chat.turn_rows(table.drop("answer"))


def test_substrings(docs, spark):
    got = {r.doc_id: r for r in substrings.dedup_substrings(docs).collect()}
    seen = {}
    for d, t in sorted({d: t for d, t in DOCS}.items()):
        w = (t or "").split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if seen.setdefault(tuple(w[i : i + 20]), (d, i)) != (d, i):
                gone[i : i + 20] = [True] * 20
        left = [x for x, g in zip(w, gone) if not g]
        assert (got[d].n_words, got[d].n_removed, got[d].kept) == (len(w), len(w) - len(left), " ".join(left))
        for f in got[d].factors:
            ref = ({x: y for x, y in DOCS}[f.ref_doc] or "").split()
            assert ref[f.ref_start : f.ref_start + f.length] == w[f.start : f.start + f.length]
    assert substrings.dedup_substrings(docs.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    pages = [(1, "http://a.example/x?y=1#z", "p"), (2, "http://www.a.example/x", "p"), (3, None, None), (4, "u\r\n", ""), (5, "http://b.example", "WARC/1.1\r\n\r\n\r\n\r\nü"), (None, "http://c", "p")]
    index, folder = warc.archive_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), per_archive=2)
    got = index.collect()
    kinds = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in got}
    assert kinds == {1: ("revisit", 2, 1), 2: ("response", None, 1), 3: ("revisit", 4, 0), 4: ("response", None, 0), 5: ("response", None, 18), None: ("revisit", 2, 1)}
    for r in got:  # every offset is where its record can be read alone
        data = (Path(folder.removeprefix("file://")) / r.archive).read_bytes()
        assert gzip.decompress(data).startswith(b"WARC/1.1")
        _, head, body = next(warc.parse_archive(data[r.offset :]))
        assert head["WARC-Type"] == r.record_type and head["WARC-Payload-Digest"] == f"sha1:{r.payload_digest}"
        assert body.decode() == ("" if r.record_type == "revisit" else {p: h or "" for p, _, h in pages}[r.page_id])
    order = index.withColumn("_p", F.spark_partition_id()).collect()
    keys = [(r._p, r.url_key, r.ts) for r in order]
    assert keys == sorted(keys) and [k[1:] for k in keys] == sorted(k[1:] for k in keys)
    runs = [sorted(RNG.choices(range(50), k=n)) for n in (0, 5, 9, 1, 30)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_warc_long_repeated_and_empty(spark):
    schema = "page_id long, url string, html string"
    long = "".join(RNG.choices("abcdefgh ", k=1 << 20)) * 17  # over 16 MB: the member's size ends in a byte that isn't 0
    rows = [(1, "http://a", long), (2, "http://a", "x"), (2, "http://a", "x"), (3, "http://b", None)]
    pages = spark.createDataFrame(rows, schema).withColumns({"offset": F.lit(0), "archive": F.lit("mine")})
    got = sorted((r.page_id, r.record_type, r.payload_bytes) for r in warc.archive_pages(pages)[0].collect())
    assert got == [(1, "response", len(long)), (2, "response", 1), (2, "response", 1), (3, "response", 0)]
    assert warc.archive_pages(spark.createDataFrame([], schema))[0].count() == 0


@pytest.mark.parametrize("bound", [200_000, 0])
def test_decontaminate(docs, spark, bound):
    items = [(1, PASSAGE), (2, "W1 w2"), (3, None), (4, "!!"), (10, "nowhere at all")]
    got = {r.doc_id: r for r in decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), bound=bound).collect()}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    for d, t in DOCS:
        w, hit, who = words(t), set(), set()
        for i, text in items:
            x = words(text)
            n = min(13, len(x))
            wins = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    who.add(i)
        assert (got[d].n_words, got[d].n_hit, set(got[d]["items"])) == (len(w), len(hit), who)
        assert got[d].contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_lines(spark):
    common = "This line is a common one."
    rows = [(1, f"{common}\nown"), (2, f" {common.upper()} \nx"), (3, f"{common}\n{common}"), (4, None), (5, ""), (None, common), (2, f" {common.upper()} \nx")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("h1", F.lit(1))).collect()
    assert sorted((r.doc_id or 0, r.n_lines, r.n_dropped, r.kept) for r in got) == sorted([(1, 2, 1, "own"), (2, 2, 1, "x"), (2, 2, 1, "x"), (3, 2, 0, f"{common}\n{common}"), (4, 1, 0, ""), (5, 1, 0, ""), (0, 1, 0, common)])


def test_embeddings(spark):
    g = np.random.default_rng(2)
    x = g.standard_normal((60, 16))
    x = np.vstack([x, x[:30] + 0.1 * g.standard_normal((30, 16)), x[:5]])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [1.0, None]), (204, [])]
    got = {r.vec_id: r for r in embeddings.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), slab_rows=16).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert all(got[i].n_links == near[i].sum() - 1 for i in range(len(x)))
    part = list(range(len(x)))
    for _ in range(5):
        part = [min(part[j] for j in np.flatnonzero(near[i])) for i in range(len(x))]
    assert [got[i].component_id for i in range(len(x))] == part
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(200, 205))


def test_language_forward_backward_and_accuracy(spark):
    g = np.random.default_rng(4)
    emit, trans = g.standard_normal((4, 1, 3)), g.standard_normal((3, 3))
    m, logz = language.chain_marginals(emit, trans, np.array([4]))
    total, want = 0.0, np.zeros((4, 3))
    for y in np.ndindex(3, 3, 3, 3):
        s = np.exp(sum(emit[t, 0, y[t]] for t in range(4)) + sum(trans[y[t], y[t + 1]] for t in range(3)))
        total += s
        for t in range(4):
            want[t, y[t]] += s
    assert np.allclose(m[:, 0], want / total) and np.isclose(logz[0], np.log(total))
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(d, sample=120)
    long = [language.letters(" ".join(r.text for r in d.where("text is not null").orderBy("doc_id").limit(6).collect()))]
    assert np.allclose(model.document_scores(long, 10**9), model.document_scores(long, 37)) and len(long[0]) > 500
    assert language.letters("x" * 70) == ["x" * 32, "x" * 32, "x" * 6]
    switched = " ".join(r.text for lang in ("de", "en") for r in d.where(F.col("lang") == lang).orderBy("doc_id").limit(1).collect())
    assert 0.3 < model.document_scores([language.letters(switched)]).max() < 0.9
    out = language.identify(d, model).where(language.fold(F.col("doc_id")) == 1).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95
    odd = spark.createDataFrame([(1, None), (2, "123 !!"), (3, ""), (4, "² ½")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in language.identify(odd, model).collect()} == {("und", 0.0)}
    assert {r.lang_pred for r in language.identify(odd, language.train([], [])).collect()} == {"und"}


def test_mixing(docs, spark):
    out, schedule = mixing.mix(docs)
    rows = out.collect()
    assert len(rows) == len(DOCS) and all(0 <= r.taken <= 3 * r.size for r in rows)
    shares = {s.source: s for s in mixing.fill_targets([(s, sum(r.size for r in rows if r.source == s)) for s in {r.source for r in rows}])}
    for s, share in shares.items():
        assert abs(sum(r.taken for r in rows if r.source == s) - share.target) < 6
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs)[0].collect()))
    assert mixing.mix(docs.limit(0))[0].count() == 0
    small = mixing.fill_targets([("a", 1), ("b", 100), (None, 0)])
    assert [x.target for x in small] == [3.0, 98.0, 0.0]


@pytest.mark.parametrize("slots", [1, 7, 40, 1 << 20])
def test_mixing_meets_small_targets(spark, slots):
    """Blocks of many words: sources of a fraction of a block, and of a few blocks."""
    sizes = {"a": [400] * 9, "b": [3], "c": [20, 21], "d": [150, 1], "e": [1], None: [60, 0]}
    rows = [(n, s, " ".join(["w"] * k)) for n, (s, k) in enumerate((s, k) for s, ks in sizes.items() for k in ks)]
    out, schedule = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), slots=slots)
    got, pieces = out.collect(), schedule.collect()
    block = -(-sum(map(sum, sizes.values())) // slots)
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    for share in mixing.fill_targets([(s, sum(k)) for s, k in sizes.items()]):
        assert abs(sum(r.taken for r in got if r.source == share.source) - share.target) <= 0.5
        slot_words = {}
        for p in pieces:
            if p.source == share.source:
                slot_words[p.rank] = slot_words.get(p.rank, 0) + p.length
        assert all(0 < n <= block for n in slot_words.values())
    size = {n: len(t.split()) for n, _, t in rows}
    words = sorted((p.doc_id, p.copy, p.start + i) for p in pieces for i in range(p.length))
    assert len(words) == len(set(words)) and all(i < size[d] for d, _, i in words)
    assert {p.slot for p in pieces} <= set(range(-(-sum(size.values()) // block)))


def test_licenses(spark):
    rows = [(1, "Hello\nLicensed under the Apache License, Version 2.0.\n"), (2, "a driving license is required"), (3, None), (4, "word " * 3000 + "Released under the MIT License. " + "word " * 3000)]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].licenses for i in (1, 2, 3, 4)] == [["apache"], [], [], ["mit"]]
    assert got[3].n_paragraphs == 0 and got[3].score == 0


def test_wrapped_and_dual_licenses(spark):
    mit = "# Permission is hereby granted, free of charge, to any person\n# obtaining a copy of this software and associated\n# documentation files (the \"Software\"), to deal"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    gpl = "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n    the Free Software Foundation, either version 3"
    prose = "word \n" * 37
    texts = [mit, bsd, gpl, prose + gpl + "\n" + prose, "Licensed under the MIT License. Licensed under CC BY 4.0.", mit.replace("\n", "\n\n"), "one\n \t\ntwo\n\n\nthree\nfour"]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].licenses for i in range(7)] == [["mit"], ["bsd"], ["gpl"], ["gpl"], ["cc-by", "mit"], [], []]
    assert [got[i].n_paragraphs for i in range(7)] == [1, 1, 1, 1, 1, 3, 3]


CLASHES = ("contaminated", "items", "n_words", "n_hit", "_n", "_row", "_d", "_r", "_hit", "_items", "n_lines", "n_dropped", "kept", "_gone", "_id", "h1", "newest", "_t", "fp", "component_id", "lang_pred", "score", "row", "words", "_extra_0")


def test_other_columns_with_an_operators_names_stay(spark):
    """Filters return the caller's columns and values, also of empty tables, whatever they are called."""
    rows = [(1, PASSAGE, "en"), (2, "the cat sat on the mat today", "en"), (2, "the cat sat on the mat today", "en"), (None, "the dog ran", "en"), (3, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = plain.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    filters = (lambda d: decontaminate.decontaminate(d, items), lines.drop_lines, simhash.near_dedup, language.keep_identified)
    for keep in filters:
        want, got = keep(plain).collect(), keep(df)
        assert got.columns == df.columns
        got = got.collect()
        assert sorted(repr(tuple(r)[:3]) for r in got) == sorted(repr(tuple(r)) for r in want)
        assert all(r[c] == f"own {c}" for r in got for c in CLASHES)
        assert keep(df.limit(0)).count() == 0
    judged = decontaminate.contamination(df, items)
    assert len(set(judged.columns)) == len(judged.columns) and judged.where("contaminated").count() == 1
    assert lines.dedup_lines(df).where("kept = text or text is null").count() == len(rows)


def test_digest_is_of_utf8():
    assert substrings.digest("ü") == hashlib.sha256("ü".encode()).hexdigest()
