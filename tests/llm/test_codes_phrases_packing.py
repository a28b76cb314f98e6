"""Vector codes, collocations and packing against plain Python, with nulls, empties, ties and repeats."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spindrift.llm import codes, collocations, packing

RNG = random.Random(3)

# --- codes -------------------------------------------------------------------------


def plain_codes(rows, parts=8, size=16, rounds=6, scale=4096):
    """rows: (vec_id, label, list) of valid vectors."""
    ints = [(i, lab, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, lab, v in rows]
    w = len(ints[0][2]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    first = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:size]
    books = [[cut(r[2], p) for r in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        held = {}
        for _, _, v in ints:
            for p in range(parts):
                held.setdefault((p, near(v, p)), []).append(cut(v, p))
        for (p, e), vs in held.items():
            books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    out = []
    for i, lab, v in ints:
        code = [near(v, p) for p in range(parts)]
        out.append((i, lab, "".join(f"{c:02x}" for c in code), sum(far(cut(v, p), books[p][c]) for p, c in enumerate(code))))
    by = Counter()
    for _, lab, _, e in out:
        by[lab] += e
    return sorted(((i, c, e, by[lab]) for i, lab, c, e in out), key=str), books


@pytest.mark.parametrize("kind", ["plain", "few", "huge"])
def test_codes_equal_brute_force(spark, kind):
    n = {"plain": 120, "few": 5, "huge": 40}[kind]
    times = 3e5 if kind == "huge" else 1.0  # squared distances beyond 64 bits on the way, errors within
    centre = [[RNG.uniform(-1, 1) for _ in range(16)] for _ in range(6)]
    rows = [(i * 3, None if i % 7 == 0 else i % 3, [times * (round(c, 1) if i % 2 else c + RNG.gauss(0, 0.01)) for c in RNG.choice(centre)]) for i in range(n)]
    rows += [rows[2], (rows[3][0], 1, rows[4][2]), (None, None, rows[1][2])]
    bad = [(-5, 1, None), (-4, 1, []), (-3, 1, [1.0] * 15), (-2, None, [float("nan")] * 16), (-1, 2, [float("inf")] + [0.0] * 15), (-6, 2, [None] + [0.0] * 15), (10_000, 1, [0.5] * 24)]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows + bad], "vec_id long, label int, embedding array<double>, code string, error double")
    got, books = codes.compress(df)
    want, plain = plain_codes(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()), key=str) == want
    assert books.entries.tolist() == plain


def test_codes_of_nothing(spark):
    got, books = codes.compress(spark.createDataFrame([(1, 1, None)], "vec_id long, label int, embedding array<float>"))
    assert got.count() == 0 and books is None and got.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_nearest_with_ties_and_python_integers():
    for dtype in (np.int64, object):
        for _ in range(30):
            book, x = np.array([[RNG.randint(-3, 3) for _ in range(5)] for _ in range(9)], dtype=dtype), np.array([[RNG.randint(-3, 3) for _ in range(5)] for _ in range(50)], dtype=dtype)
            far = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
            code, least = codes.nearest(x, book)
            assert code.tolist() == far.argmin(axis=1).tolist() and least.tolist() == far.min(axis=1).tolist()


# --- collocations --------------------------------------------------------------------


def plain_collocations(rows, least, top):
    f, n = {}, Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    key = (lang or "und", tuple(w[i : i + k]))
                    f[key] = f.get(key, 0) + 1
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = {}
    for (lang, w), a in cand.items():
        if any(x == lang and len(y) > len(w) and 100 * b >= 80 * a and any(y[i : i + len(w)] == w for i in range(len(y))) for (x, y), b in cand.items()):
            continue
        score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, left, r) in enumerate(sorted(v)[:top]))


def test_collocations_equal_brute_force(spark):
    words = ["the", "The", "of", "ünï", "new", "york", "a-b", "x", "日本"] + [f"w{i}" for i in range(12)]
    rows = [(" ".join(RNG.choice(words) + RNG.choice(["", "", "", ",", "  ", "\t", ".", "!\n"]) for _ in range(RNG.randint(0, 60))), RNG.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += [("New York  city\tlights", "en")] * 9 + [(None, "en"), ("", None), (" \t.,;", "fr"), ("new york new york new york new york " * 300, "en")]
    df = spark.createDataFrame([(i, *r, 1, "z") for i, r in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string")
    for least, top in ((3, 15), (6, 2000)):
        got = sorted(tuple(r) for r in collocations.collocations(df, least=least, top=top).collect())
        assert got == plain_collocations(rows, least, top) and got
    assert collocations.collocations(df.limit(0)).count() == 0
    assert {r.lang for r in collocations.collocations(df.where("lang = 'fr'"), least=1).collect()} == set()


def test_a_full_bitmap_and_small_buckets_change_nothing(spark):
    from spindrift.plans.scratch import Scratch

    rows = [(" ".join(RNG.choice("abcde") for _ in range(30)), "en") for _ in range(40)]
    pieces = collocations.pieces_of(spark.createDataFrame(rows, "text string, lang string"))
    one, two = (collocations.count_grams(pieces, Scratch(spark, "t"), 4, 4, bits, "64MB", most) for bits, most in ((8, 200), (25, 4 << 20)))
    for a, b in zip(one, two):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count()


# --- packing ---------------------------------------------------------------------------

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True


def test_encoder_equals_the_tokenizer(monkeypatch):
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), room=500)
    parts = ["a", "b ", "'s", " ", "  ", "\n", "\t", "\r\n", "12", "é", "\xa0", "\u3000", "\x1c", "\x85", "!", "?..", "日本", "🙂", "\u200b", "Hello", " world", "\x0b", "<|endoftext|>", "x.", ",y", ".)", "'", "ß.", "×", "a×b", "÷,", "ªº", "µ-", "Ā.", "&&&", "_", "x_y", "naïve/été", "C\u0301", "ñ'll"]
    texts = ["".join(RNG.choice(parts) for _ in range(RNG.randint(0, 20))) for _ in range(3000)]
    texts += ["no blanks" * 40_000 + " " + "some words and\nlines. " * 60_000]
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encode([t.encode() for t in texts])] == want
    monkeypatch.setattr(packing, "BLOCK", 50)  # many small blocks, texts parted
    assert [x.tolist() for x in encode([t.encode() for t in texts[:-1]])] == want[:-1]
    monkeypatch.setattr(packing, "span_hashes", lambda values, starts, ends, base: (ends - starts).astype(np.uint64))  # chunks of one length share a hash
    assert [x.tolist() for x in encode([t.encode() for t in texts[:300]])] == want[:300]
    assert encode([]) == [] and [len(x) for x in encode([b"", b"a"])] == [0, 1]


def test_packing(spark):
    size = 64
    texts = [None, "", " ", "one word", "x" * 3000, "a b c " * 500] + [" ".join(RNG.choice(["alpha", "beta", "gamma", "\n"]) for _ in range(RNG.randint(0, 90))) for _ in range(150)] + ["the same text"] * 60
    rows = [(i if i % 11 else 7, t, "x", 5) for i, t in enumerate(texts)] + [(None, "no id", "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, sequence_id int").repartition(5)
    packed = packing.pack(df, size)
    places = packed.places.collect()
    want = Counter()
    total = 0
    for doc_id, text, *_ in rows:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        total += len(ids)
        first = len(ids) if len(ids) <= size else len(ids) % size or size
        cuts = [0, *range(first, len(ids), size)]
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)])):
            want[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in places) == want
    held = {}
    for r in places:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids_crc32))
    assert len(held) == packed.n_sequences <= -(-total // size) + 1
    sequences = {r.sequence_id: r for r in packed.sequences().collect()}
    for k, v in held.items():
        at = 0
        for offset, length, crc in sorted(v):
            assert offset == at and zlib.crc32(sequences[k].ids[4 * at : 4 * (at + length)]) == crc
            at += length
        assert at == sequences[k].length <= size
    assert packing.pack(df.limit(0), size).places.count() == 0


def test_plans_are_whole_and_no_longer_than_best_fit():
    def best_fit(counts, size):
        gaps = []
        for n in sorted(counts.elements(), reverse=True):
            fit = [g for g in gaps if g >= n]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - n)
            else:
                gaps.append(size - n)
        return len(gaps)

    for seed in range(25):
        rng = random.Random(seed)
        size, high = 128, rng.choice([20, 60, 128])
        counts = Counter(rng.randint(rng.choice([1, high // 3]), high) for _ in range(rng.randint(0, 400)))
        plan = packing.plan_sequences(counts, size)
        held = {}
        for n, k in counts.items():
            for s, o in zip(*(x.tolist() for x in plan.place(np.full(k, n), np.arange(k)))):
                held.setdefault(s, []).append((o, n))
        assert sorted(held) == list(range(plan.n_sequences))
        for v in held.values():
            at = 0
            for o, n in sorted(v):
                assert o == at
                at += n
            assert at <= size
        assert plan.n_sequences <= best_fit(counts, size) * 1.02 + 1
