"""License scan: a trained paragraph classifier confirmed by templates.

Paragraphs are described by hashed word n-grams.  A multinomial logistic
regression with an *unknown* class is trained on perturbed license notices and on
text that isn't one; its probabilities are calibrated with a temperature on
held-out paragraphs.  A family counts where a paragraph contains most word trigrams
of one of its templates in a window of the template's size, and its calibrated
probability there is high enough; so one paragraph can state several.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_BITS = 15
UNKNOWN = "unknown"
WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

#: Short notices by which texts state public licences, by family.
TEMPLATES = {
    "apache": ["licensed under the apache license version 2.0", "apache license version 2.0 january 2004", "spdx-license-identifier apache-2.0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "licensed under the bsd license", "released under the bsd 3-clause license", "spdx-license-identifier bsd-3-clause", "spdx-license-identifier bsd-2-clause"],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license", "spdx-license-identifier cc-by-4.0"],
    "cc-by-nc": ["licensed under cc by-nc 4.0", "this work is licensed under a creative commons attribution-noncommercial 4.0 international license", "spdx-license-identifier cc-by-nc-4.0"],
    "cc-by-sa": ["licensed under cc by-sa 4.0", "this work is licensed under a creative commons attribution-sharealike 4.0 international license", "spdx-license-identifier cc-by-sa-4.0"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "dedicated to the public domain under cc0 1.0", "spdx-license-identifier cc0-1.0"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "spdx-license-identifier gpl-3.0-or-later", "spdx-license-identifier gpl-2.0-only"],
    "lgpl": ["licensed under the gnu lesser general public license version 3", "spdx-license-identifier lgpl-2.1-or-later"],
    "mit": ["released under the mit license", "licensed under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "spdx-license-identifier mit"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v. 2.0", "licensed under the mozilla public license 2.0", "spdx-license-identifier mpl-2.0"],
}
#: Words around notices in training, and sentences that only resemble notices.
FILLER = "the of and to in is that for it as was with be by on not he this are or his from at which but have an had they you were their one all we can her has there been if more when will would who so no said what up its about than into them only some time could these two may first then do".split()
NEAR_MISSES = [
    "a driving license is required for this job", "the driver lost the license yesterday", "licensed under the authority of the county", "the apache helicopter landed in january", "students at mit released a new version of the report",
    "permission was granted to the person next door", "the general public is free to attend the program", "this work was released under pressure", "version 2.0 of the form is subject to review", "the public domain is a legal term",
    "copyright is held by the authors", "all rights reserved by the publisher", "free software can be useful", "the license plate was found in source and binary", "open source license terms vary",
]


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(words: list[str]) -> np.ndarray:
    """Distinct hashed uni-, bi- and trigrams."""
    keys = {zlib.crc32(" ".join(words[i : i + n]).encode(), n) & ((1 << HASH_BITS) - 1) for n in (1, 2, 3) for i in range(len(words) - n + 1)}
    return np.fromiter(keys, dtype=np.int64, count=len(keys))


@dataclass
class LicenseModel:
    """Weights (features x classes), bias, temperature and families; class 0 is unknown."""

    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, words: list[str]) -> np.ndarray:
        f = features(words)
        z = (self.bias + self.weights[f].sum(axis=0) / max(1, len(f)) ** 0.5) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def _examples(rng: np.random.Generator, n: int, families: list[str]) -> tuple[list[list[str]], np.ndarray]:
    xs, ys = [], []
    for _ in range(n):
        y = int(rng.integers(-len(families), len(families) + 1))
        if y > 0:
            t = TEMPLATES[families[y - 1]]
            words = tokens(t[rng.integers(len(t))])
            words = [w for w in words if rng.random() > 0.04]
        else:
            y = 0
            words = tokens(NEAR_MISSES[rng.integers(len(NEAR_MISSES))]) if rng.random() < 0.5 else []
        pad = lambda m: [FILLER[i] for i in rng.integers(len(FILLER), size=m)]
        long = int(rng.integers(0, 25)) if rng.random() < 0.5 else 0
        xs.append(pad(long) + words + pad(long // 2) or pad(3))
        ys.append(y)
    return xs, np.array(ys)


def train(examples: int = 3000, epochs: int = 4, seed: int = 11) -> LicenseModel:
    """Fit on ``examples`` generated paragraphs, calibrate the temperature on a third as many others."""
    families = sorted(TEMPLATES)
    rng = np.random.default_rng(seed)
    k = len(families) + 1
    m = LicenseModel(families, np.zeros((1 << HASH_BITS, k)), np.zeros(k), 1.0)
    xs, ys = _examples(rng, examples, families)
    fs = [features(x) for x in xs]
    sq = np.full(m.weights.shape, 1e-3)
    for _ in range(epochs):
        for i in rng.permutation(len(fs)):
            f, s = fs[i], max(1, len(fs[i])) ** -0.5
            z = m.bias + m.weights[f].sum(axis=0) * s
            p = np.exp(z - z.max())
            p /= p.sum()
            p[ys[i]] -= 1
            g = p * s
            sq[f] += g**2
            m.weights[f] -= 0.3 * g / np.sqrt(sq[f])
            m.bias -= 0.02 * p
    held, want = _examples(rng, examples // 3, families)
    z = np.array([m.bias + m.weights[f].sum(axis=0) / max(1, len(f)) ** 0.5 for f in map(features, held)])

    def loss(t: float) -> float:
        y = z / t
        y = y - y.max(axis=1, keepdims=True)
        return float(-(y[np.arange(len(y)), want] - np.log(np.exp(y).sum(axis=1))).mean())

    m.temperature = min((0.5 + 0.1 * i for i in range(40)), key=loss)
    return m


def _grams(words: list[str]) -> tuple[int, list[tuple[str, ...]]]:
    """The length of a template's n-grams, trigrams where it has three words, and the n-grams."""
    n = min(3, len(words))
    return n, [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


_TEMPLATE_GRAMS = {f: [(len(tw), n, frozenset(grams)) for tw in map(tokens, ts) for n, grams in [_grams(tw)]] for f, ts in TEMPLATES.items()}
_ALL_GRAMS = frozenset(g for ts in _TEMPLATE_GRAMS.values() for _, _, want in ts for g in want)
_CUES = frozenset(w for g in _ALL_GRAMS for w in g) - frozenset(FILLER)


def places(words: list[str], family: str, least: float = 0.8) -> Iterator[tuple[int, int]]:
    """Spans of words that hold at least this share of a template's n-grams, in a window of about its size."""
    for size, n, want in _TEMPLATE_GRAMS[family]:
        at = [i for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in want]
        lo = 0
        for hi in range(len(at)):
            while at[hi] - at[lo] > size + 4:
                lo += 1
            if len({tuple(words[i : i + n]) for i in at[lo : hi + 1]}) >= least * len(want):
                yield at[lo], at[hi] + n


def paragraphs_of(text: str | None) -> list[str]:
    """Runs of non-blank lines, each joined by spaces."""
    out: list[list[str]] = [[]]
    for line in (text or "").split("\n"):
        if line.strip():
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [" ".join(p) for p in out if p]


def scan_text(model: LicenseModel, text: str | None, least: float = 0.5) -> tuple[int, list[tuple[int, str, float]]]:
    """(number of paragraphs, [(paragraph, family, probability)]); a paragraph is a run of non-blank lines."""
    paragraphs = paragraphs_of(text)
    out = []
    for i, p in enumerate(paragraphs):
        words = tokens(p)
        if not _may_state(words):
            continue
        for k, family in enumerate(model.families, 1):
            for start, end in places(words, family):
                # the notice by itself, then with the words around it
                pad = max(0, 40 - (end - start)) // 2
                prob = max(model.probabilities(words[start:end])[k], model.probabilities(words[max(0, start - pad) : end + pad])[k])
                if prob >= least:
                    out.append((i, family, float(prob)))
                    break
    return len(paragraphs), out


def _may_state(words: list[str]) -> bool:
    """A notice shares n-grams with a template, so it has one of these words and one of these n-grams."""
    return not _CUES.isdisjoint(words) and not (_ALL_GRAMS.isdisjoint(zip(words, words[1:], words[2:])) and _ALL_GRAMS.isdisjoint(zip(words, words[1:])))


def license_scan(docs: DataFrame, model: LicenseModel | None = None, least: float = 0.5) -> DataFrame:
    """(doc_id, n_paragraphs, licenses, score) for each row: sorted families and the best probability.

    Null, empty and blank texts have no paragraphs, no licenses and score 0.
    Repeated rows each get a row; other columns are left out.
    """
    model = model or train()
    shared = docs.sparkSession.sparkContext.broadcast((model.families, model.weights.astype(np.float32), model.bias, model.temperature))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LicenseModel(*shared.value)
        for rb in batches:
            found = [scan_text(m, t.as_py(), least) for t in rb.column(1)]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([sorted({f for _, f, _ in h}) for _, h in found], pa.list_(pa.string())), pa.array([max((p for *_, p in h), default=0.0) for _, h in found], pa.float64())],
                names=["doc_id", "n_paragraphs", "licenses", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(per_batch, "doc_id long, n_paragraphs long, licenses array<string>, score double")


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licences stated in every document."""
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
