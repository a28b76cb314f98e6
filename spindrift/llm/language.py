"""Language identification by a linear-chain conditional random field over words.

Every word has hashed affix and character n-gram features and lexicon features
(how strongly the training texts tie the word to each language).  Their weights
and the transition weights between neighbouring words' languages are learned
together by maximising the chain's likelihood; code-switched training chains are
made by joining runs of words of different languages.  Forward-backward gives
each word its language probabilities; a document's language is the one with the
most mass over its words with letters.

Training reads a bounded sample of labelled rows on the driver (``sample``
documents at most, ``sample_words`` words of each); prediction covers every word
of every text.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.columns import set_aside

#: A word: a run of letters; longer runs, as in scripts without spaces, are consecutive words of 32 letters.
WORD = re.compile(r"[^\W\d_]{1,32}")
HASH_BITS = 16
UNKNOWN = "und"


def word_features(word: str) -> list[int]:
    """Hashed prefixes, suffixes and n-grams of a lower-case word, over its UTF-8 bytes."""
    w, crc, top = word.encode(), zlib.crc32, (1 << HASH_BITS) - 1
    p = b"^" + w + b"$"
    n = len(p)
    keys = [crc(w[:2], 1), crc(w[:3], 1), crc(w[:4], 1), crc(w[-2:], 2), crc(w[-3:], 2), crc(w[-4:], 2)]
    keys += [crc(p[i : i + 3]) for i in range(max(1, n - 2))]
    keys += [crc(p[i : i + 4]) for i in range(max(1, n - 3))]
    return [k & top for k in keys]


def letters(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if they hold only numbers that aren't digits, as superscripts and fractions."""
    words = WORD.findall(text.lower()) if text else []
    return words if any(c.isalpha() for w in words for c in w) else []


def chain_marginals(emit: np.ndarray, trans: np.ndarray, lengths: np.ndarray, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains laid end to end in time-major padding.

    ``emit``: (time, chains, labels) scores, zero beyond a chain's end.  Returns
    marginals of the same shape and each chain's log-partition; adds the expected
    transition counts to ``pairs``.
    """
    steps, chains, labels = emit.shape
    t = np.exp(trans)
    top = emit.max(axis=2, keepdims=True)
    e = np.exp(emit - top)
    alpha = np.empty_like(e)
    scale = np.ones((steps, chains))
    a = e[0]
    for s in range(steps):
        if s:
            a = (a @ t) * e[s]
        z = a.sum(axis=1, keepdims=True)
        a = a / z
        alpha[s], scale[s] = a, z[:, 0]
    inside = np.arange(steps)[:, None] < lengths[None, :]
    logz = np.where(inside, np.log(scale) + top[:, :, 0], 0).sum(axis=0)
    beta = np.ones((chains, labels))
    out = np.empty_like(e)
    for s in range(steps - 1, -1, -1):
        if s < steps - 1:
            more = (s + 1 < lengths)[:, None]
            if pairs is not None:
                joint = alpha[s][:, :, None] * t[None] * (e[s + 1] * beta)[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True))[more[:, 0]].sum(axis=0)
            beta = np.where(more, (e[s + 1] * beta) @ t.T, 1.0)
            beta /= beta.sum(axis=1, keepdims=True)
        m = alpha[s] * beta
        out[s] = m / m.sum(axis=1, keepdims=True)
    return out * inside[:, :, None], logz


def stretch_marginals(emit: np.ndarray, trans: np.ndarray, before: np.ndarray | None, after: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over one stretch (time, labels) of a longer chain.

    ``before`` is the forward message of the word before it, ``after`` the
    backward message that its last word gets.  Returns the marginals, the last
    forward message and the backward message for the word before.
    """
    t = np.exp(trans)
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    alpha, a = np.empty_like(e), before
    for s in range(len(e)):
        a = e[s] if a is None else (a @ t) * e[s]
        a = a / a.sum()
        alpha[s] = a
    b = np.ones(e.shape[1]) if after is None else after
    out = np.empty_like(e)
    for s in range(len(e) - 1, -1, -1):
        out[s] = alpha[s] * b
        b = t @ (e[s] * b)
        b = b / b.sum()
    return out / out.sum(axis=1, keepdims=True), a, b


class WordIndex(dict):
    """word -> row; words asked for the first time get the next row and are noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.new.append(word)
        return row


@dataclass
class Crf:
    """Learned weights; small enough to travel with a task."""

    labels: list[str]
    weights: np.ndarray  # (features, labels)
    trans: np.ndarray  # (labels, labels)
    lexicon: dict[str, np.ndarray]
    index: WordIndex = field(default_factory=lambda: WordIndex(), repr=False)
    table: np.ndarray | None = field(default=None, repr=False)

    def rows_of(self, chains: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``table`` that hold each chain's emission scores; new words are scored first."""
        if len(self.index) > 200_000:  # bounds a worker's memory, not what is scored
            self.index.clear()
        have = len(self.index)
        rows = [np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words)) for words in chains]
        new = self.index.new
        if new:
            if self.table is None or have + len(new) > len(self.table):
                grown = np.zeros((max(1 << 12, 2 * (have + len(new))), len(self.labels)))
                grown[:have] = self.table[:have] if have else 0
                self.table = grown
            feats = [word_features(w) for w in new]
            sizes = np.fromiter(map(len, feats), dtype=np.int64, count=len(feats))
            flat = np.fromiter((f for fs in feats for f in fs), dtype=np.int64, count=int(sizes.sum()))
            score = np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0) * (4 / sizes)[:, None]
            for i, w in enumerate(new):
                if (lex := self.lexicon.get(w)) is not None:
                    score[i] += lex
            self.table[have : have + len(new)] = score
            new.clear()
        return rows

    def long_mass(self, words: list[str], stretch: int) -> np.ndarray:
        """Probability mass of each language over one long chain, a stretch at a time.

        The forward messages at the cuts are kept, and each stretch is run again
        from the last to the first with both messages, so the result is that of
        the whole chain.
        """
        cuts = range(0, len(words), stretch)
        before: list[np.ndarray | None] = [None]
        emit = lambda at: self.table[self.rows_of([words[at : at + stretch]])[0]]
        for at in cuts[:-1]:
            before.append(stretch_marginals(emit(at), self.trans, before[-1], None)[1])
        mass, after = np.zeros(len(self.labels)), None
        for at, a in zip(reversed(cuts), reversed(before)):
            marginals, _, after = stretch_marginals(emit(at), self.trans, a, after)
            mass += marginals.sum(axis=0)
        return mass

    def document_scores(self, texts: list[list[str]], stretch: int = 100_000) -> np.ndarray:
        """Share of each language's probability mass in each text's words; zero for no words.

        Texts of more than ``stretch`` words are read a stretch at a time, which
        bounds memory and changes nothing else.
        """
        out = np.zeros((len(texts), len(self.labels)))
        for i, t in enumerate(texts):
            if len(t) > stretch:
                out[i] = self.long_mass(t, stretch)
        pieces = sorted(((i, t) for i, t in enumerate(texts) if 0 < len(t) <= stretch), key=lambda x: len(x[1]))
        at = 0
        while at < len(pieces):
            stop = at + 1
            while stop < len(pieces) and (stop - at + 1) * len(pieces[stop][1]) <= 200_000:
                stop += 1
            part = [w for _, w in pieces[at:stop]]
            lengths = np.array([len(w) for w in part])
            emit = np.zeros((int(lengths[-1]), len(part), len(self.labels)))
            for c, rows in enumerate(self.rows_of(part)):
                emit[: len(rows), c] = self.table[rows]
            mass = chain_marginals(emit, self.trans, lengths)[0].sum(axis=0)
            for (i, _), m in zip(pieces[at:stop], mass):
                out[i] = m
            at = stop
        return out / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def train(texts: list[list[str]], labels: list[str], seed: int = 5, epochs: int = 2, chain: int = 24, rate: float = 0.5) -> Crf:
    """Fit weights and transitions by stochastic gradient ascent on the chains' log-likelihood.

    Chains have ``chain`` words; every fourth one switches language midway.
    """
    names = sorted(set(labels))
    k = len(names)
    model = Crf(names, np.zeros((1 << HASH_BITS, k)), np.zeros((k, k)), {})
    if k == 0:
        return model
    code = {n: i for i, n in enumerate(names)}
    counts: dict[str, np.ndarray] = {}
    chains: list[tuple[list[str], int]] = []
    for words, label in zip(texts, labels):
        for w in words:
            counts.setdefault(w, np.zeros(k))[code[label]] += 1
        chains += [(words[i : i + chain], code[label]) for i in range(0, len(words), chain)]
    totals = sum(counts.values()) if counts else np.ones(k)
    for w, c in counts.items():
        if c.sum() >= 3:
            p = (c + 0.5) / (totals + 0.5 * len(counts))
            s = np.log(p)
            model.lexicon[w] = np.clip(s - s.mean(), -3, 3)
    feats: dict[str, np.ndarray] = {}
    rng = np.random.default_rng(seed)
    grad_sq = np.full((1 << HASH_BITS, k), 1e-2)
    trans_sq = np.full((k, k), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(chains))
        for b in range(0, len(order), 64):
            batch = []
            for i in order[b : b + 64]:
                words, y = chains[i]
                tags = [y] * len(words)
                if rng.random() < 0.25:
                    more, z = chains[rng.integers(len(chains))]
                    h, g = len(words) // 2, len(more) // 2
                    words, tags = words[:h] + more[g:], [y] * h + [z] * (len(more) - g)
                if words:
                    batch.append((words, tags))
            if not batch:
                continue
            lengths = np.array([len(w) for w, _ in batch])
            emit = np.zeros((lengths.max(), len(batch), k))
            for c, (words, _) in enumerate(batch):
                for s, w in enumerate(words):
                    f = feats.get(w)
                    if f is None:
                        f = feats[w] = np.array(word_features(w))
                    emit[s, c] = model.weights[f].mean(axis=0) * 4
                    if w in model.lexicon and rng.random() < 0.5:  # so that the other features learn too
                        emit[s, c] += model.lexicon[w]
            gt = np.zeros((k, k))
            marg, _ = chain_marginals(emit, model.trans, lengths, gt)
            gt = -gt
            idx, rows = [], []
            for c, (words, tags) in enumerate(batch):
                n = len(words)
                d = -marg[:n, c]
                d[np.arange(n), tags] += 1
                for s, w in enumerate(words):
                    f = feats[w]
                    idx.append(f)
                    rows.append(np.broadcast_to(d[s] * (4 / len(f)), (len(f), k)))
                y = np.array(tags)
                np.add.at(gt, (y[:-1], y[1:]), 1)
            i, g = np.concatenate(idx), np.concatenate(rows)
            u, inv = np.unique(i, return_inverse=True)
            step = np.zeros((len(u), k))
            np.add.at(step, inv, g)
            step = step / len(batch) - 1e-5 * model.weights[u]
            grad_sq[u] += step**2
            model.weights[u] += rate * step / np.sqrt(grad_sq[u])
            gt /= len(batch)
            trans_sq += gt**2
            model.trans = np.clip(model.trans + 0.1 * gt / np.sqrt(trans_sq), -6, 6)
    return model


def fold(doc_id) -> F.Column:
    """crc32 of the id as text modulo 3; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def fit(docs: DataFrame, sample: int = 600, sample_words: int = 200, seed: int = 5) -> Crf:
    """Learn from rows with a lang whose fold isn't 1.

    The sample is the ``sample`` distinct texts with the smallest hashes, the
    first ``sample_words`` words of each; copies of a text with different langs
    count as the first in order.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 1))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    last = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not last:
        return train([], [])
    some = rows.where(F.col("h") <= last[-1]).groupBy("h").agg(F.min("lang").alias("lang"), F.min(F.substring("text", 1, 40 * sample_words)).alias("text"))
    cut = sorted((r["h"], r["lang"], letters(r["text"])[:sample_words]) for r in some.collect())
    return train([w for _, _, w in cut], [lang for _, lang, _ in cut], seed)


#: The models of a worker process by broadcast, so that word scores outlive a task.
_models: dict[int, Crf] = {}


def identify(docs: DataFrame, model: Crf) -> DataFrame:
    """Add lang_pred and score to the columns of ``docs``.

    ``und`` with score 0 for a null text, one without letters, or a model without
    languages.  Ties go to the first language in order.  Columns of the input
    named lang_pred or score are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, model.weights.astype(np.float32), model.trans, model.lexicon))
    number = uuid.uuid4().int
    cols = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = cols.index("text")
    schema = docs.select(cols).schema.add("lang_pred", "string").add("score", "double")

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = _models.get(number)
        if crf is None:
            _models.clear()
            crf = _models[number] = Crf(*shared.value)
        for rb in batches:
            for i in range(0, rb.num_rows, 512):
                part = rb.slice(i, 512)
                texts = [letters(t) for t in part.column(at).to_pylist()]
                if crf.labels:
                    s = crf.document_scores(texts)
                    best = s.argmax(axis=1)
                    pred = [crf.labels[b] if t else UNKNOWN for b, t in zip(best, texts)]
                    score = np.minimum(1.0, s[np.arange(len(texts)), best])
                else:
                    pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score)], names=[*cols, "lang_pred", "score"])

    return docs.select(cols).mapInArrow(per_batch, schema)


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``min_score``."""
    inside, back = set_aside(docs, ("doc_id", "text", "lang"))
    return back(identify(inside, fit(inside)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return out.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score")
