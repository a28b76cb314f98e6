"""Packing documents into token sequences by exact complements.

Documents become pieces of token ids.  Pieces differ, for packing, in their length
only, so the plan is made of the number of pieces of each length: at most as many
numbers as a sequence has tokens, however large the corpus.  The plan goes from the
longest length down.  What a piece leaves open is looked up among the sums of one,
two and three available lengths, and the combination that fills it exactly is used
as many times as the counts allow; where there is none, the longest length that fits
goes in and the rest of the gap is looked up again.

A piece finds its place by its rank among the pieces of its length: the plan gives
each combination a range of ranks.  Ranks are counted where the pieces are made and
offset by the counts of earlier tasks, so no length's pieces ever meet in one task.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrift.llm.words import BYTE_BASE, in_blocks, mix, span_hashes
from spindrift.plans.scratch import Scratch

PIECES = "piece_id long, doc_id long, piece int, start long, length int, place long, ids_crc32 long, ids binary"
#: Tasks number their pieces from ``task << SHIFT``.
SHIFT = 33
#: Classes of bytes: blanks, letters, and marks that end a run of letters.
_BLANK, _LETTER, _MARK = 1, 2, 3
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[list(b" \t\r\n")] = _BLANK
_CLASS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_CLASS[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = _MARK  # all ASCII punctuation but the apostrophe, which starts words of its own
#: Other characters that a library may take for white space (UTF-8); texts that hold one are not cut.
OTHER_SPACE = re.compile(rb"[\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f-\xa4]|\xe3\x80\x80|\xef\xbb\xbf")
#: The bytes that these start with.
LEADS = re.compile(rb"[\x0b\x0c\x1c-\x1f\xc2\xe1\xe2\xe3\xef]")
#: Where a long text may be parted: before a blank that follows something else.
PART = re.compile(rb"[^ \t\r\n](?=[ \t\r\n])")
BLOCK = 2 << 20
_MIXED = mix(np.arange(1, 257, dtype=np.uint64))


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """``a``, made longer if it has fewer than ``n`` places."""
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), dtype=a.dtype)])


class _Known(dict):
    """Chunks by number; a new one gets the next number and is noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = number = len(self)
        self.new.append(chunk)
        return number


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one of each distinct span, for each span the place of its own in the first), spans equal byte for byte."""
    order = np.argsort(hashes := span_hashes(_MIXED[data], starts, ends, BYTE_BASE), kind="stable")
    fresh = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
    group = np.empty(len(starts), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    one, n = order[fresh], ends - starts
    like = starts[one][group]
    same = (ends[one][group] - like == n).all() and (data == data[np.repeat(like - starts, n) + np.arange(len(data))]).all()
    return (one, group) if same else (np.arange(len(starts)), np.arange(len(starts)))  # two chunks of one hash: each span for itself


class Encoder:
    """Token ids of texts; remembers the ids of chunks met before.

    The byte-level pattern ends a word wherever blanks follow something else, and
    where an ASCII mark but the apostrophe follows a Latin letter, so a text's ids are those of the
    chunks between one after another, and a chunk's those of its words.  A block of
    texts is cut, and its distinct chunks are found, in numpy.  ``room`` bounds the
    bytes of the chunks remembered.
    """

    def __init__(self, path: str, room: int = 24_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # the strings of special tokens are ordinary text
        if self.tokenizer.normalizer is not None:
            raise ValueError(f"{path} changes texts before it cuts them")
        self.words, self.model = self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model
        # how the model's alphabet writes the bytes of characters up to U+00FF
        self.alphabet = {b: w for c in map(chr, range(32, 256)) for b, w in zip(c.encode(), "".join(x for x, _ in self.words(c)))}
        self.room = room
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.held = self.size = 0
        self.flat, self.first, self.count = np.zeros(1 << 20, dtype=np.uint32), np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)

    def _ids(self, chunk: bytes) -> list[int]:
        """A chunk of Latin letters, with or without one space before, is one word; others are cut by the tokenizer's pattern."""
        text = chunk.decode()
        letters = (text[1:] if chunk[0] == 32 else text).isalpha() and max(text) < "\u0100"
        words = (chunk.decode("latin-1").translate(self.alphabet),) if letters else [w for w, _ in self.words(text)]
        return [t.id for w in words for t in self.model.tokenize(w)]

    def _learn(self) -> None:
        """Take up the ids of the new chunks."""
        new, self.known.new = self.known.new, []
        ids = list(map(self._ids, new))
        flat, count = np.fromiter(chain.from_iterable(ids), dtype=np.uint32), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.flat = _room(self.flat, self.size + len(flat))
        self.flat[self.size : self.size + len(flat)] = flat
        k, n = len(self.known) - len(new), len(self.known)
        self.first, self.count = _room(self.first, n), _room(self.count, n)
        self.first[k:n], self.count[k:n] = self.size + np.cumsum(count) - count, count
        self.size += len(flat)
        self.held += sum(map(len, new))

    def _block(self, parts: list[bytes]) -> list[np.ndarray]:
        """The ids of each of some texts that aren't empty."""
        if self.held > self.room:
            self._forget()
        joined = b"".join(parts)
        data, sizes = np.frombuffer(joined, dtype=np.uint8), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        kind = _CLASS[data]
        kind[1:][(data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)] = _LETTER  # the last bytes of U+00C0 to U+00FF but for two signs
        before = np.concatenate(([0], kind[:-1])).astype(np.uint8)
        cut = ((kind == _BLANK) & (before != _BLANK)) | ((kind == _MARK) & (before == _LETTER))
        at = np.cumsum(sizes) - sizes
        cut[at] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        one, group = _distinct(data, starts, ends)
        number = np.fromiter(map(self.known.__getitem__, [joined[a:z] for a, z in zip(starts[one].tolist(), ends[one].tolist())]), dtype=np.int64, count=len(one))
        if self.known.new:
            self._learn()
        n = self.count[number][group]
        to = np.cumsum(n)
        ids = self.flat[np.repeat(self.first[number][group] - (to - n), n) + np.arange(int(to[-1]))]
        return np.split(ids, (to - n)[np.searchsorted(starts, at[1:])])

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text (UTF-8)."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        held, mine, size = [], [], 0
        for i, text in enumerate(texts):
            if LEADS.search(text) and OTHER_SPACE.search(text):
                found[i].append(np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.uint32))
                continue
            at = 0
            while at < len(text):
                end = len(text)
                if end - at > BLOCK and (m := PART.search(text, at + BLOCK)):
                    end = m.end()
                held.append(text[at:end])
                mine.append(i)
                size += end - at
                at = end
                if size >= BLOCK:
                    for k, ids in zip(mine, self._block(held)):
                        found[k].append(ids)
                    held, mine, size = [], [], 0
        if held:
            for k, ids in zip(mine, self._block(held)):
                found[k].append(ids)
        return [x[0] if len(x) == 1 else np.concatenate([*x, np.zeros(0, dtype=np.uint32)]).astype(np.uint32) for x in found]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder: later tasks of a worker find what earlier ones have met."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def piece_starts(n: int, size: int) -> list[int]:
    """Where the pieces of ``n`` tokens start: all but the first have ``size``."""
    return [0, *range(n % size or size, n, size)]


def _pieces(path: str, size: int):
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, placed, number = encoder(path), Counter(), TaskContext.get().partitionId() << SHIFT
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            doc_ids = b.column(0).to_pylist()
            for lo, some in in_blocks(texts, 4 * BLOCK):
                for doc_id, own in zip(doc_ids[lo : lo + len(some)], encode(some)):
                    ids = np.append(own, np.uint32(0)).astype("<u4")
                    starts = piece_starts(len(ids), size)
                    for i, (at, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        data = ids[at:end].tobytes()
                        rows.append((number, doc_id, i, at, end - at, placed[end - at], zlib.crc32(data), data))
                        placed[end - at] += 1
                        number += 1
                        held += len(data)
                        if held > 1 << 23:
                            yield flush()
                            rows, held = [], 0
        if rows:
            yield flush()

    return per_task


class Sums:
    """Which lengths are available, and which sums one, two and three of them make, as sets of bits."""

    def __init__(self, counts: dict[int, int], size: int):
        self.left = np.zeros(size + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.mask = (1 << (size + 1)) - 1
        self._index()

    def _index(self) -> None:
        self.kinds = np.minimum(self.left, 3)
        self.one = self.two = self.three = 0
        some = np.flatnonzero(self.left).tolist()
        for n in some:
            self.one |= 1 << n
        for n in some:
            self.two |= (self.one if self.left[n] > 1 else self.one ^ (1 << n)) << n
        self.two &= self.mask
        for n in some:
            self.three |= self.two << n  # a sum that needs more of a length than there is fails when it is looked up
        self.three &= self.mask

    def take(self, used: Counter, times: int) -> None:
        for n, u in used.items():
            self.left[n] -= u * times
        if (np.minimum(self.left, 3) != self.kinds).any():
            self._index()

    def _pair(self, gap: int, free: np.ndarray) -> tuple[int, int] | None:
        a = np.arange(gap - 1, (gap - 1) // 2, -1)  # the larger of the two, from the largest down
        hit = (free[a] > 0) & (free[gap - a] > (a == gap - a))
        return (int(a[at := int(hit.argmax())]), gap - int(a[at])) if hit.any() else None

    def fill(self, gap: int, used: Counter, most: int = 3) -> tuple[int, ...] | None:
        """Up to ``most`` (1 to 3) available lengths that fill ``gap`` exactly, beside those in use."""
        if not (self.one | self.two | self.three) >> gap & 1:
            return None
        free = self.left.copy()
        for n, u in used.items():
            free[n] -= u
        if free[gap] > 0:
            return (gap,)
        if most > 1 and self.two >> gap & 1 and (pair := self._pair(gap, free)):
            return pair
        if most > 2 and self.three >> gap & 1:
            for a in np.flatnonzero(free[:gap] > 0)[::-1].tolist():
                if self.two >> (gap - a) & 1:
                    free[a] -= 1
                    if pair := self._pair(gap - a, free):
                        return (a, *pair)
                    free[a] += 1
        return None

    def longest(self, gap: int, used: Counter) -> int:
        """The longest available length up to ``gap``, 0 if there is none."""
        bits = self.one & ((1 << (gap + 1)) - 1)
        while bits:
            n = bits.bit_length() - 1
            if self.left[n] > used[n]:
                return n
            bits ^= 1 << n
        return 0


@dataclass(frozen=True)
class Plan:
    """Places of pieces by length and rank: rank ``first`` and the following ones of ``length`` stand, ``uses`` to a
    sequence, in ``times`` sequences from ``sequence`` on, at ``offset`` and after."""

    table: np.ndarray  # columns length, first, uses, sequence, offset, times; ordered by length and first
    n_sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        lo, hi = np.searchsorted(self.table[:, 0], length, "left"), np.searchsorted(self.table[:, 0], length, "right")
        while (hi - lo > 1).any():  # the last row of the length whose first rank is not above
            mid = (lo + hi) // 2
            up = self.table[np.minimum(mid, len(self.table) - 1), 1] <= rank
            lo, hi = np.where(up & (hi - lo > 1), mid, lo), np.where(up | (hi - lo <= 1), hi, mid)
        row = self.table[lo]
        past = rank - row[:, 1]
        return row[:, 3] + past // row[:, 2], row[:, 4] + past % row[:, 2] * length


def plan_sequences(counts: dict[int, int], size: int) -> Plan:
    """The shortest of the plans that look for up to three, two and one lengths to fill a gap."""
    least, best = -(-sum(length * n for length, n in counts.items()) // size), None
    for most in (3, 2, 1):
        plan = _plan(counts, size, most)
        if best is None or plan.n_sequences < best.n_sequences:
            best = plan
        if best.n_sequences == least:  # no plan is shorter
            break
    return best


def _plan(counts: dict[int, int], size: int, most: int) -> Plan:
    """Combinations of lengths for all pieces, given how many pieces have each length.

    A combination is used as often as the counts allow, which leaves less than half of
    some length it uses more than once, or none; so there are at most about ``size *
    log2(size)`` combinations.
    """
    sums, ranks, rows, sequence = Sums(counts, size), Counter(), [], 0
    while sums.one:
        used = Counter([sums.one.bit_length() - 1])
        gap = size - sum(used)
        while gap:
            if fill := sums.fill(gap, used, most):
                used.update(fill)
                break
            if not (n := sums.longest(gap, used)):
                break
            used[n] += 1
            gap -= n
        times, offset = min(int(sums.left[n]) // u for n, u in used.items()), 0
        for n, u in sorted(used.items(), reverse=True):
            rows.append((n, ranks[n], u, sequence, offset, times))
            ranks[n] += u * times
            offset += n * u
        sequence += times
        sums.take(used, times)
    return Plan(np.array(sorted(rows), dtype=np.int64).reshape(-1, 6), sequence)


@dataclass(frozen=True)
class Packed:
    """``pieces``: piece_id and ids (little-endian 32-bit) of every piece.  ``places``: piece_id, doc_id, piece, start,
    length, ids_crc32, sequence_id and offset."""

    pieces: DataFrame
    places: DataFrame
    n_sequences: int

    def sequences(self) -> DataFrame:
        """(sequence_id, length, ids): the packed sequences, ids as they stand."""
        full = self.places.select("piece_id", "sequence_id", "offset", "length").join(self.pieces.select("piece_id", "ids"), "piece_id")
        # a sequence has at most as many pieces as tokens
        grouped = full.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
        return grouped.select("sequence_id", "length", F.aggregate("_parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))


def pack(docs: DataFrame, size: int = 2048, tokenizer: str | None = None) -> Packed:
    """Pack the texts of ``docs`` (doc_id, text) into sequences of at most ``size`` tokens.

    A document is its ids and an end mark, id 0; a null text is empty and so a single
    end mark.  Only documents longer than ``size`` are cut: their first piece may be
    shorter, the others are whole sequences.  Rows that share a doc_id, and repeated
    rows, are documents of their own.  Other columns are ignored.  An empty table gives
    no sequences.  ``tokenizer`` is the file of a byte-level tokenizer that every
    machine has.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = scratch.keep(texts.mapInArrow(_pieces(path, size), PIECES), "pieces")
    task = F.shiftright("piece_id", SHIFT)
    by_task = scratch.keep(pieces.groupBy(task.alias("_task"), F.col("length").alias("_length")).agg(F.count(F.lit(1)).alias("_n")), "lengths")
    counts = {r["_length"]: r["n"] for r in by_task.groupBy("_length").agg(F.sum("_n").alias("n")).collect()}  # at most ``size`` rows
    plan = plan_sequences(counts, size)
    earlier = Window.partitionBy("_length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    before = by_task.select("_task", "_length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    slim = pieces.drop("ids")
    ranked = slim.join(before, (task == F.col("_task")) & (F.col("length") == F.col("_length")))
    ranked = ranked.select("piece_id", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("place") + F.col("_before")).alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = plan.place(b.column(4).to_numpy(), b.column(6).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:6], "sequence_id", "offset"])

    places = ranked.mapInArrow(placed, "piece_id long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return Packed(pieces, places, plan.n_sequences)


def op13_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece's place in the packed sequences."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).places.drop("piece_id")
