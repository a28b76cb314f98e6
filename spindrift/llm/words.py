"""Vectorised word and window hashing over blocks of whole texts.

A *word* is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  All
functions take the UTF-8 bytes of several documents laid end to end, so one
numpy call serves thousands of short documents, and a single long document is
simply a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Fixed odd multipliers of the polynomial hashes and of the bit mixer.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MIX_1, MIX_2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; makes the hash of a sum non-linear."""
    x = x ^ (x >> _U(33))
    x = x * _U(MIX_1)
    x = x ^ (x >> _U(33))
    x = x * _U(MIX_2)
    return x ^ (x >> _U(33))


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i in 0..n."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            t = np.full(size, b, dtype=_U)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        have = _powers[base] = (tables[0], tables[1])
    return have


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[s:e]`` for each span, independent of where it stands."""
    power, inverse = _power_tables(base, len(values))
    sums = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + mix((ends - starts).astype(_U)))


@dataclass
class Block:
    """Some documents' words: byte spans of the words and word spans of the documents."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc_from: np.ndarray  # first word of each document
    doc_to: np.ndarray

    def word_hashes(self, seed: int = 0) -> np.ndarray:
        table = mix(np.arange(1, 257, dtype=_U) + _U(seed * 1000))
        return span_hashes(table[self.data], self.starts, self.ends, BYTE_BASE)


def block_of(texts: list[bytes]) -> Block:
    """Find the words of these documents."""
    joined = b" ".join(texts)
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_from = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, dtype=np.int64)
    return Block(data, starts, ends, np.searchsorted(starts, text_from), np.searchsorted(starts, text_from + lengths))


def in_blocks(texts: list[bytes], max_bytes: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Cut a list of texts into lists of about ``max_bytes``; a longer text stands alone, whole."""
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > max_bytes:
            yield at, held
            at, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield at, held
