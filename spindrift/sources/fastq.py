"""Paired FASTQ files as a data source whose partitions are ranges of records.

A record is four lines whatever they hold, so where a record starts follows from the
number of line ends before it.  A first scan counts the line ends of every stretch of
a plain file, in parallel; from the running sums the driver knows, for any record
number, a byte near it and how many line ends to skip from there.  Both files of a pair
are then read in the same ranges of record numbers, side by side in one task: pairs
meet without a shuffle, and a file of any size is spread over the cluster.  Compressed
files can't be entered in the middle; a pair with one is read side by side in one task.

Files are opened by ``pyarrow.fs``, so paths are those of a shared file system or an
object store that every machine reaches.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes read at once.
CHUNK = 8 << 20
PACKED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
STRETCHES = "file int, start long, ends long, open boolean"
PAIRS = "pair_id int, rec_no long, s1 string, s2 string"


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _packing(path: str) -> str | None:
    return next((kind for end, kind in PACKED.items() if path.endswith(end)), None)


def _size(path: str) -> int:
    fs, at = locate(path)
    info = fs.get_file_info(at)
    if info.type != pafs.FileType.File:
        raise FileNotFoundError(path)
    return info.size


# --- lines -----------------------------------------------------------------------


def sequences(stream, skip: int, records: int | None, start: int, end: int, path: str, chunk: int = CHUNK) -> Iterator[pa.Array]:
    """The slices [start, end) of the second lines of records, some thousands at a time.

    ``skip`` line ends come before the first record; after ``records`` of them it
    stops.  A carriage return before a line's end is no part of the line.  The last
    line needs no end.
    """
    rest, line, left = b"", -skip, records
    while left is None or left > 0:
        got = stream.read(chunk)
        data = rest + got if rest else got
        if not got and data:
            data += b"\n"  # the last line of a file without its end
        if not data:
            return
        raw = np.frombuffer(data, dtype=np.uint8)
        ends = np.flatnonzero(raw == 10)
        if len(ends):
            starts = np.concatenate(([0], ends[:-1] + 1))
            number = line + np.arange(len(ends))
            mine = np.flatnonzero((number >= 0) & (number % 4 == 1))[:left]
            a, z = starts[mine], ends[mine]
            z = z - ((z > a) & (raw[np.maximum(z - 1, 0)] == 13))
            a, z = np.minimum(a + start, z), np.minimum(a + end, z)
            if len(mine):
                yield _strings(raw, a, z, path)
            left = None if left is None else left - len(mine)
            line += len(ends)
            rest = data[int(ends[-1]) + 1 :]
        else:
            rest = data
        if not got:
            return


def _strings(raw: np.ndarray, a: np.ndarray, z: np.ndarray, path: str) -> pa.Array:
    n = z - a
    to = np.cumsum(n)
    data = raw[np.repeat(a - (to - n), n) + np.arange(int(to[-1]))]
    if (data > 127).any():
        raise ValueError(f"{path} holds a sequence that isn't ASCII")
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(np.concatenate(([0], to)).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))


def side_by_side(one: Iterator[pa.Array], two: Iterator[pa.Array], paths: tuple[str, str]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Arrays of equal length from both; an error if one has more records."""
    held = [pa.array([], pa.string()), pa.array([], pa.string())]
    while True:
        for i, source in enumerate((one, two)):
            if not len(held[i]):
                held[i] = next(source, held[i])
        n = min(len(held[0]), len(held[1]))
        if n == 0:
            if len(held[0]) != len(held[1]):
                raise ValueError(f"paired files differ in records: {paths[0]}, {paths[1]}")
            return
        yield held[0][:n], held[1][:n]
        held = [x[n:] for x in held]


# --- the index ---------------------------------------------------------------------


class FastqLines(DataSource):
    """Line ends in stretches of plain files: option ``stretches``, a JSON list of (file, path, start, length)."""

    @classmethod
    def name(cls) -> str:
        return "fastq_lines"

    def schema(self) -> str:
        return STRETCHES

    def reader(self, schema) -> DataSourceReader:
        return _LineReader(json.loads(self.options["stretches"]), int(self.options["stride"]))


class _LineReader(DataSourceReader):
    def __init__(self, stretches: list, stride: int):
        self.stretches, self.stride = stretches, stride

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(x) for x in self.stretches]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        file, path, start, length = partition.value
        fs, at = locate(path)
        rows, last = [], 10
        with fs.open_input_file(at) as f:
            f.seek(start)
            for lo in range(start, start + length, self.stride):
                raw = np.frombuffer(f.read(min(self.stride, start + length - lo)), dtype=np.uint8)
                last = int(raw[-1]) if len(raw) else last
                rows.append((file, lo, int((raw == 10).sum()), last != 10))
        names = [c.split()[0] for c in STRETCHES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.bool_()))], names=names)


@dataclass(frozen=True)
class FileIndex:
    """Where stretches start, and the line ends before each."""

    starts: list[int]
    before: list[int]
    lines: int

    @property
    def records(self) -> int:
        """Records that have a sequence line."""
        return (self.lines + 2) // 4

    def find(self, record: int) -> tuple[int, int]:
        """(byte, line ends to skip from there) of a record's first line."""
        if record == 0:
            return 0, 0
        k = max(0, bisect_left(self.before, 4 * record) - 1)  # the last stretch with fewer line ends before it
        return self.starts[k], 4 * record - self.before[k]


def index_files(spark: SparkSession, paths: list[str], stretch: int = 64 << 20, entries: int = 1_000_000) -> list[FileIndex]:
    """Indexes of plain files.  They hold at most about ``entries`` stretches in all, as many numbers as the driver keeps."""
    spark.dataSource.register(FastqLines)
    sizes = [_size(p) for p in paths]
    stride = max(1 << 20, sum(sizes) // entries)
    stretch = max(stretch // stride, 1) * stride
    work = [(i, p, at, min(stretch, n - at)) for i, (p, n) in enumerate(zip(paths, sizes)) for at in range(0, n, stretch)]
    rows: list[list] = [[] for _ in paths]
    if work:
        counted = spark.read.format("fastq_lines").option("stretches", json.dumps(work)).option("stride", stride).load()
        for r in counted.collect():
            rows[r["file"]].append((r["start"], r["ends"], r["open"]))
    out = []
    for mine in rows:
        starts, before, total = [], [], 0
        for start, ends, _ in sorted(mine):
            starts.append(start)
            before.append(total)
            total += ends
        out.append(FileIndex(starts or [0], before or [0], total + bool(mine and max(mine)[2])))
    return out


# --- pairs -------------------------------------------------------------------------


class FastqPairs(DataSource):
    """(pair_id, rec_no, s1, s2): option ``ranges``, a JSON list of (pair_id, paths, places, first record, records)."""

    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self) -> str:
        return PAIRS

    def reader(self, schema) -> DataSourceReader:
        return _PairReader(json.loads(self.options["ranges"]), json.loads(self.options["ends"]))


class _PairReader(DataSourceReader):
    def __init__(self, ranges: list, ends: list):
        self.ranges, self.ends = ranges, ends

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(x) for x in self.ranges]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        pair, paths, places, first, records = partition.value

        def one(path: str, place: tuple[int, int], ends: tuple[int, int]) -> Iterator[pa.Array]:
            fs, at = locate(path)
            if kind := _packing(path):
                with fs.open_input_stream(at, compression=kind) as f:
                    yield from sequences(f, 0, records, *ends, path)
            else:
                with fs.open_input_file(at) as f:
                    f.seek(place[0])
                    yield from sequences(f, place[1], records, *ends, path)

        both = side_by_side(*(one(p, x, e) for p, x, e in zip(paths, places, self.ends)), tuple(paths))
        for s1, s2 in both:
            n = len(s1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, pair, dtype=np.int32)), pa.array(np.arange(first, first + n)), s1, s2], names=[c.split()[0] for c in PAIRS.split(", ")])
            first += n


def record_ranges(spark: SparkSession, pairs: list[tuple[str, str]], task_bytes: int = 128 << 20) -> list:
    """The tasks that read the pairs; plain pairs with unequal numbers of records are an error here already."""
    plain = [(i, p) for i, p in enumerate(pairs) if not any(map(_packing, p))]
    index = index_files(spark, [f for _, p in plain for f in p])
    ranges = [(i, p, [(0, 0), (0, 0)], 0, None) for i, p in enumerate(pairs) if any(map(_packing, p))]
    for (i, p), a, b in zip(plain, index[::2], index[1::2]):
        if a.records != b.records:
            raise ValueError(f"paired files differ in records: {p[0]} has {a.records}, {p[1]} has {b.records}")
        tasks = max(1, -(-max(map(_size, p)) // task_bytes))
        cuts = sorted({a.records * k // tasks for k in range(tasks + 1)})
        ranges += [(i, p, [a.find(lo), b.find(lo)], lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]
    return ranges


def fastq_pairs(spark: SparkSession, pairs: list[tuple[str, str]], r1=(0, 32), r2=(0, 20), task_bytes: int = 128 << 20) -> DataFrame:
    """(pair_id, rec_no, s1, s2): slices of both reads of every record, pairs numbered as given.

    Files with no record give no rows.  Unequal numbers of records are an error, for
    compressed files when they are read.
    """
    pairs = [tuple(p) for p in pairs]
    if any(len(p) != 2 for p in pairs):
        raise ValueError("FASTQ files come in pairs")
    ranges = record_ranges(spark, pairs, task_bytes)
    if not ranges:
        return spark.createDataFrame([], PAIRS)
    spark.dataSource.register(FastqPairs)
    return spark.read.format("fastq_pairs").option("ranges", json.dumps(ranges)).option("ends", json.dumps([r1, r2])).load()
