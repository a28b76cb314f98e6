"""Counts of identical reads, kept up to date as files land.

The table is a folder of *runs*, Parquet folders named by the micro-batches they hold:
``run=<first>-<last>``.  A batch is counted and written as a run of its own; when
``fan_in`` runs of one level have gathered, they are added up into one run over all
their batches, so a row is rewritten once a level.  A run stands in the table if it was
written to its end and no other such run holds its batches.

That makes every step repeatable.  A batch that Structured Streaming hands over again
after a kill writes the same run once more, or nothing if a merged run has it already.
A kill between a merge and the deletion of its parts leaves parts that a reader passes
over and the next merge deletes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from spindrift.plans.scratch import dealt

_RUN = re.compile(r"run=(\d+)-(\d+)")


@dataclass(frozen=True, order=True)
class Run:
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"run={self.first:010d}-{self.last:010d}"

    def within(self, other: Run) -> bool:
        return self != other and other.first <= self.first and self.last <= other.last


class LandedCounts:
    """(keys, read_count) of all landed rows; ``folder`` is one that the whole cluster shares.

    Rows with a null key are not counted.  ``count`` names a column of counts to add
    up; without it a row counts once.  One query writes a folder at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, keys=("sequence", "source"), count: str | None = None, fan_in: int = 8):
        if fan_in < 2:
            raise ValueError("a merge takes two runs at least")
        self.spark, self.folder, self.keys, self.count, self.fan_in = spark, folder.rstrip("/"), list(keys), count, fan_in
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- runs ---

    def _written(self) -> list[Run]:
        """Runs that were written to their end."""
        root = self._path(self.folder)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        found = [Run(int(m[1]), int(m[2])) for n in names if (m := _RUN.fullmatch(n))]
        return sorted(r for r in found if self._fs.exists(self._path(f"{self.folder}/{r.name}/_SUCCESS")))

    def runs(self) -> list[Run]:
        """The runs that make up the table."""
        all_runs = self._written()
        return [r for r in all_runs if not any(r.within(o) for o in all_runs)]

    def _level(self, run: Run) -> int:
        """Merges behind a run: it holds at least ``fan_in ** level`` batches."""
        level, held = 0, run.last - run.first + 1
        while held >= self.fan_in:
            level, held = level + 1, held // self.fan_in
        return level

    def _load(self, runs: list[Run]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder}/{r.name}" for r in runs])

    def _write(self, df: DataFrame, run: Run) -> None:
        df.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(f"{self.folder}/{run.name}")

    # --- writing ---

    def counted(self, rows: DataFrame) -> DataFrame:
        n = F.sum(self.count) if self.count else F.count(F.lit(1))
        return dealt(rows.na.drop(subset=self.keys), *self.keys).groupBy(*self.keys).agg(n.cast("long").alias("read_count"))

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Count a micro-batch; the same id again changes nothing."""
        run = Run(batch_id, batch_id)
        if any(run == r or run.within(r) for r in self._written()):
            return
        self._write(self.counted(batch), run)
        self.compact()

    def compact(self) -> None:
        """Merge ``fan_in`` neighbouring runs of one level while there are any, and delete what merged runs hold."""
        while True:
            table = self.runs()
            levels = [self._level(r) for r in table]
            at = next((i for i in range(len(table) - self.fan_in + 1) if len(set(levels[i : i + self.fan_in])) == 1), None)
            if at is None:
                break
            full = table[at : at + self.fan_in]
            merged = dealt(self._load(full), *self.keys).groupBy(*self.keys).agg(F.sum("read_count").alias("read_count"))
            self._write(merged, Run(full[0].first, full[-1].last))
        for r in self._written():
            if r not in table:
                self._fs.delete(self._path(f"{self.folder}/{r.name}"), True)

    def start(self, rows: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Count a stream; ``trigger`` as for ``DataStreamWriter.trigger`` (``availableNow=True`` ends with what has landed)."""
        trigger = trigger or {"availableNow": True}
        return rows.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    # --- reading ---

    def table(self, schema: StructType | None = None) -> DataFrame:
        """(keys, read_count) over all runs; ``schema`` is that of the landed rows, for a table that nothing has landed in."""
        runs = self.runs()
        if runs:
            return dealt(self._load(runs), *self.keys).groupBy(*self.keys).agg(F.sum("read_count").alias("read_count"))
        if schema is None:
            raise FileNotFoundError(f"nothing has landed in {self.folder}")
        return self.counted(self.spark.createDataFrame([], schema))


def land_files(spark: SparkSession, source: str, schema: StructType, folder: str, checkpoint: str, keys=("sequence", "source"), count: str | None = None, files_per_batch: int | None = None, fan_in: int = 8) -> DataFrame:
    """Count the Parquet files that have landed in ``source`` since the last call with this checkpoint, and return the table."""
    table = LandedCounts(spark, folder, keys, count, fan_in)
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    table.start(stream.parquet(source), checkpoint).awaitTermination()
    return table.table(schema)

