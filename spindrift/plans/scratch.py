"""Intermediate tables in the folder that the whole cluster shares.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir`` and reading it
back: a lost executor then costs a re-read, never a recomputation of the whole
history, and the columns stay compressed and prunable.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input, as Spark estimates them for a plan, that one task of :func:`dealt` is meant for.
TASK_BYTES = 4 << 20

#: Scratch folders by path, deleted when the driver ends.
_open: dict[str, Scratch] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Where it is unset, a session whose driver and executors are one process gets a
    folder of its own; on a cluster that would be each machine's own disk, so it is
    an error there.
    """
    have = spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        have = "file://" + tempfile.mkdtemp(prefix="spindrift-")
        spark.conf.set("spark.checkpoint.dir", have)
    return have.rstrip("/")


@atexit.register
def _delete_open() -> None:
    """A query's result reads its tables lazily, so they stay until the driver ends."""
    for s in list(_open.values()):
        try:
            s._delete(s.root)
        except Exception:  # the session has ended
            return


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt out by ``columns``, whose groups then stand whole in one task each, to a number of tasks that grows with it.

    For groups of few rows: summing up before rows are dealt out only fills the tasks that
    read them, and a fixed number of tasks behind would hold more the larger the input is.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 50:  # no estimate: of a table it then is the largest long
        return df.repartition(*columns)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)), *columns)


class Scratch:
    """A folder of intermediate tables belonging to one query."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/spindrift/{name}-{uuid.uuid4().hex}"
        self._n = 0
        _open[self.root] = self

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def keep(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write ``df`` and return a frame that reads what was written."""
        path = self.path(name)
        schema = df.schema
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out._scratch_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables written by :meth:`keep` once nothing will read them again."""
        for df in tables:
            if path := getattr(df, "_scratch_path", None):
                self._delete(path)

    def free(self) -> None:
        """Let Spark remove the shuffle files of finished jobs now; it does when the driver's garbage is collected."""
        self.spark._jvm.System.gc()

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
