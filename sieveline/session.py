"""Session settings, and the small helpers that every plan shares."""

from __future__ import annotations

import os
import sys
import uuid
from contextvars import ContextVar
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = str(Path(__file__).resolve().parents[1])
BROADCAST_BYTES = 8 << 20
#: Rows of long work that one task gets.
TASK_ROWS = 20_000


def build_session(name: str = "sieveline", master: str | None = None, shuffle_partitions: int | None = None, scratch: str | None = None) -> SparkSession:
    """A session with the settings this library is tested under; a running session keeps its own.

    scratch is a folder that driver and executors share, for where spark.checkpoint.dir is not set.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.appName(name).config(map=conf)
    if scratch and not SparkConf().get("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", scratch)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def workers_find_package(spark: SparkSession) -> None:
    """Put this package on the Python path of workers, where it was not shipped by other means."""
    if PACKAGE_ROOT not in sys.path:
        sys.path.insert(0, PACKAGE_ROOT)
    env = spark.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, env.get("PYTHONPATH", "")) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, or else its context's checkpoint folder.

    Without either there is an error at every master: a folder of one machine would do on that machine only.
    """
    kept = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not kept:
        raise ValueError("set spark.checkpoint.dir, as the session starts, to a folder that the driver and all executors share")
    return kept.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def small(table: DataFrame) -> bool:
    """Whether the values of a written table have BROADCAST_BYTES at most; arrays, structs and maps count by their text."""

    def size(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        if kind.startswith(("array", "struct", "map")):
            value = F.to_json(value)
        elif kind not in ("string", "binary"):
            return F.lit(8)
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8

    sizes = [size(*x) for x in table.dtypes]
    return (table.agg(F.sum(sum(sizes, F.lit(0)))).first()[0] or 0) <= BROADCAST_BYTES


def few(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is small; beyond, Spark joins by sorting."""
    return F.broadcast(table) if small(table) else table


#: The scratches that are open in this thread, the innermost last.
_open: ContextVar[tuple[Scratch, ...]] = ContextVar("open_scratches", default=())


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, and survives lost executors.

    The files stay until the folder is cleared, or the scratch around ends.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    if around := _open.get():
        around[-1].paths[id(found)] = (path, found)
    return found


class Scratch:
    """Cuts made within its block, by its thread, are deleted at its end, but for those kept, which the scratch around then has.

    What is still to be computed after the block may read kept cuts only.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Scratch:
        self.around = _open.get()
        _open.set((*self.around, self))
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        path = self.paths.pop(id(table), None)
        if path and self.around:
            self.around[-1].paths[id(table)] = path
        return table

    def keep_all_but(self, *tables: DataFrame) -> None:
        """Keep what was cut here, or kept by scratches within, but for these."""
        for table in [x for _, x in self.paths.values() if not any(x is y for y in tables)]:
            self.keep(table)

    def drop(self, table: DataFrame) -> None:
        """Delete a cut of this scratch now; tables that are none of its cuts are left alone."""
        if id(table) in self.paths:
            delete(self.spark, self.paths.pop(id(table))[0])

    def __exit__(self, *_) -> None:
        _open.set(self.around)
        for path, _table in self.paths.values():
            delete(self.spark, path)


def file_system(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself has them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path by Spark's own file systems, if it is there."""
    where, files = file_system(spark, path)
    files.delete(where, True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """df dealt out over all cores, for rows that are few in bytes and long in work, which Spark would put together."""
    return df.repartition(max(2, df.sparkSession.sparkContext.defaultParallelism), *columns)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """A table dealt out by columns, in tasks of some TASK_ROWS rows, and over all cores at least.

    For tables whose rows are few in bytes and long in work: a file of a million rows is otherwise one task. The rows are
    counted first, which files of Parquet tell by themselves.
    """
    return df.repartition(max(2, df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)), *columns)


def numbered(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """df, written, with a number for each row that is the same wherever the result is read.

    A number that is worked out anew on each side of a join is another one there as soon as partitions differ, as
    behind an adaptive exchange; so the rows are cut as they get it.
    """
    return cut(df.withColumn(row_id, F.monotonically_increasing_id()), "numbered")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
