"""Tables written once to the cluster's shared folder, which cuts a plan's lineage."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a few narrow columns that may be broadcast: about 16 MB.
BROADCAST_ROWS = 100_000
#: Folders of the tables stored in each open ``scratch`` of this thread, innermost last.
_OPEN: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("open", default=())


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only in local mode where that is unset."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        path = context.getCheckpointDir()
    return path.rstrip("/")


def materialised(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet and read back: later plans all see the same rows."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if _OPEN.get():
        _OPEN.get()[-1].append(path)  # before writing, so that a failed table goes too
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored inside are deleted at its end, also after an error, but those stored by the function that it gives.

    Those belong to the scratch around it; without one they stay, as a result reads them. So a job that has
    written its result inside a scratch leaves nothing else behind.
    """
    around = _OPEN.get()
    own: list[str] = []
    token = _OPEN.set((*around, own))

    def kept(df: DataFrame, label: str) -> DataFrame:
        out = materialised(df, label)
        path = _OPEN.get()[-1].pop()
        if around:
            around[-1].append(path)
        return out

    try:
        yield kept
    finally:
        _OPEN.reset(token)
        for path in own:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has no more rows than may be broadcast."""
    return df.limit(rows + 1).count() <= rows


def small_or_shuffled(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows fit, else left to a shuffle."""
    return F.broadcast(df) if fits(df) else df


def dealt(df: DataFrame, rows: int, *keys: str, most: int | None = None) -> DataFrame:
    """df dealt out by a hash of the keys to tasks of about so many rows, which are counted, and to ``most`` tasks at most.

    A table of few bytes comes as one task or two, however many rows it has and whatever each row becomes.
    """
    tasks = df.count() // rows + 1
    return df.repartition(min(tasks, most or tasks), *keys)


def running(df: DataFrame, value: Column, out: str, *order: str) -> DataFrame:
    """df with the sum of a whole number over the rows before it, in an order of unique keys.

    Rows are dealt out by ranges of the order and stored; the ranges' sums, one number each, come to the
    driver. So no task has more than its range.
    """
    rows = materialised(df.withColumn("_v", value.cast("long")).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    first = rows.groupBy("_part").agg(F.min(F.struct(*order)).alias("at"), F.sum("_v").alias("n")).orderBy("at").collect()
    base, total = {}, 0
    for r in first:
        base[r["_part"]], total = total, total + r["n"]
    offsets = F.broadcast(df.sparkSession.createDataFrame(list(base.items()), "_part int, _base long"))  # a row for each range
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(offsets, "_part").withColumn(out, F.col("_base") + F.coalesce(F.sum("_v").over(before), F.lit(0))).drop("_part", "_base", "_v")


def numbered(df: DataFrame, out: str, *order: str) -> DataFrame:
    """df with consecutive numbers from 0 in an order of unique keys."""
    return running(df, F.lit(1), out, *order)
