"""Helpers shared by the operators: shared-folder tables, size-checked joins, row ids."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of more than this many bytes in a broadcast's hash table is shuffled instead.
BROADCAST_BYTES = 32 << 20
#: What a row takes in that table beside its columns, a column of a number or truth value, any other column.
ROW_BYTES, NUMBER_BYTES, OTHER_BYTES = 64, 16, 160
#: Bytes of a batch that goes to a Python worker, about; a larger row goes alone.
ARROW_BYTES = 8 << 20
#: Folders of the tables stored in each open ``scratch`` of this thread, innermost last.
_OPEN: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("open", default=())
#: Nodes of a plan that neither repeat nor merge the rows of a file.
_PLAIN = ("Project", "Filter", "SubqueryAlias")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temporary one only in local mode where that is unset."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        path = context.getCheckpointDir()
    return path.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back, which cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _OPEN.get():
        _OPEN.get()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of the shared folder, and free the shuffle files of plans that nobody holds."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored inside are deleted at its end, but those stored by the function that it gives.

    Those belong to the scratch around it, if any.
    """
    around = _OPEN.get()
    own: list[str] = []
    token = _OPEN.set((*around, own))

    def kept(df: DataFrame, label: str) -> DataFrame:
        out = stored(df, label)
        path = _OPEN.get()[-1].pop()
        if around:
            around[-1].append(path)
        return out

    try:
        yield kept
    finally:
        _OPEN.reset(token)
        deleted(spark, own)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Add a unique long. Only stable once the frame has been ``stored``."""
    return df.withColumn(name, F.monotonically_increasing_id())


def _of_files(df: DataFrame) -> bool:
    """Whether df holds each row of its files once at most: columns and filters over one scan."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in _PLAIN:
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def identified(df: DataFrame, name: str) -> DataFrame:
    """df with a string that tells its rows apart and is the same whenever df is read again.

    Rows of Parquet files have their file and place in it, where df is columns and filters over one scan.
    Any other frame, such as one that repeats rows by explode or union, is ``stored`` first.
    """
    if _of_files(df):
        try:
            return df.select("*", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias(name))
        except AnalysisException:
            pass  # files of another kind have no place
    return with_row_id(stored(df, "rows"), name).withColumn(name, F.col(name).cast("string"))


def small_or_shuffled(ids: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a narrow stored frame for broadcast if its counted rows fit, else leave it to a shuffle."""
    limit = most // (ROW_BYTES + sum(NUMBER_BYTES if kind in ("bigint", "int", "double", "boolean") else OTHER_BYTES for _, kind in ids.dtypes))
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, matched exactly, so that extra columns with clashing names do no harm.

    Of columns whose names are equal but for case, the exactly matching one is taken; of exact
    repeats, the first.
    """
    have = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"c{have.index(n)}").alias(n) for n in names])


def mapped(rows: DataFrame, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """rows.mapInPandas(run) that hands on the first column, a key, as text and gives it back as it was.

    pandas would turn whole numbers beside nulls into floats.
    """
    key, kind = rows.dtypes[0]
    out = rows.withColumn(key, F.col(key).cast("string")).mapInPandas(run, f"{key} string, {schema}")
    return out.withColumn(key, F.col(key).cast(kind))


def tuned(spark: SparkSession, rows: int = 1000) -> None:
    """Settings of the registered queries: texts are long, so few rows and bytes at once go to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """For what is written inside: at most so many rows at once in a Python worker's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
