"""Many small files at once: one file a row written in two phases, and readers that pack and reject.

Writing: tasks of so many rows stage their files in folders of their own and store what they have staged;
then tasks move the files of the stored attempts into place, and whatever happens the staging folder
goes. So n rows are n files, a failed job leaves none, and no name passes through the driver.

Reading: files are listed by tasks, a folder at a time, without being opened, packed into tasks by bytes, and opened
one by one; what cannot be read or parsed goes to a second frame and doesn't stop the job.
"""

from __future__ import annotations

import fnmatch
import io
import os
import re
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException, PySparkValueError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage

#: Bytes of small files that one task reads, about, and what opening a file costs in bytes.
TASK_BYTES, OPEN_BYTES = 64 << 20, 32 << 10
#: Bytes of texts that go to Spark at once, about; a longer file goes alone.
BATCH_BYTES = 8 << 20
#: Files that one task writes, about; files named to Spark at once.
TASK_FILES, BATCH_FILES = 8192, 10_000
#: Folders whose names a plan may hold; more are a stored table.
PLAN_FOLDERS = 10_000
#: How often a staging folder is deleted again while tasks of a failed job still write to it.
CLEARINGS = 100


def opened(uri: str):
    """The store and the path in it of a URI, of any store that pyarrow knows."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:  # Spark writes file:/path
        return fs.LocalFileSystem(), re.sub("^(file:)?/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def _each_file(rows: DataFrame, act: Callable[..., None], *columns: str) -> None:
    """Calls act once or, when a task runs again, more often for each row, in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                act(*x)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    rows.select(*columns).mapInArrow(run, "n long").agg(F.sum("n")).collect()


def _staged(rows: DataFrame, staging: str) -> DataFrame:
    """(name, folder) of rows (name, value) after their files were written to a folder of the attempt below staging."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(f"{staging}/{uuid.uuid4().hex}")
        # Not recursive: once the driver has given up and cleared the staging folder no task makes it again.
        store.create_dir(base, recursive=False)
        seen, folders = set(), {""}
        for batch in batches:
            names = batch.column("name").to_pylist()
            for name, value in zip(names, batch.column("value").to_pylist(), strict=True):
                if not name or name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"not a name of a file below the folder: {name!r}")
                if name in seen:  # rows of one name meet in one task
                    raise ValueError(f"two rows have the name of one file: {name!r}")
                seen.add(name)
                at = ""
                for part in name.split("/")[:-1]:
                    at = f"{at}/{part}"
                    if at not in folders:
                        store.create_dir(f"{base}{at}", recursive=False)
                        folders.add(at)
                with store.open_output_stream(f"{base}/{name}") as f:
                    f.write(value or b"")
            yield pa.RecordBatch.from_pydict({"name": names, "folder": [base] * len(names)}, schema=pa.schema([("name", pa.string()), ("folder", pa.string())]))

    rows = storage.dealt(rows.select("name", F.col("value").cast("binary").alias("value")), TASK_FILES, "name")
    return storage.materialised(rows.mapInArrow(run, "name string, folder string"), "staged")


def _cleared(staging: str) -> None:
    store, at = opened(staging)
    for left in reversed(range(CLEARINGS)):
        try:
            return store.delete_dir(at)
        except FileNotFoundError:
            return
        except OSError:  # a task that is being stopped has written meanwhile
            if not left:
                raise
            time.sleep(0.1)


def write_each(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Each of rows (name, value) as the file path/name; a name may lie in folders.

    The folder must be new or empty, or all its other files go with ``overwrite``. Names that
    are null, absolute, repeated or lead out of the folder are an error, after which there are no files.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    store, base = opened(path)
    staging = f"{path}/_staging-{uuid.uuid4().hex}"

    def move(folder: str, name: str) -> None:
        to = f"{base}/{name}"
        store.create_dir(to.rpartition("/")[0], recursive=True)
        try:
            store.move(f"{folder}/{name}", to)
        except FileNotFoundError:
            if not is_file(to):  # else an attempt before has moved it
                raise

    def is_file(at: str) -> bool:
        from pyarrow import fs

        return store.get_file_info(at).type == fs.FileType.File

    def delete(at: str) -> None:
        if is_file(at):
            store.delete_file(at)

    with storage.scratch(spark):
        store.create_dir(base, recursive=True)
        there = storage.materialised(_files_of(_folders(spark, [path], None, _no_staging), "*", _no_staging).select("path"), "there")
        if not overwrite and not there.isEmpty():
            raise PySparkValueError(f"{path} has files")
        store.create_dir(opened(staging)[1])
        try:
            staged = _staged(rows, staging)
            try:
                _each_file(staged, move, "folder", "name")
            except Exception:
                if not overwrite:
                    _each_file(staged.select(F.concat(F.lit(f"{base}/"), "name").alias("at")), delete, "at")
                raise
            if overwrite:
                old = there.select(F.col("path").substr(len(path) + 2, 1 << 30).alias("name")).join(staged, "name", "left_anti")
                _each_file(old.select(F.concat(F.lit(f"{base}/"), "name").alias("at")), delete, "at")
        finally:
            _cleared(staging)


def write_each_form(records: DataFrame, path: str, name: Column, overwrite: bool = False) -> None:
    """Each record as one file of JSON with all columns, named by ``name`` with .json after it."""
    write_each(records.select(F.concat(name, F.lit(".json")).alias("name"), F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value")), path, overwrite)


def _visible(name: str) -> bool:
    """Whether Spark's readers see a name."""
    return not name.startswith(".") and not (name.startswith("_") and "=" not in name) and not name.endswith("._COPYING_")


def _no_staging(name: str) -> bool:
    return not name.startswith("_staging-")


def _entries(uri: str) -> Iterator[tuple[str, int | None]]:
    """(name, length) of what lies in a folder, without a length for folders; links are followed."""
    from pyarrow import fs

    store, path = opened(uri)
    if isinstance(store, fs.LocalFileSystem):  # one after another, however many there are
        with os.scandir(path) as found:
            for e in found:
                if e.is_dir():
                    yield e.name, None
                elif e.is_file():
                    yield e.name, e.stat().st_size
    else:
        for i in store.get_file_info(fs.FileSelector(path)):
            yield i.base_name, i.size if i.is_file else None


def _folders(spark: SparkSession, roots: list[str], levels: int | None, seen: Callable[[str], bool]) -> DataFrame:
    """(path) of the folders and of all below them, or of so many levels; found by tasks, level by level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                inner = [f"{uri}/{name}" for name, length in _entries(uri) if length is None and seen(name)]
                yield pa.RecordBatch.from_pydict({"path": pa.array(inner, pa.string())})

    with storage.scratch(spark) as kept:
        level = spark.createDataFrame([(r,) for r in roots], "path string")
        found, n = [level], 1
        while levels is None or n < levels:
            level = storage.materialised(storage.dealt(level, 8, "path").mapInArrow(run, "path string"), "folders")
            if level.isEmpty():
                break
            found, n = [*found, level], n + 1
        every = found[0]
        for f in found[1:]:
            every = every.union(f)
        some = every.limit(PLAN_FOLDERS + 1).collect()
        return spark.createDataFrame(some, "path string") if len(some) <= PLAN_FOLDERS else kept(every, "folders")


def _files_of(folders: DataFrame, glob: str, seen: Callable[[str], bool]) -> DataFrame:
    """(path, length) of the files that lie in folders, each listed by one task."""

    def batch(out: list[tuple[str, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in out], pa.string()), "length": pa.array([n for _, n in out], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uris in batches:
            for uri in uris.column("path").to_pylist():
                out = []
                for name, length in _entries(uri):
                    if length is not None and seen(name) and fnmatch.fnmatchcase(name, glob):
                        out.append((f"{uri}/{name}", length))
                    if len(out) >= BATCH_FILES:
                        yield batch(out)
                        out = []
                yield batch(out)

    return storage.dealt(folders, 1, "path", most=1024).mapInArrow(run, "path string, length long")


def listed(spark: SparkSession, path: str | list[str], glob: str = "*", recursive: bool = True, levels: int | None = None, empty: bool = False) -> DataFrame:
    """(path, length) of files; none is opened. Names that begin with _ or . are left out, as Spark does, and empty files without ``empty``.

    The glob, as of ``fnmatch``, is of a file's name. Folders are listed by tasks each time that the rows are
    asked for. levels: only files of so many levels. A path that isn't there is an error.
    """
    files, folders = [], []
    for p in [path] if isinstance(path, str) else path:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
        if not found:
            raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {p}.")
        for f in found:
            uri = f.getPath().toString()
            if f.isDirectory():
                folders.append(uri)
            elif fnmatch.fnmatchcase(uri.rpartition("/")[2], glob):
                files.append((uri, f.getLen()))
    every = _files_of(_folders(spark, folders, levels if recursive else 1, _visible), glob, _visible)
    if files:
        every = every.union(spark.createDataFrame(files, "path string, length long"))
    return every if empty else every.where("length > 0")


def packed(files: DataFrame, task_bytes: int = TASK_BYTES, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """files (path, length) with ``pack``: neighbours by name in packs of about so many bytes, an
    opening counted as some; a larger file is a pack of its own."""
    before = storage.running(files, F.col("length") + open_bytes, "_before", "path")
    return before.withColumn("pack", F.floor(F.col("_before") / task_bytes).cast("long")).drop("_before")


def spread(ranges: DataFrame, task_bytes: int = TASK_BYTES, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """Byte ranges (path, offset, length, ..) dealt out to as many tasks as their bytes ask for."""
    ranges = storage.materialised(ranges, "ranges")
    total = ranges.agg(F.sum(F.col("length") + open_bytes)).first()[0] or 0
    return ranges.repartition(int(total // task_bytes) + 1, "path", "offset")


def _by_packs(files: DataFrame) -> DataFrame:
    """files (path, length) as tasks of a pack or a few."""
    with storage.scratch(files.sparkSession) as kept:
        rows = kept(packed(files), "packs")
    packs = (rows.agg(F.max("pack")).first()[0] or 0) + 1
    return rows.repartition(packs, "pack").select("path", "length")


def texts(files: DataFrame) -> DataFrame:
    """(path, value, error) of files (path, length): the whole text as UTF-8, or why it can't be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for rows in batches:
            for uri in rows["path"]:
                try:
                    store, path = opened(uri)
                    with store.open_input_stream(path) as f:
                        out.append((uri, f.read().decode("utf-8"), None))
                    size += len(out[-1][1])
                except (OSError, ValueError) as e:  # missing, forbidden, broken, not UTF-8
                    out.append((uri, None, f"{type(e).__name__}: {str(e)[:200]}"))
                if size > BATCH_BYTES:
                    yield pd.DataFrame(out, columns=["path", "value", "error"])
                    out, size = [], 0
        yield pd.DataFrame(out, columns=["path", "value", "error"]).astype(object)

    return _by_packs(files).mapInPandas(run, "path string, value string, error string")


def contents(files: DataFrame) -> DataFrame:
    """(path, length, content) of files (path, length), each as one value; a file that can't be read is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out, size = [], 0
            for uri in rows["path"]:
                store, path = opened(uri)
                with store.open_input_stream(path) as f:
                    content = f.read()
                out.append((uri, len(content), content))
                size += len(content)
                if size > BATCH_BYTES:
                    yield pd.DataFrame(out, columns=["path", "length", "content"])
                    out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=["path", "length", "content"])

    return _by_packs(files).mapInPandas(run, "path string, length long, content binary")


def lines(files: DataFrame) -> DataFrame:
    """(path, line) of files (path, length) in UTF-8, read line by line; a file that can't be read is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for rows in batches:
            for uri in rows["path"]:
                store, path = opened(uri)
                with store.open_input_stream(path) as f, io.TextIOWrapper(f, "utf-8-sig", "replace") as text:
                    for line in text:
                        out.append((uri, line.removesuffix("\n")))
                        size += len(line) + len(uri)
                        if size > BATCH_BYTES:
                            yield pd.DataFrame(out, columns=["path", "line"])
                            out, size = [], 0
        yield pd.DataFrame(out, columns=["path", "line"]).astype(object)

    return _by_packs(files).mapInPandas(run, "path string, line string")


def forms(spark: SparkSession, path: str, schema: T.StructType | str, two_levels: bool = False) -> tuple[DataFrame, DataFrame]:
    """(forms, rejects) of the JSON files of all folders below a path, or of two levels only.

    forms: (columns of the schema, _path), a row for a document and one for each element of an
    array. rejects: (_path, error), files that can't be read, aren't UTF-8, or don't hold JSON of the
    schema; one of blanks only is among them. Empty files are in neither. A folder without files gives none.
    """
    files = listed(spark, path, "*.json", levels=2 if two_levels else None)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # A document counts as an array of one; a text that is neither gives null.
    inner = F.trim(F.col("value"))
    document = F.when(inner.startswith("["), inner).otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    parsed = F.from_json(document, T.ArrayType(schema), {"mode": "PERMISSIVE"})
    strict = F.try_parse_json(document).isNotNull() & (inner != "")
    with storage.scratch(spark) as kept:
        rows = texts(files).select(F.col("path").alias("_path"), F.when(strict, parsed).alias("rows"), F.coalesce("error", F.when(~F.coalesce(strict, F.lit(False)), F.lit("not JSON"))).alias("error"))
        # Written once: files are opened once for both frames.
        rows = kept(rows.withColumn("error", F.coalesce("error", F.when(F.col("rows").isNull() | F.exists("rows", lambda x: x.isNull()), F.lit("not of the schema")))), "forms")
    return rows.where("error is null").select(F.inline("rows"), "_path"), rows.where("error is not null").select("_path", "error")
