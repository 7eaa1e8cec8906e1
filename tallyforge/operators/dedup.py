"""Exact duplicates and classification of files, as manifests; no file is moved or deleted."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions import text
from ..sources import each

#: Bytes read at a file's head and at its tail before it is read whole; bytes of a chunk; bytes read at once.
ENDS, CHUNK, PIECE = 64 << 10, 64 << 20, 4 << 20


def duplicates(files: DataFrame, content: str = "content", key: str = "path") -> DataFrame:
    """(ext, hash, kept, path, is_kept) of files (path, length, content) that share extension and bytes.

    Only files whose extension and size collide are hashed. The smallest path of a group is kept.
    """
    rows = files.withColumn("ext", text.extension(F.col(key)))
    sizes = rows.groupBy("ext", "length").agg(F.count("*").alias("n")).where("n > 1").select("ext", "length")
    hashed = rows.join(sizes, ["ext", "length"], "left_semi").select("ext", F.col(key).alias("path"), text.content_hash(F.col(content)).alias("hash"))
    # Written, so that no content is read or hashed twice.
    hashed = storage.materialised(hashed, "hashed")
    groups = hashed.groupBy("ext", "hash").agg(F.min("path").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    return hashed.join(groups, ["ext", "hash"]).select("ext", "hash", "kept", "path", (F.col("path") == F.col("kept")).alias("is_kept"))


def _digests(ranges: DataFrame, name: str) -> DataFrame:
    """ranges (path, offset, length, ..) with the SHA-256 of those bytes of the file."""

    def digest(uri: str, offset: int, length: int) -> str:
        store, path = each.opened(uri)
        h = hashlib.sha256()
        with store.open_input_file(path) as f:
            f.seek(offset)
            while length > 0:
                piece = f.read(min(PIECE, length))
                if not piece:
                    raise OSError(f"{uri} is shorter than listed")
                h.update(piece)
                length -= len(piece)
        return h.hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.assign(**{name: [digest(*x) for x in zip(rows["path"], rows["offset"], rows["length"], strict=True)]})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema)
    return ranges.mapInPandas(run, f"{kinds}, {name} string")


def _company(rows: DataFrame, *key: str) -> DataFrame:
    """The rows that share their key with others; only counts are shuffled if the shared keys are few."""
    shared = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    return rows.join(storage.small_or_shuffled(storage.materialised(shared, "shared")), list(key), "left_semi")


def duplicate_files(listing: DataFrame, ends: int = ENDS, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(found, read) of files (path, length), by their bytes read in ranges; no file is ever one row.

    found: (ext, hash, kept, path, is_kept) as of ``duplicates``. read: (step, files, bytes), what was read.
    Files go on to the next step only in company: of one extension and size; of equal ends; then all
    chunks are hashed, each by a task of its own. A file of one chunk has its SHA-256 as hash, a longer one
    that of its chunks' digests in order.
    """
    with storage.scratch(listing.sparkSession) as kept:
        # Stored, so that all steps see one listing.
        rows = storage.materialised(listing.select("path", "length", text.extension(F.col("path")).alias("ext")), "listing")
        sized = _company(rows, "ext", "length")
        # The head, and the tail if it doesn't overlap.
        head = F.struct(F.lit(0).cast("long").alias("offset"), F.least("length", F.lit(ends)).cast("long").alias("size"))
        tail = F.struct(F.greatest(F.col("length") - ends, F.lit(ends)).cast("long").alias("offset"), F.least(F.lit(ends), F.col("length") - ends).cast("long").alias("size"))
        both = F.when(F.col("length") > ends, F.array(head, tail)).otherwise(F.array(head))
        parts = sized.select("path", "ext", F.col("length").alias("whole"), F.explode(both).alias("p")).select("path", "p.offset", F.col("p.size").alias("length"), "ext", "whole")
        parts = storage.materialised(_digests(each.spread(parts), "digest"), "ends")
        near = parts.groupBy("path", "ext", "whole").agg(F.concat_ws("|", F.transform(F.array_sort(F.collect_list(F.struct("offset", "digest"))), lambda x: x.digest)).alias("ends"))
        near = storage.materialised(_company(near, "ext", "whole", "ends"), "near")
        # Files that the first step has read whole are not read again.
        done = near.where(F.col("whole") <= ends).select("ext", "path", F.col("ends").alias("hash"))
        starts = F.explode(F.expr(f"sequence(0L, (whole - 1) div {chunk}L)"))
        chunks = near.where(F.col("whole") > ends).select("path", starts.alias("i"), "ext", "whole")
        chunks = chunks.select("path", (F.col("i") * chunk).alias("offset"), F.least(F.lit(chunk), F.col("whole") - F.col("i") * chunk).cast("long").alias("length"), "ext", "whole")
        chunks = storage.materialised(_digests(each.spread(chunks), "digest"), "chunks")
        several = F.array_sort(F.collect_list(F.struct("offset", "digest")))
        whole = chunks.groupBy("ext", "path").agg(several.alias("d"))
        joined = F.when(F.size("d") == 1, F.get("d", 0).digest).otherwise(F.sha2(F.concat_ws("", F.transform("d", lambda x: x.digest)), 256))
        hashed = kept(done.union(whole.select("ext", "path", joined.alias("hash"))), "hashed")
        read = lambda rows, step: rows.agg(F.lit(step).alias("step"), F.count_distinct("path").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        steps = kept(read(parts, "ends").union(read(chunks, "whole")), "steps")
    groups = hashed.groupBy("ext", "hash").agg(F.min("path").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = hashed.join(groups, ["ext", "hash"]).select("ext", "hash", "kept", "path", (F.col("path") == F.col("kept")).alias("is_kept"))
    return found, steps


def by_folder(files: DataFrame, key: str = "path") -> DataFrame:
    """files with ``ext``, where a sorted copy of each would lie; written partitioned by ext it is the manifest."""
    return files.withColumn("ext", text.extension(F.col(key), "No_Extension"))


def removals(found: DataFrame) -> DataFrame:
    """(kept, path) of the files that a clean-up would remove."""
    return found.where("not is_kept").select("kept", "path")


def by_extension(files: DataFrame, key: str = "path") -> DataFrame:
    """(ext, files, bytes)."""
    return files.groupBy(text.extension(F.col(key), "No_Extension").alias("ext")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
