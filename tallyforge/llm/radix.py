"""Exact duplicates by distributed most-significant-digit radix partitioning.

All documents start in one group. Each level reads the next bytes of the documents that are
still in a group with others and splits every group by them. A document leaves when it is alone,
or when its text has ended: documents that end together in a group are equal byte for byte.
No digest decides equality. A level's digit is a run of bytes rather than one byte, and runs
grow, so that the number of levels is logarithmic in the longest text.

Every split is a partial aggregation (count, smallest row) joined back to the rows, so a group
of any size is never gathered in one task; Spark splits the hot keys of that join.

Edge cases: null text counts as empty, and all empty texts are equal. Rows with the same
doc_id are separate rows; of equal texts with a tied smallest doc_id the one read first stays.
A row with a null doc_id stays only where its whole group has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FIRST, GROWTH = 64, 8
SPACE = "[\\x20\\x09-\\x0D]+"


def normalised(text: F.Column) -> F.Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _split(rows: DataFrame) -> DataFrame:
    """(row, group, done) of rows (row, group, digit, ended): the groups one level further down."""
    groups = rows.groupBy("group", "digit", "ended").agg(F.min("row").alias("next"), F.count("*").alias("n"))
    shared = common.stored(groups.where("n > 1").select("group", "digit", "ended", "next"), "groups")
    # Rows without a match are alone: their own row is their group.
    out = rows.join(shared, ["group", "digit", "ended"], "left")
    return out.select("row", F.coalesce("next", "row").alias("group"), (F.col("next").isNull() | F.col("ended")).alias("done"))


def _groups(rows: DataFrame, first: DataFrame) -> DataFrame:
    """(row, group) of all rows: those of one group are equal byte for byte.

    rows: (at, bytes); first: (row, at, digit, ended), stored. Each level's wide tables are deleted
    once the next level is written.
    """
    spark = rows.sparkSession
    at, width = 0, FIRST
    with common.scratch(spark) as kept:
        level = kept(_split(first.select("row", F.lit(0).cast("long").alias("group"), "digit", "ended")), "level")
    finished = level.where("done").select("row", "group")
    left = level.where("not done").select("row", "group")
    if not left.isEmpty():
        # From the second level on, only texts that still have company are read.
        wanted = common.stored(first.select("row", "at").join(common.small_or_shuffled(left.select("row")), "row", "left_semi"), "wanted")
        rest = common.stored(rows.join(common.small_or_shuffled(wanted), "at").select("row", "bytes"), "rest")
    while not left.isEmpty():
        at, width = at + width, width * GROWTH
        with common.scratch(spark) as kept:
            digits = rest.join(common.small_or_shuffled(left), "row").select(
                "row", "group", F.substring("bytes", at + 1, width).alias("digit"), (F.length("bytes") <= at + width).alias("ended")
            )
            level = kept(_split(common.stored(digits, "digits")), "level")
        finished = finished.union(level.where("done").select("row", "group"))
        left = level.where("not done").select("row", "group")
    return finished


def _marked(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """docs under plain names with the column ``at``, and the names of doc_id and text."""
    have = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(have))])
    return common.identified(plain, "at"), f"c{have.index('doc_id')}", f"c{have.index('text')}"


def _verdict(rows: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Of all rows (row, at, doc_id, text_sha256, group), and of the groups of several rows
    (group, group_size, keep_id, stays), both stored.
    """
    clean = rows.select("at", F.col(doc_id).alias("doc_id"), F.encode(normalised(F.col(text)), "utf-8").alias("bytes"))
    with common.scratch(rows.sparkSession) as kept:
        first = clean.select(
            "at", "doc_id", F.sha2("bytes", 256).alias("text_sha256"), F.substring("bytes", 1, FIRST).alias("digit"), (F.length("bytes") <= FIRST).alias("ended")
        )
        # Written once: row ids are fixed from here on.
        first = common.stored(common.with_row_id(first, "row"), "texts")
        of = kept(first.select("row", "at", "doc_id", "text_sha256").join(_groups(clean.select("at", "bytes"), first), "row"), "of")
    sizes = of.groupBy("group").agg(F.count("*").alias("group_size"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("stays"))
    sizes = sizes.where("group_size > 1").select("group", "group_size", F.col("stays.doc_id").alias("keep_id"), F.col("stays.row").alias("stays"))
    return of, common.stored(sizes, "sizes")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document, dropped ones too."""
    of, sizes = _verdict(*_marked(common.pick(docs, "doc_id", "text")))
    lone = F.col("stays").isNull()
    return of.join(sizes, "group", "left").select(
        "doc_id",
        F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (lone | (F.col("row") == F.col("stays"))).alias("kept"),
        "text_sha256",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    if not docs.columns:
        return docs
    rows, *names = _marked(docs)
    with common.scratch(docs.sparkSession) as kept:
        of, sizes = _verdict(rows, *names)
        gone = kept(of.join(sizes, "group").where("row != stays").select("at"), "gone")
    return rows.join(common.small_or_shuffled(gone), "at", "left_anti").drop("at").toDF(*docs.columns)
