"""Hard negatives by BOND: vectors read dimension by dimension, with bounds on what is still to come.

Vectors lie in blocks as columns, one for each dimension. An anchor reads a block's columns in the
order of its own components' magnitude, largest first, and adds up what they bring to the inner product.
The least and the greatest value of the columns not yet read bound the rest, so that after every few
columns the bitmap of candidates loses those that can no longer come into question; what is
left at the end has been read in full and is exact.

Two rounds: the first finds each anchor's nearest rows of its own label, and their scores set the windows;
the second finds for each window the best rows of other labels inside it. Blocks of vectors meet
blocks of anchors; each leaves a few rows for an anchor, which are merged.

Components are whole numbers, floor(256 * x), and sums are 64-bit. Edge cases: rows with a null label,
id or vector, with null or non-finite components, or of another dimension than most take no part.
Repeated rows, also rows of one id, are rows of their own: a copy of an anchor is another row of its
label, and a repeated anchor has its results again. An anchor without positives has none, as has a
positive whose window is empty, such as one with a negative score.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Vectors, and anchors, in a block; columns read between two looks at the bounds.
BLOCK, ANCHORS, STEP = 4096, 2048, 8


def usable(rows: DataFrame, floor_by: int = 256) -> DataFrame:
    """(id, label, vector array<long>) of the rows that take part, but for their dimension."""
    x = lambda e: e.cast("double")
    rows = common.pick(rows, "vec_id", "embedding", "label").where("vec_id is not null and label is not null and embedding is not null")
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(x(e)) & (F.abs(x(e)) < float("inf")))
    vector = F.transform("embedding", lambda e: F.floor(floor_by * x(e)))
    return rows.where(fine & (F.size("embedding") > 0)).select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), vector.alias("vector"))


class Block:
    """Vectors as columns, with the least and the greatest value of each."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, label: np.ndarray, vectors: list[np.ndarray]) -> None:
        order = np.argsort(ids, kind="stable")  # so that equal scores keep the order of ids
        self.row, self.id, self.label = row[order], ids[order], label[order]
        self.columns = np.ascontiguousarray(np.stack(vectors)[order].T)
        self.low, self.high = self.columns.min(1), self.columns.max(1)

    def scan(self, anchor: np.ndarray, wanted: np.ndarray, prune: Callable[[np.ndarray, int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the wanted rows that are left, and their inner products with the anchor.

        prune: of partial sums, and the least and the most that is still to come, which to keep.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        a = anchor[order]
        ends = np.stack((a * self.low[order], a * self.high[order]))
        # What the columns from each place on bring at least and at most.
        least = np.concatenate((np.cumsum(ends.min(0)[::-1])[::-1], [0]))
        most = np.concatenate((np.cumsum(ends.max(0)[::-1])[::-1], [0]))
        columns, left = self.columns, np.flatnonzero(wanted)
        at = left  # the candidates' places in the columns that are read
        total = np.zeros(columns.shape[1], np.int64)
        for i in range(0, len(a), STEP):
            if len(at) < columns.shape[1] // 4:  # few are left: their columns alone
                columns, total = np.ascontiguousarray(columns[:, at]), total[at]
                at = np.arange(len(at))
            step = np.empty(columns.shape[1], np.int64)
            j = min(i + STEP, len(a))
            for k in range(i, j):
                np.multiply(columns[order[k]], a[k], out=step)
                total += step
            keep = prune(total[at], int(least[j]), int(most[j]))
            left, at = left[keep], at[keep]
            if not len(at):
                break
        return left, total[at]


def largest(scores: np.ndarray, k: int) -> int | None:
    """The k-th largest, None if there are fewer."""
    return int(np.partition(scores, -k)[-k]) if len(scores) >= k else None


def nearest(block: Block, anchor: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the k wanted rows of the largest scores, ties to smaller ids."""

    def prune(total: np.ndarray, least: int, most: int) -> np.ndarray:
        edge = largest(total, k)
        return np.ones(len(total), bool) if edge is None else total + most >= edge + least

    left, score = block.scan(anchor, wanted, prune)
    top = np.lexsort((left, -score))[:k]
    return left[top], score[top]


def within(block: Block, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (low, high) positions and scores of the k best wanted rows inside it."""

    lowest, highest = min(low for low, _ in windows), max(high for _, high in windows)

    def prune(total: np.ndarray, least: int, most: int) -> np.ndarray:
        if all(most - least > high - low for low, high in windows):  # no row is surely inside yet
            return (total >= lowest - most) & (total <= highest - least)
        keep = np.zeros(len(total), bool)
        for low, high in windows:
            can = (total >= low - most) & (total <= high - least)
            if most - least <= high - low:
                # Rows that are surely inside push out those that are surely below k of them.
                edge = largest(total[(total >= low - least) & (total <= high - most)], k)
                can = can if edge is None else can & (total >= edge + least - most)
            keep |= can
        return keep

    left, score = block.scan(anchor, wanted, prune)
    out = []
    for low, high in windows:
        own = np.flatnonzero((score >= low) & (score <= high))
        top = own[np.lexsort((left[own], -score[own]))[:k]]
        out.append((left[top], score[top]))
    return out


def _met(rows: DataFrame, anchors: DataFrame, n: int, asked: int, run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """run(vectors, anchors) of every block of rows (row, ..) and every block of anchors (row, ..)."""
    blocks, ask_blocks = max(1, -(-n // BLOCK)), max(1, -(-asked // ANCHORS))
    copies = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    own = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    base = rows.withColumn("b", own(blocks)).withColumn("q", copies(ask_blocks))
    ask = anchors.withColumn("q", own(ask_blocks)).withColumn("b", copies(blocks))
    empty = [c.split()[0] for c in schema.split(", ")]
    both = lambda x, a: run(x, a) if len(x) and len(a) else pd.DataFrame(columns=empty)
    return base.groupBy("b", "q").cogroup(ask.groupBy("b", "q")).applyInPandas(both, schema)


def _block(x: pd.DataFrame) -> Block:
    return Block(x["row"].to_numpy(), x["id"].to_numpy(), x["label"].to_numpy(), x["vector"].tolist())


def positives(rows: DataFrame, anchors: DataFrame, n: int, asked: int, k: int) -> DataFrame:
    """(row, place, positive_id, positive_score): each anchor's k nearest other rows of its label."""

    def run(x: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        block = _block(x)
        out: list[pd.DataFrame] = []
        for row, label, v in zip(a["row"], a["label"], a["vector"], strict=True):
            at, score = nearest(block, v, (block.label == label) & (block.row != row), k)
            out.append(pd.DataFrame({"row": row, "positive_id": block.id[at], "positive_score": score}))
        return pd.concat(out)

    found = _met(rows, anchors, n, asked, run, "row long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def negatives(rows: DataFrame, anchors: DataFrame, n: int, asked: int, k: int) -> DataFrame:
    """(row, place, rank, negative_id, negative_score): the k best rows of other labels in each window.

    anchors: (row, label, vector, windows array of (place, low, high)).
    """

    def run(x: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        block = _block(x)
        out: list[pd.DataFrame] = []
        for row, label, v, windows in zip(a["row"], a["label"], a["vector"], a["windows"], strict=True):
            found = within(block, v, block.label != label, [(w["low"], w["high"]) for w in windows], k)
            out += [pd.DataFrame({"row": row, "place": w["place"], "negative_id": block.id[at], "negative_score": score}) for w, (at, score) in zip(windows, found, strict=True) if len(at)]
        return pd.concat(out) if out else pd.DataFrame(columns=["row", "place", "negative_id", "negative_score"])

    found = _met(rows, anchors, n, asked, run, "row long, place int, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 100, pos: int = 5, neg: int = 10, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (id, label,
    vector), as ``usable`` gives them: anchors are those whose id is divisible by ``every``, and a window
    is given in percent of the positive's score.
    """
    with common.scratch(vectors.sparkSession) as kept:
        dims = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
        rows = common.stored(common.with_row_id(vectors.where(F.size("vector") == (dims[0] if dims else 0)), "row"), "vectors")
        anchors = rows.where(F.col("id") % every == 0)
        n, asked = rows.count(), anchors.count()
        near = common.stored(positives(rows, anchors, n, asked, pos), "positives")
        # For a score of at least 0, the least and the greatest whole number inside; below it there is none.
        low, high = F.expr(f"({window[0]}L * positive_score + 99L) div 100L"), F.expr(f"({window[1]}L * positive_score) div 100L")
        windows = near.where("positive_score >= 0").select("row", F.struct("place", low.alias("low"), high.alias("high")).alias("w"))
        windows = windows.groupBy("row").agg(F.array_sort(F.collect_list("w")).alias("windows"))
        asks = common.stored(anchors.select("row", "id", "label", "vector").join(windows, "row"), "asks")
        far = common.stored(negatives(rows, asks.drop("id"), n, asked, neg), "negatives")
        out = far.join(near, ["row", "place"]).join(common.small_or_shuffled(asks.select("row", F.col("id").alias("anchor_id"))), "row")
        return kept(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "mined")
