"""Ranked lexical search of a set of queries over all documents, each bag of words scored once.

The documents are restricted to the vocabulary of the queries. Documents with the same term
counts and the same length measure m get the same scores, whatever else they hold: they form a class,
found by a hash and told apart by the counts themselves. A class is scored once, and its documents
are put in its place by rising id.

Queries go in blocks of about ``PAIRS`` (query, term) pairs, so what a worker holds of them is bounded
whatever their number; each block reads the documents once. A class keeps only the k smallest ids,
which is all that k results of a query can take of it; Spark limits them before the shuffle, so a class
with a third of all documents is not gathered. In the workers a batch of classes is a matrix of
whole numbers in doubles, which are exact up to 2**53, and so are the scores.

Terms are known by 64-bit hashes. Edge cases: null and empty texts have no terms and count neither
for N nor for L. All rows of a query id are one query, with the terms of all its texts once each;
a query without terms has no results. Repeated documents are documents of their own; a null doc_id
comes after all others and is returned as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, hashing

#: Bytes between terms: ASCII but for letters and digits.
BETWEEN = hashing.NO_LETTER.copy()
BETWEEN[48:58] = False
#: (query, term) pairs in a block, about; numbers in a matrix of a batch.
PAIRS, CELLS = 1 << 16, 1 << 22
#: Queries scored at once.
AT_ONCE = 128
#: In place of a null doc_id.
LAST = (1 << 63) - 1


def term_counts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The hashes of all terms of the texts in some chunks, and where each text's begin (one more at the end)."""
    for part in hashing.chunks(texts):
        _, h, _, first = hashing.words(part, BETWEEN)
        yield h, first


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term) distinct: the hashes of the terms of each query."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at = 0
            for h, first in term_counts(rows["text"].tolist()):
                n = len(first) - 1
                ids = rows["item"].iloc[at : at + n]
                yield pd.DataFrame({"item": ids.repeat(np.diff(first)), "term": h.view(np.int64)}).drop_duplicates()
                at += n

    rows = common.pick(items, item_id, text).toDF("item", "text")
    return common.mapped(rows, run, "term long").distinct()


def bags(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of docs (doc_id, text) with terms: n of all terms; positions in the
    vocabulary (sorted hashes) and counts of those in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at = 0
            for h, first in term_counts(rows["text"].tolist()):
                length = np.diff(first)
                place = np.minimum(np.searchsorted(vocabulary, h), max(len(vocabulary) - 1, 0))
                known = vocabulary[place] == h if len(vocabulary) else np.zeros(len(h), bool)
                doc = np.repeat(np.arange(len(length)), length)[known]
                pair, count = np.unique(doc * max(len(vocabulary), 1) + place[known], return_counts=True)
                cut = np.searchsorted(pair, np.arange(1, len(length)) * max(len(vocabulary), 1))
                terms = np.split((pair % max(len(vocabulary), 1)).astype(np.int32), cut)
                out = pd.DataFrame({"doc_id": rows["doc_id"].iloc[at : at + len(length)], "n": length, "terms": terms, "counts": np.split(count.astype(np.int32), cut)})
                yield out[length > 0]
                at += len(length)

    rows = common.pick(docs, "doc_id", "text").withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    return rows.mapInPandas(run, "doc_id long, n long, terms array<int>, counts array<int>")


def measured(rows: DataFrame) -> tuple[DataFrame, int]:
    """Stored bags as (doc_id, m, terms, counts), and the number of documents."""
    n, length = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"10L + ((90L * n * {n}L) div {max(length, 1)}L)")
    return rows.select("doc_id", m.alias("m"), "terms", "counts"), n


def weights(rows: DataFrame, n: int, terms: int) -> np.ndarray:
    """The weight of each of the vocabulary's terms, by the documents that hold it; 0 where none does."""
    df = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    out = np.zeros(terms)
    for term, w in df.select("term", F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1)))).collect():
        out[term] = w
    return out


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(m, terms, counts, ids) of rows (doc_id, m, terms, counts): one row for each class, with its k smallest ids."""
    key = ["hash", "m", "terms", "counts"]
    rows = rows.where(F.size("terms") > 0).withColumn("hash", F.xxhash64("m", "terms", "counts"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k)
    return few.groupBy(*key).agg(F.array_sort(F.collect_list("doc_id")).alias("ids")).drop("hash")


def matrix(terms: list[np.ndarray], counts: list[np.ndarray], m: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Of each class and column what the term adds to a score for each unit of its weight.

    columns: the matrix's column for each term of the vocabulary, or -1.
    """
    length = np.fromiter(map(len, terms), np.int64, len(terms))
    row = np.repeat(np.arange(len(terms)), length)
    column, tf = columns[np.concatenate(terms)], np.concatenate(counts).astype(np.int64)
    out = np.zeros((len(terms), int(columns.max(initial=-1)) + 1))
    got = column >= 0
    out[row[got], column[got]] = (1_000_000_000 * tf[got]) // (1000 * tf[got] + 8 * m[row[got]])
    return out


class Best:
    """The k highest-scoring documents of each query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.least = k, np.ones(queries)
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * queries

    def offer(self, query: int, scores: np.ndarray, ids: list[np.ndarray]) -> None:
        """scores and ids of classes, each with the k smallest of its ids."""
        least = self.least[query]
        if len(scores) > self.k:
            least = max(least, np.partition(scores, -self.k)[-self.k])
        near = np.flatnonzero(scores >= least)
        if len(near):
            own, doc = self.found[query]
            score = np.concatenate((own, np.repeat(scores[near], [len(ids[i]) for i in near])))
            doc = np.concatenate((doc, *[ids[i] for i in near]))
            top = np.lexsort((doc, -score))[: self.k]
            self.found[query] = score[top], doc[top]
            if len(top) == self.k:
                self.least[query] = score[top[-1]]


def ranked(found: DataFrame, query: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int) -> DataFrame:
    """(query, doc_id, score): of each task the k best documents of each query.

    found: classes; query, term: pairs of a query and the place of one of its terms in the vocabulary,
    sorted; weight: of the vocabulary's terms.
    """
    queries = int(query.max(initial=-1)) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(queries, k)
        for rows in batches:
            for at in range(0, queries, AT_ONCE):
                own = slice(*np.searchsorted(query, (at, at + AT_ONCE)))
                used, column = np.unique(term[own], return_inverse=True)
                columns = np.full(len(weight), -1)
                columns[used] = np.arange(len(used))
                by = np.zeros((len(used), min(AT_ONCE, queries - at)))
                by[column, query[own] - at] = weight[term[own]]
                step = max(1, CELLS // max(len(used), 1))
                for i in range(0, len(rows), step):
                    part = rows.iloc[i : i + step]
                    # Exact: all terms of the sums are whole numbers below 2**53.
                    score = matrix(part["terms"].tolist(), part["counts"].tolist(), part["m"].to_numpy(), columns) @ by
                    ids = part["ids"].tolist()
                    for q in np.flatnonzero((score >= best.least[at : at + score.shape[1]]).any(0)).tolist():
                        best.offer(at + q, score[:, q], ids)
        for q, (score, doc) in enumerate(best.found):
            if len(doc):
                yield pd.DataFrame({"query": q, "doc_id": doc, "score": score.astype(np.int64)})

    return found.mapInPandas(run, "query int, doc_id long, score long")


def _block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of the queries of a block of pairs (item, term)."""
    spark = docs.sparkSession
    got = pairs.groupBy("item").agg(F.collect_list("term").alias("terms")).collect()
    spelt = [np.array(r["terms"], np.int64).view(np.uint64) for r in got]
    vocabulary = np.unique(np.concatenate(spelt)) if spelt else np.zeros(0, np.uint64)
    query = np.repeat(np.arange(len(spelt)), [len(x) for x in spelt])
    term = np.searchsorted(vocabulary, np.concatenate(spelt)) if spelt else np.zeros(0, np.int64)
    with common.scratch(spark) as kept:
        rows, n = measured(common.stored(bags(docs, vocabulary), "bags"))
        found = ranked(classes(rows, k), query, term, weights(rows, n, len(vocabulary)), k)
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")).alias("rank")
        top = found.select("query", rank, F.when(F.col("doc_id") != LAST, F.col("doc_id")).alias("doc_id"), "score").where(F.col("rank") <= k)
        # A block's ids are few, by PAIRS.
        ids = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(got)], f"query int, item_id {pairs.dtypes[0][1]}")
        return kept(top.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score"), "top")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring of docs (doc_id, text) for each of items (item_id, text)."""
    with common.scratch(docs.sparkSession) as kept:
        pairs = common.stored(query_terms(items, "item_id", "text"), "pairs")
        blocks = max(1, -(-pairs.count() // PAIRS))
        block = F.pmod(F.xxhash64("item"), F.lit(blocks))
        return kept(reduce(DataFrame.union, [_block(docs, pairs.where(block == b), k) for b in range(blocks)]), "ranked")
