"""Approximate nearest neighbours by learned partitions.

A node of the index holds vectors; the root holds all. A node is fitted on a bounded sample of its
own vectors: their exact neighbour graph is cut into balanced parts, and a small classifier learns
each vector's part from the parts of its neighbours. Every vector goes to its most probable part, a
query to its several most probable ones. Parts are nodes of the next level, until a part has about
``PART`` vectors; so the number of parts grows with the table, and no fit or task does. In the last
parts all vectors are reranked by the exact inner product. How many parts a query visits in a node
is set on the node's sample, for a target recall that all levels meet together.

Equal vectors are one: the k + 1 smallest of their ids stand for all candidates, and equal queries
are asked once. Parts still hold unequal numbers of vectors, so their vectors and queries are dealt
out in blocks of bounded size; each pair of blocks leaves k + 1 rows for each query.

Edge cases: vectors that are null, zero, of another dimension than most, or that hold null or
non-finite components, and rows with a null id, take no part. Rows with the query's id are its
own. Rows of one id are one candidate and one query: equal ones count once, and of different
vectors the pair with the largest score counts. Equal scores go to the smaller id. If the visited parts
hold too few vectors, more are visited, down to all.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, fitting

#: Vectors in the sample of a node, at most about.
SAMPLE = 4096
#: Vectors in a last part, about; parts of a node, at most; sampled vectors that a part needs.
PART, FAN, LEAST = 250, 16, 32
NEIGHBOURS = 10
HIDDEN = 96
RECALL = 0.94
#: Vectors, and queries, in a block; queries scored at once.
BLOCK, QUERY_BLOCK, AT_ONCE = 8192, 4096, 256


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Each row's k rows of largest inner product, without itself."""
    out = np.zeros((len(x), k), np.int64)
    for i in range(0, len(x), 1024):
        s = x[i : i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i : i + 1024] = np.argpartition(-s, k - 1, 1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 0.1) -> np.ndarray:
    """Part of each node: equal halvings along random directions, then moves that cut fewer edges.

    No part grows beyond (1 + slack) of its fair share.
    """
    rng = np.random.default_rng(5)
    part = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        part[rows] = first
        if n > 1:
            a, b = x[rng.choice(rows, 2)]
            order = rows[np.argsort(x[rows] @ (a - b), kind="stable")]
            cut = len(order) * (n // 2) // n
            todo += [(order[:cut], first, n // 2), (order[cut:], first + n // 2, n - n // 2)]
    most = int(np.ceil((1 + slack) * len(x) / parts))
    ends = np.concatenate((graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])))
    begins = np.concatenate((np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()))
    for _ in range(rounds):
        near = np.bincount(begins * parts + part[ends], minlength=len(x) * parts).reshape(len(x), parts)
        gain = near - near[np.arange(len(x)), part][:, None]
        best = gain.argmax(1)
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain.max(1), kind="stable").tolist():
            if gain[i, best[i]] <= 0:
                break
            if size[best[i]] < most:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Index:
    """The classifier (one hidden layer) and how many parts a query visits."""

    dim: int
    w1: np.ndarray
    w2: np.ndarray
    visits: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(0, np.concatenate((x, np.ones((len(x), 1))), 1) @ self.w1)
        return np.concatenate((h, np.ones((len(h), 1))), 1) @ self.w2


def fit(x: np.ndarray, parts: int, k: int, recall: float = RECALL) -> Index:
    """An index from sampled vectors (one a row)."""
    dim = x.shape[1]
    if parts < 2 or len(x) <= NEIGHBOURS:
        return Index(dim, np.zeros((dim + 1, 1)), np.zeros((2, 1)), 1)
    graph = neighbour_graph(x, NEIGHBOURS)
    part = balanced_parts(x, graph, parts)
    # The target: where a vector and its neighbours lie.
    target = (np.eye(parts)[part] + np.eye(parts)[part[graph]].sum(1)) / (NEIGHBOURS + 1)
    rng = np.random.default_rng(6)
    scale = np.sqrt((x**2).mean()) or 1.0
    inputs = np.concatenate((x / scale, np.ones((len(x), 1))), 1)
    shape1, shape2 = (dim + 1, HIDDEN), (HIDDEN + 1, parts)
    cut = shape1[0] * shape1[1]

    def gradient(w: np.ndarray, step: int) -> np.ndarray:
        rows = rng.integers(0, len(x), 512)
        w1, w2 = w[:cut].reshape(shape1), w[cut:].reshape(shape2)
        a = inputs[rows]
        h = np.concatenate((np.maximum(0, a @ w1), np.ones((len(a), 1))), 1)
        z = h @ w2
        e = np.exp(z - z.max(1, keepdims=True))
        d = (e / e.sum(1, keepdims=True) - target[rows]) / len(rows)
        back = (d @ w2[:-1].T) * (h[:, :-1] > 0)
        return np.concatenate(((a.T @ back).ravel(), (h.T @ d).ravel()))

    w = np.concatenate([rng.normal(0, 1 / np.sqrt(s[0]), s).ravel() for s in (shape1, shape2)])
    w = fitting.adam(w, gradient, 700, 0.01)
    w1 = w[:cut].reshape(shape1)
    w1[:-1] /= scale
    index = Index(dim, w1, w[cut:].reshape(shape2), parts)
    order = np.argsort(-index.logits(x), 1, kind="stable")
    ask = rng.choice(len(x), min(len(x), 1000), replace=False)
    true = neighbour_graph(x, min(k, len(x) - 1))[ask]
    rank = np.argsort(order[ask], 1)  # of each part, for each query
    found = np.take_along_axis(rank, order[true, 0], 1)
    index.visits = int(next(v for v in range(1, parts + 1) if (found < v).mean() >= recall))
    return index


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one vector with rows, in double, summed in the order of components."""
    out = np.zeros(len(x))
    for d in range(len(q)):
        out += q[d] * x[:, d]
    return out


def nearest(q_id: np.ndarray, q: np.ndarray, visits: np.ndarray, x_id: np.ndarray, x: np.ndarray, x_part: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's k nearest ids in the parts that it visits, by the best of their rows: (ask, vec_id, score).

    visits: a row of truth values by part for each query.
    """
    order = np.argsort(x_id, kind="stable")
    x_id, x, x_part = x_id[order], x[order], x_part[order]
    first = np.flatnonzero(np.concatenate(([True], x_id[1:] != x_id[:-1])))
    ids, found, scores = [], [], []
    for at in range(0, len(q), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        s = q[some] @ x.T
        slack = 1e-9 * (np.abs(q[some]).max(1) * np.abs(x).max() * x.shape[1])
        s[~visits[some][:, x_part]] = -np.inf
        best = s if len(first) == len(x_id) else np.maximum.reduceat(s, first, 1)
        least = np.partition(best, -k, 1)[:, -k] - slack if best.shape[1] > k else np.full(len(s), -np.inf)
        for i in range(len(s)):
            near = np.flatnonzero((s[i] >= least[i]) & (s[i] > -np.inf))
            score = exact_scores(q[at + i], x[near])
            top = np.lexsort((x_id[near], -score))
            top = top[np.sort(np.unique(x_id[near][top], return_index=True)[1])[:k]]
            ids.append(np.full(len(top), q_id[at + i]))
            found.append(x_id[near][top])
            scores.append(score[top])
    return pd.DataFrame({"ask": np.concatenate(ids), "vec_id": np.concatenate(found), "score": np.concatenate(scores)})


def _usable(rows: DataFrame) -> DataFrame:
    """(id, vector array<double>) of the rows that take part, but for their dimension."""
    v = F.transform("embedding", lambda e: e.cast("double"))
    rows = rows.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("id"), v.alias("vector"))
    fine = F.forall("vector", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("vector", lambda e: e != 0)
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0)).where(fine)


def _dealt(rows: DataFrame, blocks: DataFrame, *key: str) -> DataFrame:
    """rows (node, ...) in their node's blocks: a column block below the node's number of them (node, blocks)."""
    return rows.join(common.small_or_shuffled(blocks), "node").withColumn("block", F.pmod(F.xxhash64(*key), F.col("blocks")).cast("int")).drop("blocks")


def _sent(rows: DataFrame, models: DataFrame, key: str, parts_of: Callable[[Index, np.ndarray, dict[int, int]], list[list[int]]]) -> DataFrame:
    """rows (node, key, vector) with the parts of their node that each goes to, stored.

    models: (node, model, held), stored. Blocks of a node's rows meet its model, so neither a node's rows
    nor all models come together in a task.
    """
    blocks = common.stored(rows.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    each = models.join(common.small_or_shuffled(blocks), "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def sent(x: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        index, held = pickle.loads(m["model"].iloc[0]), dict(m["held"].iloc[0] or [])
        parts = parts_of(index, np.stack(x["vector"]), held) if len(x) else []
        return pd.DataFrame({"node": x["node"], key: x[key], "vector": x["vector"], "parts": pd.Series(parts, x.index, object)})

    met = _dealt(rows, blocks, key, "vector").groupBy("node", "block").cogroup(each.groupBy("node", "block"))
    return common.stored(met.applyInPandas(sent, f"node long, {key} long, vector array<double>, parts array<int>"), "nodes")


def _level(placed: DataFrame, asks: DataFrame, k: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """Vectors (node, id, vector) with the part of their node, queries (node, ask, vector) with those they visit."""
    sizes = common.stored(placed.groupBy("node").agg(F.count("*").alias("n")), "sizes")
    share = F.pmod(F.xxhash64("id", "vector", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = placed.join(common.small_or_shuffled(sizes), "node").where(share < SAMPLE / F.col("n"))

    def model(rows: pd.DataFrame) -> pd.DataFrame:
        parts = int(min(FAN, rows["n"].iloc[0] // PART, len(rows) // LEAST))
        return pd.DataFrame({"node": rows["node"].iloc[:1], "model": [pickle.dumps(fit(np.stack(rows["vector"]), parts, k, recall))]})

    models = common.stored(sample.groupBy("node").applyInPandas(model, "node long, model binary"), "models")
    down = _sent(placed, models.withColumn("held", F.lit(None).cast("map<int,long>")), "id", lambda index, x, _: index.logits(x).argmax(1)[:, None].tolist())
    held = down.groupBy("node", F.col("parts")[0].alias("part")).agg(F.count_distinct("id").alias("n"))
    held = held.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("held"))

    def visited(index: Index, x: np.ndarray, held: dict[int, int]) -> list[list[int]]:
        out = []
        for order in np.argsort(-index.logits(x), 1, kind="stable").tolist():
            seen = 0
            out.append([])
            for i, part in enumerate(order):
                if i >= index.visits and seen > 4 * k:
                    break
                if part in held:
                    seen += held[part]
                    out[-1].append(part)
        return out

    return down, _sent(asks, common.stored(models.join(held, "node"), "models"), "ask", visited)


def _reranked(placed: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """(ask, vec_id, score): the k nearest of the vectors in the parts that a query visits.

    A node of the last level and the queries there are one group, or several where they are many, so
    that a query leaves k rows for a node and not for each part.
    """
    count = lambda rows, most, name: rows.groupBy("node").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    blocks = common.stored(count(placed, BLOCK, "blocks").join(count(asks, QUERY_BLOCK, "ask_blocks"), "node"), "blocks")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, *key: F.pmod(F.xxhash64(*key), F.col(n)).cast("int")
    base = placed.join(common.small_or_shuffled(blocks), "node").select("node", own("blocks", "id", "vector").alias("b"), copies("ask_blocks").alias("q"), "id", "vector", F.col("parts")[0].alias("part"))
    ask = asks.join(common.small_or_shuffled(blocks), "node").select("node", copies("blocks").alias("b"), own("ask_blocks", "ask").alias("q"), "ask", "vector", "parts")

    def score(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"ask": [], "vec_id": [], "score": []})
        visits = np.zeros((len(q), FAN), bool)
        for i, parts in enumerate(q["parts"]):
            visits[i, parts] = True
        return nearest(q["ask"].to_numpy(), np.stack(q["vector"]), visits, x["id"].to_numpy(), np.stack(x["vector"]), x["part"].to_numpy(), k)

    found = base.groupBy("node", "b", "q").cogroup(ask.groupBy("node", "b", "q")).applyInPandas(score, "ask long, vec_id long, score double")
    return _top(found, "ask", k)


def _top(found: DataFrame, by: str, k: int) -> DataFrame:
    """The k best of found (by, vec_id, score), each id once, with their rank."""
    best = found.repartition(by).groupBy(by, "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "vec_id")).alias("rank")
    return best.select(by, rank, "vec_id", "score").where(F.col("rank") <= k)


def levels(n: int) -> int:
    """Levels of nodes above the last parts."""
    return next(i for i in itertools.count(1) if PART * FAN**i >= n)


def search(rows: DataFrame, every: int = 20, k: int = 20, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of rows (vec_id, embedding) whose id is
    divisible by ``every``, among all rows but their own."""
    with common.scratch(rows.sparkSession) as kept:
        usable = _usable(common.pick(rows, "vec_id", "embedding"))
        dims = usable.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
        usable = usable.where(F.size("vector") == (dims[0] if dims else 0)).distinct().withColumn("hash", F.xxhash64("vector"))
        usable = common.stored(usable, "vectors")
        # A query takes k ids beside its own, so of equal vectors no more than the k + 1 smallest ids matter.
        place = F.row_number().over(Window.partitionBy("hash", "vector").orderBy("id"))
        placed = common.stored(usable.withColumn("place", place).where(F.col("place") <= k + 1).select(F.lit(0).cast("long").alias("node"), "id", "vector"), "nodes")
        queries = usable.where(F.col("id") % every == 0)
        asks = common.stored(common.with_row_id(queries.select("hash", "vector").distinct(), "ask"), "asks")
        own = common.stored(queries.join(asks, ["hash", "vector"]).select(F.col("id").alias("query_id"), "ask"), "own")
        asks = asks.select(F.lit(0).cast("long").alias("node"), "ask", "vector")
        n = levels(placed.count())
        for i in range(n):
            if i:
                placed = placed.select((F.col("node") * FAN + F.col("parts")[0]).alias("node"), "id", "vector")
                asks = asks.select("node", F.explode("parts").alias("part"), "ask", "vector").select((F.col("node") * FAN + F.col("part")).alias("node"), "ask", "vector")
            placed, asks = _level(placed, asks, k, recall ** (1 / n))
        near = common.stored(_reranked(placed, asks, k + 1).select("ask", "vec_id", "score"), "near")
        own, near = kept(own, "own"), kept(near, "near")
    return _top(own.join(near, "ask").where("vec_id != query_id").select("query_id", "vec_id", "score"), "query_id", k)
