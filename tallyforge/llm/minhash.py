"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts gives each document its set of 5-word shingles (64-bit hashes), a
   128-bit digest of that set, 8-bit lanes of its MinHash signature and its band keys.
2. Documents with equal sets form one node; all later work is on nodes.
3. Bands propose candidates. First every member of a bucket meets only the bucket's smallest
   node (linear in the bucket). In buckets that then still hold more than one component, pairs
   across components are compared in blocks: a first pass over the blocks finds the members with
   a surviving pair, a second gets their sets, decides exactly, and leaves the links of a
   spanning forest of each block. No group is gathered in one task, no list of pairs is made, and a
   pair is compared only in the first band that it shares.
4. A candidate's signatures are compared batch by batch; it is dropped as soon as the posterior
   probability of similarity >= threshold falls under ``miss``. Survivors are decided exactly
   on their full sets.
5. Links go to connected components (large star, small star).

Edge cases: null and empty texts, and texts of white space, have no shingles and link with
nothing. Rows with equal doc_id are separate documents that share an id. A null doc_id never
becomes a component's id unless all of the component's ids are null.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, hashing

WORDS = 5
THRESHOLD_PERCENT = 75
BANDS, ROWS = 40, 5
LANES = BANDS * ROWS
BATCH = 25
MISS = 1e-6
BLOCK = 256
#: Rows with texts or sets held at once by a Python worker.
BATCH_ROWS = 1000
_U = np.uint64
_PLACE = hashing.random(12, 8) | _U(1)
_COUNT = hashing.random(13, 8)
_LANE = hashing.random(15, LANES) | _U(1)


def _chunk_shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    _, word, _, bound = hashing.words(texts, hashing.WHITE)
    grams = np.zeros(max(0, len(word) - words + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            grams += word[k : k + len(grams)] * _PLACE[k]
        grams = hashing.mix(grams + _COUNT[words])
    out = []
    for lo, hi in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        if hi - lo >= words:
            s = np.sort(grams[lo : hi - words + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif hi > lo:
            with np.errstate(over="ignore"):
                out.append(hashing.mix((word[lo:hi] * _PLACE[: hi - lo]).sum(dtype=np.uint64, keepdims=True) + _COUNT[hi - lo]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``words`` make one shingle."""
    for part in hashing.chunks(texts):
        yield from _chunk_shingles(part, words)


def signature(grams: np.ndarray) -> tuple[bytes, np.ndarray]:
    """8-bit lanes of the MinHash signature, and the band keys (of the lanes) as signed longs."""
    low = np.full(LANES, _U(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for i in range(0, len(grams), 1024):
            np.minimum(low, (_LANE[:, None] * grams[None, i : i + 1024]).min(1), out=low)
    lanes = (hashing.mix(low) >> _U(56)).astype(np.uint8)
    keys = np.arange(BANDS, dtype=np.int64)
    for lane in lanes.reshape(BANDS, ROWS).T:
        keys = keys << 8 | lane
    return lanes.tobytes(), keys


@functools.lru_cache(8)
def least_matches(percent: int, miss: float) -> tuple[tuple[int, int], ...]:
    """(lanes compared, fewest matches to go on) after each batch.

    With a uniform prior, the posterior of the lane match rate is Beta(m + 1, n - m + 1), and
    P(rate >= t) = P(Binomial(n + 1, t) <= m). Lanes of 8 bits also match by chance.
    """
    t = percent / 100
    t += (1 - t) / 256
    out = []
    for n in range(BATCH, LANES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return tuple(out)


def survives(a: np.ndarray, b: np.ndarray, percent: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of rows of a and b (lanes as bytes) that pass every batch, and their matches."""
    left, hits, done = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for n, least in least_matches(percent, miss):
        hits = hits + (a[left, done:n] == b[left, done:n]).sum(1, dtype=np.int32)
        keep = hits >= least
        left, hits, done = left[keep], hits[keep], n
    return left, hits


def _lanes(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), LANES)


def features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(at, doc_id, n, digest, lanes, bands) of each row of docs (at, doc_id, text); the last three are null
    for an empty set."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            n, digest, lanes, bands = [], [], [], []
            for s in shingle_sets(f["text"].tolist(), words):
                n.append(len(s))
                if len(s):
                    a, b = signature(s)
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    lanes.append(a)
                    bands.append(b)
                else:
                    digest.append(None)
                    lanes.append(None)
                    bands.append(None)
            yield pd.DataFrame({"doc_id": f["doc_id"], "at": f["at"], "n": n, "digest": digest, "lanes": lanes, "bands": bands})

    return common.mapped(docs.select("doc_id", "at", "text"), run, "at string, n long, digest binary, lanes binary, bands array<bigint>")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(node, grams) of rows (node, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"node": f["node"], "grams": [s.tobytes() for s in shingle_sets(f["text"].tolist(), words)]})

    return rows.select("node", "text").mapInPandas(run, "node long, grams binary")


def _confirm(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """The links among stored candidate pairs (a, b): batches of signatures, then full sets."""

    def prune(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                keep, _ = survives(_lanes(f["la"]), _lanes(f["lb"]), percent, miss)
                yield f.iloc[keep][["a", "b"]]

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(f["ga"], f["gb"], strict=True)]
            yield f.loc[keep, ["a", "b"]]

    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("lanes").alias("la"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("lanes").alias("lb"))
    near = pairs.join(one, "a").join(two, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    near = common.stored(near.select("a", "b", "la", "lb").mapInPandas(prune, "a long, b long"), "near")
    full = near.join(sets.toDF("a", "ga"), "a").join(sets.toDF("b", "gb"), "b")
    with common.small_batches(pairs.sparkSession, BATCH_ROWS):
        return common.stored(full.select("a", "b", "ga", "gb").mapInPandas(exact, "a long, b long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (a, b) of longs; component is the smallest node.

    Alternates large stars and small stars until all that is left are stars: no node has two
    edges to smaller ones, and no centre has a smaller neighbour. Each round's edges are written to
    the shared folder.
    """
    both = edges.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    now = common.stored(both.distinct(), "stars")
    while True:
        ends = now.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("lo", F.lit(0), F.lit(1)))
        open_ = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0")
        if open_.isEmpty():
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        around = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        # The smallest ends are stored, so that Spark can split the edges of a hot centre in these joins.
        least = common.stored(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = around.where("v > u").join(common.small_or_shuffled(least), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = common.stored(large, "stars")
        low = common.stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        small = large.join(common.small_or_shuffled(low), "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = common.stored(small.union(low.select("hi", F.col("m").alias("lo"))).distinct(), "stars")


def _blocks(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt out to pairs of blocks (x, y).

    members: (key, node, component). A bucket's largest component is only compared with the
    other members.
    """
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top"))
    open_ = open_.where("parts > 1").select(
        "key", F.col("top.component").alias("major"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("nm"), F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("no"), (F.col("all") - F.col("top.n") == 1).alias("alone")
    )
    rows = members.join(common.small_or_shuffled(common.stored(open_, "open")), "key").withColumn("out", F.col("component") != F.col("major"))
    at = F.pmod(F.xxhash64("node"), F.when(F.col("out"), F.col("no")).otherwise(F.col("nm"))).cast("int")
    rows = rows.withColumn("at", at)
    none = F.array().cast("array<struct<x:int,y:int>>")
    over = lambda n, f: F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)).otherwise(none)
    pair = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    # Blocks of the major component are numbered -1, -2, ...; those of the others 0, 1, ...
    cells = F.when(
        F.col("out"),
        F.concat(F.when(F.col("alone"), none).otherwise(over("no", lambda j: pair(F.least(j, F.col("at")), F.greatest(j, F.col("at"))))), over("nm", lambda j: pair(-1 - j, F.col("at")))),
    ).otherwise(over("no", lambda j: pair(-1 - F.col("at"), j)))
    rows = rows.select("key", "node", "component", "out", F.explode(cells).alias("cell"))
    rows = rows.select("key", "node", "component", "out", "cell.x", "cell.y").join(nodes.select("node", "n", "lanes"), "node")
    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")


def _candidates(g: dict[str, np.ndarray], percent: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a block's members that survive, most matching lanes first."""
    if g["x"][0] < 0:
        i, j = (v.ravel() for v in np.meshgrid(np.flatnonzero(g["out"]), np.flatnonzero(~g["out"])))
    else:
        i, j = np.triu_indices(len(g["node"]), 1)
    n, comp, lanes = g["n"], g["component"], g["lanes"]
    ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
    i, j = i[ok], j[ok]
    keep, hits = survives(lanes[i], lanes[j], percent, miss)
    i, j = i[keep], j[keep]
    band = int(g["key"][0]) >> 8 * ROWS
    if band and len(i):
        same = (lanes[i, : band * ROWS] == lanes[j, : band * ROWS]).reshape(len(i), band, ROWS).all(2).any(1)
        i, j, hits = i[~same], j[~same], hits[~same]
    order = np.argsort(-hits, kind="stable")
    return i[order], j[order]


def _by_block(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[dict[str, np.ndarray], pd.DataFrame]]:
    """The blocks of sorted rows, whole ones, with at least two members."""
    rest = None

    def groups(f: pd.DataFrame, cut: np.ndarray) -> Iterator[tuple[dict[str, np.ndarray], pd.DataFrame]]:
        cols = {c: f[c].to_numpy() for c in ("key", "x", "y", "node", "component", "n", "out")} | {"lanes": _lanes(f["lanes"])}
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if e - s > 1:
                yield {k: v[s:e] for k, v in cols.items()}, f.iloc[s:e] if "grams" in f else f

    for f in frames:
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if len(f):
            k = f[["key", "x", "y"]].to_numpy()
            cut = np.concatenate(([0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1))
            yield from groups(f, cut)
            rest = f.iloc[cut[-1] :]
    if rest is not None:
        yield from groups(rest, np.array([0, len(rest)]))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _across(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links (a, b) that join different components of a bucket; members: (key, node, component)."""

    def survivors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, _ in _by_block(frames):
            i, j = _candidates(g, percent, miss)
            if len(i):
                some = np.unique(np.concatenate((i, j)))
                yield pd.DataFrame({c: g[c][some] for c in ("key", "x", "y", "node", "component", "n", "out")} | {"lanes": [v.tobytes() for v in g["lanes"][some]]})

    def forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, f in _by_block(frames):
            root = {c: c for c in g["component"].tolist()}

            def find(c: int, root: dict[int, int] = root) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            grams = [np.frombuffer(v, np.uint64) for v in f["grams"]]
            links = []
            for i, j in zip(*(v.tolist() for v in _candidates(g, percent, miss)), strict=True):
                a, b = find(int(g["component"][i])), find(int(g["component"][j]))
                if a != b and linked(grams[i], grams[j], percent):
                    root[a] = b
                    links.append((int(g["node"][i]), int(g["node"][j])))
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    kinds = "key long, x int, y int, node long, component long, n long, out boolean, lanes binary"
    blocks = _blocks(members, nodes).select("key", "x", "y", "node", "component", "n", "out", "lanes").mapInPandas(survivors, kinds)
    blocks = common.stored(blocks, "survivors").join(sets, "node")
    blocks = blocks.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "node")
    with common.small_batches(sets.sparkSession, BATCH_ROWS):
        return common.stored(blocks.mapInPandas(forest, "a long, b long").distinct(), "links")


def _classes(docs: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    """(row, at, doc_id, n, part) of every row of docs (at, doc_id, text), stored; rows of one part are linked."""
    spark = docs.sparkSession
    with common.scratch(spark) as kept_last:
        with common.scratch(spark) as kept:
            with common.small_batches(spark, BATCH_ROWS):
                rows = common.stored(common.with_row_id(features(docs, words), "row"), "features")
            reps = common.stored(rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("node")), "nodes")
            of = rows.select("row", "at", "doc_id", "n", "digest").join(reps, "digest", "left")
            of = kept(of.select("row", "at", "doc_id", "n", F.coalesce("node", "row").alias("node")), "of")
            nodes = rows.select(F.col("row").alias("node"), "at", "n", "digest", "lanes", "bands").join(reps.select("node"), "node", "left_semi")
            member = nodes.select("node", F.explode("bands").alias("key"))
            buckets = member.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).where("size > 1").select("key", "pivot")
            members = kept(member.join(common.stored(buckets, "buckets"), "key"), "members")
            busy = common.stored(members.select("node").distinct(), "busy")
            near = kept(nodes.join(busy, "node").select("node", "at", "n", "lanes"), "candidates")
        wanted = common.stored(near.select("at", "node"), "wanted")
        text = docs.select("at", "text").join(common.small_or_shuffled(wanted), "at")
        with common.small_batches(spark, BATCH_ROWS):
            sets = common.stored(_sets(text, words), "sets")

        pairs = common.stored(members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
        links = _confirm(pairs, near, sets, percent, miss)
        parts = components(links)
        labelled = members.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        parts = components(links.union(_across(labelled, near, sets, percent, miss)))
        of = of.join(common.small_or_shuffled(parts), "node", "left")
        return kept_last(of.select("row", "at", "doc_id", "n", F.coalesce("component", "node").alias("part")), "parts")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD_PERCENT, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text).

    Two documents link if 100 * shared >= percent * united shingles. component_id is the smallest
    doc_id reachable over links; kept marks the rows with that id.
    """
    of = _classes(common.identified(common.pick(docs, "doc_id", "text"), "at"), words, percent, miss)
    first = of.groupBy("part").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
    shared = common.stored(first.where("size > 1").select("part", "component_id"), "firsts")
    out = of.join(shared, "part", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD_PERCENT, miss: float = MISS) -> DataFrame:
    """The rows of docs without those that link, over others too, with a row that stays.

    Of linked rows one stays: the smallest doc_id, of those with that id the one read first. Rows that
    share an id but no link all stay.
    """
    if not docs.columns:
        return docs
    have = docs.columns
    rows = common.identified(docs.toDF(*[f"c{i}" for i in range(len(have))]), "at")
    with common.scratch(docs.sparkSession) as kept:
        of = _classes(rows.select("at", F.col(f"c{have.index('doc_id')}").alias("doc_id"), F.col(f"c{have.index('text')}").alias("text")), words, percent, miss)
        stays = of.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count("*").alias("size")).where("size > 1")
        stays = common.stored(stays.select("part", F.col("first.row").alias("stays")), "stays")
        gone = kept(of.join(common.small_or_shuffled(stays), "part").where("row != stays").select("at"), "gone")
    return rows.join(common.small_or_shuffled(gone), "at", "left_anti").drop("at").toDF(*have)
