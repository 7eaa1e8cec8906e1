import re
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from .conftest import LONG, SF

from tallyforge.llm import common, minhash, queries, radix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_radix_matches_sql(spark, con):
    got = sorted(map(tuple, queries.op7_exact_dedup(spark, SF).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    want = sorted(con.sql(queries.ORACLE_SQL["op7_exact_dedup"]).fetchall())
    assert got == want


def test_radix_odd_rows(odd_docs, no_docs):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in radix.exact_duplicates(odd_docs).collect()}
    assert {(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (4, 4, 2, True), (5, 4, 2, False), (6, 6, 2, True), (7, 6, 2, False), (None, None, 1, True)} <= got
    assert sum(r.doc_id == 8 and r.kept for r in radix.exact_duplicates(odd_docs).collect()) == 1
    kept = radix.without_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 7
    assert radix.exact_duplicates(no_docs).count() == radix.without_duplicates(no_docs).count() == 0


def test_radix_splits_at_every_level(spark):
    """Texts that differ only at, before or after the end of a digit, or by their end."""
    rows, i = [], 0
    for n in (0, 1, 63, 64, 65, 575, 576, 577, 5000):
        for tail in ("", "a", "b"):
            rows += [(i, "x" * n + tail), (i + 1, "x" * n + tail)]
            i += 2
    got = radix.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    first = {}
    for d, t in rows:
        first.setdefault(t, d)
    assert {(r.doc_id, r.keep_id) for r in got} == {(d, first[t]) for d, t in rows}


def test_minhash_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_minhash_near_dedup(spark, SF).collect()}
    assert got == brute_components(docs)


def test_minhash_chain_in_a_large_bucket(spark, monkeypatch):
    """A group of edited copies, of which many only link to others than the smallest, over several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(90):
        words = list(base)
        for k in rng.choice(120, rng.integers(0, 6), replace=False):
            words[k] = f"e{i}_{k}"
        docs.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_components(docs)


def test_minhash_odd_rows(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert (by[1].n_shingles, by[1].component_id, by[3].n_shingles, by[4].n_shingles) == (0, 1, 0, 1)
    assert (by[5].component_id, by[7].component_id, by[7].kept, by[None].component_id) == (4, 6, False, None)
    assert by[6].n_shingles == len(shingles(LONG))
    assert minhash.near_duplicates(no_docs).count() == 0


def test_minhash_stage_drops_by_row(spark, odd_docs, no_docs):
    """A repeated doc_id of which one row is a near copy keeps its other row."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (5, base + " extra"), (5, "a text of its own that nobody else has"), (None, base + " other"), (7, None), (7, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, TEXT string")
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted([rows[0], rows[2], rows[4], rows[5]], key=repr)
    kept = minhash.without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 8
    assert minhash.without_near_duplicates(no_docs).count() == 0


def test_scratch_leaves_what_is_kept(spark):
    with common.scratch(spark) as kept:
        with common.scratch(spark) as inner:
            a, b = common.stored(spark.range(3), "a"), inner(spark.range(4), "b")
        c = kept(spark.range(5), "c")
        assert b.count() == 4 and not Path(a.inputFiles()[0].removeprefix("file://")).exists()
    assert c.count() == 5 and not Path(b.inputFiles()[0].removeprefix("file://")).exists()


def test_least_matches_keeps_similar_pairs():
    for n, least in minhash.least_matches(75, 1e-6):
        assert 0 <= least < 0.76 * n


@pytest.mark.parametrize(("edges", "want"), [([], {}), ([(1, 2), (3, 2), (3, 9), (7, 8), (8, 8)], {2: 1, 3: 1, 9: 1, 8: 7})])
def test_components(spark, edges, want):
    got = minhash.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect() if r.node != r.component} == want


@pytest.mark.parametrize("stage", [radix.without_duplicates, minhash.without_near_duplicates])
def test_repeated_rows_of_a_file_are_rows(spark, tmp_path, stage):
    """explode and union give rows of one place in a file; none of the unique ones is lost."""
    spark.range(3).selectExpr("id as doc_id").write.parquet(str(tmp_path / "rows"))
    read = spark.read.parquet(str(tmp_path / "rows"))
    texts = F.array(*[F.concat(F.lit(t), F.col("doc_id").cast("string")) for t in ("same words here again and ", "one ", "two ", "same words here again and ")])
    for docs, n in ((read.select("doc_id", F.explode(texts).alias("text")), 9), (read.select("doc_id", F.lit("x").alias("text")).union(read.select("doc_id", F.lit("y").alias("text"))), 2)):
        got = stage(docs)
        assert got.select("text").distinct().count() == docs.select("text").distinct().count() and got.count() == n
        assert not common._of_files(docs)
    assert common._of_files(read.where("doc_id > 0").select("doc_id"))
    assert not common._of_files(read.where(F.rand() > 0.5))


def test_two_calls_at_once(spark):
    """Each thread has its own scratch tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(r.doc_id for r in minhash.without_near_duplicates(docs).collect())
    with ThreadPoolExecutor(3) as pool:
        runs = [pool.submit(lambda: sorted(r.doc_id for r in minhash.without_near_duplicates(docs).collect())) for _ in range(3)]
        assert [r.result() for r in runs] == [want] * 3
