"""WARC archives, ranked lexical search, hard negatives: SQL, brute force, odd rows."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from .conftest import SF
from tallyforge.llm import common, lexical, negatives, queries, warc

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_warc_index", "op12_bag_search", "op13_bond_negatives"])
def test_matches_sql(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(f"select {', '.join(columns)} from ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want, key=repr)


# --- archives ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd_pages(spark):
    """Nulls, empty and long payloads, payloads like records, equal ones, repeated rows and ids."""
    trap = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [
        (1, "http://a/ b\r\nX: y", "<p>é € 😀</p>"),
        (2, None, None),
        (3, "http://c", ""),
        (4, "http://d", trap),
        (5, "http://e", trap),
        (5, "http://e", trap),
        (6, "http://f", "x" * 700_000 + "\r\n\r\n"),
        (7, "http://g", "x" * 700_000 + "\r\n\r\n"),
        (None, "http://h", "<p>é € 😀</p>"),
        (None, "http://i", "no id"),
        (8, "", "\r\n\r\n\r\n"),
    ]
    return spark.createDataFrame([(*r, "page", i) for i, r in enumerate(rows)], "page_id long, url string, html string, URL string, offset int")


def test_archives_odd_rows(odd_pages):
    got = sorted(map(tuple, warc.round_trip(odd_pages).collect()), key=repr)
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    groups = defaultdict(list)
    for r in odd_pages.collect():
        groups[r.html or ""].append(r.page_id)
    want = []
    for text, ids in groups.items():
        first = max((i for i in ids if i is not None), default=None)
        ids.remove(first)
        want.append((first, len(text.encode()), digest(text), "response", None))
        want += [(i, len(text.encode()), digest(text), "revisit", first) for i in ids]
    assert got == sorted(want, key=repr)


def test_archives_empty(odd_pages):
    assert warc.round_trip(odd_pages.where("false")).count() == 0


def test_index_reads_selected_records(spark, odd_pages, tmp_path):
    """Any selection by the index gives those payloads; the bytes at an entry are that record."""
    path = f"file://{tmp_path}/pages"
    warc.write(odd_pages.repartition(2), path, "2020-01-01T00:00:00Z")
    found = common.stored(warc.index(spark, path), "index")
    assert found.count() == odd_pages.count()
    some = found.where("kind = 'response' and page_id in (1, 5, 8)")
    got = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warc.read(some).collect()}
    assert got[1] == ("http://a/%20b%0D%0AX:%20y", "<p>é € 😀</p>") and got[8] == ("", "\r\n\r\n\r\n") or got[8][0] in (None, "")
    assert got[5][1].startswith("WARC/1.1") and len(got) == 3
    for r in found.collect():
        with open(re.sub("^file:/+", "/", r.archive), "rb") as f:
            data = f.read()
        record = data[r.offset : r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and r.record.encode() in record and data[r.offset + r.length :][:4] == b"\r\n\r\n"
    assert {r.kind for r in found.collect()} == {"response", "revisit"}


def test_ranges_join_close_records():
    import pandas as pd

    far = warc.GAP + 11
    rows = pd.DataFrame({"archive": ["a", "a", "a", "b"], "offset": [0, 10, 20 + far, 0], "length": [10, 10, warc.RANGE + 1, 5]})
    assert list(warc.ranges(rows)) == [("a", 0, 20, [0, 1]), ("a", 20 + far, 20 + far + warc.RANGE + 1, [2]), ("b", 0, 5, [3])]


def test_archives_broken(spark, odd_pages, tmp_path):
    """A payload that differs from its digest is an error, not a row."""
    rows = odd_pages.sparkSession.createDataFrame([(1, "response", "r", None, "A", 3, "B")], "page_id long, kind string, record string, refers string, digest string, payload_bytes long, payload_digest string")
    with pytest.raises(Exception, match="wrong payload"):
        warc.resolved(rows).collect()


# --- search --------------------------------------------------------------------------------------


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, k=10):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, length = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for i, own in asked.items():
        found = []
        for d, bag, size in bags:
            m = 10 + (90 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in own if t in bag)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_search(spark):
    word = ["alpha", "Beta", "ÉTÉ", "été", "x1", "日本", "gamma", "delta"]
    docs = [(i, " ".join(word[j % 8] for j in range(i % 5, i % 5 + i % 7))) for i in range(40)]
    docs += [(100 + i, "alpha beta, beta!") for i in range(30)] + [(100, "alpha beta, beta!")] * 3
    docs += [(None, "alpha ETE"), (None, None), (50, None), (51, ""), (52, "..."), (53, "alpha " * 60_000 + "gamma")]
    items = [(1, "Alpha beta ALPHA"), (2, None), (3, "..."), (4, "ÉTÉ été 日本"), (4, "x1"), (None, "delta"), (5, "unknown"), (6, "alpha gamma delta x1 beta")]
    extra = "TEXT string, terms int, n long"
    return (
        spark.createDataFrame([(*d, "t", 1, 2) for d in docs], f"doc_id long, text string, {extra}"),
        spark.createDataFrame([(*i, "t", 1, 2) for i in items], f"item_id long, text string, {extra}"),
        docs,
        items,
    )


def test_search_odd_rows(odd_search):
    docs, items, plain, asked = odd_search
    assert sorted(map(tuple, lexical.search(docs, items).collect()), key=repr) == brute_search(plain, asked)


def test_search_in_blocks(odd_search, monkeypatch):
    """More queries than one block holds, and matrices of few rows."""
    docs, items, plain, asked = odd_search
    monkeypatch.setattr(lexical, "PAIRS", 5)
    monkeypatch.setattr(lexical, "CELLS", 7)
    monkeypatch.setattr(lexical, "AT_ONCE", 2)
    assert sorted(map(tuple, lexical.search(docs, items, 3).collect()), key=repr) == brute_search(plain, asked, 3)


def test_search_empty(odd_search):
    docs, items, *_ = odd_search
    assert lexical.search(docs.where("false"), items).count() == lexical.search(docs, items.where("false")).count() == 0


def test_classes_hold_equal_bags_once(spark):
    rows = spark.createDataFrame([(i, 10, [1, 2], [1, 1 + i % 2]) for i in range(100)], "doc_id long, m long, terms array<int>, counts array<int>")
    got = sorted(lexical.classes(rows, 10).collect(), key=lambda r: r.ids)
    assert [r.ids for r in got] == [list(range(0, 20, 2)), list(range(1, 20, 2))]


# --- hard negatives ------------------------------------------------------------------------------


def brute_negatives(rows, every=100):
    """rows: (id, label, whole numbers)."""
    out = []
    x = np.array([v for *_, v in rows], np.int64).reshape(len(rows), -1)
    for a, (i, label, v) in enumerate(rows):
        if i % every:
            continue
        score = x @ np.array(v, np.int64)
        order = sorted((r for r in range(len(rows)) if r != a), key=lambda r: (-score[r], rows[r][0]))
        near = [r for r in order if rows[r][1] == label][:5]
        for p in near:
            inside = [r for r in order if rows[r][1] != label and 30 * score[p] <= 100 * score[r] <= 90 * score[p]]
            out += [(i, rows[p][0], k + 1, rows[r][0], int(score[p]), int(score[r])) for k, r in enumerate(inside[:10])]
    return sorted(out)


def test_negatives_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 4), rng.normal(0, 1, 6).round(2).tolist()) for i in range(400)]
    rows += [(200, 0, rows[200][2]), (400, 1, [0.5] * 6), (400, 2, [0.5] * 6), (500, 1, [0.0] * 6), (600, 9, [1.0] * 6), (-100, 1, [-1.0] * 6)]
    rows += [(700 + i, 2, [0.25] * 6) for i in range(30)]
    bad = [(800, None, [1.0] * 6), (900, 1, None), (1000, 1, [1.0] * 5 + [None]), (1100, 1, [1.0] * 5 + [math.nan]), (1200, 1, [math.inf] * 6), (1300, 1, [1.0] * 3), (1400, 1, []), (None, 1, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, k, 0, "v") for i, k, v in rows + bad], "vec_id long, embedding array<double>, label int, row long, VEC_ID string")
    got = sorted(map(tuple, negatives.mine(negatives.usable(df)).collect()))
    assert got == brute_negatives([(i, k, [math.floor(256 * x) for x in v]) for i, k, v in rows])
    assert negatives.mine(negatives.usable(df.where("false"))).count() == 0


def test_negatives_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 50)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 3), rng.integers(-9, 9, 20).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>")
    assert sorted(map(tuple, negatives.mine(df, every=25).collect())) == brute_negatives(rows, 25)


def test_bounds_shrink_the_candidates():
    """On vectors whose first dimensions tell, most rows are left before the last columns are read."""
    rng = np.random.default_rng(5)
    x = (rng.normal(0, 1, (2000, 64)) * np.linspace(60, 1, 64)).astype(np.int64)
    block = negatives.Block(np.arange(2000), np.arange(2000), np.zeros(2000, int), list(x))
    left = []

    def counted(total, least, most):
        edge = negatives.largest(total, 5)
        keep = total + most >= edge + least
        left.append(int(keep.sum()))
        return keep

    at, score = block.scan(x[0], np.arange(2000) > 0, counted)
    best = np.argsort(-(x[1:] @ x[0]), kind="stable")[:5] + 1
    assert set(best) <= set(at) and left[4] < 400
