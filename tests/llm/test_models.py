import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from .conftest import SF
from .test_duplicates import brute_components
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import ann, common, fitting, langid, mixing, queries, toxicity

MORE = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    got = queries.op10_language_id(spark, MORE).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97


def test_language_odd_rows(odd_docs, no_docs):
    model = langid.fitted(odd_docs)
    got = {r.n_chars: r for r in langid.predict(odd_docs.drop("score"), model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 9)] == ["und"] * 4 and got[3].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.predict(odd_docs.drop("score"), None).collect()} == {"und"}
    kept = langid.accepted(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 7
    assert langid.accepted(no_docs).count() == 0


def test_language_of_a_text_is_its_own(spark):
    """Order, neighbours and batches change neither features nor predictions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fitted(docs)
    texts = [(r.text or "").encode() for r in docs.collect()]
    texts += [t[:n] for t in texts[:60] for n in (0, 1, 2, 3, 12)]
    alone = [model.predict([t]) for t in texts]
    for some in (texts, texts[::-1]):
        lang, score = model.predict(some)
        pairs = list(zip(lang, score.tolist(), strict=True))
        assert (pairs if some is texts else pairs[::-1]) == [(a[0], b[0]) for a, b in alone]
    a, b = (list(langid._frequencies(t)) for t in (pd.DataFrame({"text": ["hola", "x"]}), pd.DataFrame({"text": ["hola"]})))
    assert (a[0] == b[0]).all()


def test_language_stage_rejects_by_prediction(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    said = {r.doc_id: r for r in queries.op10_language_id(spark, MORE).collect()}
    for least in (0.5, 0.99):
        kept = {r.doc_id for r in langid.accepted(docs, least).collect()}
        assert kept == {i for i, r in said.items() if r.lang_pred != "und" and r.score >= least}
    assert len(langid.accepted(docs).collect()) > 0.995 * len(said)


def test_language_stage_without_labels(spark, odd_docs):
    docs = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.fitted(docs) is None
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r.n_chars for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 10]


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    got = queries.op9_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    said = got["predicted"] == 1
    assert got["toxic"][said].mean() > 0.9 and said[got["toxic"] == 1].mean() > 0.6


def test_toxicity_locates_the_sentence(spark):
    bad = [(i, f"Fine words {i}. You are a scumbag here. More fine words.", 1) for i in range(60)]
    good = [(100 + i, f"Fine words {i}. You are a friend here. More fine words.", 0) for i in range(200)]
    docs = spark.createDataFrame(bad + good, "doc_id long, text string, toxic int")
    model = toxicity.fitted(docs, docs)
    for r in toxicity.score(docs, model).collect():
        text = dict((d, t) for d, t, _ in bad + good)[r.doc_id]
        assert (r.score >= 0.5) == (r.doc_id < 100)
        assert r.doc_id >= 100 or "scumbag" in text[r.sentence_start : r.sentence_end]


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.score(odd_docs, toxicity.fitted(odd_docs, labels)).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(no_docs, None).count() == 0
    assert toxicity.fitted(odd_docs, labels.where("false")) is None


def test_neighbours_go_through_parts():
    """The index of the test below has several parts, of which a query visits some."""
    rows = pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = ann.fit(np.stack(rows["embedding"]).astype(float), len(rows) // ann.PART, 20)
    assert ann.levels(len(rows)) == 1 and index.w2.shape[1] == 8 and 1 < index.visits < 8


@pytest.mark.parametrize(("part", "fan"), [(ann.PART, ann.FAN), (100, 4)])
def test_neighbours_recall(spark, monkeypatch, part, fan):
    """Recall through the routing, on one level of nodes and on three."""
    monkeypatch.setattr(ann, "PART", part)
    monkeypatch.setattr(ann, "FAN", fan)
    assert ann.levels(2000) == (1 if part == ann.PART and fan == 16 else 3)
    d = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").toPandas()
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    got = queries.op3_nearest_neighbours(spark, d).toPandas()
    hits = 0
    for i in ids[ids % 20 == 0]:
        s = x @ x[ids == i][0]
        s[ids == i] = -np.inf
        own = got[got["query_id"] == i].sort_values("rank")
        assert len(own) == 20 and (np.diff(own["score"]) <= 0).all()
        assert np.allclose(own["score"], s[own["vec_id"]])
        hits += len(set(own["vec_id"]) & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert hits / 20 / (ids % 20 == 0).sum() >= 0.9


def test_neighbours_odd_rows(spark):
    v = [1.0, 2.0]
    rows = [(0, v), (20, v), (3, v), (1, v), (2, [2.0, 4.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0]), (None, v), (40, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, part int, VEC_ID int")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 10.0), (0, 2, 1, 5.0), (0, 3, 3, 5.0), (0, 4, 20, 5.0), (20, 1, 2, 10.0), (20, 2, 0, 5.0), (20, 3, 1, 5.0), (20, 4, 3, 5.0)]
    assert ann.search(df.where("false")).count() == 0


def test_neighbours_repeated_ids(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0])] * 2
    rows += [(1, [50.0, 0.0])] * 30 + [(2, [40.0 - i, 0.0]) for i in range(30)]
    rows += [(100 * i + 3, [1.0, float(i)]) for i in range(1, 31)]
    got = [(r.rank, r.vec_id, r.score) for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("query_id = 20").orderBy("rank").collect()]
    best = {}
    for i, v in rows:
        best[i] = max(best.get(i, -np.inf), *v)
    del best[20]
    assert got == [(n + 1, i, s) for n, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20])]


def test_neighbours_in_clusters(spark, monkeypatch):
    """Where vectors have structure, few parts are visited: three levels of nodes, clusters of 25, hot vectors."""
    monkeypatch.setattr(ann, "PART", 50)
    monkeypatch.setattr(ann, "FAN", 4)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(80, 16))
    x = np.repeat(centre / np.linalg.norm(centre, axis=1)[:, None], 25, 0) + rng.normal(0, 0.02, (2000, 16))
    x = np.concatenate((x, np.repeat(x[:1], 1000, 0)))
    made = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(made).toPandas()
    hits = 0
    for i in range(0, 3000, 20):
        s = np.round(np.array([ann.exact_scores(x[i], x[j : j + 1])[0] for j in range(len(x))]), 12)
        s[i] = -np.inf
        own = got[got["query_id"] == i].sort_values("rank")["vec_id"].tolist()
        assert len(own) == 20
        hits += len(set(own) & set(np.lexsort((np.arange(3000), -s))[:20].tolist()))
    assert hits / 20 / 150 >= 0.9
    assert ann.fit(x[:2000], 8, 20).visits <= 3


def test_balanced_parts():
    x = np.random.default_rng(0).normal(size=(600, 8))
    part = ann.balanced_parts(x, ann.neighbour_graph(x, 10), 6)
    assert np.bincount(part).max() <= 110


def same(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    return sorted(map(tuple, got.select(columns).collect())), sorted(con.sql(f"select {', '.join(columns)} from ({queries.ORACLE_SQL[name]})").fetchall())


def test_mixing_matches_sql(spark, con):
    got, want = same(spark, con, "op6_temperature_mixing")
    assert got == want


def skewed(spark):
    rows = [(i, "abcd" * (50 + i % 7), "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixing_reaches_the_entropy(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 1000)
    docs = skewed(spark)
    got = mixing.mix(docs, entropy=0.98).groupBy("source").agg(F.sum("tokens").alias("n")).toPandas()["n"]
    p = got / got.sum()
    assert abs(-(p * np.log(p)).sum() / np.log(len(p)) - 0.98) < 0.005
    total = docs.agg(F.sum(mixing.tokens_of(F.col("text")))).first()[0]
    assert total - 60 * len(p) <= got.sum() <= total + len(p)


def test_mixing_repeats_within_the_limit(spark):
    docs = skewed(spark)
    size = {r[0]: r[1] for r in docs.groupBy("source").agg(F.sum(mixing.tokens_of(F.col("text")))).collect()}
    got = {r[0]: r[1] for r in mixing.mix(docs, entropy=None, repeats=1.5).groupBy("source").agg(F.sum("tokens")).collect()}
    assert max(got[s] / size[s] for s in size) <= 1.5 + 1e-6 and max(got[s] / size[s] for s in size) > 1.4


def test_mixing_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert {r.source for r in got} <= {"", "a", "b"} and {1, 2} <= {r.doc_id for r in got}
    kept = mixing.mixed(odd_docs, most=1)
    assert kept.columns == odd_docs.columns and 0 < kept.count() <= 11
    assert mixing.mix(no_docs).count() == mixing.mixed(no_docs).count() == 0


@pytest.mark.parametrize(("block", "fold", "chunk"), [(1000, 4096, 4096), (1000, 3, 2), (1 << 18, 7, 4096)])
def test_mixing_passes_over_long_documents(spark, monkeypatch, block, fold, chunk):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", block)
    monkeypatch.setattr(mixing, "FOLD", fold)
    monkeypatch.setattr(mixing, "CHUNK_BLOCKS", chunk)
    rows = [(i, "abcd" * (20 + i % 9 if i % 50 else 0), "small") for i in range(200)] + [(900 + i, "abcd" * 3000, "small") for i in range(3)]
    rows += [(1000 + i, "abcd" * 100, "large") for i in range(100)]
    docs = spark.createDataFrame([*rows, (5, "abcd" * 24, "small")], "doc_id long, text string, source string")
    budget = 9000
    rows = [(r.doc_id, len(r.text) // 4, r.source) for r in docs.collect()]
    got = sorted((r.doc_id, r.tokens) for r in mixing.mix(docs, entropy=0.0, budget=budget).collect())
    want, total = [], sum(t for _, t, _ in rows)
    for source in ("small", "large"):
        own = [r for r in rows if r[2] == source]
        left = int(sum(t for _, t, _ in own) / total * budget + 0.5)
        for d, t, _ in sorted(own, key=lambda r: (hashlib.md5(f"mix|0|{r[0]}".encode()).hexdigest()[:12], r[0], r[1])):
            if t <= left:
                left -= t
                want.append((d, t))
        assert left < 30 or source == "large" and left < 100
    assert got == sorted(want)


def test_mixture_stage_keeps_every_document(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 1000)
    docs = skewed(spark).union(spark.createDataFrame([(9000, "abcd" * 50, "lone"), (9001, "", "lone"), (9002, None, "empty")], "doc_id long, text string, source string"))
    size, n = {}, {}
    for r in docs.collect():
        size[r.doc_id], source = (len(r.text or "") + 3) // 4, r.source
        n[source] = n.get(source, 0) + size[r.doc_id]
    total = sum(n.values())
    shares = {s: v / total for s, v in n.items() if v}
    low, high = 0.0, 1.0
    for _ in range(60):  # the largest exponent that reaches the entropy
        a = (low + high) / 2
        z = sum(p**a for p in shares.values())
        low, high = (a, high) if -sum(p**a / z * np.log(p**a / z) for p in shares.values()) >= mixing.ENTROPY * np.log(len(shares)) else (low, a)
    # No document more than MOST times: the lone one would come more often by the entropy.
    even = 1 - np.log(mixing.MOST) / np.log(max(shares.values()) / min(shares.values()))
    assert even > low
    low = even
    spend = max(n[s] / p**low for s, p in shares.items())
    got = corpus_pipeline.mixture(spark, docs, SF)
    assert got.columns == docs.columns and got.exceptAll(docs).join(docs, "doc_id", "left_anti").count() == 0
    times = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    for r in docs.collect():
        want = spend * shares[r.source] ** low / n[r.source] if n[r.source] else 1
        assert int(want + 1e-3) <= times[r.doc_id] <= int(want + 1e-3) + 1
    assert max(times.values()) == mixing.MOST and times[9000] == mixing.MOST and {times[r.doc_id] for r in docs.where("source = 'hot' or source = 'empty'").collect()} == {1}
    used = {r[0]: r[1] for r in got.groupBy("source").agg(F.sum(mixing.tokens_of(F.col("text")))).collect()}
    for s, p in shares.items():
        assert spend * p**low - 60 * 4 - 1 < used[s] <= spend * p**low + 1


def test_mixture_stage_limits_repeats(spark):
    """One document beside 20000 of another source comes MOST times, and not as often as the entropy asks."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("abcd" * 20).alias("text"), F.when(F.col("id") < 1, "b").otherwise("a").alias("source"))
    got = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert len(got) == 20_000 and got.pop(0) == mixing.MOST and set(got.values()) == {1}


def test_many_labels(spark):
    """Of 2000 labels the most frequent are learned, and all texts get one of them."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("word"), F.md5(F.col("id").cast("string"))).alias("text"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("x"), F.col("id") % 20)).otherwise(F.concat(F.lit("l"), F.col("id") % 2000)).alias("lang"))
    model = langid.fitted(rows)
    assert len(model.families) == langid.LANGS and {f"x{i}" for i in range(20)} <= set(model.families)
    assert langid.predict(rows, model).where(F.col("lang_pred").isin(model.families)).count() == 6000


def test_toxic_pairs_of_words(spark):
    """A phrase whose words are harmless alone is found."""
    harmless = [f"w{i} red w{i % 50} apples w{i % 7} rotten fruit w{i % 31}" for i in range(600)]
    rows = [(i, t if i % 6 else t + ". You rotten apples here", int(i % 6 == 0)) for i, t in enumerate(harmless)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.score(docs, toxicity.fitted(docs, docs)).join(docs, "doc_id").toPandas()
    assert got["score"][got["toxic"] == 1].min() > 0.5 > got["score"][got["toxic"] == 0].max()


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_SLOTS", 3000)
    docs = spark.createDataFrame([(i, f"w{i} idiot" if i % 2 else f"w{i} nice word", i % 2) for i in range(3000)], "doc_id long, text string, toxic int")
    seen = []
    real = toxicity.trained
    monkeypatch.setattr(toxicity, "trained", lambda toxic, *a: seen.append(len(toxic)) or real(toxic, *a))
    assert toxicity.fitted(docs, docs) is not None and 300 < seen[0] < 1000


def test_fitting_sample_is_bounded(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 == 0).cast("int").alias("y"))
    got, counts = fitting.thinned(rows, "y", "doc_id", 100)
    assert counts == {0: 4900, 1: 100} and got.where("y = 1").count() == 100 and 50 < got.where("y = 0").count() < 160


def test_toxicity_of_a_text_is_its_own(spark):
    docs = [(i, t) for i, t in enumerate(["You idiot. Fine", "", None, "fine words", "idiot", "x" * 50_000 + " idiot", "fine! You idiot"])]
    weights = np.zeros(toxicity.SLOTS, np.float32)
    weights[toxicity.bags([b"idiot"])[0]] = 3.0
    score = lambda rows: {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), (weights, -4.0)).collect()}
    together = score(docs)
    assert together == score(docs[::-1]) and together[1] == together[2] == 0
    assert all(together[d] == score([(d, t)])[d] for d, t in docs)
    assert together[0] > 0.8 > together[3]


def stages(spark, docs):
    """The rows that each stage of the pipeline returns, written and read again in between."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def test_pipeline_matches_brute_force(spark):
    """Every stage by its predecessor's rows; run() gives the last stage's."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = stages(spark, docs)
    rows = {n: [tuple(r) for r in d.collect()] for n, d in got.items()}
    assert all(d.columns == docs.columns for n, d in got.items() if n != "packing")
    said = {r.doc_id: r for r in queries.op10_language_id(spark, SF).collect()}
    want = [tuple(r) for r in docs.collect() if said[r.doc_id].lang_pred != "und" and said[r.doc_id].score >= langid.SURE]
    assert sorted(rows["language_id"]) == sorted(want) and len(want) > 190
    first = {}
    for r in sorted(want):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r)
    want = sorted(first.values())
    assert sorted(rows["exact_dedup"]) == want
    near = brute_components([r[:2] for r in want])
    want = [r for r in want if near[r[0]][1] == r[0]]
    assert sorted(rows["near_dedup"]) == want
    # How often a document comes is the matter of test_mixture_stage_keeps_every_document.
    assert sorted(set(rows["mixture"])) == want
    times = Counter(r[0] for r in rows["mixture"])
    pieces = Counter()
    for doc_id, _, length, _, tokens, _, _ in rows["packing"]:
        pieces[doc_id] += length / tokens
    assert pieces == {d: pytest.approx(n) for d, n in times.items()}
    assert sum(r.length for r in corpus_pipeline.run(spark, SF).collect()) == sum(r[2] for r in rows["packing"])


def test_pipeline_odd_rows(spark, odd_docs):
    plain = odd_docs.toDF(*[f"c{i}" for i in range(8)]).select("c0", "c1", "c2", "c3", "c4", "c6", "c7")
    docs = common.stored(plain.toDF("doc_id", "text", "lang", "source", "n_chars", "score", "row"), "odd")
    got = {n: d.collect() for n, d in stages(spark, docs).items()}
    assert sorted(r.n_chars for r in got["language_id"]) == [3, 4, 5, 6, 7, 8, 10]
    assert sorted(r.n_chars for r in got["exact_dedup"]) in ([3, 5, 7, 10], [3, 5, 8, 10])
    assert len(got["near_dedup"]) == 4 and {r.doc_id for r in got["mixture"]} == {r.doc_id for r in got["packing"]} == {4, 6, 8, None}
    assert stages(spark, docs.where("false"))["packing"].count() == 0
