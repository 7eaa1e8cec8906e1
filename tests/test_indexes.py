"""Indexes, rewriting, keyed noise, files by the thousand: brute force, laws and failures."""

import difflib
import hashlib
import hmac
import json
import math
import random
import threading
from pathlib import Path

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyforge import storage
from tallyforge.functions import noise, similarity
from tallyforge.functions.similarity import lcs_length
from tallyforge.operators import contingency, dedup, enrich, flatten, grid, matching, reports, reshape, validate
from tallyforge.plans import jobs
from tallyforge.queries import ORACLE_SQL, QUERIES
from tallyforge.sources import each, files

BOX = "section string, field string, x1 double, y1 double, x2 double, y2 double"


# --- points in rectangles -------------------------------------------------------------------------


def _boxes(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
        w, h = (10 ** rng.uniform(-4, 2) for _ in "wh")
        out.append(("s", f"f{i}", x, y, x + w, y + h))
    return out


def test_tiles_find_what_all_pairs_find(spark):
    rng = random.Random(1)
    boxes = _boxes(150, 2) + [("s", "point", 1.0, 1.0, 1.0, 1.0), ("s", "all", -math.inf, -math.inf, math.inf, math.inf), ("s", "line", -1e9, 1.0, 1e9, 1.0)]
    boxes += [("s", "reversed", 5.0, 0.0, 1.0, 9.0), ("s", "none", None, 0.0, 1.0, 9.0), ("s", "nan", math.nan, 0.0, 1.0, 9.0)]
    points = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(300)]
    points += [(1000 + i, b[2], b[5]) for i, b in enumerate(boxes[:153])]  # corners
    points += [(2000, 1.0, 1.0), (2001, None, 1.0), (2002, math.nan, 1.0), (2000, 1.0, 1.0)]
    got = grid.in_rectangles(spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(boxes, BOX))
    assert got.columns == ["id", "x", "y", "section", "field"]
    inside = lambda p, b: None not in (*p[1:], *b[2:]) and b[2] <= p[1] <= b[4] and b[3] <= p[2] <= b[5]
    want = sorted((p[0], b[1]) for p in points for b in boxes if inside(p, b))
    assert sorted((r.id, r.field) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tiles_of_an_empty_layout(spark):
    words = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    assert grid.in_rectangles(words, spark.createDataFrame([], BOX)).count() == 0
    assert grid.in_rectangles(words.where("false"), spark.createDataFrame(_boxes(3, 3), BOX)).count() == 0


def test_a_rectangle_lies_in_few_tiles(spark):
    boxes = spark.createDataFrame(_boxes(400, 4), BOX)
    for d in "xy":
        level = grid._level(F.col(f"{d}2") - F.col(f"{d}1"))
        most = boxes.select((grid._tile(F.col(f"{d}2"), level) - grid._tile(F.col(f"{d}1"), level)).alias("n")).agg(F.max("n")).first()[0]
        assert most <= 2


# --- fuzzy matching -------------------------------------------------------------------------------


def _ratio(a, b):
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


@pytest.mark.parametrize("accept", [50.0, 67.0, 80.0, 93.0])
def test_index_finds_what_all_pairs_find(spark, accept):
    rng = random.Random(5)
    refs = {"".join(rng.choice("ABC ") for _ in range(rng.randint(0, 9))) for _ in range(60)} | {"BOSTON", "BOSTON MA", "AAAAAAAA", "日本国民"}
    names = {"BOSTN", "", "A", "AAAAAAA", "日本国", "B" * 60}
    for r in sorted(refs):
        cut = rng.randrange(len(r) + 1)
        names |= {r[:cut] + rng.choice("ABCX") + r[cut:], r[:cut] + r[cut + 1 :], r[:cut] + "Q" + r[cut + 1 :]}
    got = matching.best_matches(spark.createDataFrame([(n,) for n in [*names, None, "BOSTN"]], "name string"), spark.createDataFrame([(r,) for r in [*refs, None]], "ref string"), accept)
    want = {}
    for n in names:
        score, match = min((-_ratio(n, r), r) for r in refs)
        if -score >= accept:
            want[n] = (match, -score)
    assert {r.name: (r.match, pytest.approx(r.score)) for r in got.collect()} == want


def test_index_compares_few_pairs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12))
    refs = [f"{word()} {word()}" for _ in range(400)]
    names = [r[:3] + r[4:] for r in refs]
    count = lambda grams: grams.groupBy("gram").agg(F.count("*").alias("frequency"))
    frame = lambda x: spark.createDataFrame([(t,) for t in x], "text string")
    frequency = count(frame(refs).select(F.explode(matching._grams(3)).alias("gram")))
    pairs = matching.candidates(matching._indexed(frame(names), frequency, 3), matching._indexed(frame(refs), frequency, 3), 3, 80.0)
    assert {(r.name, r.ref) for r in pairs.collect()} >= set(zip(names, refs, strict=True))
    assert pairs.count() < 0.01 * len(names) * len(refs)


@pytest.mark.parametrize("accept", [80.0, 95.0])
def test_near_names_are_found_by_rare_runs(spark, accept):
    rng = random.Random(7)
    text = lambda: "".join(rng.choice("ABé ") for _ in range(rng.randint(3, 22)))
    refs = {text() for _ in range(60)} | {"A" * 14, "A" * 15, "A" * 17, "BOSTON CITY HALL", "BOSTON CITY MALL"}
    names = {"A" * 13, "A" * 16, "BOSTON CITY ALL", "BOSTON CITY XALL", "A" * 11}
    for r in sorted(refs):
        for _ in range(3):
            n = list(r)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(n) + 1)
                n[at : at + rng.randint(0, 1)] = rng.choice(["", "A", "é"])
            names.add("".join(n))
    frame = lambda x: spark.createDataFrame([(t,) for t in sorted(x)], "text string")
    got = matching.near_matches(frame(names), frame(refs), accept).collect()
    want = {}
    for n in names:
        score, match = min((-_ratio(n, r), r) for r in refs)
        if len(n) >= 12 and -score >= accept and len(n) + len(match) - 2 * lcs_length(n, match) <= 2:
            want[n] = (match, -score)
    assert len(got) == len(want) > 60 and {r.name: (r.match, pytest.approx(r.score)) for r in got} == want


def test_names_near_the_reference_need_no_index_of_all_runs(spark, monkeypatch):
    monkeypatch.setattr(matching, "candidates", lambda *a: pytest.fail("names are looked up by all runs"))
    rows = spark.range(300).select(F.concat(F.lit("large ring ECONOMY "), F.substring(F.md5(F.col("id").cast("string")), 1, 12)).alias("ref"))
    got = matching.best_matches(rows.select(F.expr("concat(left(ref, 4), substr(ref, 7))").alias("name")), rows).collect()
    assert len(got) == 300 and all(r.name == r.match[:4] + r.match[6:] and r.score == pytest.approx(200 * 29 / 60) for r in got)


def test_matching_blocks_are_those_of_the_standard_library():
    rng = random.Random(7)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    pairs = [(text(rng.randint(0, 40), "ab c"), text(rng.randint(0, 40), "ab c")) for _ in range(300)]
    pairs += [(text(300, "abcdefgh \n"), text(rng.randint(190, 420), "abcdefgh \n")) for _ in range(20)] + [(text(250, "xyz" * 40 + "abcdefghijklmnop"), text(250, "xyz" * 40 + "abcdefghijklmnop")) for _ in range(20)]
    for a, b in pairs:
        assert similarity.matching_letters(a, b) == sum(m.size for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks())


def test_shared_letters_bound_both_similarities(spark):
    texts = ["", "aab", "Ab.*", "ba", "abab abab"]
    got = {r.t: r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", similarity.shared_letters(F.col("t"), "aab.*").alias("n")).collect()}
    assert got == {"": 0, "aab": 3, "Ab.*": 3, "ba": 2, "abab abab": 3}


# --- tables as values, rewritten forms ------------------------------------------------------------


def test_sparse_and_ragged_tables(spark):
    """Cells that a table lacks count as 0, a row without a total never adds up."""
    cells = [("d", "t", 0, 0, 1, 0.9), ("d", "t", 0, 2, 3, 0.9), ("d", "t", 0, 3, 4, 0.9), ("d", "t", 1, 0, 2, 0.1), ("d", "t", 1, 3, 7, 0.9), ("d", "t", 2, 1, 5, 0.1), (None, "t", 0, 0, 1, None)]
    df = spark.createDataFrame(cells, "doc string, table string, r int, c int, value int, conf double").withColumn("note", F.lit("n"))
    got = {(r.doc, r.r, r.c): (r.value, r.repaired, r.row_valid, r.note) for r in validate.rows_checked(df).collect()}
    assert got == {
        ("d", 0, 0): (1, False, True, "n"), ("d", 0, 2): (3, False, True, "n"), ("d", 0, 3): (4, False, True, "n"),
        ("d", 1, 0): (7, True, True, "n"), ("d", 1, 3): (7, False, True, "n"), ("d", 2, 1): (5, False, False, "n"), (None, 0, 0): (1, False, False, "n"),
    }
    assert validate.verdicts(df.where("false")).count() == 0


@pytest.mark.parametrize("order", ["rows_first", "columns_first"])
@pytest.mark.parametrize("back", [1, 2])
def test_tables_as_arrays_and_as_cells_agree(spark, order, back):
    rng = random.Random(8)
    tables = []
    for i in range(120):
        m = [[rng.randint(0, 9) for _ in range(3)] for _ in range(3)]
        m = [r + [sum(r)] for r in m]
        m.insert(3 if back == 1 else 2, [sum(c) for c in zip(*m[: 3 if back == 1 else 2])])
        for _ in range(rng.choice([0, 0, 1, 2])):
            m[rng.randrange(4)][rng.randrange(4)] += rng.choice([1, -5])
        k = [[rng.choice([0.1, 0.9, 0.9, 0.9, 0.9]) for _ in r] for r in m]
        tables.append((i, "t", m, k))
    df = spark.createDataFrame(tables, "doc int, table string, m array<array<int>>, k array<array<double>>")
    arrays = validate.judged(df.withColumn("rows", validate.matrix_rows(F.col("m"), F.col("k"))), "rows", back, order)
    assert "Exchange" not in arrays._jdf.queryExecution().executedPlan().toString()
    cells = reshape.matrix_cells(df, ["doc", "table", "k"], "m").withColumn("conf", F.get(F.get("k", F.col("r")), F.col("c"))).drop("k")
    got = {r.doc: r for r in arrays.select("doc", "verdict.*", validate.rows_matrix(validate.mended_rows(F.col("balanced"))).alias("m")).collect()}
    want = {r.doc: r for r in validate.verdicts(cells, back, order).collect()}
    assert len({r.status for r in want.values()}) > 1
    for d, r in want.items():
        assert all(got[d][c] == r[c] for c in ("rows_ok", "cols_ok", "part_ok", "only_last_col", "status"))
    for r in validate.rows_checked(cells).collect():
        assert got[r.doc].m[r.r][r.c] == r.value


def test_forms_are_rewritten_in_place(spark):
    conf = json.dumps([[0.9, 0.9, 0.1], [0.9, 0.9, 0.9]])
    form = [
        ("b-CITY_TOWN", json.dumps(["City", "BOSTN", "more"]), "[0.9, 0.9, 0.9]"),
        ("x-OTHER", json.dumps(["é"]), "[0.4]"),
        ("h-TABLE", json.dumps([[1, 2, 9], [1, 2, 3]]), conf),
        ("b-STATE", json.dumps(["State", "MA"]), "[0.9, 0.9]"),
        ("E-AND_F", json.dumps({"yes": True}), None),
        ("b-CITY_TOWN", json.dumps(["again", "BOSTN"]), "[0.9, 0.9]"),
    ]
    rows = [("one", 10 * i, *f) for i, f in enumerate(form)] + [("two", 0, "b-STATE", json.dumps(["State"]), "[]"), ("three", 0, "x", None, None)]
    fields = spark.createDataFrame(rows, "doc string, at int, id string, content string, confidence string")
    places = spark.createDataFrame([("BOSTON", "MA")], "city string, state string")
    forms = jobs.checked_forms(fields, places)
    got = {r.doc: r for r in forms.collect()}
    new = [json.loads(f.content) for f in got["one"].fields]
    assert new == [["City", "BOSTON", "more"], ["é"], [[1, 2, 3], [1, 2, 3]], ["State", "MA"], {"yes": True}, ["again", "BOSTN"]]
    assert [f.id for f in got["one"].fields] == [f[0] for f in form] and [f.confidence for f in got["one"].fields] == [f[2] for f in form]
    assert got["two"].missing_location and got["two"].fields[0].content == json.dumps(["State"]) and got["three"].fields[0].content is None
    assert {(r.check, r.doc) for r in jobs.offending(forms).collect()} == {("missing_location", "two"), ("missing_location", "three"), ("partial_invalid", "one"), ("invalid", "one")}
    assert jobs.checked_forms(fields.where("false"), places).count() == 0


# --- noise ----------------------------------------------------------------------------------------


def test_keyed_noise_follows_its_law(spark):
    key, epsilon, n = bytes(32), 1 / 21, 100_000
    got = spark.range(n).select(noise.keyed_laplace(key, epsilon, F.lit("t"), F.col("id")).alias("x")).groupBy("x").count().collect()
    counts, q = {r.x: r["count"] for r in got}, math.exp(-epsilon)
    for x in (0, 1, -1, 5, -20, 40):
        p = (1 - q) / (1 + q) * q ** abs(x)
        assert abs(counts.get(x, 0) - n * p) < 5 * math.sqrt(n * p)
    for t in (10, 60, 150):
        p = q**t / (1 + q)
        for sign in (1, -1):
            assert abs(sum(c for x, c in counts.items() if sign * x >= t) - n * p) < 5 * math.sqrt(n * p)


def test_keyed_noise_is_hmac(spark):
    for key in (b"k", bytes(range(100))):
        got = spark.range(1).select(noise.hmac_hex(key, F.lit("a|é")).alias("h")).first().h
        assert got == hmac.new(key, "a|é".encode(), hashlib.sha256).hexdigest()
    stream = noise.Stream(b"k", "n")
    whole = int(hmac.new(b"k", b"n|0", hashlib.sha256).hexdigest(), 16)
    assert [stream.next() for _ in range(4)] == [whole >> 52 * i & (1 << 52) - 1 for i in (3, 2, 1, 0)]


def test_messages_differ(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("-", "ab"), ("1:a", "b")]
    got = spark.createDataFrame(rows, "a string, b string").select(noise.message(F.col("a"), F.col("b")).alias("m"))
    assert got.distinct().count() == len(rows)


def test_absent_cells_are_kept_by_the_law(spark):
    key, epsilon, above, cells = bytes(range(9)), 1 / 21, 120, 3_000_000
    tables = spark.createDataFrame([(1, cells), (2, 1 << 60), (3, 0)], "gid int, cells long")
    got = contingency.kept_places(tables.where("gid != 2"), key, epsilon, above).collect()
    want = cells * contingency.tail(epsilon, above)
    assert abs(len(got) - want) < 5 * math.sqrt(want) and all(r.gid == 1 and 0 <= r.place < cells and r.Count >= above for r in got)
    assert len({r.place for r in got}) == len(got)
    assert abs(sum(r.place for r in got) / len(got) - cells / 2) < 5 * cells / math.sqrt(12 * len(got))
    q = math.exp(-epsilon)
    assert abs(sum(r.Count - above for r in got) / len(got) - q / (1 - q)) < 5 * 21 / math.sqrt(len(got))
    # The cost follows what is kept: about a thousand of 2**60 cells.
    want = (1 << 60) * contingency.tail(1.0, 34)
    assert want < 2500 and abs(contingency.kept_places(tables.where("gid = 2"), key, 1.0, 34).count() - want) < 5 * math.sqrt(want)


def test_tables_with_absent_cells(spark):
    rows = [(f"a{i % 40}", f"b{i % 30}", f"c{i % 7}", 1000 if i == 5 else 1) for i in range(200)]
    df = spark.createDataFrame(rows + [(None, "b1", "c1", 1)], "a string, b string, c string, n int")
    run = lambda: contingency.dp_contingency(df, ["a", "b", "c"], "n", key=b"k", above=60).where("arity = 3")
    got = run().collect()
    present = {r[:3] for r in rows}
    assert all(r.Count >= 60 for r in got) and {tuple(r[2:5]) for r in got} - present and {(r.a, r.b, r.c) for r in got if r.Count > 500} == {("a5", "b5", "c5")}
    assert len({(r.a, r.b, r.c) for r in got}) == len(got) and sorted(map(tuple, run().collect())) == sorted(map(tuple, got))
    share = contingency.tail(1 / 21, 60) * 40 * 30 * 7
    assert abs(len(got) - share) < 6 * math.sqrt(share)
    with pytest.raises(ValueError):
        contingency.dp_contingency(df, ["a", "b", "c"], "n", above=0)


# --- files ----------------------------------------------------------------------------------------


def _tree(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file())


def test_each_row_is_a_file_or_none_is(spark, tmp_path):
    rows = spark.range(40, numPartitions=4).select(F.concat(F.lit("d"), F.col("id") % 3, F.lit("/"), "id", F.lit(".txt")).alias("name"), F.when(F.col("id") != 7, F.concat(F.lit("é\n"), "id")).alias("value"))
    each.write_each(rows, str(tmp_path / "good"))
    assert len(_tree(tmp_path / "good")) == 40 and (tmp_path / "good/d1/1.txt").read_text() == "é\n1" and (tmp_path / "good/d1/7.txt").read_text() == ""
    broken = rows.withColumn("value", F.when(F.col("name") == "d0/39.txt", F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("value")))
    for bad in (broken, rows.withColumn("name", F.lit("same")), rows.withColumn("name", F.lit("../out")), rows.withColumn("name", F.lit(None).cast("string"))):
        with pytest.raises(PySparkException):
            each.write_each(bad, str(tmp_path / "bad"))
        assert not (tmp_path / "bad").exists() or _tree(tmp_path / "bad") == []
    with pytest.raises(PySparkException):
        each.write_each(rows, str(tmp_path / "good"))
    assert len(_tree(tmp_path / "good")) == 40
    each.write_each(rows.limit(2), str(tmp_path / "good"), overwrite=True)
    assert len(_tree(tmp_path / "good")) == 2
    each.write_each(rows.where("false"), str(tmp_path / "none"))
    assert _tree(tmp_path / "none") == []


def test_many_files_are_written_and_read_by_few_rows_a_task(spark, tmp_path, monkeypatch):
    rows = spark.range(200, numPartitions=1).select(F.concat(F.col("id") % 3, F.lit("/"), "id", F.lit(".log")).alias("name"), F.concat(F.lit("a\r\nb "), "id", F.lit("\n")).alias("value"))
    (tmp_path / "staging").mkdir()
    with monkeypatch.context() as m:
        m.setattr(each, "TASK_FILES", 50)
        assert each._staged(rows, str(tmp_path / "staging")).select("folder").distinct().count() > 2
    each.write_each(rows, str(tmp_path / "logs"))
    lines = files.log_lines(spark, str(tmp_path / "logs" / "1"))
    assert lines.rdd.getNumPartitions() == 1 and lines.count() == 2 * 67 and {r.line for r in lines.where("file = '4.log'").collect()} == {"a", "b 4"}
    assert files.binaries(spark, str(tmp_path / "logs")).rdd.getNumPartitions() == 1
    assert each.listed(spark, str(tmp_path), levels=2).count() == 0 and each.listed(spark, str(tmp_path), "1*.log", levels=3).count() == 111


ODD_DOCUMENTS = [(1, "a", "en"), (2, "", "en"), (3, "", "fr"), (4, None, "en"), (5, "é", "fr"), (6, "", "de"), (7, "a", None), (8, "b", "_x"), (9, "b", "."), (10, "", ""), (11, "a\r\n", "en"), (12, "b", "a/b")]


@pytest.mark.parametrize("name", ["cls1_manifest_by_folder", "src8_binary_files", "ded1_files_by_ranges", "ded1_bytes_read"])
def test_files_of_odd_documents(spark, tmp_path, name):
    spark.createDataFrame(ODD_DOCUMENTS, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES[name](spark, str(tmp_path))
    want = duckdb.connect().sql(f"with documents as (from '{tmp_path}/documents.parquet/*.parquet') select {', '.join(got.columns)} from ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_unreadable_files_are_rejected(spark, tmp_path):
    good = {"a.json": '{"id": "1", "n": [1, 2]}', "x/b.json": ' [{"id": "2"}, {"id": "3", "n": null}]\n', "x/y/c.json": '[]', "x/y/d.json": '{"other": 1}'}
    bad = {"e.json": '{"id": "1"', "f.json": "  ", "g.json": b"\xff\xfe{}", "x/h.json": '"text"', "i.json": '{"id": "1"} {"id": "2"}'}
    for name, body in (good | bad | {"z.txt": "no form"}).items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(body if isinstance(body, bytes) else body.encode())
    last = lambda r: r._path.rsplit("/", 1)[1]
    found, rejects = each.forms(spark, str(tmp_path), "id string, n array<int>")
    assert sorted((last(r), r.id, r.n) for r in found.collect()) == [("a.json", "1", [1, 2]), ("b.json", "2", None), ("b.json", "3", None), ("d.json", None, None)]
    assert sorted(map(last, rejects.collect())) == ["e.json", "f.json", "g.json", "h.json", "i.json"]
    found, rejects = each.forms(spark, str(tmp_path), "id string, n array<int>", two_levels=True)
    assert {last(r) for r in found.collect()} == {"a.json", "b.json"} and rejects.count() == 5
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "one.json").write_text('{"id": "9"}')
    assert each.forms(spark, str(tmp_path / "flat"), "id string", two_levels=True)[0].count() == 1


def test_files_gone_since_they_were_listed(spark, tmp_path):
    rows = spark.createDataFrame([(f"file:{tmp_path}/gone.json", 3)], "path string, length long")
    got = each.texts(rows).first()
    assert got.value is None and "FileNotFound" in got.error


def test_packs_hold_about_so_many_bytes(spark):
    rows = spark.range(500).select(F.format_string("f%05d", "id").alias("path"), F.when(F.col("id") == 250, 5000).otherwise(10).cast("long").alias("length"))
    got = each.packed(rows, 1000, 10).groupBy("pack").agg(F.sum(F.col("length") + 10).alias("n"), F.min("path").alias("a"), F.max("path").alias("b")).orderBy("pack").collect()
    assert all(r.n <= 1020 or r.n >= 5000 for r in got) and len(got) >= 11 and all(x.b < y.a for x, y in zip(got, got[1:]))


def test_numbers_in_order(spark):
    rows = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = [r.k for r in storage.numbered(rows, "i", "k").orderBy("i").collect()]
    assert got == sorted(got) and storage.numbered(rows.where("false"), "i", "k").count() == 0


def test_duplicates_by_ranges(spark, tmp_path):
    big = bytes(range(256)) * 40  # 10240 bytes, 11 chunks of 1000
    bodies = {"a.bin": big, "b.BIN": big, "c.bin": big[:5000] + b"x" + big[5001:], "d.bin": big[:-1] + b"y", "e.txt": big, "f.bin": b"s", "g.bin": b"s", "h.bin": b"t", "i": b"s", "j.bin": big[:900], "k.bin": big[:900]}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    found, read = dedup.duplicate_files(each.listed(spark, str(tmp_path)), ends=600, chunk=1000)
    got = sorted((r.path.rsplit("/", 1)[1], r.kept.rsplit("/", 1)[1], r.is_kept) for r in found.collect())
    assert got == [("a.bin", "a.bin", True), ("b.BIN", "a.bin", False), ("f.bin", "f.bin", True), ("g.bin", "f.bin", False), ("j.bin", "j.bin", True), ("k.bin", "j.bin", False)]
    # Ends of all that share a size and extension; whole only those that share their ends too.
    assert {r.step: (r.files, r.bytes) for r in read.collect()} == {"ends": (9, 4 * 1200 + 3 + 2 * 900), "whole": (5, 3 * 10240 + 2 * 900)}
    found, read = dedup.duplicate_files(each.listed(spark, str(tmp_path)).where("false"))
    assert found.count() == 0 and {r.bytes for r in read.collect()} == {0}


# --- shapes, reports ------------------------------------------------------------------------------


def test_any_shape_flattens(spark):
    docs = ['{"a": 1, "b": {"c": [true, null, {"d": "x"}]}, "e": [], "f": {}, "g<h>": [[1, 2], [3]]}', "[1, [2]]", "3", '"text"', "null", "{}", None]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, j string").withColumn("v", F.parse_json("j"))
    got = {(r.id, r.path): r.value for r in flatten.flattened(df, "v", ["id"]).collect()}
    assert got == {
        (0, "a"): "1", (0, "b.c_0"): "true", (0, "b.c_1"): None, (0, "b.c_2.d"): "x", (0, "g<h>_0_0"): "1", (0, "g<h>_0_1"): "2", (0, "g<h>_1_0"): "3",
        (1, "0"): "1", (1, "1_0"): "2", (2, ""): "3", (3, ""): "text", (4, ""): None,
    }
    wide = flatten.widened(flatten.flattened(df.where("id = 0"), "v", ["id"]), ["id"])
    assert set(wide.columns) == {"id", "a", "b.c_0", "b.c_1", "b.c_2.d", "g<h>_0_0", "g<h>_0_1", "g<h>_1_0"} and wide.count() == 1
    assert flatten.flattened(df.where("false"), "v", ["id"]).count() == 0


def test_report_names_that_could_be_mistaken(spark):
    dims = ["Job Category", "Org", "Size", "Org Size"]
    df = spark.createDataFrame([("j", "g", "s", "o", 1), ("j", "h", "t", "o", 2)], ", ".join(f"`{d}` string" for d in dims) + ", n int")
    with pytest.raises(ValueError, match="same name"):
        reports.every_table(contingency.contingency(df, dims, 2, "n"), dims)  # Org and Size are Org_Size too
    dims.remove("Org")
    got = reports.every_table(contingency.contingency(df, dims, 2, "n"), dims).collect()
    assert {(r.table_name, tuple(r.rows), r.column) for r in got} == {("Job_Category_Size", ("j",), "s"), ("Job_Category_Size", ("j",), "t"), ("Job_Category_Org_Size", ("j",), "o"), ("Size_Org_Size", ("s",), "o"), ("Size_Org_Size", ("t",), "o")}


def test_small_file_readers_agree(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1"}, {"id": "2"}]')
    plain = files.forms(spark, str(tmp_path), spark.createDataFrame([], "id string").schema)
    assert sorted(r.id for r in plain.collect()) == sorted(r.id for r in each.forms(spark, str(tmp_path), "id string")[0].collect())


def test_one_file_of_records_becomes_rows_in_many_tasks(spark, monkeypatch):
    table = F.array(*[F.array(*[(F.col("id") + i + j).cast("int") for j in range(15)]) for i in range(12)])
    names = ("city", "headquarter_state", "headquarter_city", "NAICS", "NAICS_name", "zipcode", "headquarter_zipcode")
    one = spark.range(200, numPartitions=1).select(F.concat(F.lit("f"), F.col("id") % 100).alias("filename"), F.lit("MA").alias("state"), *[F.lit("").alias(n) for n in names], F.lit(2019).alias("reporting_year"), table.alias("table"))
    whole = sorted(map(tuple, jobs.wide_rows(one)[0].collect()), key=repr)
    monkeypatch.setattr(jobs, "TASK_RECORDS", 20)
    wide = jobs.wide_rows(one)[0]
    assert "REPARTITION_BY_NUM" in wide._jdf.queryExecution().toString()
    assert storage.dealt(one, 20, "filename").rdd.getNumPartitions() == 11 and storage.dealt(one, 20, "filename", most=3).rdd.getNumPartitions() == 3
    assert sorted(map(tuple, wide.collect()), key=repr) == whole and len(whole) == 100 * 12


# --- stored tables --------------------------------------------------------------------------------


def _stored(spark):
    return {p.name for p in Path(storage.shared_dir(spark).removeprefix("file:").replace("//", "/")).iterdir()}


def test_only_what_a_result_reads_stays(spark, tmp_path):
    rows = spark.createDataFrame([("anna karenina", 3), ("war and peace", 4), ("dead souls", 5)], "name string, n long")
    others = spark.createDataFrame([("anna karenin",), ("oblomov",)], "ref string")
    each.write_each(spark.createDataFrame([("a.json", '{"id": "1"}'), ("b.json", '{"id": "1"}'), ("c.json", "{")], "name string, value string"), str(tmp_path / "f"))
    cases = [
        (0, lambda: [enrich.quartile_edges(rows, "n")]),
        (0, lambda: [enrich.quartile_edges(rows.where("false"), "n")]),
        (1, lambda: [matching.best_matches(rows, others)]),
        (1, lambda: [matching.best_matches(rows, others, 95.0)]),
        (2, lambda: dedup.duplicate_files(each.listed(spark, str(tmp_path / "f")))),
        (1, lambda: each.forms(spark, str(tmp_path / "f"), "id string")),
    ]
    for n, run in cases:
        before = _stored(spark)
        got = [sorted(d.collect(), key=repr) for d in run()]
        assert len(_stored(spark) - before) == n, got
        with storage.scratch(spark):
            assert [sorted(d.collect(), key=repr) for d in run()] == got
        assert len(_stored(spark) - before) == n


def test_a_failed_job_leaves_no_tables(spark):
    before = _stored(spark)
    with pytest.raises(PySparkException), storage.scratch(spark) as kept:
        storage.materialised(spark.range(3), "fine")
        kept(spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x")), "broken")
    assert _stored(spark) == before


def test_scratches_nest_and_keep_to_their_thread(spark):
    before = _stored(spark)
    with storage.scratch(spark) as outer:
        with storage.scratch(spark) as inner:
            storage.materialised(spark.range(1), "gone")
            a = inner(spark.range(2), "inner")
            b = outer(spark.range(3), "outer")
        assert (a.count(), b.count()) == (2, 3) and len(_stored(spark) - before) == 2
        other = []
        thread = threading.Thread(target=lambda: other.append(storage.materialised(spark.range(4), "other")))
        thread.start()
        thread.join()
    # Kept by the outermost scratch, and stored by a thread that has none.
    assert other[0].count() == 4 and b.count() == 3
    assert sorted(name.partition("-")[0] for name in _stored(spark) - before) == ["other", "outer"]
