import difflib
import json
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyforge import queries, schemas
from tallyforge.functions import noise, similarity, text
from tallyforge.operators import contingency, dedup, enrich, grid, logs, matching, reshape, validate
from tallyforge.plans import jobs
from tallyforge.sources import files

from .conftest import SF


def cells(spark, matrix, conf=None):
    rows = [("d", "t", r, c, v, (conf or {}).get((r, c), 0.9)) for r, row in enumerate(matrix) for c, v in enumerate(row)]
    return spark.createDataFrame(rows, "doc string, table string, r int, c int, value int, conf double")


def grid_of(df):
    return {(r.r, r.c): r.value for r in df.collect()}


def test_laplace_moments(spark):
    got = spark.range(200_000).select(noise.laplace(21.0, 5).alias("x")).agg(F.avg("x"), F.avg(F.abs("x"))).first()
    assert abs(got[0]) < 5 * 21 * 2**0.5 / 200_000**0.5 and abs(got[1] - 21) < 5 * 21 / 200_000**0.5


def test_noise_is_drawn_once(spark):
    df = spark.createDataFrame([(a, b, c, d, 5) for a in "xy" for b in "uv" for c in "st" for d in "pq"], "a string, b string, c string, d string, n int")
    got = contingency.dp_contingency(df, ["a", "b", "c", "d"], "n")
    t3 = {r.table_name: [] for r in got.where("arity = 3").collect()}
    assert len(t3) == 4
    rows = got.collect()
    versions = {}
    for r in rows:
        if r.arity == 3 and r.a is not None and r.b is not None:
            versions.setdefault((r.a, r.b), {}).setdefault(r.table_name, 0.0)
            versions[r.a, r.b][r.table_name] += r.Count
    for r in rows:
        if r.table_name == "a_b":
            assert abs(r.Count - sum(versions[r.a, r.b].values()) / 2) < 1e-9


def test_nulls_vanish_and_domain_fills(spark):
    df = spark.createDataFrame([("x", "u", "s", 1), (None, "u", "s", 5), ("y", "u", "t", 2)], "a string, b string, c string, n int")
    assert contingency.cube(df, ["a", "b", "c"], "n").count() == 2
    assert contingency.cube(df, ["a", "b", "c"], "n", keep_nulls=True).count() == 3
    domain = spark.createDataFrame([(a, "u", c) for a in "xy" for c in "st"], "a string, b string, c string")
    got = contingency.dp_contingency(df, ["a", "b", "c"], "n", noise="none", domain=domain)
    assert got.where("arity = 3").count() == 4
    assert contingency.spent(schemas.FORM1_KEYS[:6]) == pytest.approx(20 / 21)
    with pytest.raises(ValueError):
        contingency.dp_contingency(df, ["a", "b", "c"], "n", noise="loud")


def test_row_repair(spark):
    low = {(0, 1): 0.5, (1, 2): 0.1, (2, 0): 0.1, (2, 1): 0.1, (3, 0): 0.7, (4, 0): 0.1}
    m = [[1, 9, 5], [1, 2, 9], [1, 1, 9], [1, 1, 9], [9, 5, 2]]
    got = validate.rows_checked(cells(spark, m, low))
    g = grid_of(got)
    assert g[0, 1] == 4 and g[1, 2] == 3 and g[2, 0] == 1 and g[3, 0] == 1 and g[4, 0] == -3
    assert {r.r: r.row_valid for r in got.collect()} == {0: True, 1: True, 2: False, 3: False, 4: True}
    assert grid_of(validate.rows_checked(cells(spark, m, low), allow_negative=False))[4, 0] == 9
    assert not any(r.repaired for r in validate.rows_checked(cells(spark, m, low), repair=False).collect())


def test_orders_of_checks_differ(spark):
    # The repair of the first row also mends its column.
    m, low = [[1, 9, 3], [1, 1, 2], [2, 3, 5], [0, 0, 0]], {(0, 1): 0.1}
    rows_first = validate.verdicts(cells(spark, m, low)).first()
    columns_first = validate.verdicts(cells(spark, m, low), order="columns_first").first()
    assert rows_first.status == "Valid" and not columns_first.cols_ok and columns_first.rows_ok


def test_grand_total(spark):
    m = [[1, 2, 3], [1, 1, 2], [2, 3, 9], [0, 0, 0]]
    assert validate.verdicts(cells(spark, m)).first().rows_ok is False
    assert grid_of(validate.grand_total_repaired(cells(spark, m)))[2, 2] == 5
    assert grid_of(validate.grand_total_repaired(cells(spark, m), compat=True))[2, 2] == 9
    assert validate.margins(cells(spark, m)).first().diff == 4


def test_quartiles(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 5.0)] + [(None,)], "v double")
    got = {r.v: r.b for r in enrich.size_bins(df, "v", "b").collect()}
    assert got == {1.0: "Small", 2.0: "Small", 3.0: "Medium", 4.0: "Large", 5.0: "Very Large", None: None}
    flat = spark.createDataFrame([(1.0,)] * 5 + [(9.0,)], "v double")
    with pytest.raises(PySparkException):
        enrich.size_bins(flat, "v", "b").collect()
    assert enrich.size_bins(flat, "v", "b", duplicates="drop").count() == 6


def test_string_functions(spark):
    df = spark.createDataFrame([("2139", "x_page_1_cropped_2.json"), ("02139-1234", "a.b.PDF"), ("", "none"), (None, None)], "z string, p string")
    got = df.select(text.zip5(F.col("z")), text.extension(F.col("p"), "No_Extension"), text.document_key(F.col("p"))).collect()
    assert [r[0] for r in got] == ["02139", "02139", None, None]
    assert [r[1] for r in got][:3] == ["json", "pdf", "No_Extension"] and got[0][2] == "x"
    years = spark.createDataFrame([("in 2019 or 2020",), ("12019",), ("",)], "t string").select(text.year(F.col("t"))).collect()
    assert [r[0] for r in years] == [2019, -1, -1]
    parts = spark.createDataFrame([("Two or More Races_Male_FULL-TIME STAFF_Clerks",)], "l string").select(*text.split_label(F.col("l"), "_", 4)).first()
    assert tuple(parts) == ("Two or More Races", "Male", "FULL-TIME STAFF", "Clerks")


def test_indel_ratio_agrees_with_fold(spark):
    random.seed(2)
    word = lambda: "".join(random.choice("ABCD ") for _ in range(random.randrange(0, 9)))
    df = spark.createDataFrame([(word(), word()) for _ in range(60)] + [("BOSTN", "BOSTON")], "a string, b string")
    for r in df.select("a", "b", similarity.indel_ratio("a", "b").alias("x"), similarity.indel_ratio_by_fold(F.col("a"), F.col("b")).alias("y")).collect():
        assert r.x == pytest.approx(100.0 if not r.a and not r.b else r.y)


def test_matching(spark):
    reference = spark.createDataFrame([("BOSTON", "MA"), ("AUSTIN", "TX"), ("BOSTON", "NY")], "city string, state string")
    df = spark.createDataFrame([(1, "BOSTN", "MA"), (2, "AUSTIN", "MA"), (3, "QQ", "MA"), (4, None, "MA")], "id int, city string, state string")
    got = {r.id: (r.city, r.matched) for r in matching.corrected_pairs(df, "city", "state", reference).collect()}
    assert got == {1: ("BOSTON", True), 2: ("AUSTIN", False), 3: ("QQ", False), 4: (None, False)}


def test_matching_a_large_reference(spark, monkeypatch):
    names = spark.createDataFrame([("BOSTN",), ("BOSTON",), ("CAMBRIDG",), ("NOWHERE",)], "name string")
    reference = spark.createDataFrame([("BOSTON",), ("CAMBRIDGE",), ("LYNN",)], "ref string")
    small = sorted(map(tuple, matching.best_matches(names, reference).collect()))
    monkeypatch.setattr(matching.storage, "fits", lambda df: df.limit(3).count() <= 2)
    assert sorted(map(tuple, matching.best_matches(names, reference).collect())) == small
    assert [n for n, *_ in small] == ["BOSTN", "BOSTON", "CAMBRIDG"]


def test_header_limit_and_skips(spark):
    df = spark.createDataFrame([("CONSOLIDATED REPORT",), ("CONSOLIDATED REPOR",), ("ESTABLISHMENT REPORT",), (None,)], "t string")
    assert {r.t for r in matching.unlike(df, "t").collect()} == {"ESTABLISHMENT REPORT", None}


def test_grid_rules(spark):
    def word(seq, value, x, y, conf=0.9):
        return ("d", seq, value, conf, x / 500, y / 250, x / 500, y / 250, 1000.0, 500.0)

    at = lambda c, r: (45 + (c + 0.5) * 102.5, 45 + (r + 0.5) * 25)
    words = [word(1, "x", *at(0, 0)), word(2, "7", *at(0, 0)), word(3, "8", *at(0, 0)), word(4, "a", *at(1, 0)), word(5, "b", *at(1, 0)), word(6, "5", *at(2, 9)), word(7, "6", 10, 60)]
    df = spark.createDataFrame(words, "doc string, seq int, value string, conf double, x0 double, y0 double, x1 double, y1 double, page_w double, page_h double")
    placed = grid.positions(df, 3, 4)
    got = {(r.r, r.c): r.raw for r in grid.grid_cells(placed, ["doc"], 3, 4, ["seq"]).collect()}
    assert len(got) == 12 and got[0, 0] == "7" and got[0, 1] == "b" and got[2, 2] == "5" and got[1, 1] is None
    assert [r.value for r in grid.outside(placed, 4).collect()] == ["6"]


def field(doc, i, content, confidence=None):
    return (doc, i, json.dumps(content), json.dumps(confidence))


def form1(doc, report, city="BOSTN", state="MA", matrix=None):
    answers = {"a-TYPE_OF_REPORT": report, "b-EMPLOYER": "ACME", "b-STATE": state, "b-CITY_TOWN": city, "g-NAICS": "code 5112 x", "b-ZIPCODE": "2139"}
    rows = [field(doc, k, ["caption", v], [0.9, 0.9]) for k, v in answers.items()]
    rows += [field(doc, "h-CURRENT_YEAR_REPORTING_TOTAL_LABEL", ["TOTAL 2019"], [0.9])]
    matrix = matrix or [[1] * 14 + [14]] * 10 + [[10] * 14 + [140], [0] * 15]
    return rows + [field(doc, "h-TABLE", matrix, [[0.9] * 15] * len(matrix))]


FIELD = "doc string, id string, content string, confidence string"


def test_form1_jobs(spark):
    fields = spark.createDataFrame(form1("/in/a_page_1_cropped.json", "ESTABLISHMENT REPORT") + form1("/in/b_cropped.json", "CONSOLIDATED REPORT") + form1("/in/c.json", "OTHER", state="TX", matrix=[[1]]), FIELD)
    names = spark.createDataFrame([("5112", "Software")], "code string, title string")
    zips = spark.createDataFrame([("02108",)], "zip string")
    got = jobs.extract_form1(fields, names, zips).collect()
    assert [(r.filename, r.NAICS, r.NAICS_name, r.reporting_year, r.state) for r in got] == [("a", "5112", "Software", 2019, "MA")]
    both = jobs.extract_form1(fields, names, spark.createDataFrame([("2139",)], "zip string"))
    wide, rejects = jobs.wide_rows(both)
    assert wide.count() == 12 and rejects.count() == 1
    industries = spark.createDataFrame([("51", "Information")], "code string, title string")
    counties = spark.createDataFrame([("02139", "1", "Middlesex", 0.6), ("02139", "2", "Suffolk", 0.4)], "zip string, county_code string, county_name string, share double")
    cities = spark.createDataFrame([("CAMBRIDGE", "MA", "Other", "02139 02140")], "city string, state string, county_name string, zips string")
    rich = jobs.enrich_forms(wide, industries, counties, cities, duplicates="drop")
    assert rich.count() == 20 and {r["County Name"] for r in rich.collect()} == {"Middlesex", "Suffolk"}
    assert {r["Organizational Size"] for r in rich.collect()} == {140}
    long = jobs.form1_long(rich.where("`County Name` = 'Suffolk'"), ["JobCategory", "NAICS_label"])
    assert long.count() == 140 and {r.Race for r in long.select("Race").distinct().collect()} == set(schemas.RACES)
    docs, summary, years = jobs.validate_forms(fields, spark.createDataFrame([("BOSTON", "MA")], "city string, state string"))
    assert summary.first().forms == 3 and {r.city for r in docs.where("state = 'MA'").collect()} == {"BOSTON"}
    assert {(r.year, r.forms) for r in years.collect()} == {(2019, 3)}
    diffs, histogram = jobs.margin_report(both.where("filename = 'a'"), 1)
    assert diffs.first().diff == 0 and histogram.count() == 0


def test_form5_jobs(spark):
    table = lambda n: [[1] * 14 + [14]] * n
    rows = [field("/in/x.json", k, ["c", v]) for k, v in {"b-STATE": "MA", "b-COUNTY": "suffolk", "title-OE_NUM_AND_YEAR": "2020"}.items()]
    rows += [field("/in/x.json", f"table-{t}", table(n)) for t, n in (("A", 19), ("B", 3), ("C", 6))]
    rows += [field("/in/x.json", "a-TYPE_OF_AGENCY", {"Local Public School": True, "Other": True})]
    records = jobs.extract_form5(spark.createDataFrame(rows, FIELD))
    r = records.first()
    assert (r.county, r.reporting_year, r["State Education Agency"]) == ("SUFFOLK", "2020", False)
    flat = jobs.flatten_form5(records)
    assert flat.count() == 350 and {x["Type of Agent"] for x in flat.collect()} == {"Other"}
    assert jobs.flatten_form5(records, include_new_hires=False).count() == 280
    assert jobs.margin_report(records, 5)[0].count() == 3
    assert records.where(validate.not_exactly_one(schemas.AGENT_FLAGS)).count() == 1


def test_noise_at_the_ends(spark):
    got = spark.createDataFrame([(u,) for u in (0.0, 2.0**-53, 0.5, 1 - 2.0**-53, 1.0)], "u double").select(noise.laplace_from(F.col("u"), 21.0).alias("x")).collect()
    low, less, mid, more, high = (r.x for r in got)
    assert low == pytest.approx(-21 * 53 * math.log(2)) and low <= less < mid == 0 < more <= high == -low


def test_quartiles_agree_with_percentile(spark):
    for n, spread in ((1, 1), (2, 9), (7, 3), (5000, 40), (4001, 10**6)):
        df = spark.range(n).select(F.when(F.col("id") % 11 != 3, F.xxhash64("id") % spread).alias("v"))
        want = df.agg(F.percentile("v", F.array(*[F.lit(q / 4) for q in range(5)]))).first()[0]
        assert enrich.quartile_edges(df, "v").first().edges == pytest.approx(want)
    assert enrich.quartile_edges(df.where("false"), "v").first().edges is None


def test_layouts(spark):
    words = spark.createDataFrame([("p", 1.0, 1.0), ("q", 1.0, 1.0)], "form string, x double, y double")
    layout = spark.createDataFrame([("p", "s", "f", 0.0, 0.0, 2.0, 2.0), ("q", "s", "g", 0.0, 0.0, 1.0, 1.0), ("q", "s", "h", 2.0, 0.0, 3.0, 1.0)], "form string, section string, field string, x1 double, y1 double, x2 double, y2 double")
    assert sorted((r.form, r.field) for r in grid.in_rectangles(words, layout, ("form",)).collect()) == [("p", "f"), ("q", "g")]


def test_unlike_skips_by_length(spark):
    texts = ["CONSOLIDATED REPORT", "CONSOLIDATED REPRT", "REPORT", "", None, "CONSOLIDATED REPORT" * 9]
    got = [r.t for r in matching.unlike(spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()]
    assert got == texts[2:]


def test_words_to_stacked_tables(spark):
    words = [("d", "a2", 0, 0, 0, 1, "5", 0.9, 0.1, 0.5, 0.1, 0.5, 1000.0, 500.0)]
    df = spark.createDataFrame(words, "doc string, table string, page int, block int, line int, word_seq int, value string, conf double, x0 double, y0 double, x1 double, y1 double, page_w double, page_h double")
    got, _, rejects = jobs.words_to_tables(df, 15, 5)
    assert {r.r for r in got.collect()} == {10} and rejects.count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    for name, body in (("a.txt", "one"), ("b.txt", "one"), ("c.md", "one"), ("deep/d.TXT", "two"), ("deep/e", "six")):
        (tmp_path / name).write_text(body)
    found = dedup.duplicates(files.binaries(spark, str(tmp_path)))
    assert [r.path.rsplit("/", 1)[1] for r in dedup.removals(found).collect()] == ["b.txt"]
    assert {(r.ext, r.files) for r in dedup.by_extension(files.binaries(spark, str(tmp_path))).collect()} == {("txt", 3), ("md", 1), ("No_Extension", 1)}
    assert files.by_suffix(spark, str(tmp_path), "TXT").count() == 2
    with pytest.raises(PySparkException):
        files.by_suffix(spark, str(tmp_path / "none"), "txt")


def test_form_files(spark, tmp_path):
    (tmp_path / "one" / "two").mkdir(parents=True)
    for i, p in enumerate(("a.json", "one/b.json", "one/two/c.json")):
        (tmp_path / p).write_text(json.dumps([{"id": str(i), "section": "s", "content": [[1, 2]], "confidence": [[0.5]]}], indent=2))
    assert files.forms(spark, str(tmp_path), schemas.FIELDS).count() == 3
    some = files.forms(spark, str(tmp_path), schemas.FIELDS, two_levels=True)
    assert {r.id for r in some.collect()} == {"0", "1"} and json.loads(some.first().content) == [[1, 2]]


def test_reference_files(spark, tmp_path):
    (tmp_path / "i.csv").write_text("﻿Seq,Code of 2022,Title,\n1,11,Farming ,\n2,31,Making,\n")
    (tmp_path / "z.csv").write_text("zcta,county,CountyName,ZIPName,pop20,afact\nZIP code,County code,Name,Zip name,Pop,Factor\n ,1,x,,,\n02139,25017,Middlesex MA,Cambridge,1,0.9\n")
    assert [tuple(r) for r in files.industries(spark, str(tmp_path / "i.csv")).collect()] == [("11", "Farming"), ("31", "Making")]
    assert [tuple(r) for r in files.zip_counties(spark, str(tmp_path / "z.csv")).collect()] == [("02139", "25017", "Middlesex", 0.9)]
    (tmp_path / "x.log").write_text("[INFO],2025/05/01 10:00:00,CELL_TO_CONTENTS,Valid table, invalid sum\n[INFO],bad\n")
    (tmp_path / "y.log").write_text("[INFO],2025/05/01 10:00:00,SPLIT,none\n")
    lines = files.log_lines(spark, str(tmp_path))
    assert tuple(logs.summary(lines, "file").first()) == (2, 1, 1, 50.0)
    assert tuple(logs.summary(lines, "file", prefix="CELL_TO_CONTENTS").first()) == (1, 1, 0, 100.0)
    assert logs.parsed(lines).where("ts is not null").count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x", "u", "s", 1)], "a string, b string, c string, n int")
    tables = contingency.contingency(df, ["a", "b", "c"], 2, "n")
    files.write_tables(tables, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    files.write_forms(df, str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).count() == 1
    files.write_tables(tables, str(tmp_path / "c"), "csv")
    assert sorted(p.name for p in (tmp_path / "c").iterdir() if p.is_dir()) == [f"file={x}_contingency.csv" for x in ("a_b", "a_c", "b_c")]
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    files.write_summary(df, str(tmp_path / "s"))
    assert len(list((tmp_path / "s").glob("*.json"))) == 1
    names = [r.table_name for r in files.combined([df, df], ["n" * 40, "n" * 40]).collect()]
    assert len(set(names)) == 2 and max(map(len, names)) == 31


def test_explode_zips(spark):
    df = spark.createDataFrame([("[02108 02109]",), ("02110",), ("",)], "zips string")
    assert sorted(r.z for r in reshape.explode_zips(df, "zips", "z").collect()) == ["02108", "02109", "02110"]


def test_headed_compares_whole_lines(spark):
    pattern = "HEADER " * 40
    texts = [pattern, pattern[:200], pattern[:150], pattern + "x" * 400, pattern[:200] + "y" * 900, "", "short", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ratio = {t: difflib.SequenceMatcher(None, t, pattern).ratio() for t in texts if t is not None}
    assert {r.t: r.score for r in matching.headed(df, "t", pattern).collect()} == {t: s for t, s in ratio.items() if s >= matching.HEADER}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def best_words(words, keys, rows, columns):
    """grid_cells by brute force: words of (doc, part, r, c, page, seq, value, conf)."""
    out = {}
    for key in {w[:keys] for w in words}:
        for r in range(rows):
            for c in range(columns):
                here = sorted((w for w in words if w[:keys] == key and w[2:4] == (r, c)), key=lambda w: w[4:6])
                digits = [w for w in here if w[6] is not None and w[6].isdigit()]
                best = digits[0] if digits else here[-1] if here else None
                out[(*key, r, c)] = (best[6], -1.0 if best[7] is None else best[7]) if best else (None, -1.0)
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("keys", [["doc"], ["doc", "part"]])
def test_grid_cells_by_brute_force(spark, seed, keys):
    """Crowded, empty and outside places, null values, keys, places and confidences, and a table with words outside only."""
    rng = random.Random(seed)
    places = [(rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice([-1, 0, 1, 2, 3, 5, None]), rng.choice([-2, 0, 1, 2, 3, None])) for _ in range(60)]
    words = [(*p, i % 2, i, rng.choice(["7", "12", "a", "x1", "", None]), rng.choice([0.5, 0.9, None])) for i, p in enumerate(places)]
    words += [("far", "x", 9, 9, 0, 1, "5", 0.9), ("far", "x", 0, -1, 0, 2, "6", 0.9), ("full", "x", 2, 2, 1, 1, "a", 0.8), ("full", "x", 2, 2, 1, 2, "b", 0.7)]
    df = spark.createDataFrame(words, "doc string, part string, r int, c int, page int, seq int, value string, conf double")
    if len(keys) == 1:
        words = [(w[0], None, *w[2:]) for w in words]
    got = grid.grid_cells(df, keys, 4, 3, ["page", "seq"])
    assert [t for _, t in got.dtypes] == ["string"] * len(keys) + ["int", "int", "string", "double"]
    found = got.collect()
    assert {tuple(r[:-2]): tuple(r[-2:]) for r in found} == best_words(words, len(keys), 4, 3)
    assert len(found) == 12 * len({w[: len(keys)] for w in words})


def test_grid_cells_stay_where_they_are_dealt(spark):
    """Rows of a column, of two tables; words dealt out by a key are not shuffled again; no rows, no grid."""
    df = spark.createDataFrame([("a", "p", 0, 1, 1, "4", 0.9), ("a", "q", 1, 0, 1, "5", 0.9), ("a", "none", 0, 0, 1, "5", 0.9)], "doc string, part string, r int, c int, seq int, value string, conf double")
    heights = F.create_map(F.lit("p"), F.lit(1), F.lit("q"), F.lit(2))
    got = grid.grid_cells(df.repartition(3, "doc").dropDuplicates(["doc", "part", "seq"]), ["doc", "part"], heights[F.col("part")], 2, ["seq"])
    assert plan_of(got).count("Exchange") == 1
    assert {(r.part, r.r, r.c): r.raw for r in got.collect()} == {("p", 0, 0): None, ("p", 0, 1): "4", ("q", 0, 0): None, ("q", 0, 1): None, ("q", 1, 0): "5", ("q", 1, 1): None}


@pytest.mark.parametrize("name", ["grd1_grd2_grid_cells", "job7_words_to_tables"])
def test_words_of_cells_take_one_pass(spark, name):
    assert plan_of(queries.QUERIES[name](spark, SF)).count("FileScan") == 1


@pytest.mark.parametrize("name", ["grd1_grd2_grid_cells", "job7_words_to_tables", "val4_rows_checked", "val5_val7_verdicts_rows_first", "val8_verdicts_columns_first"])
def test_order_lines_are_dealt_out_once(spark, monkeypatch, name):
    """One pass over the lines, one shuffle, as many tasks as the counted rows need."""
    plain = queries.QUERIES[name](spark, SF)
    monkeypatch.setattr(queries, "TASK_LINES", 500)
    df = queries.QUERIES[name](spark, SF)
    tasks = spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500 + 1
    plan = plan_of(df)
    assert plan.count("Exchange") == 1 and "hashpartitioning(l_orderkey" in plan and f", {tasks})" in plan and plan.count("FileScan") == 1
    assert df.rdd.getNumPartitions() == tasks
    assert sorted(df.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("order", ["rows_first", "columns_first"])
def test_rows_are_known_by_one_window(spark, order):
    """One window of the tables and one of their rows."""
    df = cells(spark, [[1, 2, 3], [4, 5, 9], [5, 7, 12]])
    for got in (validate.rows_checked(df), validate.verdicts(df, 1, order)):
        assert plan_of(got).count("Window [") == 2


@pytest.mark.parametrize("repair", [False, True])
def test_checks_sort_cells_once(spark, repair):
    """The windows of tables and of rows share one sort."""
    df = cells(spark, [[1, 2, 3], [4, 5, 9], [5, 7, 12]])
    for got in (validate.rows_checked(df, repair), validate.verdicts(df, 1, repair=repair)):
        assert plan_of(got).count("Sort [") == 1
