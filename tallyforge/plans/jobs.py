"""The user-level jobs, from extracted records to validated, enriched and protected tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas, storage
from ..functions import text
from ..operators import dedup, enrich, grid, logs, matching, reshape, validate


#: Form-1 records that one task turns into rows, about.
TASK_RECORDS = 8192


def records_by_field(fields: DataFrame, ids: dict[str, str], keys: tuple[str, ...] = ("doc",)) -> DataFrame:
    """One row for each document with the raw content of the named fields, looked up by id."""
    return fields.groupBy(*keys).agg(*[F.max(F.when(F.col("id") == i, F.col("content"))).alias(n) for n, i in ids.items()])


def sorted_forms(fields: DataFrame) -> DataFrame:
    """(doc, fields) of fields (doc, id, ..): each form's fields as one array in the order of their ids."""
    return fields.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("id", *[c for c in fields.columns if c not in ("doc", "id")]))).alias("fields"))


def _answer(column: str) -> F.Column:
    return text.second_or_empty(F.from_json(column, "array<string>"))


_MATRIX = "array<array<int>>"
_FORM1 = {
    "type_of_report": "a-TYPE_OF_REPORT",
    "employer_name": "b-EMPLOYER",
    "state": "b-STATE",
    "city": "b-CITY_TOWN",
    "headquarter_state": "c-STATE",
    "headquarter_city": "c-CITY_TOWN",
    "EIN": "d-EIN",
    "zipcode": "b-ZIPCODE",
    "headquarter_zipcode": "c-ZIP_STATE",
    "_naics": "g-NAICS",
    "_year": "h-CURRENT_YEAR_REPORTING_TOTAL_LABEL",
    "_table": "h-TABLE",
}
_FORM5 = {"state": "b-STATE", "county": "b-COUNTY", "city": "b-CITY", "zipcode": "b-ZIPCODE", "_year": "title-OE_NUM_AND_YEAR", "table_a": "table-A", "table_b": "table-B", "table_c": "table-C", "_flags": "a-TYPE_OF_AGENCY"}


def extract_form1(fields: DataFrame, names: DataFrame, zips: DataFrame, state: str = "MA") -> DataFrame:
    """Form-1 records of fields (doc, id, content): consolidated reports and other states left out.

    names: (code, title) of industries; zips: (zip) of the state. doc is the file's path.
    """
    raw = records_by_field(fields, _FORM1)
    got = raw.select("doc", "_table", "_year", "_naics", *[_answer(c).alias(c) for c in _FORM1 if c[0] != "_"])
    got = matching.unlike(got, "type_of_report")
    got = got.withColumn("NAICS", text.first_digits(_answer("_naics")))
    got = enrich.name_join(got, "NAICS", names, "code", "title", "NAICS_name")
    got = got.withColumn("filename", text.document_key(F.col("doc")))
    got = got.withColumn("reporting_year", text.year(F.coalesce(F.get(F.from_json("_year", "array<string>"), 0), F.lit(""))))
    got = got.withColumn("table", F.from_json("_table", _MATRIX))
    got = enrich.relevant(got, state, ["state", "headquarter_state"], ["zipcode", "headquarter_zipcode"], zips)
    return got.select(*schemas.FORM1.names)


def extract_form5(fields: DataFrame) -> DataFrame:
    """Form-5 records of fields (doc, id, content)."""
    raw = records_by_field(fields, _FORM5)
    flags = F.from_json("_flags", "map<string,boolean>")
    got = raw.select(
        text.document_key(F.col("doc")).alias("filename"),
        _answer("state").alias("state"),
        F.upper(_answer("county")).alias("county"),
        _answer("city").alias("city"),
        _answer("zipcode").alias("zipcode"),
        text.year(_answer("_year")).cast("string").alias("reporting_year"),
        *[F.from_json(t, _MATRIX).alias(t) for t in schemas.FORM5_TABLES],
        *[F.coalesce(flags[f], F.lit(False)).alias(f) for f in schemas.AGENT_FLAGS],
    )
    return got.select(*[f"`{n}`" for n in schemas.FORM5.names])


def wide_rows(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Form-1 records as rows by job category, summed over all records by their 11 keys, and the rejects.

    Rejects are records whose table is not 12 by 15.
    """
    shape = (F.size("table") == len(schemas.JOB_CATEGORIES)) & F.forall("table", lambda r: F.size(r) == len(schemas.FORM1_COLUMNS))
    good = F.coalesce(shape, F.lit(False))
    keys = {"State": "state", "City": "city", "Headquarter State": "headquarter_state", "Headquarter City": "headquarter_city", "NAICS": "NAICS", "Year": "reporting_year", "NAICS Name": "NAICS_name", "zip code": "zipcode", "HQ zip code": "headquarter_zipcode", "filename": "filename"}
    # Dealt out by the keys before each record becomes 12 rows, so that no task sums up more than its share.
    dealt = storage.dealt(records.where(good).select(*[F.col(v).alias(k) for k, v in keys.items()], "table"), TASK_RECORDS, *[f"`{k}`" for k in keys])
    rows = dealt.select(*[f"`{k}`" for k in keys], F.posexplode("table").alias("_r", "_row"))
    rows = rows.withColumn("JobCategory", F.get(F.array(*[F.lit(j) for j in schemas.JOB_CATEGORIES]), F.col("_r")))
    sums = [F.sum(F.get("_row", i)).alias(c) for i, c in enumerate(schemas.FORM1_COLUMNS)]
    return rows.groupBy(*schemas.FORM1_KEYS).agg(*sums), records.where(~good)


def enrich_forms(wide: DataFrame, industries: DataFrame, counties: DataFrame, cities: DataFrame, county_mode: str = "fanout", duplicates: str = "raise") -> DataFrame:
    """Wide rows with industry, organisation size and its quartile, zip and county; summary rows left out.

    The county comes from the zip table, else from the cities that list the zip.
    """
    got = enrich.prefix_join(wide, "NAICS", industries, "code", "title", "NAICS_label")
    got = got.where(~F.col("JobCategory").isin(*schemas.SUMMARY_JOBS))
    got = enrich.total_by(got, ["filename"], schemas.TOTAL, "Organizational Size")
    got = enrich.size_bins(got, "Organizational Size", "Organizational Size Binned", duplicates=duplicates)
    got = got.withColumn("zip5", text.zip5(enrich.zip_by_state(F.col("State"), F.col("zip code"), F.col("HQ zip code"))))
    got = enrich.county_join(got, "zip5", counties, county_mode)
    other = reshape.explode_zips(cities, "zips", "zip5").select("zip5", F.col("county_name").alias("_other"))
    got = got.join(other, "zip5", "left")
    return got.withColumn("County Name", text.fill(F.col("county_name"), F.col("_other"))).drop("county_name", "_other")


def form1_long(wide: DataFrame, dims: list[str]) -> DataFrame:
    """(dims.., Race, Gender, Count) of wide rows."""
    long = reshape.melt(wide.select(*[f"`{d}`" for d in dims], *[f"`{c}`" for c in schemas.FORM1_COLUMNS[:-1]]), dims, schemas.FORM1_COLUMNS[:-1], "_label", "Count")
    return reshape.split_labels(long, "_label", ["Race", "Gender"], " ")


def flatten_form5(records: DataFrame, include_new_hires: bool = True) -> DataFrame:
    """(filename, county, Type of Agent, Work Type, Job Category, Race, Gender, Count) of form-5 records.

    Totals are left out. The new hires are a part of the full-time staff and may be left out.
    """
    rows = records.withColumn("Type of Agent", reshape.last_flag(schemas.AGENT_FLAGS))
    parts = []
    for table, (kind, names) in schemas.FORM5_TABLES.items():
        if table == "table_c" and not include_new_hires:
            continue
        cells = reshape.matrix_cells(rows, ["filename", "county", "Type of Agent"], table)
        cells = reshape.without_totals(cells, len(names), len(schemas.RACE_GENDER))
        named = reshape.named_cells(cells, names, schemas.FORM5_COLUMNS)
        race, gender = text.split_label(F.col("column_name"), "_", 2)
        parts.append(named.select("filename", "county", "Type of Agent", F.lit(kind).alias("Work Type"), F.col("row_name").alias("Job Category"), race.alias("Race"), gender.alias("Gender"), F.col("value").alias("Count")))
    return reduce(DataFrame.unionByName, parts)


#: Ids of a form's table, of its checkboxes, of its place and of its year.
_TABLE, _CHECKBOX, _CITY, _STATE, _YEAR = "h-TABLE", "E-AND_F", "b-CITY_TOWN", "b-STATE", "h-CURRENT_YEAR_REPORTING_TOTAL_LABEL"


def checked_forms(fields: DataFrame, places: DataFrame) -> DataFrame:
    """One row for each form of fields (doc, at, id, content, confidence): its verdicts, and its fields rewritten.

    (doc, text_ok, table_ok, table_part_ok, city, state, place_matched, missing_location, year,
    fields array of (at, id, content, confidence)). at: the field's place in the form; without it fields
    are in the order of their ids, and the result has places from 0. places: (city, state), cities in upper case.

    The table is checked by columns as it came, then by rows with repair. The repaired table and
    the corrected place are put back where they came from; all other fields stay as they were. A form is
    one row, so that the checks take one shuffle, by form; of fields of one id the first is meant.
    """
    order = [c for c in ("at", "id", "content", "confidence") if c in fields.columns]
    every = F.array_sort(F.collect_list(F.struct(*order, F.from_json("confidence", "array<double>").alias("c"))))
    placed = lambda f, i: F.struct(i.alias("at"), *[f[n].alias(n) for n in ("id", "content", "confidence", "c")])
    forms = fields.groupBy("doc").agg(F.transform(every, placed).alias("_all"))
    first = lambda i: F.get(F.filter("_all", lambda f: f.id == i), 0)
    forms = forms.withColumns({f"_{n}": first(i) for n, i in (("table", _TABLE), ("city", _CITY), ("state", _STATE), ("year", _YEAR))})
    texts = lambda n: F.from_json(F.col(f"_{n}.content"), "array<string>")
    forms = forms.withColumns({f"_{n}s": texts(n) for n in ("city", "state", "year")})
    forms = forms.withColumn("_rows", validate.matrix_rows(F.from_json("_table.content", _MATRIX), F.from_json("_table.confidence", "array<array<double>>")))
    got = validate.judged(forms, "_rows", 2, "columns_first")
    lacks = lambda n: F.coalesce(F.size(f"_{n}s"), F.lit(0)) < 2
    got = got.select(
        "doc",
        F.forall(F.filter("_all", lambda f: ~f.id.isin(_TABLE, _CHECKBOX)), lambda f: validate.text_status(f.c).getField("valid")).alias("text_ok"),
        F.coalesce(F.col("verdict.rows_ok") & F.col("verdict.cols_ok"), F.lit(True)).alias("table_ok"),
        F.coalesce("verdict.part_ok", F.lit(True)).alias("table_part_ok"),
        text.second_or_empty(F.col("_citys")).alias("city"),
        text.second_or_empty(F.col("_states")).alias("state"),
        (lacks("city") | lacks("state")).alias("missing_location"),
        F.when(F.col("_year").isNotNull(), text.year(F.coalesce(F.get("_years", 0), F.lit("")))).alias("year"),
        F.to_json(validate.rows_matrix(validate.mended_rows(F.col("balanced")))).alias("_mended"),
        *["_all", "_citys", "_states", "_table", "_city", "_state"],
    )
    got = matching.corrected_pairs(got, "city", "state", places).withColumnRenamed("matched", "place_matched")
    moved = lambda n: F.to_json(F.transform(f"_{n}s", lambda x, i: F.when(i == 1, F.col(n)).otherwise(x)))
    got = got.withColumns({"_new_city": moved("city"), "_new_state": moved("state")})
    moves = F.col("place_matched") & ~F.col("missing_location")

    def rewritten(f: F.Column) -> F.Column:
        new = F.when(f["at"] == F.col("_table.at"), F.coalesce("_mended", f.content))
        new = new.when((f["at"] == F.col("_city.at")) & moves, F.col("_new_city")).when((f["at"] == F.col("_state.at")) & moves, F.col("_new_state"))
        return F.struct(f["at"].alias("at"), f.id.alias("id"), new.otherwise(f.content).alias("content"), f.confidence.alias("confidence"))

    names = ["doc", "text_ok", "table_ok", "table_part_ok", "city", "state", "place_matched", "missing_location", "year"]
    return got.select(*names, F.transform("_all", rewritten).alias("fields"))


def rewritten_fields(forms: DataFrame) -> DataFrame:
    """(doc, at, id, content, confidence) of checked forms, to be written back."""
    return forms.select("doc", F.inline("fields"))


def offending(forms: DataFrame) -> DataFrame:
    """(check, doc): the forms that each check has found fault with."""
    failed = {"partial_invalid": ~F.col("table_part_ok"), "invalid": ~F.col("table_ok"), "invalid_text": ~F.col("text_ok"), "missing_location": F.col("missing_location")}
    return forms.select(F.explode(F.array_compact(F.array(*[F.when(bad, F.lit(check)) for check, bad in failed.items()]))).alias("check"), "doc")


def validate_forms(fields: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, summary, years) of form-1 fields, as ``checked_forms`` takes them.

    documents: its rows without the fields; years: (year, forms).
    """
    docs = checked_forms(fields, places).drop("fields")
    summary = docs.agg(
        F.count("*").alias("forms"),
        F.count_if(~F.col("table_part_ok")).alias("partial_invalid"),
        F.count_if(~F.col("table_ok")).alias("invalid"),
        F.count_if(~F.col("text_ok")).alias("invalid_text"),
        F.count_if("missing_location").alias("missing_location"),
    )
    return docs.drop("year"), summary, docs.where("year is not null").groupBy("year").agg(F.count("*").alias("forms"))


def margin_report(records: DataFrame, form: int) -> tuple[DataFrame, DataFrame]:
    """(doc, table, diff) of every table of form-1 or form-5 records, and the histogram of non-zero differences."""
    tables = ["table"] if form == 1 else list(schemas.FORM5_TABLES)
    parts = [reshape.matrix_cells(records, ["filename"], t).select(F.col("filename").alias("doc"), F.lit(t).alias("table"), "r", "c", "value") for t in tables]
    diffs = validate.margins(reduce(DataFrame.unionByName, parts), 2 if form == 1 else 1)
    return diffs, validate.margin_histogram(diffs)


def words_to_tables(words: DataFrame, columns: int, form: int, rows: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, verdicts, rejects) of the recognised words of table cells.

    words: the schema of words, with the table's part in ``table``. rows: of form 1's table. The parts of
    form 5 have rows of their own; words of unknown parts are left out. They are put under one another
    before they are checked.
    """
    if form == 5:
        words = words.where(F.col("table").isin(*schemas.SUB_TABLES))
        heights = F.create_map(*[F.lit(x) for k, (_, height, _) in schemas.SUB_TABLES.items() for x in (k, height)])
        rows = heights[F.col("table")]
    placed = grid.positions(words, rows, columns, grid.ROW_HEIGHT if form == 1 else None)
    cells = grid.grid_cells(placed, ["doc", "table"], rows, columns, ["page", "block", "line", "word_seq"])
    if form == 5:
        cells = reshape.stack_sub_tables(cells, schemas.SUB_TABLES)
    cells = validate.cleaned(cells)
    back = 2 if form == 1 else 1
    fixed = validate.rows_checked(cells)
    return fixed, validate.verdicts(cells, back), grid.outside(placed, columns)


def log_summary(lines: DataFrame, prefix: str | None = None) -> DataFrame:
    """(logs, valid, invalid, accuracy) of lines (file, line)."""
    return logs.summary(lines, "file", "line", prefix)


def dedup_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Duplicate groups, and the list of files that a clean-up would remove."""
    found = dedup.duplicates(files)
    return found, dedup.removals(found)


def classify_files(files: DataFrame) -> DataFrame:
    return dedup.by_extension(files)
