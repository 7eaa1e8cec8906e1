"""Checks and repair of tables with totals, on long cells (doc, table, r, c, value, conf) or on arrays.

The last column holds the row totals. total_back says how far the total row is from the end: 2
where a prior year's row follows it, 1 where it is the last.

Long cells are checked with windows that share one partitioning by (doc, table). A table that comes
as arrays is checked as one value, an array of rows (r, cells) with cells (c, value, conf): sums, repair
and verdict are folds over it and take no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["doc", "table"]
#: Confidence limits of text, repair and warning.
TEXT_LOW, REPAIR_LOW, WARN_LOW = 0.5, 0.7, 0.8


def cleaned(cells: DataFrame) -> DataFrame:
    """Cells (.., raw, conf) with value and issue: empty or non-digit is 0, low confidence only warned of."""
    digits = F.coalesce(F.col("raw").rlike("^[0-9]+$"), F.lit(False))
    issue = F.when(F.col("raw").isNull(), "Empty_cell").when(~digits, "Invalid_digit").when(F.col("conf") < WARN_LOW, "Unconfident_cell")
    return cells.withColumn("value", F.when(digits, F.col("raw").cast("int")).otherwise(F.lit(0))).withColumn("issue", issue)


def _sized(cells: DataFrame) -> DataFrame:
    # In order of r, so that the windows of rows find the cells sorted as they need them.
    w = Window.partitionBy(*KEY).orderBy("r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return cells.withColumn("_h", F.max("r").over(w)).withColumn("_w", F.max("c").over(w))


def _rows(cells: DataFrame, repair: bool, allow_negative: bool) -> DataFrame:
    """rows_checked with the table's last row and column, _h and _w, and each value as it came, _came."""
    row = Window.partitionBy(*KEY, "r")
    total = F.col("c") == F.col("_w")
    low = F.coalesce(F.col("conf") < REPAIR_LOW, F.lit(False))
    # All that is known of a row comes from one window; of a single cell of low confidence, its column and value too.
    known = {"_sum": F.coalesce(F.sum(F.when(~total, F.col("value"))).over(row), F.lit(0)), "_total": F.max(F.when(total, F.col("value"))).over(row)}
    if repair:
        known |= {"_low": F.sum(low.cast("int")).over(row), "_at": F.max(F.when(low, F.col("c"))).over(row), "_value": F.max(F.when(low, F.col("value"))).over(row)}
    got = _sized(cells).withColumn("_came", F.col("value")).withColumns(known)
    adds = F.coalesce(F.col("_sum") == F.col("_total"), F.lit(False))
    if not repair:
        return got.withColumn("row_valid", adds).withColumn("repaired", F.lit(False)).drop(*known)
    new = F.when(F.col("_at") == F.col("_w"), F.col("_sum")).otherwise(F.col("_total") - F.col("_sum") + F.col("_value"))
    fixes = ~adds & (F.col("_low") == 1) & new.isNotNull()
    if not allow_negative:
        fixes = fixes & (new >= 0)
    got = got.withColumn("repaired", fixes & low).withColumn("row_valid", adds | fixes)
    return got.withColumn("value", F.when(F.col("repaired"), new).otherwise(F.col("value")).cast("long")).drop(*known)


def rows_checked(cells: DataFrame, repair: bool = True, allow_negative: bool = True) -> DataFrame:
    """cells with row_valid and repaired.

    With repair, a row that doesn't add up and has exactly one cell of low confidence (its total
    included) gets the value that balances it. conf stays as it was.
    """
    return _rows(cells, repair, allow_negative).drop("_h", "_w", "_came")


def _columns(sized: DataFrame, value: str, total_back: int, *more: Column) -> DataFrame:
    """(doc, table, c, col_valid, ..): whether the rows above the total row add up to it."""
    at = F.col("_h") - (total_back - 1)
    upper = F.coalesce(F.sum(F.when(F.col("r") < at, F.col(value))), F.lit(0))
    return sized.groupBy(*KEY, "c").agg(F.coalesce(upper == F.max(F.when(F.col("r") == at, F.col(value))), F.lit(False)).alias("col_valid"), *more)


def columns_checked(cells: DataFrame, total_back: int = 2) -> DataFrame:
    """(doc, table, c, col_valid): whether the rows above the total row add up to it."""
    return _columns(_sized(cells), "value", total_back)


def verdicts(cells: DataFrame, total_back: int = 2, order: str = "rows_first", repair: bool = True, allow_negative: bool = True) -> DataFrame:
    """(doc, table, rows_ok, cols_ok, part_ok, only_last_col, status) of each table.

    order: columns are checked on repaired cells (rows_first) or on the cells as they came
    (columns_first). part_ok forgives the last row; only_last_col: all fine but the last column.
    """
    # A table's rows, columns and verdict are all grouped within its one shuffle.
    fixed = _rows(cells, repair, allow_negative)
    last_row, last_column = F.col("r") == F.col("_h"), F.col("c") == F.col("_w")
    cols = _columns(
        fixed,
        "value" if order == "rows_first" else "_came",
        total_back,
        F.every("row_valid").alias("rows_ok"),
        F.every(F.col("row_valid") | last_row).alias("rows_part"),
        F.any_value("_w").alias("_w"),
    )
    got = cols.groupBy(*KEY).agg(
        F.every("rows_ok").alias("rows_ok"), F.every("rows_part").alias("rows_part"), F.every("col_valid").alias("cols_ok"), F.every(F.col("col_valid") | last_column).alias("others_ok")
    )
    only = F.col("rows_ok") & F.col("others_ok") & ~F.col("cols_ok")
    status = F.when(F.col("rows_ok") & F.col("cols_ok"), "Valid").when(only, "Valid, invalid sum").otherwise("Invalid")
    return got.select(*KEY, "rows_ok", "cols_ok", (F.col("rows_part") & F.col("cols_ok")).alias("part_ok"), only.alias("only_last_col"), status.alias("status"))


def matrix_rows(matrix: Column, conf: Column) -> Column:
    """Rows (r, cells) of an array of arrays and the confidences of the same places."""
    cell = lambda r: lambda v, c: F.struct(c.alias("c"), v.cast("long").alias("value"), F.get(F.get(conf, r), c).alias("conf"))
    return F.transform(matrix, lambda row, r: F.struct(r.alias("r"), F.transform(row, cell(r)).alias("cells")))


def rows_matrix(rows: Column) -> Column:
    """The values of rows as an array of arrays."""
    return F.transform(rows, lambda t: F.transform(t.cells, lambda x: x.value))


def last_column(rows: Column) -> Column:
    """The number of the totals' column."""
    return F.array_max(F.transform(rows, lambda t: F.element_at(t.cells, -1).c))


def _value(cells: Column, c: Column) -> Column:
    """The value at a column: at its place where the row is whole, else searched for."""
    there = F.get(cells, c.cast("int"))
    return F.when(there.c == c, there.value).otherwise(F.get(F.filter(cells, lambda x: x.c == c), 0).value)


def balanced(rows: Column, w: Column, repair: bool = True, allow_negative: bool = True) -> Column:
    """Rows (r, cells, valid, at, new): whether each adds up, after repair; at and new are the column and
    value that repair has set, null without.

    With repair, a row that doesn't add up and has exactly one cell of low confidence (its total
    included) gets the value that balances it.
    """
    long = F.lit(None).cast("long")
    number = lambda x: F.coalesce(x.value, F.lit(0))
    sums = F.transform(
        rows,
        lambda t: F.struct(
            t.r.alias("r"),
            t.cells.alias("cells"),
            F.aggregate(t.cells, F.lit(0).cast("long"), lambda a, x: a + F.when(x.c < w, number(x)).otherwise(0)).alias("sum"),
            F.aggregate(t.cells, long, lambda a, x: F.when(x.c == w, x.value.cast("long")).otherwise(a)).alias("total"),
            F.filter(t.cells, lambda x: x.conf < REPAIR_LOW).alias("low") if repair else F.lit(None).alias("low"),
        ),
    )
    adds = lambda t: F.coalesce(t["sum"] == t.total, F.lit(False))
    if not repair:
        return F.transform(sums, lambda t: F.struct(t.r.alias("r"), t.cells.alias("cells"), adds(t).alias("valid"), F.lit(None).cast("int").alias("at"), long.alias("new")))

    def mended(t: Column) -> Column:
        one = F.get(t.low, 0)
        new = F.when(one.c == w, t["sum"]).otherwise(t.total - t["sum"] + number(one))
        fixes = ~adds(t) & (F.size(t.low) == 1) & new.isNotNull()
        if not allow_negative:
            fixes = fixes & (new >= 0)
        return F.struct(t.r.alias("r"), t.cells.alias("cells"), (adds(t) | fixes).alias("valid"), F.when(fixes, one.c).cast("int").alias("at"), F.when(fixes, new).alias("new"))

    return F.transform(sums, mended)


def mended_rows(rows: Column) -> Column:
    """Rows (r, cells) of balanced rows with the repaired values in their places."""
    cell = lambda t: lambda x: F.struct(x.c.alias("c"), F.when(x.c == t["at"], t.new).otherwise(x.value.cast("long")).alias("value"), x.conf.alias("conf"))
    return F.transform(rows, lambda t: F.struct(t.r.alias("r"), F.transform(t.cells, cell(t)).alias("cells")))


def columns_valid(rows: Column, total_back: int, mended: bool = False) -> Column:
    """(c, valid) of each column: whether the rows above the total row add up to it.

    mended: of balanced rows, with their repaired values.
    """
    at = F.element_at(rows, -1).r - (total_back - 1)
    value = lambda t, c: F.when(t["at"] == c, t.new).otherwise(_value(t.cells, c)) if mended else _value(t.cells, c)
    upper = lambda c: F.aggregate(rows, F.lit(0).cast("long"), lambda a, t: a + F.when(t.r < at, F.coalesce(value(t, c), F.lit(0))).otherwise(0))
    whole = lambda c: F.aggregate(rows, F.lit(None).cast("long"), lambda a, t: F.when(t.r == at, value(t, c)).otherwise(a))
    every = F.array_sort(F.array_distinct(F.flatten(F.transform(rows, lambda t: F.transform(t.cells, lambda x: x.c)))))
    return F.transform(every, lambda c: F.struct(c.alias("c"), F.coalesce(upper(c) == whole(c), F.lit(False)).alias("valid")))


def verdict(rows: Column, columns: Column, w: Column) -> Column:
    """struct(rows_ok, cols_ok, part_ok, only_last_col, status) of balanced rows and valid columns.

    part_ok forgives the last row; only_last_col: all fine but the last column.
    """
    last = F.element_at(rows, -1).r
    rows_ok, cols_ok = F.forall(rows, lambda t: t.valid), F.forall(columns, lambda x: x.valid)
    part = F.forall(rows, lambda t: t.valid | (t.r == last)) & cols_ok
    only = rows_ok & F.forall(columns, lambda x: x.valid | (x.c == w)) & ~cols_ok
    status = F.when(rows_ok & cols_ok, "Valid").when(only, "Valid, invalid sum").otherwise("Invalid")
    return F.struct(rows_ok.alias("rows_ok"), cols_ok.alias("cols_ok"), part.alias("part_ok"), only.alias("only_last_col"), status.alias("status"))


def judged(tables: DataFrame, rows: str, total_back: int, order: str = "rows_first", repair: bool = True, allow_negative: bool = True) -> DataFrame:
    """tables with ``balanced``, the rows of the column ``rows`` after repair, and ``verdict``, in one pass.

    order: columns are checked on repaired cells (rows_first) or on the cells as they came
    (columns_first).
    """
    got = tables.withColumn("_w", last_column(F.col(rows))).withColumn("balanced", balanced(F.col(rows), F.col("_w"), repair, allow_negative))
    got = got.withColumn("_columns", columns_valid(F.col("balanced"), total_back, mended=order == "rows_first"))
    return got.withColumn("verdict", verdict(F.col("balanced"), F.col("_columns"), F.col("_w"))).drop("_w", "_columns")


def grand_total_repaired(cells: DataFrame, total_back: int = 2, compat: bool = False) -> DataFrame:
    """cells whose grand total is set where the row totals and the column totals agree on it, with total_set.

    compat keeps two slips of older tools: the last row before the total is left out of the sum, and
    the row that is second to last is always the one written.
    """
    w = Window.partitionBy(*KEY)
    at = F.col("_h") - (1 if compat else total_back - 1)
    upto = F.col("_h") - 2 if compat else at
    got = _sized(cells)
    got = got.withColumn("_down", F.coalesce(F.sum(F.when((F.col("r") < upto) & (F.col("c") == F.col("_w")), F.col("value"))).over(w), F.lit(0)))
    got = got.withColumn("_across", F.coalesce(F.sum(F.when((F.col("r") == at) & (F.col("c") < F.col("_w")), F.col("value"))).over(w), F.lit(0)))
    sets = (F.col("_down") == F.col("_across")) & (F.col("r") == at) & (F.col("c") == F.col("_w"))
    got = got.withColumn("total_set", sets).withColumn("value", F.when(sets, F.col("_down")).otherwise(F.col("value")).cast("long"))
    return got.drop("_h", "_w", "_down", "_across")


def margins(cells: DataFrame, total_back: int = 2) -> DataFrame:
    """(doc, table, diff): how far the row totals and the column totals are at most from the whole."""
    at = F.col("_h") - (total_back - 1)
    last = F.col("c") == F.col("_w")
    got = _sized(cells).groupBy(*KEY).agg(
        F.coalesce(F.sum(F.when((F.col("r") < at) & last, F.col("value"))), F.lit(0)).alias("down"),
        F.coalesce(F.sum(F.when((F.col("r") == at) & ~last, F.col("value"))), F.lit(0)).alias("across"),
        F.max(F.when((F.col("r") == at) & last, F.col("value"))).alias("whole"),
    )
    return got.select(*KEY, F.greatest(F.abs(F.col("down") - F.col("whole")), F.abs(F.col("across") - F.col("whole"))).alias("diff"))


def margin_histogram(diffs: DataFrame) -> DataFrame:
    """(table, diff, files) of the differences that are not 0."""
    return diffs.where("diff <> 0").groupBy("table", "diff").agg(F.count("*").alias("files"))


def text_status(confidences: str | Column, limit: float = TEXT_LOW) -> Column:
    """struct(valid, status) of a list of confidences; the first, a caption's, doesn't count."""
    c = F.col(confidences) if isinstance(confidences, str) else confidences
    empty = F.coalesce(F.size(c), F.lit(0)) < 2
    low = F.exists(F.slice(c, 2, F.greatest(F.size(c), F.lit(1))), lambda x: x < limit)
    return F.when(empty, F.struct(F.lit(True).alias("valid"), F.lit("empty_content").alias("status"))).otherwise(
        F.struct((~low).alias("valid"), F.when(low, F.lit("low_confidence")).otherwise(F.lit("")).alias("status"))
    )


def not_exactly_one(flags: list[str]) -> F.Column:
    """Whether other than exactly one of the flags is true; null counts as false."""
    return sum((F.coalesce(F.col(f"`{f}`"), F.lit(False)).cast("int") for f in flags), F.lit(0)) != 1
