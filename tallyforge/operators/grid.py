"""Recognised words into fields, lines and table cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage

#: Margin of a page, row height of form 1, both in pixels at half the page size.
PADDING, ROW_HEIGHT = 45, 25
# Names of table parts and of fields.
_PART = r".+_section_table_(a1|a2|a3|b|c)$"
_FIELD = r".*_section_([a-zA-Z]+)_([a-zA-Z0-9_]+)"
#: Tiles double twice from level to level: sides of 4**level, from the least to the greatest, which is one tile.
TILE_BASE, LEAST_LEVEL, WHOLE_LEVEL = 4.0, -10, 24


def _level(extent: Column) -> Column:
    """The level whose tiles are just as large as an extent, so that it meets two of them, or three."""
    level = F.ceil(F.log(F.greatest(extent, F.lit(TILE_BASE**LEAST_LEVEL))) / F.log(F.lit(TILE_BASE)))
    return F.least(level, F.lit(WHOLE_LEVEL)).cast("int")


def _tile(at: Column, level: Column) -> Column:
    return F.when(level == WHOLE_LEVEL, F.lit(0)).otherwise(F.floor(at / F.pow(F.lit(TILE_BASE), level))).cast("long")


def in_rectangles(words: DataFrame, layout: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """words (x, y, ..) with the section and field of every rectangle that holds the point, edges included.

    layout: (x1, x2, y1, y2, section, field) of any number of rectangles and any sizes. on: columns of both,
    such as the form or page, that must be equal.

    A bucket index: by its width and height a rectangle gets a level in each direction, and it is listed
    under the few tiles of that level that it touches. A point lies in one tile of each pair of levels
    that the layout has, a few for usual layouts. Equal tiles are joined, then the exact test decides.
    The index of a layout is broadcast if its counted rows fit; beyond that it is shuffled by tile. Points
    and rectangles with a null or not-a-number edge, and rectangles whose ends are reversed, match nothing.
    """
    levels = ["_lx", "_ly"]
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    boxes = layout.where((F.col("x1") <= F.col("x2")) & (F.col("y1") <= F.col("y2")) & known("x1") & known("x2") & known("y1") & known("y2"))
    boxes = boxes.withColumns({f"_l{d}": _level(F.col(f"{d}2") - F.col(f"{d}1")) for d in "xy"})
    present = [tuple(r) for r in boxes.select(*levels).distinct().collect()]  # a few numbers, whatever the layout
    for d in "xy":
        level = F.col(f"_l{d}")
        boxes = boxes.withColumn(f"_t{d}", F.explode(F.sequence(_tile(F.col(f"{d}1"), level), _tile(F.col(f"{d}2"), level))))
    pairs = F.array(*[F.struct(F.lit(x).alias("_lx"), F.lit(y).alias("_ly")) for x, y in present]) if present else F.expr("cast(array() as array<struct<_lx: int, _ly: int>>)")
    points = words.where(known("x") & known("y")).withColumn("_pair", F.explode(pairs)).select("*", "_pair._lx", "_pair._ly").drop("_pair")
    points = points.withColumns({f"_t{d}": _tile(F.col(d), F.col(f"_l{d}")) for d in "xy"})
    inside = F.col("x").between(F.col("x1"), F.col("x2")) & F.col("y").between(F.col("y1"), F.col("y2"))
    tiles = [*on, *levels, "_tx", "_ty"]
    return points.join(storage.small_or_shuffled(boxes), tiles).where(inside).select(*words.columns, *[c for c in layout.columns if c not in (*on, "x1", "x2", "y1", "y2")])


def positions(words: DataFrame, rows: int | Column, columns: int, row_height: float | None = ROW_HEIGHT, padding: float = PADDING) -> DataFrame:
    """words with r and c: the cell at the box's midpoint. row_height None: the page in equal rows.

    rows: the table's rows, or a column of them where tables differ.

    Rows beyond the last count as the last. Positions outside the grid stay as they are.
    """
    w, h = F.col("page_w") / 2, F.col("page_h") / 2
    x = (F.col("x0") + F.col("x1")) * w / 2 - padding
    y = (F.col("y0") + F.col("y1")) * h / 2 - padding
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    height = F.lit(float(row_height)) if row_height is not None else (h - 2 * padding) / rows
    c = F.floor(x / ((w - 2 * padding) / columns)).cast("int")
    r = F.least(F.floor(y / height).cast("int"), rows - 1)
    return words.withColumn("r", r).withColumn("c", c)


def outside(placed: DataFrame, columns: int) -> DataFrame:
    """Words that fell outside the grid."""
    return placed.where((F.col("r") < 0) | (F.col("c") < 0) | (F.col("c") >= columns))


def grid_cells(placed: DataFrame, keys: list[str], rows: int | Column, columns: int, order: list[str]) -> DataFrame:
    """(keys, r, c, raw, conf), every position of the grid. rows: a number, or a column made of keys.

    The first word of digits wins; without one, the last word. Untouched positions have a null raw
    and the confidence -1.

    A table's words are sorted once, by position and rank there. Each winner yields its position and the empty ones
    before it, the last word those behind it. Words that are already dealt out by some of the keys stay where they are.
    """
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    inside = F.col("r").between(F.lit(0), rows - 1) & F.col("c").between(0, columns - 1)
    digits = F.coalesce(F.col("value").rlike("^[0-9]+$"), F.lit(False))
    at = F.coalesce(F.when(inside, F.col("r") * columns + F.col("c")), F.lit(-1))  # words outside come first
    words = placed.select(*keys, *order, "value", "conf", digits.alias("_digits"), at.alias("_at"))
    ranks = [F.when(F.col("_digits"), F.col(o)).asc() for o in order] + [F.when(~F.col("_digits"), F.col(o)).desc() for o in order]
    table = Window.partitionBy(*keys).orderBy("_at", F.desc("_digits"), *ranks)
    got = words.withColumns({"_before": F.coalesce(F.lag("_at").over(table), F.lit(-1)), "_after": F.lead("_at").over(table)})
    first = F.when(F.col("_before") < F.col("_at"), F.col("_before")).otherwise(F.col("_at")) + 1
    last = F.when(F.col("_after").isNull(), rows * columns - 1).otherwise(F.col("_at"))
    got = got.where(first <= last).select(*keys, "value", "conf", "_at", F.explode(F.sequence(first, last)).alias("_place"))
    place, here = F.col("_place"), F.col("_place") == F.col("_at")
    r, c = F.floor(place / columns).cast("int").alias("r"), (place % columns).cast("int").alias("c")
    return got.select(*keys, r, c, F.when(here, F.col("value")).alias("raw"), F.coalesce(F.when(here, F.col("conf")), F.lit(-1.0)).alias("conf"))


def lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, line_text, conf): words joined by blanks in order of word_seq, and their mean confidence."""
    items = F.array_sort(F.collect_list(F.struct("word_seq", "value")))
    return words.groupBy(*keys).agg(F.array_join(F.transform(items, lambda s: s.value), " ").alias("line_text"), F.avg("conf").alias("conf"))


def routed(cells: DataFrame, name: str) -> DataFrame:
    """cells with section, field (of ``.._section_<section>_<field>``) and table_part (of table parts)."""
    part = F.regexp_extract(name, _PART, 1)
    section = F.regexp_extract(name, _FIELD, 1)
    field = F.regexp_extract(name, _FIELD, 2)
    empty = lambda c: F.when(c != "", c)
    return cells.withColumn("section", empty(section)).withColumn("field", empty(field)).withColumn("table_part", empty(part))
