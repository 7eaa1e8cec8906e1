"""The tables behind the reports: shares, pivots and relative sizes of contingency counts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import contingency, enrich, reshape


def hidden(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Without the categories; null stays."""
    return df.where(F.coalesce(~F.col(column).isin(*values), F.lit(True))) if values else df


def ordered(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Rows of the listed categories only, with ``position`` to sort by."""
    at = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(column))
    return df.where(at > 0).withColumn("position", at.cast("int"))


def shares(df: DataFrame, dims: list[str], count: str, within: list[str] | None = None, hide: dict[str, list[str]] | None = None, hide_after: bool = False) -> DataFrame:
    """(dims.., n, share) sums by dims and percent of the total within the columns.

    hide: categories by column, left out before the shares are taken, or after them.
    """
    for c, values in (hide or {}).items() if not hide_after else ():
        df = hidden(df, c, values)
    got = enrich.share_of(df.groupBy(*dims).agg(F.sum(count).alias("n")), "n", "share", within)
    for c, values in (hide or {}).items() if hide_after else ():
        got = hidden(got, c, values)
    return got


def count_by(df: DataFrame, column: str) -> DataFrame:
    """(column, n) rows of each category; null is none."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def relative_size(df: DataFrame, group: str, count: str, floor: float = 0.3) -> DataFrame:
    """(group, total, size): each group's total by the largest one, at least ``floor``; only positive groups."""
    got = df.groupBy(group).agg(F.sum(count).alias("total")).where("total > 0")
    # One row for each category: the window's one partition is as small as the report.
    return got.withColumn("size", F.greatest(F.lit(floor), F.col("total") / F.max("total").over(Window.partitionBy())))


def pivot_report(df: DataFrame, row: str, column: str, count: str, values: list[str], percent: bool = False) -> DataFrame:
    """(row, values.., total) and with percent each value's share of the row, in whole percent, half to even."""
    got = reshape.pivot_sum(df, [row], column, count, values)
    got = got.withColumn("total", sum((F.col(f"`{v}`") for v in values), F.lit(0)))
    for v in values if percent else ():
        got = got.withColumn(f"{v}_pct", text.whole(F.coalesce(100.0 * F.col(f"`{v}`") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))))
    return got


def sized_shares(df: DataFrame, group: str, split: str, count: str, floor: float = 0.3) -> DataFrame:
    """(group, split, n, share, total, size): how each group splits, in percent, and its relative size."""
    return shares(df, [group, split], count, [group]).join(relative_size(df, group, count, floor), group)


def ranked_pivot(df: DataFrame, row: str, column: str, count: str, values: list[str]) -> DataFrame:
    """(row, values.., total, place): rows by falling total, ties by name."""
    got = pivot_report(df, row, column, count, values)
    # One row for each category, as in relative_size.
    return got.withColumn("place", F.row_number().over(Window.partitionBy().orderBy(F.desc("total"), row)))


def selected_counts(df: DataFrame, row: str, column: str, count: str, values: list[str], keep: list[str]) -> DataFrame:
    """(row, values.., total, position) of the listed rows, with whole counts."""
    got = ordered(pivot_report(df, row, column, count, values), row, keep)
    return got.select(row, *[F.round(F.col(f"`{c}`")).cast("long").alias(c) for c in (*values, "total")], "position")


def every_table(tables: DataFrame, dims: list[str]) -> DataFrame:
    """(table_name, rows, column, n, share) of all contingency tables at once: each table's last dimension
    across, the others down, and percent of the line.

    tables: (table_name, arity, dims.., Count), null in the dimensions that a table hasn't. Which ones it has
    is known by the names that its dimensions in order give it, blanks as _, never by parts of a name.
    """
    sets = {contingency.table_name(s): list(s) for k in range(1, len(dims) + 1) for s in combinations(dims, k)}
    if len(sets) < 2 ** len(dims) - 1:
        raise ValueError("two sets of dimensions give a table the same name")
    value = {d: F.col(f"`{d}`").cast("string") for d in dims}
    # Only tables that are there; a plan of all sets would grow with 2**dims.
    there = [r[0] for r in tables.select("table_name").distinct().collect()]
    values = F.lit(None).cast("array<string>")
    for name in there:
        if name not in sets:
            raise ValueError(f"no set of dimensions gives the name {name!r}")
        values = F.when(F.col("table_name") == name, F.array(*[value[d] for d in sets[name]])).otherwise(values)
    cells = tables.select("table_name", values.alias("values"), F.col("Count").alias("n"))
    cells = cells.select("table_name", F.slice("values", 1, F.size("values") - 1).alias("rows"), F.element_at("values", -1).alias("column"), "n")
    cells = cells.groupBy("table_name", "rows", "column").agg(F.sum("n").alias("n"))
    return enrich.share_of(cells, "n", "share", ["table_name", "rows"])
