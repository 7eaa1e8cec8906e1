"""The long count cube, exact contingency tables and noisy ones derived from one another."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions import noise as N

#: Fixed value: the privacy parameter of one table.
EPSILON = 1 / 21


def cube(df: DataFrame, fields: list[str], count: str, keep_nulls: bool = False) -> DataFrame:
    """Sums by all fields. Rows with a null field are left out, or kept as a category."""
    rows = df if keep_nulls else df.na.drop(subset=fields)
    return rows.groupBy(*fields).agg(F.sum(count).alias("Count"))


def _bits(fields: list[str], present: tuple[str, ...]) -> int:
    """grouping_id() of a set: the first field is the highest bit, 1 where absent."""
    return sum(1 << (len(fields) - 1 - i) for i, f in enumerate(fields) if f not in present)


def table_name(fields: tuple[str, ...]) -> str:
    """The name of the table of these fields, in their order."""
    return "_".join(fields).replace(" ", "_")


def _table_name(fields: list[str], arity: int, gid: Column) -> Column:
    names = {_bits(fields, s): table_name(s) for s in combinations(fields, arity)}
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[gid]


def _sets(rows: DataFrame, fields: list[str], arity: int, keep: list[str], value: Column) -> DataFrame:
    """One pass of grouping sets over all tables of an arity, separately for the columns ``keep``."""
    sets = [[*keep, *s] for s in combinations(fields, arity)]
    got = rows.groupingSets([[F.col(f"`{c}`") for c in s] for s in sets], *[F.col(f"`{c}`") for c in [*keep, *fields]])
    return got.agg(value.alias("Count"), F.grouping_id().cast("int").alias("gid"))


def contingency(df: DataFrame, fields: list[str], arity: int, count: str) -> DataFrame:
    """(table_name, arity, fields.., Count): all tables of the arity in one frame; absent fields null.

    The cube is summed first, so that each table is summed from its few rows.
    """
    got = _sets(cube(df, fields, count), fields, arity, [], F.sum("Count"))
    return got.select(_table_name(fields, arity, F.col("gid")).alias("table_name"), F.lit(arity).alias("arity"), *[f"`{f}`" for f in fields], "Count")


def derived(rows: DataFrame, fields: list[str], arity: int) -> DataFrame:
    """Tables one arity lower: each is the median, by key, of its versions summed from rows (gid, fields.., Count)."""
    versions = _sets(rows.withColumnRenamed("gid", "source"), fields, arity, ["source"], F.sum("Count"))
    # Only versions whose source holds all the fields of the set.
    whole = versions.where(F.col("source").bitwiseAND(F.col("gid")) == F.col("source"))
    return whole.groupBy("gid", *[f"`{f}`" for f in fields]).agg(F.median("Count").alias("Count"))


def dp_contingency(df: DataFrame, fields: list[str], count: str, noise: str = "keyed", epsilon: float = EPSILON, seed: int | None = None, domain: DataFrame | None = None, key: bytes | None = None, above: int | None = None) -> DataFrame:
    """Noisy 3-way tables, and 2- and 1-way tables derived from them: (table_name, arity, fields.., Count).

    noise: ``keyed`` (whole numbers decided by table, cell and ``key``, by default a new one, which must
    stay secret and is part of the plan), ``laplace`` (Spark's generator, written before
    anything is derived), ``none``, or ``hash`` (decided by the cells alone; for tests, protects
    nobody). Without ``domain`` or ``above`` combinations that are absent from the data get neither row
    nor noise, which can reveal presence. domain (fields..) adds its combinations with a count of 0. above,
    with keyed noise: the cells of all combinations of the fields' values whose noisy count is so large,
    at least 1, present or not, as ``with_noisy_zeros`` draws them. Each of the C(n, 3) tables spends
    epsilon, so all together spend C(n, 3) * epsilon; derived tables spend nothing.
    """
    rows = df.select(*[f"`{f}`" for f in fields], F.col(count).alias("Count"))
    if domain is not None:
        rows = rows.unionByName(domain.select(*[f"`{f}`" for f in fields], F.lit(0).alias("Count")))
    t3 = _sets(cube(rows, fields, "Count"), fields, 3, [], F.sum("Count").cast("double"))
    scale = 1 / epsilon
    if noise == "keyed":
        key = key or N.new_key()
        cell = [F.col(f"`{f}`") for f in fields]
        t3 = t3.withColumn("Count", F.col("Count") + N.keyed_laplace(key, epsilon, _table_name(fields, 3, F.col("gid")), *cell))
        if above is not None:
            t3 = with_noisy_zeros(t3, rows, fields, key, epsilon, above)
    elif noise == "laplace":
        t3 = storage.materialised(t3.withColumn("Count", F.col("Count") + N.laplace(scale, seed)), "noisy")
    elif noise == "hash":
        t3 = t3.withColumn("Count", F.col("Count") + N.hash_laplace(scale, _table_name(fields, 3, F.col("gid")), *[F.col(f"`{f}`") for f in fields]))
    elif noise != "none":
        raise ValueError(noise)
    t2 = derived(t3, fields, 2)
    t1 = derived(t2, fields, 1)
    named = lambda t, k: t.select(_table_name(fields, k, F.col("gid")).alias("table_name"), F.lit(k).alias("arity"), *[f"`{f}`" for f in fields], "Count")
    return named(t3, 3).unionByName(named(t2, 2)).unionByName(named(t1, 1))


#: Cells that a shard of a table keeps, about.
SHARD = 10_000


def tail(epsilon: float, above: int) -> float:
    """The share of absent cells whose noise is ``above`` or more."""
    return math.exp(-epsilon * above) / (1 + math.exp(-epsilon))


def kept_places(tables: DataFrame, key: bytes, epsilon: float, above: int) -> DataFrame:
    """(gid, place, Count) of the cells of tables (gid, cells), numbered from 0, that a noise of
    ``above`` or more would keep if all counts were 0, with that noise.

    From one kept cell to the next is a geometric step, and what a noise has beyond ``above`` is geometric
    too: cells in between are never listed. Shards of a table step on their own.
    """
    step = -math.log1p(-tail(epsilon, above))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shards in batches:
            for gid, first, end in zip(shards["gid"], shards["first"], shards["end"], strict=True):
                draw, at, found = N.Stream(key, f"zeros|{gid}|{first}"), int(first) - 1, []
                while (at := at + 1 + draw.geometric(step, int(end))) < end:
                    found.append((gid, at, float(above + draw.geometric(epsilon))))
                    if len(found) == 10_000:
                        yield pd.DataFrame(found, columns=["gid", "place", "Count"])
                        found = []
                yield pd.DataFrame(found, columns=["gid", "place", "Count"]).astype({"gid": "int32", "place": "int64", "Count": "float64"})

    size = F.least(F.col("cells"), F.lit(min(1 << 62, math.ceil(SHARD / tail(epsilon, above)))))
    shards = tables.where("cells > 0").select("gid", "cells", size.alias("size"))
    shards = shards.select("gid", "cells", "size", F.explode(F.expr("sequence(0L, (cells - 1) div size)")).alias("s"))
    shards = shards.select("gid", (F.col("s") * F.col("size")).alias("first"), F.least(F.col("cells"), (F.col("s") + 1) * F.col("size")).alias("end"))
    return shards.repartition("gid", "first").mapInPandas(run, "gid int, place long, Count double")


def with_noisy_zeros(t3: DataFrame, rows: DataFrame, fields: list[str], key: bytes, epsilon: float, above: int) -> DataFrame:
    """Noisy cells (fields.., Count, gid) of at least ``above``, and those that absent cells reach by their noise.

    A table's cells are all combinations of the values that its fields have in rows; they are
    numbered, never listed, so the cost follows what is kept.
    """
    if above < 1:
        raise ValueError("above must be at least 1")
    # The values of all fields in one frame, numbered in each.
    each = F.array(*[F.struct(F.lit(k).alias("field"), F.col(f"`{f}`").cast("string").alias("v")) for k, f in enumerate(fields)])
    values = rows.select(F.explode(each).alias("x")).select("x.*").where("v is not null").distinct()
    with storage.scratch(rows.sparkSession) as kept_last:
        values = kept_last(storage.numbered(values, "i", "field", "v"), "values")
    held = {r["field"]: r for r in values.groupBy("field").agg(F.min("i").alias("first"), F.count("*").alias("n")).collect()}
    n = {f: held[k]["n"] if k in held else 0 for k, f in enumerate(fields)}
    spark, sets = rows.sparkSession, list(combinations(fields, 3))
    places = []
    for s in sets:
        if (cells := n[s[0]] * n[s[1]] * n[s[2]]) >= 1 << 62:
            raise ValueError(f"too many combinations to number: {s}")
        places.append((_bits(fields, s), cells))

    def names(f: str) -> DataFrame:
        k = fields.index(f)
        own = values.where(F.col("field") == k).select(F.col("v").cast(rows.schema[f].dataType).alias(f), (F.col("i") - (held[k]["first"] if k in held else 0)).alias(f"_i_{f}"))
        return storage.small_or_shuffled(own)

    kept = storage.materialised(kept_places(spark.createDataFrame(places, "gid int, cells long"), key, epsilon, above), "zeros")
    out = []
    for s in sets:
        zeros = kept.where(F.col("gid") == _bits(fields, s)).withColumn("rest", F.col("place"))
        for f in reversed(s):
            zeros = zeros.withColumn(f"_i_{f}", F.expr(f"rest % {max(n[f], 1)}L")).withColumn("rest", F.expr(f"rest div {max(n[f], 1)}L"))
        for f in s:
            zeros = zeros.join(names(f), f"_i_{f}").drop(f"_i_{f}")
        # A present cell has noise of its own.
        there = t3.where(F.col("gid") == _bits(fields, s)).select(*[f"`{f}`" for f in s])
        out.append(zeros.join(there, list(s), "left_anti").select(*[F.col(f"`{f}`") if f in s else F.lit(None).cast(rows.schema[f].dataType).alias(f) for f in fields], "Count", "gid"))
    return reduce(DataFrame.union, out, t3.where(F.col("Count") >= above).select(*[f"`{f}`" for f in fields], "Count", "gid"))


def spent(fields: list[str], epsilon: float = EPSILON) -> float:
    """The privacy parameter of all 3-way tables together."""
    return len(list(combinations(fields, 3))) * epsilon
