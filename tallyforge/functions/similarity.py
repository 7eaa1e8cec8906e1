"""String similarities that Spark lacks, as Arrow-batched functions for already blocked pairs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & where.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 * 2 * LCS / (sum of lengths); 100 for two empty strings, null if either is null."""
    return pd.Series([None if x is None or y is None else 200.0 * lcs_length(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b, strict=True)], dtype="float64")


#: In a second text of so many letters, those in more than one of a hundred places, and
#: one more, start no block.
LONG, POPULAR = 200, 100


def matching_letters(a: str, b: str) -> int:
    """Letters in matching blocks: the longest common run, the earliest in a and then in b, and so on left and right of it."""
    places: dict[str, list[int]] = {}
    for j, c in enumerate(b):
        places.setdefault(c, []).append(j)
    if len(b) >= LONG:
        places = {c: at for c, at in places.items() if len(at) <= len(b) // POPULAR + 1}
    found, todo = 0, [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        at, to, size = a0, b0, 0
        runs: dict[int, int] = {}  # length of the common run that ends at each place of b
        for i in range(a0, a1):
            ends: dict[int, int] = {}
            for j in places.get(a[i], ()):
                if b0 <= j < b1:
                    k = ends[j] = runs.get(j - 1, 0) + 1
                    if k > size:
                        at, to, size = i - k + 1, j - k + 1, k
            runs = ends
        # Popular letters start no block but may lengthen one.
        while at > a0 and to > b0 and a[at - 1] == b[to - 1]:
            at, to, size = at - 1, to - 1, size + 1
        while at + size < a1 and to + size < b1 and a[at + size] == b[to + size]:
            size += 1
        if size:
            found += size
            todo += [(a0, at, b0, to), (at + size, a1, to + size, b1)]
    return found


def shared_letters(text: Column, pattern: str) -> Column:
    """Letters that a text and a pattern have in common, in any order: no similarity by blocks or runs counts more."""
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return sum((F.least(count(c), F.lit(pattern.count(c))) for c in sorted(set(pattern))), F.lit(0))


@F.pandas_udf(T.DoubleType())
def ratcliff_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the letters in matching blocks by the sum of lengths; 1 for two empty texts, null if either is null."""
    return pd.Series([None if x is None or y is None else 2.0 * matching_letters(x, y) / (len(x) + len(y)) if x or y else 1.0 for x, y in zip(a, b, strict=True)], dtype="float64")


def indel_ratio_by_fold(a: Column, b: Column) -> Column:
    """The same as indel_ratio with SQL functions only; slow, for checking."""
    cells = lambda s: F.filter(F.split(s, ""), lambda c: c != "")
    zero = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))

    def row(before: Column, ch: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            up, left, corner = F.element_at(before, j + 1), F.element_at(acc, -1), F.element_at(before, j)
            return F.array_append(acc, F.when(F.substring(b, j, F.lit(1)) == ch, corner + 1).otherwise(F.greatest(up, left)))

        return F.when(F.length(b) == 0, before).otherwise(F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(F.lit(0)), cell))

    lcs = F.element_at(F.aggregate(cells(a), zero, row), -1)
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * lcs / total)
