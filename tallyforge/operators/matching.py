"""Fuzzy matching of strings against a reference list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions.similarity import indel_ratio, ratcliff_ratio, shared_letters

#: Scores above skip a report, from here on accept a match; least header similarity.
SKIP_ABOVE, ACCEPT, HEADER = 80.0, 80.0, 0.70
CONSOLIDATED = "CONSOLIDATED REPORT"
#: The score tried before ``accept``: a name that has a match so good looks no further.
FIRST = 92.0
#: Runs that a pair must share among its rarest ones, where its length promises so many.
SHARED = 2
#: Letters left out or added, a replaced one counting as two, between names that are looked for first; letters
#: of the runs by which they are found, which must be more; names of a task.
NEAR, RUN, TASK_NAMES = 2, 4, 2048
#: Stands for what lies before a name's first letter and after its last.
PAD = "\x01"


def unlike(df: DataFrame, column: str, pattern: str = CONSOLIDATED, above: float = SKIP_ABOVE) -> DataFrame:
    """Rows whose text is not like the pattern; null counts as ''.

    Only texts whose length and letters can get above the score are compared: twice the shared letters by the
    sum of lengths.
    """
    value = F.coalesce(F.col(column), F.lit(""))
    n, m = F.length(value), F.lit(len(pattern))
    can = (n + m == 0) | (200.0 * F.least(n, m) / (n + m) > above) & (200.0 * shared_letters(value, pattern) / (n + m) > above)
    return df.where(F.coalesce(indel_ratio(F.when(can, value), F.lit(pattern)), F.lit(0.0)) <= above)


def headed(df: DataFrame, column: str, pattern: str, least: float = HEADER) -> DataFrame:
    """Rows whose whole text is like the pattern, with their score; null never is.

    Only texts whose length and letters can still reach the score are compared: twice the shared letters by
    the sum of lengths.
    """
    n, m = F.length(column), F.lit(len(pattern))
    can = (n + m == 0) | (2.0 * F.least(n, m) / (n + m) >= least) & (2.0 * shared_letters(F.col(column), pattern) / (n + m) >= least)
    return df.where(can).withColumn("score", ratcliff_ratio(column, F.lit(pattern))).where(F.col("score") >= least)


def _grams(q: int) -> Column:
    """All runs of q letters of ``text`` padded at both ends, each with the number of its occurrence."""
    # Bound to a name, r, so that the runs are cut once.
    runs = f"transform(sequence(1, length(text) + {q - 1}), i -> substring(concat(repeat('{PAD}', {q - 1}), text, repeat('{PAD}', {q - 1})), i, {q}))"
    return F.expr(f"get(transform(array({runs}), r -> transform(r, (g, i) -> concat(g, size(filter(slice(r, 1, i + 1), x -> x = g))))), 0)")


def gram_size(accept: float) -> int:
    """The longest runs, of up to 3 letters, of which names of such a score always share one."""
    return next(q for q in (3, 2, 1) if (2 * q - 1) * accept >= 200 * (q - 1))


def _least_common(q: int, accept: float) -> str:
    """How many runs a name of n letters shares at least with a partner whose score is ``accept`` or more.

    A letter that only one of two names has breaks q of its own runs and q - 1 of the other's; the
    shortest partner promises least.
    """
    total = f"(n + ceil(n * {accept / (200.0 - accept)!r}D - 1e-9D))"
    return f"cast(ceil({total} * {(2 * q - 1) * accept / 200.0 - (q - 1)!r}D + {q - 1} - 1e-9D) as int)"


def _indexed(texts: DataFrame, frequency: DataFrame, q: int) -> DataFrame:
    """(text, n, grams) with the runs (frequency, gram, at) of each text, those rare in the reference first."""
    runs = texts.select("text", F.posexplode(_grams(q)).alias("at", "gram")).join(frequency, "gram", "left")
    return runs.groupBy("text").agg(F.expr("array_sort(collect_list(struct(coalesce(frequency, 0) as frequency, gram, at))) as grams")).selectExpr("text", "length(text) as n", "grams")


def _frequency(grams: DataFrame) -> DataFrame:
    return grams.groupBy("gram").agg(F.count("*").alias("frequency"))


def candidates(names: DataFrame, reference: DataFrame, q: int, accept: float) -> DataFrame:
    """(name, ref) that can have the score, of names and reference as ``_indexed`` gives them.

    Of the runs that a name of such a score has in common with its partner the first k, by rareness, lie among
    its rarest all - least + k ones: a name looks only at these, and a pair must meet k times, at
    places that are close enough.
    """
    least = _least_common(q, accept)

    def side(df: DataFrame, text: str, n: str, k: str, at: str) -> DataFrame:
        counted = df.selectExpr(f"text as {text}", "n", f"{least} as least", f"least({least}, {SHARED}) as k", "grams")
        return counted.selectExpr(text, f"n as {n}", f"k as {k}", f"explode(slice(grams, 1, greatest(n + {q - 1} - least + k, 1))) as g").selectExpr(text, n, k, "g.gram", f"g.at as {at}")

    lcs = f"ceil((n + m) * {accept / 200.0!r}D - 1e-9D)"
    close = f"abs(i - j) <= greatest(n, m) - {lcs} and {lcs} <= least(n, m)"
    met = side(names, "name", "n", "k", "i").join(side(reference, "ref", "m", "l", "j"), "gram").where(close)
    return met.groupBy("name", "ref").agg(F.expr("count(*) as met"), F.expr("any_value(least(k, l)) as must")).where("met >= must").select("name", "ref")


def near_matches(names: DataFrame, reference: DataFrame, accept: float, near: int = NEAR, q: int = RUN) -> DataFrame:
    """(name, match, score) of names that differ by ``near`` letters at most from one of reference (both: text).

    Of near + 1 runs of a name that don't overlap one is whole in its partner, and what lies before and behind it
    differs in length by so many letters in all. Of the runs that begin q letters apart those are
    looked up that are rarest in the reference. Names with room for so many runs have no match
    elsewhere that is as good: q is larger than near. Shorter ones are left out. Both joins are shuffled, as Spark
    takes runs to be as few as the names they are cut from.
    """
    runs = F.expr(f"transform(sequence(1, length(text) - {q - 1}), i -> struct(substring(text, i, {q}) as gram, i as at))")
    looked = names.where(F.length("text") >= (near + 1) * q).select("text", F.inline(runs))
    refs = reference.where(F.length("text") >= q).select(F.col("text").alias("ref"), F.length("text").alias("m"), F.inline(runs)).withColumnRenamed("at", "j")
    rows = looked.join(_frequency(refs).hint("merge"), "gram", "left").groupBy("text", (F.col("at") % q).alias("first"))
    rarest = rows.agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "gram", "at"))), 1, near + 1).alias("runs")).where(F.size("runs") > near)
    total = F.aggregate("runs", F.lit(0).cast("long"), lambda x, r: x + r.frequency)
    chosen = rarest.groupBy("text").agg(F.min(F.struct(total.alias("total"), "runs")).alias("b")).select("text", F.inline("b.runs"))
    n = F.length("text")
    probes = chosen.select(F.col("text").alias("name"), n.alias("n"), "gram", F.col("at").alias("i"), F.explode(F.sequence(n - near, n + near)).alias("m"))
    met = probes.join(refs.hint("merge"), ["gram", "m"]).where(f"abs(j - i) + abs(m - n - (j - i)) <= {near}").where(F.levenshtein("name", "ref", near) >= 0)
    scored = met.withColumn("s", indel_ratio("name", "ref")).where(F.col("s") >= accept).where(f"(n + m) * (100.0D - s) <= {100 * near + 1e-6!r}D")
    return scored.groupBy("name").agg(F.min(F.struct((-F.col("s")).alias("s"), "ref")).alias("b")).select("name", F.col("b.ref").alias("match"), (-F.col("b.s")).alias("score"))


def best_matches(names: DataFrame, reference: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(name, match, score) of the distinct names (name): the most similar of reference (ref), if its score is enough.

    Exact hits skip the comparison. Names that differ from one of reference by a letter or two are found by a few
    rare runs of letters (``near_matches``) and look no further. The others look partners up in an inverted index of all runs:
    a name of such a score shares one of each side's rarest runs, at a close place, and a known number of
    all runs; only such pairs are compared. The index is tried with a high score first, which names few
    pairs, and names that found a match leave. Spark broadcasts an index that turns out small, else
    shuffles both sides by run and splits frequent ones. Ties go to the smaller reference.
    """
    names = names.select(F.col("name").alias("text")).where("text is not null").distinct()
    reference = reference.select(F.col("ref").alias("text")).where("text is not null").distinct()
    exact = names.join(reference, "text", "left_semi").select(F.col("text").alias("name"), F.col("text").alias("match"), F.lit(100.0).alias("score"))
    q = gram_size(accept)
    refs, left = reference.where("text != ''"), names.join(reference, "text", "left_anti").where("text != ''")

    def best(names: DataFrame, refs: DataFrame, least: float) -> DataFrame:
        scored = candidates(names, refs, q, least).withColumn("s", indel_ratio("name", "ref")).where(F.col("s") >= least)
        found = scored.groupBy("name").agg(F.min(F.struct((-F.col("s")).alias("s"), "ref")).alias("b"))
        return found.select("name", F.col("b.ref").alias("match"), (-F.col("b.s")).alias("score"))

    # The matches are stored, a row for a name at most; the indexes go.
    with storage.scratch(names.sparkSession) as kept:
        deal = lambda df, label: storage.dealt(storage.materialised(df, label), TASK_NAMES, "text")
        refs, left = deal(refs, "reference"), deal(left, "names")
        first = storage.materialised(near_matches(left, refs, accept), "near")
        left = storage.materialised(left.join(first.select(F.col("name").alias("text")), "text", "left_anti"), "names")
        exact = exact.union(first)
        if left.isEmpty():
            return kept(exact, "matched")
        refs = storage.materialised(_indexed(refs, _frequency(refs.select(F.explode(_grams(q)).alias("gram"))), q), "reference")
        left = storage.materialised(_indexed(left, _frequency(refs.select(F.explode("grams.gram").alias("gram"))), q), "names")
        if accept >= FIRST:
            return kept(exact.union(best(left, refs, accept)), "matched")
        near = storage.materialised(best(left, refs, FIRST), "matches")
        far = best(left.join(near.select(F.col("name").alias("text")), "text", "left_anti"), refs, accept)
        return kept(exact.union(near).union(far), "matched")


def corrected_pairs(df: DataFrame, first: str, second: str, reference: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """df with both columns corrected where both best matches are good enough and exist as a pair.

    reference: (first, second) under the same column names.
    """
    pairs = df.select(first, second).distinct()
    a = best_matches(pairs.select(F.col(first).alias("name")), reference.select(F.col(first).alias("ref")), accept)
    b = best_matches(pairs.select(F.col(second).alias("name")), reference.select(F.col(second).alias("ref")), accept)
    known = reference.select(F.col(first).alias("_a"), F.col(second).alias("_b")).distinct()
    fixes = pairs.join(a.select(F.col("name").alias(first), F.col("match").alias("_a")), first).join(b.select(F.col("name").alias(second), F.col("match").alias("_b")), second)
    got = df.join(fixes.join(known, ["_a", "_b"]).select(first, second, "_a", "_b"), [first, second], "left")
    fix = lambda c, m: F.coalesce(m, c).alias(c)
    return got.select(*[c for c in df.columns if c not in (first, second)], fix(first, "_a"), fix(second, "_b"), F.col("_a").isNotNull().alias("matched"))
