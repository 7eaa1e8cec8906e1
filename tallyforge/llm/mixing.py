"""Temperature mixing of sources to target weights, with DataFrame and SQL functions only.

A source's weight is its share of all tokens to the power of an exponent between 0 and 1,
normalised. The exponent is bisected: the largest whose weights reach a target entropy, or the
smallest that repeats no source beyond a limit. Weights times the token budget are the sources'
quotas. They are realised by block permutations: each epoch deals a source's documents to blocks
by a seeded hash; whole epochs take every block, the last takes blocks in order up to the quota,
and from the block at its edge on documents in order of their hash, as long as one fits.

Prefix sums run over chunks of blocks, the blocks of a chunk, and the documents of a block, whose
number is the tokens divided by ``BLOCK_TOKENS``; no window holds a source's documents or blocks.

Edge cases: a null source counts as the source ''. Null and empty texts have 0 tokens; they fit into
any quota, so each epoch has them all. A document is never cut: one larger than what is left of the
quota is passed over, and later ones are tried. Without any tokens, every document is taken once.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

BLOCK_TOKENS = 1 << 18
#: Blocks in a chunk of prefix sums.
CHUNK_BLOCKS = 4096
#: Rows of a source that are folded at once; so few that Spark limits them before a shuffle.
FOLD = 1000
#: Target entropy as a share of the largest possible, which equal weights have.
ENTROPY = 0.95
#: In the mixture of rows, how often a document comes at most.
MOST = 4
SEED = "mix"
#: Halvings of the exponent's interval, done so many at a time by one pass over the sources.
BITS, AT_ONCE = 30, 6
BYTES_PER_TOKEN = 4


def tokens_of(text: F.Column) -> F.Column:
    """Tokens of a text by its bytes, rounded up."""
    return F.floor((F.octet_length(F.coalesce(text, F.lit(""))) + BYTES_PER_TOKEN - 1) / BYTES_PER_TOKEN)


def unit_hash(*parts: F.Column) -> F.Column:
    """A fixed number in [0, 1) for the parts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(1 << 48)


def exponent(sources: DataFrame, budget: float | None, entropy: float | None, repeats: float | None) -> float:
    """The exponent for sources (share), by bisection; one row for each candidate reaches the driver.

    budget: of all tokens; None is the smallest that drops no document.
    """
    count = sources.count()
    target = (entropy or 0.0) * math.log(count) if count else 0.0
    low, high, done = 0, 1 << BITS, 0

    def fine(rows: DataFrame, grid: list[int]) -> set[int]:
        at = rows.select("share", F.explode(F.array(*[F.lit(g) for g in grid])).alias("g")).withColumn("a", F.col("g") / float(1 << BITS))
        power = F.pow("share", "a")
        got = at.groupBy("g", "a").agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("l"), F.max(F.pow(F.col("share"), F.col("a") - 1)).alias("m"), F.max(F.pow(F.col("share"), 1 - F.col("a"))).alias("k"))
        if repeats is None:
            return {r.g for r in got.where(F.log("z") - F.col("a") * F.col("l") / F.col("z") >= target).select("g").collect()}
        # Beyond the limit, the exponent must grow: the search is for the last that is not fine.
        times = F.col("m") * F.col("k") if budget is None else F.col("m") / F.col("z") * budget
        return {r.g for r in got.where(times > repeats).select("g").collect()}

    ends = fine(sources, [low, high]) if count else {high}
    if high in ends:
        return 1.0
    if low not in ends:
        return 0.0
    while done < BITS:
        step = min(AT_ONCE, BITS - done)
        grid = [low + (high - low) * i // (1 << step) for i in range(1, 1 << step)]
        ok = fine(sources, grid)
        low, high = max([low, *ok]), min([high, *(g for g in grid if g not in ok)])
        done += step
    return (low if repeats is None else high) / (1 << BITS)


def plan(sized: DataFrame, entropy: float | None = ENTROPY, repeats: float | None = None, budget: int | None = None, whole: int | None = None) -> DataFrame:
    """(source, n, quota, epochs, rest, blocks) of sized (source, tokens), stored.

    epochs: whole epochs; rest: tokens of the last one. whole: the budget is the smallest that drops no
    document, and the exponent is raised until no document comes more than so many times; else the
    budget is ``budget``, or all tokens.
    """
    sources = sized.groupBy("source").agg(F.sum("tokens").alias("n")).where("n > 0")
    sources = common.stored(sources, "sources")
    total = sources.agg(F.sum("n")).first()[0] or 0
    spend = budget or total
    shares = sources.withColumn("share", F.col("n") / F.lit(float(total or 1)))
    alpha = exponent(shares, spend / total if total else 1.0, entropy, repeats)
    if whole and total:
        alpha = max(alpha, exponent(shares, None, None, float(whole)))
    powers = shares.withColumn("power", F.pow("share", F.lit(alpha)))
    z, most = powers.agg(F.sum("power"), F.max(F.col("n") / F.col("power"))).first()
    weighed = powers.withColumn("weight", F.col("power") / F.lit(z or 1.0))
    if whole and total:
        spend = most * z
    quota = F.floor(F.col("weight") * F.lit(float(spend)) + 0.5).cast("long")
    if whole:
        quota = F.least(F.greatest(quota, "n"), F.col("n") * whole)
    out = weighed.withColumn("quota", quota).withColumn("epochs", F.expr("quota div n")).withColumn("rest", F.expr("quota % n"))
    blocks = F.ceil(F.col("n") / BLOCK_TOKENS).cast("long").alias("blocks")
    return common.stored(out.select("source", "n", "weight", "quota", "epochs", "rest", blocks), "plan")


def dealt(rows: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """rows (doc_id, source, tokens, ...) with their source's plan, and for each epoch at and block."""
    rows = rows.join(common.small_or_shuffled(sources), "source", "left")
    epochs = F.sequence(F.lit(0).cast("long"), F.when(F.col("n").isNull(), F.lit(0)).otherwise(F.col("epochs") + F.when(F.col("rest") > 0, 0).otherwise(-1)))
    rows = rows.where("n is null or quota > 0").withColumn("epoch", F.explode(epochs))
    rows = rows.withColumn("at", unit_hash(F.lit(seed), F.col("epoch"), F.col("doc_id")))
    return rows.withColumn("block", F.floor(F.col("at") * F.coalesce("blocks", F.lit(1))).cast("long"))


def held_before(blocks: DataFrame) -> DataFrame:
    """Stored blocks (source, block, held, ...) with the sum of held of the source's earlier blocks, as before.

    Sums run inside chunks of blocks and then over the chunks, so no window has all blocks of a source.
    """
    earlier = lambda *by: Window.partitionBy(*by).orderBy(F.col("block") if "chunk" in by else F.col("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("chunk", F.floor(F.col("block") / CHUNK_BLOCKS))
    chunks = blocks.groupBy("source", "chunk").agg(F.sum("held").alias("chunk_held"))
    chunks = chunks.select("source", "chunk", F.coalesce(F.sum("chunk_held").over(earlier("source")), F.lit(0)).alias("chunks_before"))
    inside = F.coalesce(F.sum("held").over(earlier("source", "chunk")), F.lit(0))
    blocks = blocks.withColumn("inside", inside).join(common.small_or_shuffled(common.stored(chunks, "chunks")), ["source", "chunk"])
    return blocks.withColumn("before", F.col("chunks_before") + F.col("inside")).drop("chunk", "inside", "chunks_before")


def edges(partial: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows in their source's last epoch: the blocks (source, block, room) with the tokens that they
    may still use, and whether they fit whole."""
    blocks = common.stored(partial.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("held")), "held")
    blocks = held_before(blocks).withColumn("room", F.col("rest") - F.col("before")).where("room > 0")
    return common.stored(blocks.select("source", "block", "room", (F.col("held") <= F.col("room")).alias("whole")), "blocks")


def upto_first(rows: DataFrame, room: DataFrame) -> DataFrame:
    """(source, room, after) of rows (source, block, pos, tokens) of one block of each source: the room that is left,
    and the place, when all rows up to the first that doesn't fit are taken; after is null where all fit."""
    used = rows.join(room, "source").withColumn("used", F.sum("tokens").over(Window.partitionBy("source").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    spent = F.sum(F.when(F.col("used") <= F.col("room"), F.col("tokens")).otherwise(0))
    return used.groupBy("source", "room").agg(spent.alias("spent"), F.min(F.when(F.col("used") > F.col("room"), F.struct("block", "pos"))).alias("after")).select("source", (F.col("room") - F.col("spent")).alias("room"), "after")


def filled(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places (source, block, pos) of stored rows (source, block, pos, tokens) that fit into their source's room,
    in order, passing over each that is larger than what is left; and what stays (source, room).

    state: (source, room, after), stored; only rows behind the place ``after`` count. Rows that can still fit are
    folded ``FOLD`` at a time, so that no group is unbounded.
    """
    place = F.struct("block", "pos")
    order = F.row_number().over(Window.partitionBy("source").orderBy("block", "pos"))
    kind = "struct<room:bigint,taken:array<struct<block:bigint,pos:int>>>"
    took, left = [], state.select("source", "room")
    while True:
        still = rows.join(common.small_or_shuffled(state), "source").where((place > F.col("after")) & (F.col("tokens") <= F.col("room")))
        still = still.withColumn("k", order).where(F.col("k") <= FOLD)
        held = still.groupBy("source", "room").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "tokens"))).alias("rows"))
        start = F.struct(F.col("room"), F.array().cast("array<struct<block:bigint,pos:int>>").alias("taken")).cast(kind)
        take = lambda a, x: F.struct((a.room - x.tokens).alias("room"), F.array_append(a.taken, F.struct(x.block, x.pos)).alias("taken")).cast(kind)
        end = F.aggregate("rows", start, lambda a, x: F.when(x.tokens <= a.room, take(a, x)).otherwise(a))
        last = F.element_at("rows", -1)
        step = held.withColumn("end", end).select("source", "end.taken", F.col("end.room").alias("room"), F.struct(last.block.alias("block"), last.pos.alias("pos")).alias("after"), (F.size("rows") == FOLD).alias("more"))
        step = common.stored(step, "fold")
        took.append(step.select("source", F.explode("taken").alias("p")).select("source", "p.block", "p.pos"))
        left = left.union(step.select("source", "room"))
        state = step.where("more and room > 0").select("source", "room", "after")
        if state.isEmpty():
            break
    return reduce(DataFrame.union, took), left.groupBy("source").agg(F.min("room").alias("room"))


def taken_at_edge(partial: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows with tokens that still fit, from the block at the edge of a quota on, in order of their hash."""
    some = partial.where("tokens > 0")
    order = Window.partitionBy("source", "block").orderBy("at", "doc_id", "tokens")

    def placed(room: DataFrame, where: str) -> tuple[DataFrame, DataFrame]:
        rows = some.join(common.small_or_shuffled(room), "source").where(where).select(*some.columns)
        rows = common.stored(rows.withColumn("pos", F.row_number().over(order)), "edge")
        return rows, rows.select("source", "block", "pos", "tokens")

    edge = blocks.where("not whole").select("source", F.col("block").alias("edge"), "room")
    rows, narrow = placed(edge, "block = edge")
    state = common.stored(upto_first(narrow, edge.select("source", "room")), "state")
    got = rows.join(common.small_or_shuffled(state.select("source", "after")), "source").where("after is null or block < after.block or block = after.block and pos < after.pos").select(partial.columns)
    more, left = filled(narrow, common.stored(state.where("after is not null"), "state"))
    got = got.union(rows.join(common.stored(more, "more"), ["source", "block", "pos"], "left_semi").select(partial.columns))
    # Later blocks only have what is no larger than the rest of the room.
    left = state.select("source", "room").union(left).groupBy("source").agg(F.min("room").alias("room")).where("room > 0")
    later = common.stored(edge.select("source", "edge").join(left, "source"), "left")
    rows, narrow = placed(later, "block > edge and tokens <= room")
    start = F.struct(F.lit(-1).cast("long").alias("block"), F.lit(0).alias("pos")).alias("after")
    more, _ = filled(narrow, common.stored(later.select("source", "room", start), "state"))
    return got.union(rows.join(common.stored(more, "more"), ["source", "block", "pos"], "left_semi").select(partial.columns))


def uses(rows: DataFrame, narrow: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """rows (doc_id, source, tokens, ...) with their plan, epoch and block, a row for each use.

    narrow: the same rows, stored without further columns.
    """
    last = (F.col("epoch") == F.col("epochs")) & F.col("n").isNotNull()
    blocks = edges(dealt(narrow, sources, seed).where(last))
    spread = dealt(rows, sources, seed)
    some = spread.join(common.small_or_shuffled(blocks), ["source", "block"], "left")
    some = some.where(~last | F.coalesce("whole", F.lit(False)) | (F.col("tokens") == 0))
    return some.select(spread.columns).union(taken_at_edge(spread.where(last), blocks).select(spread.columns))


def mix(docs: DataFrame, entropy: float | None = ENTROPY, repeats: float | None = None, budget: int | None = None, seed: str = SEED) -> DataFrame:
    """(doc_id, source, tokens, epoch, block, mix_key) of docs (doc_id, source, text), a row for each use.

    Sorting by mix_key interleaves the sources' blocks by weight.
    """
    rows = common.pick(docs, "doc_id", "source", "text")
    rows = common.stored(rows.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), tokens_of(F.col("text")).alias("tokens")), "sized")
    got = uses(rows, rows, plan(rows, entropy, repeats, budget), seed)
    jitter = unit_hash(F.lit(seed), F.col("source"), F.col("epoch"), F.col("block"))
    progress = (F.col("epoch") + (F.col("block") + jitter) / F.col("blocks")) * F.col("n") / F.col("quota")
    return got.select("doc_id", "source", "tokens", "epoch", "block", F.round(F.coalesce(progress, jitter), 9).alias("mix_key"))


def mixed(docs: DataFrame, entropy: float = ENTROPY, seed: str = SEED, most: int = MOST) -> DataFrame:
    """The rows of docs in a mixture, all columns as they were, a row for each use.

    The budget is the smallest that drops no document: the largest source is taken once, the
    others as often as their weights ask, up to ``most`` times. Where the entropy would ask for
    more, the exponent is raised, so the weights are as even as the limit allows.
    """
    have = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(have))])
    col = lambda n: F.col(f"c{have.index(n)}")
    rows = plain.withColumns({"doc_id": col("doc_id"), "source": F.coalesce(col("source"), F.lit("")), "tokens": tokens_of(col("text"))})
    narrow = common.stored(rows.select("doc_id", "source", "tokens"), "sized")
    got = uses(rows, narrow, plan(narrow, entropy, whole=most), seed)
    return got.select(*[f"c{i}" for i in range(len(have))]).toDF(*have)
