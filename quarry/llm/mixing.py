"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words: its weight's share of all words, at most ``most`` times the
words it has; what is over is shared anew by weight until nothing is. A source's documents are each
taken ``target / words`` times in expectation. The whole part is certain: so many copies of every document.
For the rest each document has an inclusion probability p. It draws a uniform number u (a hash of its id, so
reruns agree) and ranks by its odds u / (1 - u) divided by its inclusion odds p / (1 - p); the lowest
ranks are taken until the sample has its fixed size. Size is counted in words: the
document at the border gives its first words only, so a source's sample has exactly the words that are missing
to its target. With ``prefer``, a positive whole number for each document, documents of a source are taken in
proportion to it, up to ``most`` times each, and p differs inside a source.

The ranks at which sources end are found without ordering the documents: words are summed by source and by the first
bits of the rank (partial aggregates), the border is searched in these sums, and its cell is split by the next bits, until
the cells at the borders are small. Only their rows are ordered. So a source with most of the documents is no hot
group anywhere. Sources are a table too: their number is not bounded.

Defined cases: a null text has no words; a document without words is taken 0 words; null is a source, the last one; null and
equal ids draw by what they have in common, and rows equal in id, source and size share the words at the border one
after the other; without any word all targets are 0; an empty table gives an empty result. Only doc_id,
source and text are read, so extra columns of any name are harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import shared_table
from quarry.operators.numbering import number_rows
from quarry.session import checked_broadcast

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 2024
WORD = r"[^\x20\x09-\x0D]+"
BITS = 52  # of a rank
DIGIT = 13  # bits of a rank that are split at a time
CELL = 4096  # rows of a border cell that are ordered in one task


def sizes(docs: DataFrame, prefer: Column | None = None) -> DataFrame:
    """(doc_id, source, size, prefer): words of every whole text, written once."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    prefer = F.lit(1) if prefer is None else F.greatest(F.coalesce(prefer, F.lit(1)), F.lit(1))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), prefer.cast("bigint").alias("prefer"))
    return shared_table(rows, "sizes")


def levels(rows: DataFrame, groups: DataFrame, most: int = MOST) -> DataFrame:
    """(nth, level): what a unit of ``share`` gets in each group, so that its rows share ``budget`` and none gets over ``most`` times its ``size``.

    rows: nth, share, size, all whole numbers; groups: nth, budget. What is over the most of a row goes to the others
    by share, until none is above; a pass over the rows each time. Groups without words have no level.
    """
    rows, cap = rows.where("size > 0"), F.col("size") * most
    level, full = groups.select("nth", F.lit(0.0).alias("level")), None
    while True:
        at_most = F.col("share") * F.col("level") > cap
        sums = rows.join(checked_broadcast(level), "nth").groupBy("nth").agg(
            F.count_if(at_most).alias("full"), F.sum(F.when(at_most, cap).otherwise(0)).alias("given"), F.sum(F.when(at_most, 0).otherwise(F.col("share"))).alias("open"))
        sums = shared_table(sums.join(groups, "nth"), "levels")
        before, full = full, sums.agg(F.sum("full")).first()[0] or 0
        if full == before:
            return level
        to_share = (F.col("budget") - F.col("given").cast("double")) / F.col("open")
        level = sums.select("nth", F.when(F.col("open") > 0, to_share).otherwise(F.lit(float("inf"))).alias("level"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(nth, source, source_size, target), written once; sources take the weights in turn, by code point, null last."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = number_rows(sums, [F.col("source").asc_nulls_last()], "nth", start=0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    listed = shared_table(listed.select("nth", "source", "source_size", weight.cast("bigint").alias("weight")), "sources")
    total = listed.agg(F.lit(0).alias("nth"), F.coalesce(F.sum("source_size"), F.lit(0)).cast("double").alias("budget"))
    level = levels(listed.select(F.lit(0).alias("nth"), F.col("weight").alias("share"), F.col("source_size").alias("size")), total, most).first()
    per_weight = level["level"] if level else 0.0
    return shared_table(listed.select("nth", "source", "source_size", F.least(F.col("weight") * F.lit(per_weight), (F.col("source_size") * most).cast("double")).alias("target")), "targets")


def pareto_rank(doc_id: Column, p: Column, seed: int = SEED) -> Column:
    """Odds of a hash of the id over inclusion odds, as a whole number of ``BITS`` bits in the same order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(h, 1, BITS // 4), 16, 10).cast("double") + 0.5) / F.lit(float(1 << BITS))
    ratio = (u / (1 - u)) / (p / (1 - p))
    return F.least(F.floor(ratio / (1 + ratio) * F.lit(float(1 << BITS))).cast("bigint"), F.lit((1 << BITS) - 1))


def borders(ranked: DataFrame, left: DataFrame, cell: int = CELL) -> tuple[DataFrame, int]:
    """Where each source's sample ends: (nth, border, left), and the bits that are not in ``border``.

    ranked: nth, rank, size; left: nth, left, the words to take. Documents whose rank begins with less than
    ``border`` are in the sample, and ``left`` words of those whose rank begins with it.
    """
    state, shift = left.select("nth", F.lit(0).cast("bigint").alias("border"), "left"), BITS
    while shift:
        inside = ranked.join(checked_broadcast(state), "nth").where(F.shiftright("rank", shift) == F.col("border"))
        shift -= DIGIT
        cells = inside.groupBy("nth", "left", F.shiftright("rank", shift).alias("d")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = F.sum("words").over(Window.partitionBy("nth").orderBy("d"))  # at most 2 ** DIGIT cells
        cells = cells.withColumn("upto", upto)
        over = F.col("upto") < F.col("left")
        # The first cell that holds the border; the last one if all is taken.
        first = F.min(F.struct(over.alias("over"), F.when(over, -F.col("d")).otherwise(F.col("d")).alias("o"), "d", (F.col("left") - F.col("upto") + F.col("words")).alias("left"), "n"))
        state = cells.groupBy("nth").agg(first.alias("f")).select("nth", F.col("f.d").alias("border"), F.col("f.left").alias("left"), F.col("f.n").alias("n"))
        state = shared_table(state, "borders")
        if (state.agg(F.max("n")).first()[0] or 0) <= cell:
            break
    return state.drop("n"), shift


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, prefer: Column | None = None, seed: int = SEED, cell: int = CELL) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken (words the mix takes of it, repeats counted)."""
    sized = sizes(docs, prefer)
    targets = source_targets(sized, weights, most)
    small = checked_broadcast(targets)
    rows = sized.join(small, sized["source"].eqNullSafe(small["source"])).drop("source")
    rows = rows.select("doc_id", "nth", "size", "prefer", "source_size", "target")
    level = levels(rows.select("nth", (F.col("prefer") * F.col("size")).alias("share"), "size"), targets.select("nth", F.col("target").alias("budget")), most)
    level = shared_table(level, "document-levels")
    copies = F.when(F.col("level").isNull(), 0.0).otherwise(F.least(F.col("prefer") * F.col("level"), F.lit(float(most))))
    rows = rows.join(checked_broadcast(level), "nth", "left").withColumn("copies", copies).withColumn("whole", F.floor("copies").cast("bigint"))
    p = F.col("copies") - F.col("whole")
    rows = rows.withColumn("rank", F.when((p > 0) & (F.col("size") > 0), pareto_rank(F.col("doc_id"), p, seed)))
    rows = shared_table(rows.select("doc_id", "nth", "size", "source_size", "target", "whole", "rank"), "ranked")
    certain = rows.groupBy("nth", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("words"))
    left = shared_table(certain.select("nth", F.greatest(F.floor(F.col("target") + 0.5).cast("bigint") - F.col("words"), F.lit(0)).alias("left")), "left")
    ends, shift = borders(rows.where("rank is not null").select("nth", "rank", "size"), left, cell)
    placed = rows.join(checked_broadcast(ends), "nth", "left")
    begins = F.shiftright("rank", shift)
    at_border = F.coalesce(begins == F.col("border"), F.lit(False))
    inside = F.coalesce(begins < F.col("border"), F.lit(False))
    clear = placed.where(~at_border).withColumn("taken", F.col("size") * (F.col("whole") + inside.cast("bigint")))
    # The border cells' rows in order; equal ones counted, so that they are no group either.
    key = ["nth", "rank", "doc_id", "size", "whole"]
    few = placed.where(at_border).groupBy(*key, "source_size", "target", "left").agg(F.count(F.lit(1)).alias("m"))
    before = F.sum(F.col("m") * F.col("size")).over(Window.partitionBy("nth").orderBy("rank", F.col("doc_id").asc_nulls_last(), "size", "whole"))
    few = few.withColumn("room", F.col("left") - before + F.col("m") * F.col("size")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1)))
    part = F.least(F.greatest(F.col("room") - F.col("i") * F.col("size"), F.lit(0)), F.col("size"))
    few = few.withColumn("taken", F.col("size") * F.col("whole") + part)
    out = ["doc_id", "size", "source_size", "target", "taken"]
    return clear.select(*out).unionByName(few.select(*out))
