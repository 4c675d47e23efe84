"""Benchmark decontamination: prefix-filtered containment join, DataFrame operations only.

An item's windows are its runs of ``window`` consecutive words (a shorter
item is one window). A document contains a window if it holds the same words
in the same order somewhere. Words are ordered by how rare they are over all
documents; containment 1 makes the necessary prefix of a window one word
long, its rarest. Documents' words join that word only; the position of the
word in the window and the window's length bound where an occurrence can
begin and end; the words between are then compared exactly.

Texts are split once, into a table in the shared folder that the two passes
(word counts, candidates) read. Benchmark words and windows are broadcast in
blocks of at most ``block_windows`` windows each, so a benchmark of any size works:
each block is one pass over the documents' words, and one pass is enough up
to that bound. No shuffle carries a text or an unaggregated word.

Defined cases: null texts have no words and are clean; an empty table on
either side gives clean documents or none; items without words have no
window; items with a null id count as one item named ``null``; repeated items and rows
change nothing but the number of rows. Only doc_id, text, item_id are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import doc_key, shared_table

WINDOW = 10
# Windows broadcast at a time: some 300 bytes each.
BLOCK_WINDOWS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, w): every window of every item, once."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words_of(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window + 1, F.lit(1))
    begun = items.withColumn("s", F.explode(F.sequence(F.lit(1), last)))
    return begun.select("item", F.slice("words", F.col("s"), F.least(F.size("words"), F.lit(window))).alias("w")).distinct()


def split_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, words), written once."""
    rows = docs.select("doc_id", doc_key().alias("key"), words_of(F.col("text")).alias("words"))
    return shared_table(rows.select("doc_id", "key", F.size("words").cast("bigint").alias("n_words"), "words"), "words", compression="zstd")


def _blocks(df: DataFrame, by: str, rows: int, limit: int) -> list[DataFrame]:
    """``df`` in blocks of about ``limit`` rows at most, by the hash of a column."""
    n = -(-rows // limit)
    if n <= 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(by), F.lit(n)) == k) for k in range(n)]


def window_hits(split: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(key, s, w): windows that occur in a text, with their 0-based first word."""
    windows = shared_table(item_windows(benchmark, window).select("w").distinct().withColumn("id", F.xxhash64(F.array_join("w", " "))), "windows")
    n = windows.count()
    terms = windows.select(F.explode("w").alias("word")).distinct()
    split_words = split.select(F.explode("words").alias("word"))
    counts = [split_words.join(F.broadcast(part), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")) for part in _blocks(terms, "word", n * window, block_windows * window)]
    counts = reduce(DataFrame.unionByName, counts)
    placed = windows.select("w", F.posexplode("w").alias("p", "word")).join(counts, "word", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "p"))
    anchors = shared_table(placed.groupBy("w").agg(rarest.alias("r")).select("w", "r.word", "r.p", "r.n"), "anchors")
    # A window with a word that no document has cannot occur.
    anchors = anchors.where("n > 0").select("w", "word", "p")
    spread = split.select("key", "words", F.posexplode("words").alias("at", "word"))
    begin = F.col("at") - F.col("p")
    found = []
    for part in _blocks(anchors, "word", n, block_windows):
        near = spread.join(F.broadcast(part), "word").where((begin >= 0) & (begin + F.size("w") <= F.size("words")))
        found.append(near.where(F.slice("words", begin + 1, F.size("w")) == F.col("w")).select("key", begin.alias("s"), "w"))
    return reduce(DataFrame.unionByName, found).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    split = split_documents(docs)
    hits = shared_table(window_hits(split, benchmark, window, block_windows), "hits")
    covered = hits.select("key", F.explode(F.sequence(F.col("s"), F.col("s") + F.size("w") - 1)).alias("at")).distinct()
    covered = covered.groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    items = hits.select("key", "w").distinct().join(item_windows(benchmark, window), "w").select("key", "item").distinct()
    items = items.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    out = split.select("doc_id", "key", "n_words").join(covered.join(items, "key"), "key", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, with all their columns."""
    hit = window_hits(split_documents(docs), benchmark, window).select(F.col("key").alias("_hit_key")).distinct()
    return docs.join(hit, doc_key() == F.col("_hit_key"), "left_anti")
