"""Exact deduplication: 128-bit content hash, then a byte comparison inside groups.

Rows are grouped by the MD5 of their text. Every group of two or more rows
elects one text (the smallest) and each member is compared with it byte by
byte; members that differ are collisions and are regrouped by their whole
text, so equal hashes alone never merge rows. Only hashes are aggregated;
the texts cross the network once, for the comparison, in a join whose skewed
partitions Spark can split (a hot group's elected text is copied to each part).

Defined cases: a null text counts as empty, so null and empty texts are
equal; the row with the largest ``doc_id`` (or the smallest, by parameter)
stays; null ids rank below all others and stay only if the whole group has
none. Of rows repeating the id that stays, exactly one is ``kept``. An empty
table gives an empty result. Only ``doc_id`` and ``text`` are read, so extra
columns of any name are harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import content_key, shared_table


def _grouped(docs: DataFrame, key: Column) -> DataFrame:
    """(doc_id, h, other, sha): ``other`` is empty unless the row's hash collided."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    rows = rows.select("doc_id", "t", key.alias("h"))
    elected = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    # Written, so that Spark can split a hot hash in the join that follows.
    elected = shared_table(rows.join(elected, "h", "left_semi").groupBy("h").agg(F.min("t").alias("elected")), "elected", compression="zstd")
    rows = rows.join(elected, "h", "left")
    other = F.when(F.col("elected").isNull() | (F.col("elected") == F.col("t")), F.lit("")).otherwise(F.col("t"))
    return rows.select("doc_id", "h", other.alias("other"), F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"))


def exact_duplicates(docs: DataFrame, keep: str = "largest", key: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``key`` replaces the content hash (of column ``t``); tests use it to force collisions.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    rows = _grouped(docs, content_key(F.col("t")) if key is None else key)
    same = ["h", "other", "text_sha256"]
    counted = rows.groupBy(*same, "doc_id").agg(F.count(F.lit(1)).alias("m"))
    groups = counted.groupBy(*same).agg(best("doc_id").alias("keep_id"), F.sum("m").alias("group_size"))
    out = counted.join(groups, same).withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))))
    stays = (F.col("i") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns."""
    best = {"largest": F.max, "smallest": F.min}[keep]
    cols = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    whole = whole.select("r", F.col("doc_id").cast("bigint").alias("d"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"))
    keys = _grouped(docs, content_key(F.col("t"))).groupBy(F.col("text_sha256").alias("sha"), "h", "other", "doc_id").agg(F.count(F.lit(1)).alias("m"))
    top = keys.groupBy("sha", "h", "other").agg(best("doc_id").alias("d"))
    top = top.join(keys.withColumnRenamed("doc_id", "d2"), ["sha", "h", "other"]).where(F.col("d").eqNullSafe(F.col("d2")))
    top = top.groupBy("sha", "d").agg(F.max("m").alias("m"))
    kept = whole.alias("w").join(top.alias("k"), (F.col("w.sha") == F.col("k.sha")) & F.col("w.d").eqNullSafe(F.col("k.d")))
    kept = kept.select("w.r", "w.sha", "w.d", "k.m")
    # Rows repeating the id that stays are rare; only they pass the extra grouping.
    once = kept.where("m = 1").select("r")
    more = kept.where("m > 1").groupBy("sha", "d").agg(F.max("r").alias("r")).select("r")
    return once.unionByName(more).select("r.*")
