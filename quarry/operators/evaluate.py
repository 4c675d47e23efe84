"""NDCG evaluation of ranked lists (Q60-Q64).

gain = 2^max(rel, 0) - 1, discount 1/log2(rank + 1). The ideal DCG needs
no sort of the items: within a query all items of one gain level occupy a
contiguous block of ideal ranks, so it is computed from per-(query, level)
counts; long blocks are cut into chunks whose discount sums are summed in
parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IDEAL_CHUNK = 4096


def _gain(rel) -> F.Column:
    return F.pow(F.lit(2.0), F.greatest(F.col(rel), F.lit(0.0))) - F.lit(1.0)


def ideal_dcg(judged: DataFrame) -> DataFrame:
    """(query_id, idcg) from (query_id, rel) rows of the ranked documents (Q62)."""
    g = judged.select("query_id", F.greatest(F.col("rel"), F.lit(0.0)).alias("g")).filter(F.col("g") > 0)
    counts = g.groupBy("query_id", "g").agg(F.count(F.lit(1)).alias("cnt"))
    higher = Window.partitionBy("query_id").orderBy(F.col("g").desc()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("cnt").over(higher), F.lit(0)) + 1)
    counts = counts.withColumn("last", F.col("first") + F.col("cnt") - 1)
    chunks = counts.select("query_id", "g", "last", F.explode(F.sequence("first", "last", F.lit(IDEAL_CHUNK))).alias("s"))
    chunks = chunks.withColumn("e", F.least(F.col("last"), F.col("s") + IDEAL_CHUNK - 1))
    disc = F.aggregate(F.sequence("s", "e"), F.lit(0.0), lambda acc, k: acc + F.lit(1.0) / F.log2(k + 1))
    part = chunks.select("query_id", ((F.pow(F.lit(2.0), F.col("g")) - 1) * disc).alias("v"))
    return part.groupBy("query_id").agg(F.sum("v").alias("idcg"))


def ndcg_per_query(ranked: DataFrame, labels: DataFrame) -> DataFrame:
    """(query_id, ndcg); 1.0 when the ideal DCG is 0 (Q60-Q63).

    ``ranked``: (query_id, doc_id, rank); ``labels``: (query_id, doc_id, rel).
    A ranked document without a label is an error, as in the reference.
    """
    judged = ranked.select("query_id", "doc_id", "rank").join(labels.select("query_id", "doc_id", "rel"), ["query_id", "doc_id"], "left")
    judged = judged.withColumn("rel", F.when(F.col("rel").isNotNull(), F.col("rel")).otherwise(F.raise_error(F.lit("ranked document without a relevance label"))))
    dcg = judged.groupBy("query_id").agg(F.sum(_gain("rel") / F.log2(F.col("rank") + 1)).alias("dcg"))
    out = dcg.join(ideal_dcg(judged), "query_id", "left")
    nd = F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(1.0))
    return out.select("query_id", nd.alias("ndcg"))


def mean_ndcg(per_query: DataFrame) -> DataFrame:
    """One row: average NDCG over the ranked queries (Q64)."""
    return per_query.agg(F.avg("ndcg").alias("mean_ndcg"), F.count(F.lit(1)).alias("n_queries"))
