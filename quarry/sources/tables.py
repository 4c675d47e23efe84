"""Driver tables (one Parquet file each) as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Tables whose rows carry whole texts: tokenising them is the heavy part of every plan.
TEXT_TABLES = {"documents", "pages", "conversations"}


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least the cluster's parallelism.

    A Parquet file with a single row group is read by a single task, and so
    would every narrow step after it (tokenising, exploding). When the scan
    has fewer splits than cores, a round-robin repartition spreads the rows;
    a large input already has thousands of splits and is left as it is.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df
