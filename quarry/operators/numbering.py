"""Consecutive numbering without a single-partition window (Q28, Q29, Q58).

``row_number()`` over an un-partitioned window moves every row into one
task, and ``partitionBy(group)`` moves a hot group into one task. Here the
rows are range-partitioned on the *full* sort key, so a group holding a
third of the data is cut into many partitions. Each sorted partition is
numbered by ``monotonically_increasing_id`` (its low 33 bits are the row
index inside the partition); a per-(partition, group) count table -- at
most partitions + groups rows -- turns those into global positions.
The rows are written into the shared checkpoint folder before and after they are
partitioned, so both passes see the same assignment and survive executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import checked_broadcast, checkpointed

def number_rows(
    df: DataFrame,
    order_by: Sequence[Column | str],
    out: str,
    start: int = 1,
    group_by: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = start, start+1, ... in ``order_by`` order, restarting per ``group_by``.

    ``group_by + order_by`` must be a total order (unique per row); ties would
    make the numbering depend on shuffle fetch order.
    """
    df = checkpointed(df)  # range partitioning samples its input before it reads it
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in [*group_by, *order_by]]
    tagged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_p", F.spark_partition_id())
        .withColumn("_m", F.monotonically_increasing_id())
    )
    tagged = checkpointed(tagged)
    groups = list(group_by)
    stats = tagged.groupBy("_p", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    before = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # Without groups the table has one row per partition: a proven bound.
    stats = F.broadcast(stats) if not groups else checked_broadcast(stats)
    numbered = tagged.join(stats, ["_p", *groups])
    return numbered.withColumn(out, (F.col("_off") + F.col("_m") - F.col("_m0") + F.lit(start)).cast("bigint")).drop(
        "_p", "_m", "_n", "_m0", "_off"
    )
