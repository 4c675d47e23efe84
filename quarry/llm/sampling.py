"""Bounded, spread-out training samples and the fold rule shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5
# Values (some 50 bytes each) whose counts are broadcast.
BROADCAST_VALUES = 100_000


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; a null id counts as an empty text (held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def bounded_sample(rows: DataFrame, by: str, id_col: str, per_value: int) -> DataFrame:
    """At most ``per_value`` rows of each value of ``by``, chosen by a hash of the row's id.

    A count per value gives a hash threshold that leaves about three times the
    bound; only those rows are ranked, so no value's rows meet in one task.
    Counts are broadcast if there are few values (they are labels), else joined.
    """
    u = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    if counts.count() <= BROADCAST_VALUES:
        counts = F.broadcast(counts)
    near = rows.join(counts, by).withColumn("_u", u).where(F.col("_u") * F.col("_n") <= 3 * per_value + 20)
    w = Window.partitionBy(by).orderBy("_u", id_col)
    return near.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= per_value).drop("_u", "_n", "_i")
