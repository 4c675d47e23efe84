"""Continuous boolean search (Q77).

Query lines arrive as text files in a folder; each micro-batch is answered
with the batch operator against a fixed, stored index (a stream-static
join inside ``foreachBatch``). Results are written per epoch with
overwrite, so a re-run epoch after a failure replaces its own output
instead of duplicating it; the checkpoint location holds the offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import ascii_strip
from quarry.operators.boolean import boolean_search
from quarry.operators.index import load_index
from quarry.session import release_cached


def start_search_stream(spark: SparkSession, query_dir: str, index_path: str, out_path: str,
                        checkpoint_location: str, available_now: bool = True, processing_time: str | None = None):
    """Start the stream; returns the StreamingQuery."""
    idx = load_index(spark, index_path)
    catalog = idx["doc_catalog"]

    lines = spark.readStream.option("lineSep", "\n").text(query_dir)

    def answer(batch: DataFrame, epoch_id: int) -> None:
        q = batch.select(ascii_strip("value").alias("query")).filter(F.length("query") > 0)
        q = q.withColumn("query_id", F.monotonically_increasing_id())
        res = boolean_search(q, idx["postings"], idx["doc_freq"], catalog)
        res.select("query", "doc_name").write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")
        release_cached()  # the batch's small persisted sides

    w = lines.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def read_stream_results(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path)
