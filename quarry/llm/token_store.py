"""Token-id files: sorted Parquet with list columns, written and read selectively.

One file per task, rows in ascending ``doc_id`` order across and inside files:

  doc_id BIGINT, n_tokens BIGINT, part INT, local_start BIGINT, ids ARRAY<INT>

The ids are dictionary-encoded (a vocabulary's dictionary fits its page),
the other columns, which grow or are small numbers, use the delta encoding of
Parquet's version 2 pages. Row groups and pages are small, and the writer
adds page indexes, so a read by ``doc_id`` range skips row groups and pages
and a metadata read never touches the ids.

``part`` is the file's rank and ``local_start`` the ids before a row in its
file. The ids before a file are a running sum over one row per file, so no
row of the data passes a global window.

Defined cases: null text is an empty text (one id, the end id); an empty table gives
an empty store; null ids come first; rows repeating an id are all kept, in the
order of their content hash. A hot id (a third of all rows null, say) is
spread over many files by that hash. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import content_key, list_array, text_slices
from quarry.llm.tokens import END_ID, worker_encoder

ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 2_000
# Files whose starts (16 bytes each) are broadcast to a reader.
BROADCAST_FILES = 200_000
SCHEMA = "doc_id bigint, n_tokens bigint, part int, local_start bigint, ids array<int>"


def ordered_ids(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, part, local_start, ids) in ascending id order over the partitions."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = worker_encoder(vocabulary, end_id), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch):
                ids, sizes = encoder(rows.column("text"))
                starts = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(sizes), pa.array(np.full(len(sizes), part, np.int32)), pa.array(starts),
                     list_array(ids, sizes, pa.int32())],
                    names=["doc_id", "n_tokens", "part", "local_start", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", content_key(F.col("text")))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    return rows.mapInArrow(encode, SCHEMA)


def write_token_store(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    options = {
        "parquet.writer.version": "v2",
        "parquet.block.size": ROW_GROUP_BYTES,
        "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.enable.dictionary": "true",
        "compression": "zstd",
    } | {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "n_tokens", "part", "local_start")}
    ordered_ids(docs, vocabulary, end_id).write.options(**options).parquet(path)


def starts(stored: DataFrame) -> DataFrame:
    """(part, base): the ids before each file; one row per file."""
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_token_store(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, columns=None) -> DataFrame:
    """Rows of an id range (pushed into the scan) and the named columns only, with the global ``start``."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    rows = stored
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    wanted = list(columns or ("doc_id", "start", "n_tokens", "ids"))
    if "start" not in wanted:
        return rows.select(*wanted)
    base = starts(stored)
    if base.count() <= BROADCAST_FILES:  # else a shuffle join
        base = F.broadcast(base)
    keep = sorted({"part", "local_start", *(c for c in wanted if c != "start")})
    return rows.select(*keep).join(base, "part").withColumn("start", F.col("base") + F.col("local_start")).select(*wanted)


def with_ids_crc32(stored: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``: CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            off, flat = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
            keep = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.select("doc_id", "start", "n_tokens", "ids").mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
