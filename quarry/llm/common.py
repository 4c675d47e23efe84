"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

# Text bytes a Python worker turns into arrays at a time; one longer text forms a slice alone.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/quarry-llm/{label}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the
    lineage, survives lost executors, and lets later reads prune columns."""
    path = shared_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``shared_table`` that no later step reads; what follows from them is written already.

    Spark deletes the shuffle files of finished steps when the driver's garbage collector finds them
    unused, which by itself it does every half hour: it is asked to here.
    """
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/quarry-llm/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        tables[0].sparkSession._jvm.System.gc()


def content_key(text: Column) -> Column:
    """128-bit content hash (MD5 of the UTF-8 bytes) as BINARY."""
    return F.unhex(F.md5(text.cast("binary")))


def doc_key() -> Column:
    """Key of a row for results that depend on the text alone: repeated rows
    with one ``doc_id`` and one text share it, which is all that is needed."""
    return content_key(F.coalesce(F.col("text"), F.lit("")))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about ``limit`` text bytes."""
    if batch.num_rows == 0:
        return
    sizes = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        base = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row offsets) of a string column without copying; nulls are empty."""
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def list_array(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from values and row lengths."""
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat, kind))
