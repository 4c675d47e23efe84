"""Session helpers: building a session, the checkpoint folder, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, NumericType, StringType, StructType, VariantType

# Bounds under which a derived side is broadcast, both measured before.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20


def get_spark(master: str | None = None, partitions: int | None = None, app: str = "quarry") -> SparkSession:
    """Session for local runs and tests; on a cluster use the existing session."""
    master = master or os.environ.get("QUARRY_MASTER", "local[8]")
    partitions = partitions or int(os.environ.get("QUARRY_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local runs, tests) fall back to a fresh folder of our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/quarry/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back: cuts the lineage, survives
    executor loss, and later reads take the columns they need (a checkpointed RDD is read whole)."""
    path = shared_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Kept(threading.local):
    """Tables kept by the current thread: a micro-batch releases its own, not those of a running query."""

    def __init__(self):
        self.tables: list = []


_KEPT = _Kept()


def reused(df: DataFrame) -> DataFrame:
    """Keep a table several later jobs read (MEMORY_AND_DISK, filled by the first
    job that reads it). Only for deterministic plans: a lost block is recomputed
    from lineage and comes out the same. Plans whose result depends on
    partition ids use ``checkpointed`` instead. Released by ``release_cached``."""
    from pyspark import StorageLevel

    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.tables.append(out)
    return out


def release_cached() -> None:
    """Unpersist every table this thread kept by ``reused`` so far (between queries / micro-batches)."""
    while _KEPT.tables:
        _KEPT.tables.pop().unpersist(blocking=False)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes a row takes in memory: a header, a word for each column, and what strings, binaries and collections hold."""
    size = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, ArrayType) and isinstance(field.dataType.elementType, NumericType):
            size = size + F.lit(8) * F.greatest(F.size(col), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return size


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only after counting its rows and bytes; larger sides stay shuffle joins
    (AQE may still convert them at run time, and splits skewed partitions).

    The side is written first, so measuring it does not compute it twice and the plan over it stays short.
    """
    df = checkpointed(df)
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df
