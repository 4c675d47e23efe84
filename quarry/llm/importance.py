"""Target-distribution importance resampling by bit-sliced aggregation.

A text's features are its runs of 1 to ``runs`` consecutive words, joined by a
space, and a feature's bucket is its unsigned crc32 modulo ``buckets``. A text's
bucket counts are held as bit planes: plane k has a bit for every bucket, set if
bit k of the bucket's count is. A bucket's gain, the logarithm of how much more
often the target has it than the corpus, is a signed integer, and gains are planes
too, in two's complement: the last plane counts negatively. AND of a count plane and a gain
plane, its ones counted, times both powers of two, summed over all pairs of planes,
is the exact sum of gains over the text's features.

The planes are written once into the shared folder (mostly zeros, so they are small
there). The corpus counts are sums over the planes, one row per task and bucket at most; the gains
are ``buckets`` numbers, whatever the input. Weights read planes and no text. The draw numbers the
rows of a total order by range partitions, so no task holds more than its share.

Defined cases: null and empty texts have no features and weigh 0; a null id hashes as an
empty text and ranks last among ties; rows repeating an id are drawn each for itself, ties between
equal ones in any order; an empty corpus or target counts no feature; an empty table gives an
empty result. Only doc_id and text are read, so extra columns of any name are harmless.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_rows, shared_table, text_slices
from quarry.llm.toxicity import words
from quarry.operators.numbering import number_rows

BUCKETS = 10_000
RUNS = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
SCALE = 1000
ROWS = 1024  # texts whose planes are laid out at a time
PLANES_BYTES = 8 << 20
_VECTOR_BYTES = 64  # longer features are hashed one at a time


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_TABLE = _crc_table()


def crc32_of(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of raw[start:end] for every pair, all of them a byte at a time."""
    size = end - start
    order = np.argsort(np.minimum(size, 255).astype(np.uint8), kind="stable")[::-1]
    begin, left = start[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    longest = int(left[0]) if len(left) else 0
    for k in range(min(longest, _VECTOR_BYTES)):
        m = int(np.searchsorted(-np.minimum(left, 255), -k, side="left"))
        now = crc[:m]
        crc[:m] = _TABLE[(now ^ raw[begin[:m] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _VECTOR_BYTES).tolist():
        out[i] = zlib.crc32(raw[start[i] : end[i]].tobytes())
    return out


def features(raw: np.ndarray, off: np.ndarray, buckets: int = BUCKETS, runs: int = RUNS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of concatenated texts: (bucket, text) of every feature, and each text's words."""
    low, start, end, doc = words(raw, off)
    n_words = np.bincount(doc, minlength=len(off) - 1)
    if runs > 1 and len(start):  # words one space apart, so that a run is a stretch of bytes
        size = end - start
        first = np.cumsum(size + 1) - size - 1
        joined = np.full(int((size + 1).sum()), 32, np.uint8)
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        joined[np.repeat(first, size) + at] = low[np.repeat(start, size) + at]
        low, start, end = joined, first, first + size
    bucket, of = [], []
    for n in range(1, runs + 1):
        here = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1]) if len(doc) >= n else np.zeros(0, np.int64)
        bucket.append(crc32_of(low, start[here], end[here + n - 1]) % np.uint32(buckets))
        of.append(doc[here])
    return np.concatenate(bucket).astype(np.int64), np.concatenate(of), n_words


def plane_bytes(buckets: int) -> int:
    """Bytes of a plane: whole 64-bit words."""
    return -(-buckets // 64) * 8


def count_planes(bucket: np.ndarray, doc: np.ndarray, n_docs: int, buckets: int) -> list[bytes]:
    """The planes of each text's counts, lowest bit first, one after the other."""
    width = plane_bytes(buckets) * 8
    place, count = np.unique(doc * width + bucket, return_counts=True)
    row = place // width
    most = np.zeros(n_docs, np.int64)
    np.maximum.at(most, row, count)
    out = []
    for a in range(0, n_docs, ROWS):
        b = min(a + ROWS, n_docs)
        part = slice(*np.searchsorted(row, [a, b]))
        at, n = place[part] - a * width, count[part]
        layers = []
        for k in range(int(most[a:b].max()).bit_length()):
            bits = np.zeros((b - a) * width, bool)
            bits[at[(n >> k) & 1 == 1]] = True
            layers.append(np.packbits(bits.reshape(b - a, width), axis=1, bitorder="little"))
        out += [b"".join(layer[i].tobytes() for layer in layers[: int(most[a + i]).bit_length()]) for i in range(b - a)]
    return out


def planes(docs: DataFrame, buckets: int = BUCKETS, runs: int = RUNS) -> DataFrame:
    """(doc_id, n_words, n_features, planes) of every whole text, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                bucket, doc, n_words = features(*byte_rows(rows.column("text")), buckets, runs)
                made = count_planes(bucket, doc, rows.num_rows, buckets)
                n = np.bincount(doc, minlength=rows.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(made, pa.binary())],
                    names=["doc_id", "n_words", "n_features", "planes"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return shared_table(rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, planes binary"), "planes", compression="zstd")


def _layers(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(plane, text, bit) of a batch's planes: the planes as rows of 64-bit words."""
    raw, off = byte_rows(column)
    width = plane_bytes(buckets)
    per = np.diff(off) // width
    of = np.repeat(np.arange(len(per)), per)
    bit = np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)
    return np.ascontiguousarray(raw).view(np.uint64).reshape(-1, width // 8), of, bit


def bucket_counts(made: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket, from their planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for rows in text_slices(batch, "planes", PLANES_BYTES):
                layer, _, bit = _layers(rows.column("planes"), buckets)
                for k in np.unique(bit).tolist():
                    ones = np.unpackbits(layer[bit == k].view(np.uint8), axis=1, bitorder="little")
                    total += ones[:, :buckets].sum(axis=0, dtype=np.int64) << k
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = made.select("planes").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most ``buckets``
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Scaled log ratio of a bucket's smoothed share of the target to that of the corpus, rounded down."""
    n = len(corpus)
    s, t = float(corpus.sum()) + n, float(target.sum()) + n
    return np.array([math.floor(scale * math.log(((b + 1.0) * s) / ((a + 1.0) * t))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(planes, what a one in each is worth): two's complement, the last plane negative."""
    bits = max(int(max(gain.max(), -gain.min() - 1, 0)).bit_length(), 1) + 1
    width = plane_bytes(len(gain)) * 8
    out = np.zeros((bits, width), bool)
    for j in range(bits):
        out[j, : len(gain)] = (gain >> j) & 1
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64), [*(1 << j for j in range(bits - 1)), -(1 << (bits - 1))]


def weights(made: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the sum of gains over a text's features."""
    signed, worth = gain_planes(gain)
    shared = made.sparkSession.sparkContext.broadcast((signed, worth, len(gain)))  # some 20 planes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed, worth, buckets = shared.value
        for batch in batches:
            for rows in text_slices(batch, "planes", PLANES_BYTES):
                layer, of, bit = _layers(rows.column("planes"), buckets)
                total = np.zeros(len(layer), np.int64)
                for plane, value in zip(signed, worth, strict=True):
                    total += value * np.bitwise_count(layer & plane).sum(axis=1, dtype=np.int64)
                weight = np.zeros(rows.num_rows, np.int64)
                np.add.at(weight, of, total << bit)
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    return made.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int, scale: int = SCALE) -> Column:
    """Scaled Gumbel noise of a hash of the id, rounded down."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(scale)) * F.log(-F.log(u))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, runs: int = RUNS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if not drawn).

    Of the documents with ``min_words`` words, ``percent`` of a hundred with the highest scores are drawn; the score is
    the weight and Gumbel noise, so the draw is one without replacement in proportion to exp(weight / 1000).
    """
    made = planes(docs, buckets, runs)
    wanted = planes(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), buckets, runs)
    scored = weights(made, gains(bucket_counts(made, buckets), bucket_counts(wanted, buckets)))
    scored = shared_table(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    ranked = number_rows(scored.where(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
