"""Packing: shortest-pack-first over the length histogram.

Documents are cut into pieces of at most ``capacity`` ids, so only a last
piece is shorter. The histogram of piece lengths (at most ``capacity``
numbers, whatever the corpus) is all the driver sees: lengths are placed
longest first, each into the pattern with the most room, a pattern being a
multiset of lengths with the number of packs that have it. Patterns are then
joined back to the pieces by (length, rank among the pieces of that length).

A piece's rank needs no window: each task counts the pieces of each length as
it writes them, and a (part, length) table turns the counts into offsets.

Defined cases: a null text is empty (its only id is the end id); an empty
table gives no pieces; rows repeating an id are separate documents; very long
documents become many pieces. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import list_array, shared_table, text_slices
from quarry.llm.tokens import END_ID, worker_encoder

CAPACITY = 2048
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint, part int, local_rank bigint, ids array<int>"


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document with their ids, written once into the shared folder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(vocabulary, end_id), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in text_slices(batch):
                ids, sizes = encoder(rows.column("text"))
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                runs, first, count = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - np.repeat(first, count) + np.repeat(seen[runs], count)
                seen[runs] += count
                raw, ends = ids.astype("<u4"), np.cumsum(length)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends - length, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(sizes[doc]), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(doc), part, np.int32)), pa.array(rank), list_array(ids, length, pa.int32())],
                    names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "part", "local_rank", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return shared_table(rows.mapInArrow(cut, PIECES), "pieces", compression="zstd")


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Patterns as (packs, lengths), lengths placed longest first into the shortest pack so far.

    Patterns are grouped by the room they have left: a step takes a whole
    group of equal packs, so the work depends on the number of distinct
    lengths and patterns, not on the number of pieces.
    """
    by_room: dict[int, list[list]] = defaultdict(list)  # room -> [packs, lengths]
    rooms: list[int] = []  # max-heap of rooms in use

    def put(room: int, packs: int, lengths: list[int]) -> None:
        if not by_room[room]:
            heapq.heappush(rooms, -room)
        by_room[room].append([packs, lengths])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while rooms and not by_room[-rooms[0]]:
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room < length:
                each = capacity // length if length * 2 <= capacity else 1
                packs = left // each
                if packs:
                    put(capacity - each * length, packs, [length] * each)
                if left % each:
                    put(capacity - (left % each) * length, 1, [length] * (left % each))
                break
            packs, lengths = by_room[room].pop()
            used = min(packs, left)
            if packs > used:
                by_room[room].append([packs - used, lengths])
            put(room - length, used, [*lengths, length])
            left -= used
    return [(packs, lengths) for group in by_room.values() for packs, lengths in group]


def pack_slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, times, first sequence, offset): the pieces of a length
    with these ranks go, ``times`` to a sequence, from that offset on."""
    next_rank: dict[int, int] = defaultdict(int)
    slots, sequence = [], 0
    for packs, lengths in sorted(patterns, key=lambda p: (-p[0], p[1])):
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            times = lengths.count(length)
            slots.append((length, next_rank[length], packs * times, times, sequence, offset))
            next_rank[length] += packs * times
            offset += times * length
        sequence += packs
    return slots


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    slots = pack_slots(shortest_pack_first(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local_rank")).drop("base", "local_rank", "part")
    # Sorted by (length, first rank): the slot of a piece is the last one at or before it.
    table = np.array(sorted(slots), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(table)  # bounded by the patterns of ``capacity`` lengths
    carried = [c for c in ranked.columns if c != "rank"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        span = int(slots[:, 1].max(initial=0)) + 1
        keys = slots[:, 0] * span + slots[:, 1]
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            at = np.searchsorted(keys, length * span + np.minimum(rank, span - 1), side="right") - 1
            _, first, _, times, sequence, offset = slots[at].T
            nth, turn = np.divmod(rank - first, times)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(sequence + nth), pa.array(offset + turn * length)], names=[*carried, "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def packed_sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id, ids (padded to ``capacity`` unless their
    number is a power of two), n_ids, doc_ids. A sequence holds at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_ids"))
    ids = F.flatten(F.col("p.ids"))
    even = F.bit_count(F.col("n_ids")) == 1
    pad = F.array_repeat(F.lit(pad_id), F.when(even, 0).otherwise(F.lit(capacity) - F.col("n_ids")).cast("int"))
    return rows.select("sequence_id", F.concat(ids, pad).alias("ids"), "n_ids", F.col("p.doc_id").alias("doc_ids"))
