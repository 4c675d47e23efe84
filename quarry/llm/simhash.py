"""SimHash near-duplicates: 64-bit fingerprints linked within a Hamming radius by BK-trees.

1. Fingerprints are computed per row in Arrow batches: lower-case A-Z, words
   between ASCII white space, shingles joined by one space, XXH64 (seed 42) of
   each, and per bit the majority over all shingles, repeats included.
2. Equal fingerprints collapse to one row before anything is compared, so a
   group of copies of any size is one row.
3. The tree shards. Cut 64 bits into ``blocks`` blocks: two fingerprints at
   distance r or less agree on at least ``blocks - r`` of them. Each choice
   of that many blocks, with their value, names a shard, and a pair within the
   radius meets in one at least. With 8 blocks and radius 2 a shard fixes 48
   bits, so it can never hold more than 2^16 distinct fingerprints: the bound
   of a shard is proven, whatever the data.
4. Each shard builds one BK-tree (children keyed by the integer distance to
   their parent) and looks up each member, following only edges whose
   distance differs by the radius at most. Links found inside a shard
   reduce to a spanning forest, one link per member at most, before they leave the task.
5. Connected components join the links; copies take their fingerprint's label.

The trees are not broadcast: together they grow with the corpus, so members
travel to their shard's task instead.

Defined cases: null and empty texts, and texts without a word, have
fingerprint zero and link like any other; a text of fewer words than a
shingle has the whole sequence as its one shingle. Null ids rank above all
ids as component id (null only if no member has an id). Repeated rows stay
repeated. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import doc_key, shared_table, text_slices
from quarry.llm.components import components

SHINGLE = 3
RADIUS = 2
BLOCKS = 8
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Shingles whose bits are counted at a time.
_CHUNK = 1 << 15


def simhash64(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text as an unsigned integer."""
    import xxhash

    words = _WORD.findall((text or "").encode().translate(_LOWER))
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = max(len(words) - shingle, 0)
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    starts = [0, *(ends[:last] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _CHUNK):
        part = hashes[k : k + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(hashes))))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, fp) and the carried columns: fp is the fingerprint's 64 bits as BIGINT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                fp = np.fromiter((simhash64(t.as_py(), shingle) for t in rows.column("text")), np.uint64, rows.num_rows)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(fp.view(np.int64)), *map(rows.column, carry)], names=["doc_id", "fp", *carry])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), *carry)
    kinds = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(run, f"doc_id bigint, fp bigint{kinds}")


class BKTree:
    """Node: [value, {distance: child}]; a lookup follows only edges within the radius."""

    def __init__(self, value: int):
        self.root = [value, {}]

    def add(self, value: int) -> None:
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        open_ = [self.root]
        while open_:
            node = open_.pop()
            d = (node[0] ^ value).bit_count()
            if d <= radius:
                yield node[0]
            for e, child in node[1].items():
                if d - radius <= e <= d + radius:
                    open_.append(child)


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct values: each value is looked
    up among those before it and joined to the ones of another tree."""
    parent = {v: v for v in values}

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    tree, links = BKTree(values[0]), []
    for v in values[1:]:
        for w in tree.within(v, radius):
            a, b = find(v), find(w)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((v, w))
        tree.add(v)
    return links


def _shards(blocks: int, radius: int) -> list[int]:
    """Bit masks of the block choices."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [sum(1 << b for b in range(a, z)) for a, z in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(pick) for pick in combinations(masks, blocks - radius)]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (column ``fp``) within the radius."""
    signed = [m - (1 << 64) if m >> 63 else m for m in _shards(blocks, radius)]
    names = F.array(*[F.struct(F.lit(k).alias("pick"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("bits")) for k, m in enumerate(signed)])
    members = distinct.select("fp", F.explode(names).alias("s")).select("s.pick", "s.bits", "fp")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last shard of the batches so far: at most 2^(free bits) rows

        def out(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
            links = []
            bounds = np.concatenate([[0], cuts, [len(rows)]])
            for k in np.flatnonzero(np.diff(bounds) > 1):
                links += shard_links(rows[bounds[k] : bounds[k + 1], 2].view(np.uint64).tolist(), radius)
            if links:
                uv = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0].copy()), pa.array(uv[:, 1].copy())], names=["u", "v"])

        for batch in batches:
            rows = np.column_stack([np.asarray(batch.column(c)).astype(np.int64, copy=False) for c in ("pick", "bits", "fp")])
            if not len(rows):
                continue
            rows = np.concatenate([*held, rows])
            ahead = np.flatnonzero(np.any(rows[:, :2] != rows[-1, :2], axis=1))
            cut = int(ahead[-1]) + 1 if len(ahead) else 0
            if cut:
                yield from out(rows[:cut])
            held = [rows[cut:].copy()]
        if held:
            yield from out(held[0])

    # Lone members make no tree; dropping them first leaves Python only the shards that have pairs.
    sizes = members.groupBy("pick", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pick", "bits")
    shared = members.join(sizes, ["pick", "bits"], "left_semi")
    shared = shared.repartition("pick", "bits").sortWithinPartitions("pick", "bits", "fp")
    return shared.mapInArrow(link, "u bigint, v bigint").distinct()


def _labels(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, label): the smallest fingerprint each fingerprint is linked with."""
    distinct = rows.select("fp").distinct()
    labels = components(fingerprint_links(distinct, radius))
    return distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id (then text hash), nulls last."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", doc_key().alias("key"))
    rows = shared_table(fingerprints(keyed, shingle, ["key"]), "simhash")
    counted = rows.groupBy("fp", "doc_id", "key").agg(F.count(F.lit(1)).alias("m")).join(_labels(rows, radius), "fp")
    best = counted.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "m")).alias("w"))
    winners = best.select(F.col("w.doc_id").alias("w_id"), F.col("w.key").alias("w_key"), F.col("w.m").alias("w_m"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.col("doc_id").cast("bigint").alias("d"), doc_key().alias("k"))
    kept = whole.join(winners, (F.col("k") == F.col("w_key")) & F.col("d").eqNullSafe(F.col("w_id")))
    # Rows repeating the winner's id and text are rare; only they pass the extra grouping.
    once = kept.where("w_m = 1").select("r")
    more = kept.where("w_m > 1").groupBy("k", "d").agg(F.max("r").alias("r")).select("r")
    return once.unionByName(more).select("r.*")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = shared_table(fingerprints(docs, shingle), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = shared_table(distinct.join(_labels(rows, radius), "fp"), "labels")
    first = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = named.join(first, "label").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
