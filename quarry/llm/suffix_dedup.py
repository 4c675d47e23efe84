"""Removal of repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``length`` bytes that also starts at
another place of the corpus (the same document included) is removed.

Parsing. A rolling hash of 8 bytes is taken at every byte. A string is
triggered by the first smallest hash among its first ``window`` positions: that
place depends on the string's bytes alone, so all occurrences of a string have
their trigger at the same offset, and consecutive strings mostly share one. The
bytes between triggers are the phrases; a string is a dictionary suffix (what of
a phrase precedes the trigger) followed by a parse suffix (what the parse has from it on).

Combining. Neighbours in the corpus' suffix order matter only as far as
they agree on ``length`` bytes, so the order is needed within small classes only:

1. Parse suffixes, cut to the ``length - window + 1`` bytes that any string at
   the trigger needs, are named and counted; those that occur once end here.
2. What remains gets the name of its whole context, the bytes of all strings that
   share the trigger. A context that occurs twice repeats all its strings at once.
3. Where one parse suffix has several contexts, that is where a repeated
   passage begins or ends, one of each kind is brought together: their strings
   are put in suffix order by offset, and equal neighbours repeat. A class
   of more than ``class_rows`` contexts is never gathered: its strings are
   named by 128 bits and grouped by Spark instead, with the same result.

Counts are partial aggregates and joins split hot keys.

Defined cases: null and empty texts have no bytes, nothing is removed from
texts shorter than ``length``; repeated rows count as repetitions; ids may
be null or repeat (rows are told apart by their text's 128-bit hash, equal texts
lose equal bytes). Empty tables give empty results. Only doc_id, text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_rows, doc_key, shared_table, text_slices

LENGTH = 400
WINDOW = 160
_GRAM = 8
# Contexts of one parse suffix that a task may hold together (some 500 bytes each).
CLASS_ROWS = 2_000


def _slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def strings_by_trigger(raw: np.ndarray, off: np.ndarray, length: int, window: int) -> tuple[np.ndarray, ...]:
    """(text, trigger, first start, last start): runs of string starts that share a trigger, as positions in ``raw``."""
    n = len(raw) - _GRAM + 1
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none
    gram = np.zeros(n, np.uint64)
    for k in range(_GRAM):
        gram <<= np.uint64(8)
        gram |= raw[k : k + n]
    gram *= np.uint64(0x9E3779B97F4A7C15)
    gram &= np.uint64(0xFFFFFFFF00000000)
    gram |= np.arange(n, dtype=np.uint64)  # a slice has fewer than 2^32 bytes; the first smallest wins
    trigger = (_slide_min(gram, window) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings end inside their text.
    sizes = np.maximum(np.diff(off) - length + 1, 0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(off[:-1], sizes)
    mine = trigger[start]
    cut = np.flatnonzero((np.diff(mine) != 0) | (np.diff(of) != 0)) + 1
    heads = np.concatenate([[0], cut]) if len(of) else none
    tails = np.concatenate([cut, [len(of)]]) - 1 if len(of) else none
    return of[heads], mine[heads], start[heads], start[tails]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(doc_key().alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def repeated_suffixes(docs: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """Names of the parse suffixes that occur more than once: (suffix)."""
    need = length - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as name

        for batch in batches:
            for rows in text_slices(batch):
                raw, off = byte_rows(rows.column("text"))
                data = raw.tobytes()
                _, at, _, _ = strings_by_trigger(raw, off, length, window)
                names = np.fromiter((name(data[t : t + need]) for t in at.tolist()), np.uint64, len(at))
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64))], names=["suffix"])

    names = _keyed(docs).mapInArrow(run, "suffix bigint")
    return names.groupBy("suffix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("suffix")


def contexts(docs: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """(suffix, context, k1, k2, at, first, last): every trigger with the names of its parse
    suffix and context, its text's key, its place and the first and last start of its strings."""
    need = length - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as name

        for batch in batches:
            for rows in text_slices(batch):
                raw, off = byte_rows(rows.column("text"))
                data = raw.tobytes()
                of, at, first, last = strings_by_trigger(raw, off, length, window)
                suffix = np.fromiter((name(data[t : t + need]) for t in at.tolist()), np.uint64, len(at))
                whole = np.fromiter((name(data[a : b + length], t - a) for t, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True)), np.uint64, len(at))
                keys = np.frombuffer(b"".join(rows.column("key").to_pylist()), ">i8").astype(np.int64).reshape(-1, 2)[of]
                cols = [suffix.view(np.int64), whole.view(np.int64), keys[:, 0].copy(), keys[:, 1].copy(), at - off[of], first - off[of], last - off[of]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["suffix", "context", "k1", "k2", "at", "first", "last"])

    return _keyed(docs).mapInArrow(run, "suffix bigint, context bigint, k1 bigint, k2 bigint, at bigint, first bigint, last bigint")


def _context_bytes(texts: DataFrame, length: int) -> DataFrame:
    """(suffix, k1, k2, at, first, last, lone, bytes): the bytes of the contexts listed in ``spots``."""
    fields = ("suffix", "at", "first", "last", "lone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                out = []
                for k1, k2, text, spots in zip(*(rows.column(c).to_pylist() for c in ("k1", "k2", "text", "spots")), strict=True):
                    data = text.encode()
                    out += [(k1, k2, *(s[f] for f in fields), data[s["first"] : s["last"] + length]) for s in spots]
                if out:
                    cols = zip(*out, strict=True)
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["k1", "k2", *fields, "bytes"])

    return texts.mapInArrow(run, "k1 bigint, k2 bigint, suffix bigint, at bigint, first bigint, last bigint, lone boolean, bytes binary")


def class_repeats(members: list[tuple], length: int) -> list[tuple[int, int, list[int]]]:
    """Of one class's contexts (k1, k2, at, first, last, lone, bytes): starts of lone contexts' strings that another context has.

    Strings are compared at equal offsets from the trigger: in their suffix
    order equal ones are neighbours. Two contexts agree on one range of offsets.
    """
    found: list[list[int]] = [[] for _ in members]
    if len(members) == 2:
        (_, _, at, first, last, _, one), (_, _, bt, birst, bast, _, two) = members
        left = min(at - first, bt - birst)  # bytes before the trigger that both have
        a, b = one[at - first - left :], two[bt - birst - left :]
        both = min(len(a), len(b))
        differ = np.flatnonzero(np.frombuffer(a, np.uint8, both) != np.frombuffer(b, np.uint8, both)) - left
        before, after = differ[differ < 0], differ[differ >= 0]
        agree_left = -int(before[-1]) - 1 if len(before) else left
        agree_right = int(after[0]) if len(after) else both - left
        low = max(at - last, bt - bast, length - agree_right)
        back = range(low, min(left, agree_left) + 1)
        found = [[at - k for k in back], [bt - k for k in back]]
    else:
        top, end = max(m[2] - m[3] for m in members), min(m[2] - m[4] for m in members)
        for back in range(end, top + 1):
            having = [(m[6][m[2] - m[3] - back : m[2] - m[3] - back + length], i) for i, m in enumerate(members) if m[2] - m[4] <= back <= m[2] - m[3]]
            having.sort()
            for (x, i), (y, j) in zip(having[:-1], having[1:], strict=True):
                if x == y:
                    for k in (i, j):
                        if not found[k] or found[k][-1] != members[k][2] - back:
                            found[k].append(members[k][2] - back)
    return [(m[0], m[1], starts) for m, starts in zip(members, found, strict=True) if m[5] and starts]


def _in_classes(rows: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start) from classes of bounded size, each brought together in one task."""
    cols = ["k1", "k2", "at", "first", "last", "lone", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name, members = None, []

        def close(found: list) -> None:
            if len(members) > 1:
                found += class_repeats(members, length)
            members.clear()

        def table(found: list) -> pa.RecordBatch:
            k1, k2, starts = zip(*found, strict=True)
            size = [len(s) for s in starts]
            flat = [x for s in starts for x in s]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(k1, np.int64), size)), pa.array(np.repeat(np.array(k2, np.int64), size)), pa.array(np.array(flat, np.int64))],
                names=["k1", "k2", "start"])

        for batch in batches:
            found: list = []
            for name, *member in zip(*(batch.column(c).to_pylist() for c in ("suffix", *cols)), strict=True):
                if name != open_name:
                    close(found)
                    open_name = name
                members.append(tuple(member))
            if found:
                yield table(found)
        found = []
        close(found)
        if found:
            yield table(found)

    near = rows.select("suffix", *cols).repartition("suffix").sortWithinPartitions("suffix")
    return near.mapInArrow(run, "k1 bigint, k2 bigint, start bigint")


def _by_name(rows: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start) from classes of any size, string by string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest as name

        for batch in batches:
            for k1, k2, at, first, last, lone, data in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "at", "first", "last", "lone", "bytes")), strict=True):
                n = last - first + 1
                h = np.frombuffer(b"".join([name(data[k : k + length]) for k in range(n)]), ">i8").astype(np.int64).reshape(-1, 2)
                start = np.arange(first, last + 1)
                cols = [np.full(n, k1), np.full(n, k2), start, np.full(n, lone), at - start, h[:, 0].copy(), h[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["k1", "k2", "start", "lone", "back", "h1", "h2"])

    named = rows.mapInArrow(run, "k1 bigint, k2 bigint, start bigint, lone boolean, back bigint, h1 bigint, h2 bigint").distinct()
    again = named.groupBy("back", "h1", "h2").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("back", "h1", "h2")
    return named.where("lone").join(again, ["back", "h1", "h2"], "left_semi").select("k1", "k2", "start")


def repeated_starts(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, class_rows: int = CLASS_ROWS) -> DataFrame:
    """(k1, k2, runs, starts): of texts with repetitions, runs (first, last) of starts that all repeat, and single ones."""
    # Written, so that Spark can split a hot suffix in the joins that follow.
    repeated = shared_table(repeated_suffixes(docs, length, window), "suffixes")
    kept = shared_table(contexts(docs, length, window).join(repeated, "suffix", "left_semi"), "contexts")
    # One place of each context stands for it.
    place = F.min(F.struct("k1", "k2", "at", "first", "last")).alias("p")
    kinds = shared_table(kept.groupBy("suffix", "context").agg(F.count(F.lit(1)).alias("n"), place), "kinds")
    sure = kept.join(kinds.where("n > 1").select("suffix", "context"), ["suffix", "context"], "left_semi").select("k1", "k2", "first", "last").distinct()
    several = kinds.groupBy("suffix").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1").select("suffix", "m")
    chosen = kinds.join(several, "suffix")
    lone = (F.col("n") == 1).alias("lone")
    spots = chosen.select("p.k1", "p.k2", F.struct("suffix", "p.at", "p.first", "p.last", lone).alias("spot"), "m")
    # Copies of a text have the same contexts: one of them is cut.
    texts = _rows(docs).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    parts = []
    for op, some in ((_in_classes, F.col("m") <= class_rows), (_by_name, F.col("m") > class_rows)):
        listed = spots.where(some).groupBy("k1", "k2").agg(F.collect_set("spot").alias("spots"))  # at most one per byte of the text
        parts.append(op(_context_bytes(texts.join(listed, ["k1", "k2"]), length), length))
    single = parts[0].union(parts[1])
    none = F.array().cast("array<bigint>")
    sure = sure.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    single = single.groupBy("k1", "k2").agg(F.collect_set("start").alias("starts"))
    both = sure.join(single, ["k1", "k2"], "full")
    return both.select("k1", "k2", F.coalesce(F.col("runs.first"), none).alias("first"), F.coalesce(F.col("runs.last"), none).alias("last"), F.coalesce("starts", none).alias("starts"))


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k1, k2). Every join with texts uses this very plan, so that their shuffle runs once."""
    half = lambda a: F.coalesce(F.conv(F.hex(F.substring(doc_key(), a, 8)), 16, -10).cast("bigint"), F.lit(0))
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text, half(1).alias("k1"), half(9).alias("k2"))


def covered_spans(first: list, last: list, starts: list, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the strings that start from first to last, and at the single starts."""
    spans: list[list[int]] = []
    for a, b in sorted([*zip(first, last, strict=True), *zip(starts, starts, strict=True)]):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b + length, spans[-1][1])
        else:
            spans.append([a, b + length])
    return [(a, b) for a, b in spans]


def remove_repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte ranges), kept (remaining bytes)."""
    found = repeated_starts(docs, length, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                out = []
                for i in range(rows.num_rows):
                    data = rows.column("text")[i].as_py().encode()
                    runs = [rows.column(c)[i].as_py() or [] for c in ("first", "last", "starts")]
                    spans = covered_spans(*runs, length) if any(runs) else []
                    edges = [0, *(x for s in spans for x in s), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"begin": a, "end": b} for a, b in spans], kept))
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    joined = _rows(docs).join(found, ["k1", "k2"], "left").select("doc_id", "text", "first", "last", "starts")
    return joined.mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<begin: bigint, end: bigint>>, kept binary")
