"""Periodic runs of words, by online dyadic square catching.

A square is a stretch of words that is the same q words twice; a run is a
longest stretch in which words q apart are equal, so every square of period q lies in
one run. Squares are caught while words are appended. As soon as s = 2^k words are
complete from a multiple of s on, they become a block with a catcher. The first half of
a square of 2s - 1 to 4s - 2 words a half holds such a block whole, and the block
returns q words later. So the catcher compares its block with the last s appended words
while these are 2s - 1 to 4s - 2 words ahead; where they agree, it extends the agreement
at distance q to both sides as far as it goes. If that makes ``min_exponent`` times q words, they are
a run, and squares of the same run merge into it. A word is compared with 2 blocks of each
size on average, so the work is n log n.

The last s words are named by a polynomial of the words; the comparisons of all catchers
of one size are one array operation. Names only propose: whatever is reported has been compared word by word.

All of a text is handled in one task, one pass, in memory in proportion to the text.

Defined cases: a null text has no words and no run; so has an empty one; texts are never joined, and rows
repeating an id are handled each for itself; an empty table gives an empty result. Only doc_id and text are
read, so extra columns of any name are harmless.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_slices

MIN_EXPONENT = 4
MIN_LENGTH = 6
WORD = r"[^\x20\x09-\x0D]+"
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_B_INVERSE = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


class Catchers:
    """Squares of a growing sequence of word numbers, merged into runs.

    ``limit`` is for sequences appended at once: for a period, how many words from the first on can hold a run of it.
    """

    def __init__(self, min_exponent: int = MIN_EXPONENT, limit=None):
        self.least, self.limit = min_exponent, limit
        self.codes = np.zeros(0, np.int64)
        self.runs: dict[tuple[int, int], int] = {}  # (period, first word): end
        self.open: set[tuple[int, int]] = set()  # (first word, distance) of agreements that reach the last word

    def append(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """Append words; the runs (first word, end, period) that are new or longer now."""
        t0 = len(self.codes)
        self.codes = np.concatenate([self.codes, np.asarray(codes, np.int64)])
        n = len(self.codes)
        self._names()
        # A run that covers a word, for skipping what it explains.
        self.period, self.end = np.zeros(n, np.int64), np.zeros(n, np.int64)
        grow = np.array(sorted(self.open), np.int64).reshape(-1, 2)
        self.open = set()
        new = self._settled(grow[:, 0], np.maximum(t0 - grow[:, 1], grow[:, 0]), grow[:, 1])
        s = 1
        while 3 * s - 1 <= (n if self.limit is None else self.limit(2 * s - 1)):
            new += self._level(s, t0)
            s *= 2
        return new

    def _names(self) -> None:
        n = len(self.codes)
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _B))])
        self.back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _B_INVERSE))])
        self.total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(self.codes.astype(np.uint64) * _B + _A) * power[:-1])])

    def _same(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether the names of ``size`` words from a and from b on are equal."""
        return (self.total[a + size] - self.total[a]) * self.back[a] == (self.total[b + size] - self.total[b]) * self.back[b]

    def _level(self, s: int, t0: int) -> list[tuple[int, int, int]]:
        n = len(self.codes) if self.limit is None else min(len(self.codes), self.limit(2 * s - 1))
        first = max(0, (t0 - 5 * s + 2) // s)  # the first block whose catcher is still open
        m = (n - s - (2 * s - 1)) // s + 1  # blocks with room for the least distance
        if m <= first:
            return []
        name = (self.total[s : n + 1] - self.total[: n + 1 - s]) * self.back[: n + 1 - s]
        name = np.concatenate([name[first * s :], np.zeros(5 * s, np.uint64)])
        # Row: a block; column: how far ahead the last s words begin.
        ahead = np.lib.stride_tricks.as_strided(name[2 * s - 1 :], (m - first, 2 * s), (name.strides[0] * s, name.strides[0]))
        block, q = np.nonzero(ahead == name[: (m - first) * s : s, None])
        block, q = (block + first) * s, q + 2 * s - 1
        open_ = (block + q + s > t0) & (block + q + s <= n)
        block, q = block[open_], q[open_]
        if not len(block):
            return []
        # Inside a run whose period divides q the agreement is that run.
        p = self.period[block]
        known = (p > 0) & (self.end[block] >= block + q + s)
        known[known] = q[known] % p[known] == 0
        block, q = block[~known], q[~known]
        order = np.lexsort((block, q))
        block, q = block[order], q[order]
        if not len(block):
            return []
        head = np.ones(len(block), bool)
        head[1:] = (q[1:] != q[:-1]) | (block[1:] != block[:-1] + s)
        at = np.flatnonzero(head)
        return self._settled(block[at], block[np.append(at[1:], len(block)) - 1] + s, q[at])

    def _settled(self, begin: np.ndarray, end: np.ndarray, q: np.ndarray) -> list[tuple[int, int, int]]:
        """Extend agreements, and merge those that are long enough into the runs."""
        begin, end = self._extended(begin, end, q)
        reach = end + q == len(self.codes)
        self.open.update(zip(begin[reach].tolist(), q[reach].tolist(), strict=True))
        long = end - begin >= (self.least - 1) * q
        found = []
        for a, b, d in sorted(set(zip(begin[long].tolist(), end[long].tolist(), q[long].tolist(), strict=True)), key=lambda x: (x[2], x[0])):
            for x, y in self._compared(a, b, d):
                if y - x >= (self.least - 1) * d and self.runs.get((d, x), 0) < y + d:
                    self.runs[d, x] = y + d
                    found.append((x, y + d, d))
                free = self.period[x : y + d] == 0
                self.period[x : y + d][free] = d
                self.end[x : y + d][free] = y + d
        return found

    def _extended(self, begin: np.ndarray, end: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretches of agreement at distance q, as far as names agree."""
        n = len(self.codes)
        step = 1 << max(n.bit_length() - 1, 0)
        begin, end = begin.copy(), end.copy()
        while step:
            may = np.flatnonzero(end + q + step <= n)
            go = may[self._same(end[may], end[may] + q[may], step)]
            end[go] += step
            may = np.flatnonzero(begin >= step)
            go = may[self._same(begin[may] - step, begin[may] - step + q[may], step)]
            begin[go] -= step
            step >>= 1
        return begin, end

    def _compared(self, a: int, b: int, q: int) -> list[tuple[int, int]]:
        """The stretches of [a, b) where words q apart are equal, compared word by word."""
        differ = np.flatnonzero(self.codes[a:b] != self.codes[a + q : b + q])
        if not len(differ):
            return [(a, b)]
        edge = [a - 1, *(differ + a).tolist(), b]
        return [(x + 1, y) for x, y in zip(edge[:-1], edge[1:], strict=True) if y > x + 1]


def runs_of(texts: list[np.ndarray], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(first word, length, smallest period) of the runs of each text (word numbers), by first word, then period."""
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-size, kind="stable")  # the longest first, so that large periods read these alone
    start = np.cumsum(size[order])
    base, parts = 0, []
    for i in order.tolist():  # no word of two texts is the same
        parts.append(texts[i] + base)
        base += int(texts[i].max()) + 1 if len(texts[i]) else 0
    reach = lambda q: int(size[order][size[order] >= q * min_exponent].sum())
    catchers = Catchers(min_exponent, reach)
    catchers.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
    least: dict[tuple[int, int], int] = {}
    for (q, a), b in catchers.runs.items():
        if b - a >= max(min_length, min_exponent * q):
            least[a, b] = min(q, least.get((a, b), q))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (a, b), q in least.items():
        k = int(np.searchsorted(start, a, side="right"))
        i = int(order[k])
        out[i].append((a - int(start[k] - size[i]), b - a, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the first, then that of the smallest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal ones the same."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def _described(split: list[list[bytes]], min_exponent: int, min_length: int) -> Iterator[tuple]:
    for words, runs in zip(split, runs_of([numbered(w) for w in split], min_exponent, min_length), strict=True):
        kept = words
        if runs:
            edge = np.zeros(len(words) + 1, np.int64)
            for a, size, q in runs:
                edge[a + q] += 1
                edge[a + size] -= 1
            kept = [w for w, k in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not k]
        best = strongest(runs)
        yield (len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
               "".join(f"{a},{size},{q}\n" for a, size, q in runs), b" ".join(kept).decode())


_FOUND = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint"


def periodic_runs(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_runs, start, length, period, exponent_milli (the strongest run), runs, collapsed.

    ``runs`` has a line "start,length,period" for each run; ``collapsed`` is the text without the repeats of any run (a run's
    first period stays), words one space apart. With ``digest`` the last two are sha256 sums, runs_sha256 and collapsed_sha256.
    """
    names = ["runs_sha256", "collapsed_sha256"] if digest else ["runs", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                texts = rows.column("text").cast(pa.binary()).to_pylist()
                split = [(t or b"").split() for t in texts]  # bytes are split at these six characters alone
                cols = list(zip(*_described(split, min_exponent, min_length), strict=True))
                tail = [[hashlib.sha256(x.encode()).hexdigest() for x in c] for c in cols[5:]] if digest else cols[5:]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in tail)],
                    names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", *names])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id bigint, {_FOUND}, {names[0]} string, {names[1]} string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The query's input: (doc_id, text), every tenth text by a hash of its id made periodic from a word on; null ids are left alone."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))

    def planted(w: Column) -> Column:
        n, g = F.size(w), F.floor(F.col("h") / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, at(i))), " ")

    return rows.select("doc_id", F.when(F.size("w") > 0, planted(F.col("w"))).otherwise(F.col("text")).alias("text"))
