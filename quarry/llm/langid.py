"""Language ID by prediction by partial matching (PPM) over bytes.

A language's model is a variable-order tree of byte contexts up to ``order``
bytes with frozen counts. A byte seen in its longest context costs
-log2(count / (total + distinct)); otherwise an escape, -log2(distinct /
(total + distinct)), and the next shorter context decide; contexts never
seen cost nothing, and below order 0 every byte costs 8 bits. The language
with the shortest code for the whole text wins.

As statistics are frozen, the cost of a byte depends on its last ``order``
bytes only. All languages' trees are kept as one table per order, from a
context string to the costs in each language, and a batch of texts is
scored with numpy: one lookup per byte, more only after an escape.

Fitting takes at most ``per_language`` texts of each language, each of at most
``max_chars`` characters, chosen by a hash of the id among the rows that are not held out;
scoring reads every text whole.

Defined cases: null texts and texts without a letter are ``und`` with score
0; so is everything if no row has a language to learn from. Equal codes fall
to the first language in byte order. Empty tables give empty results. Only
doc_id, text and (for learning) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarry.llm.common import byte_rows, text_slices
from quarry.llm.sampling import bounded_sample, held_out

ORDER = 4
PER_LANGUAGE = 300
MAX_LANGUAGES = 256  # learned, those with most labelled texts
MAX_CHARS = 8_000
UNKNOWN = "und"
SLICE_BYTES = 1 << 20  # scored at a time: each takes some 40 bytes meanwhile
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _grams(raw: np.ndarray, n: int) -> np.ndarray:
    """The last n bytes at each position as a number, led by a 1 that marks the length."""
    key = np.ones(len(raw), np.uint64)
    for back in range(n - 1, -1, -1):
        key <<= np.uint64(8)
        if back:
            key[back:] |= raw[:-back]
        else:
            key |= raw
    return key


def _padded(raw: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``order`` newlines before each, and a mask of the texts' own bytes."""
    sizes = np.diff(off)
    own = np.ones(len(raw) + order * len(sizes), bool)
    heads = off[:-1] + order * np.arange(len(sizes))
    for k in range(order):
        own[heads + k] = False
    out = np.full(len(own), 10, np.uint8)
    out[own] = raw
    return out, own


class Lookup:
    """Open-addressing hash table from distinct uint64 keys to their index."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * max(len(keys), 1) - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.rows[slot[todo]] < 0
            first = todo[free]
            _, pick = np.unique(slot[first], return_index=True)
            put = first[pick]
            self.keys[slot[put]] = keys[put]
            self.rows[slot[put]] = put
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 if absent."""
        slot = self._slot(keys)
        got = self.rows[slot]
        wrong = np.flatnonzero((got >= 0) & (self.keys[slot] != keys))
        slot = slot[wrong]
        while len(wrong):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            got[wrong] = self.rows[slot]
            on = (got[wrong] >= 0) & (self.keys[slot] != keys[wrong])
            wrong, slot = wrong[on], slot[on]
        return got


class PPM:
    """Frozen trees of all languages. ``tables[k]`` has, for context strings of k + 1 bytes,
    the cost of the last byte and the escape cost after the whole string, each [language, string]."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = ORDER):
        self.languages, self.order = sorted(samples), order
        counts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order + 1)]
        for lang in self.languages:
            texts = samples[lang]
            raw, own = _padded(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), order)
            for k in range(order + 1):
                counts[k].append(np.unique(_grams(raw, k + 1)[own], return_counts=True))
        n = len(self.languages)
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(order + 1):
            # Strings seen here, and the contexts of the order above (a text's first ones are not strings of their own).
            above = [g >> np.uint64(8) for g, _ in counts[k + 1]] if k < order else []
            keys = np.unique(np.concatenate([*(g for g, _ in counts[k]), *above, np.zeros(0, np.uint64)]))
            context = keys >> np.uint64(8)
            # Escape cost and total + distinct of each context in each language.
            names, of = np.unique(context, return_inverse=True)
            size, kinds = np.zeros((n, len(names))), np.zeros((n, len(names)))
            seen = np.zeros((n, len(keys)))
            for i, (grams, c) in enumerate(counts[k]):
                at = np.searchsorted(keys, grams)
                seen[i, at] = c
                np.add.at(size[i], of[at], c)
                np.add.at(kinds[i], of[at], 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(size > 0, -np.log2(kinds / (size + kinds)), 0.0)
                found = -np.log2(seen / (size + kinds)[:, of])
            if k == 0:
                self.root_escape = escape[:, 0] if len(names) else np.zeros(n)
                shorter = np.full((n, len(keys)), 8.0)
            else:
                # Escapes belong to the strings of the order below.
                prev_keys, _, prev_escape = self.tables[-1]
                at = np.minimum(np.searchsorted(prev_keys, names), len(prev_keys) - 1)
                here = prev_keys[at] == names
                prev_escape[:, at[here]] = escape[:, here]
                shorter = self._costs(keys, k - 1)
            cost = np.where(seen > 0, found, escape[:, of] + shorter)
            self.tables.append((keys, cost, np.zeros((n, len(keys)))))
        self.tables = [(k, c.astype(np.float32), e.astype(np.float32)) for k, c, e in self.tables]

    @classmethod
    def restored(cls, languages: list[str], order: int, tables: list, root_escape: np.ndarray) -> PPM:
        model = cls.__new__(cls)
        model.languages, model.order, model.tables, model.root_escape = languages, order, tables, root_escape
        return model

    def _costs(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Costs of the last byte of strings under contexts of at most k bytes."""
        low = (keys & np.uint64((1 << 8 * (k + 1)) - 1)) | np.uint64(1 << 8 * (k + 1))
        names, cost, _ = self.tables[k]
        at = np.minimum(np.searchsorted(names, low), max(len(names) - 1, 0))
        hit = names[at] == low
        out = np.empty((len(self.languages), len(keys)))
        out[:, hit] = cost[:, at[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            if k == 0:
                out[:, miss] = self.root_escape[:, None] + 8.0
            else:
                context = low[miss] >> np.uint64(8)
                up, _, escape = self.tables[k - 1]
                pos = np.minimum(np.searchsorted(up, context), len(up) - 1)
                known = up[pos] == context
                out[:, miss] = np.where(known, escape[:, pos], 0.0) + self._costs(keys[miss], k - 1)
        return out


class Scorer:
    """Code lengths of Arrow text columns under every language of a PPM."""

    def __init__(self, model: PPM):
        self.model = model
        self.find = [Lookup(keys) for keys, _, _ in model.tables]

    def bits(self, column: pa.Array) -> np.ndarray:
        """[row, language]: bits of each text."""
        model, order = self.model, self.model.order
        raw, off = byte_rows(column)
        padded, own = _padded(raw, off, order)
        # Deepest order first; what a string escapes to is added to the rest.
        grams = _grams(padded, order + 1)[own]
        rows = self.find[order](grams)
        deep = np.flatnonzero(rows < 0)
        parts = [(None, order, rows)]
        extra = []
        at, key = deep, grams[deep]
        for k in range(order - 1, -2, -1):
            if not len(at):
                break
            mask = np.uint64((1 << 8 * (k + 2)) - 1)
            if k >= 0:
                context = ((key & mask) | np.uint64(1 << 8 * (k + 2))) >> np.uint64(8)
                esc = self.find[k](context)
                some = esc >= 0
                extra.append((at[some], k, esc[some]))
                key = (key & np.uint64((1 << 8 * (k + 1)) - 1)) | np.uint64(1 << 8 * (k + 1))
                row = self.find[k](key)
                hit = row >= 0
                parts.append((at[hit], k, row[hit]))
                at, key = at[~hit], key[~hit]
            else:
                parts.append((at, -1, None))
        out = np.zeros((len(column), len(model.languages)))
        full = np.flatnonzero(np.diff(off) > 0)
        if not len(full):
            return out
        for lang in range(len(model.languages)):
            cost = np.zeros(len(raw), np.float32)
            top = np.append(model.tables[order][1][lang], np.float32(0))
            cost = top[rows]  # row -1 is the appended zero
            for where, k, row in parts[1:]:
                cost[where] += model.tables[k][1][lang][row] if k >= 0 else np.float32(model.root_escape[lang] + 8.0)
            for where, k, row in extra:
                cost[where] += model.tables[k][2][lang][row]
            out[full, lang] = np.add.reduceat(cost, off[:-1][full], dtype=np.float64)
        return out

    def __call__(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Best language and its share of 2^-bits over all languages."""
        n, langs = len(column), self.model.languages
        letters = np.asarray(pc.fill_null(pc.match_substring_regex(column, r"\pL"), False))
        if not langs or not n:
            return [UNKNOWN] * n, np.zeros(n)
        bits = self.bits(column)
        best = bits.argmin(axis=1)
        share = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
        return [langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], np.where(letters, share, 0.0)


def fit(docs: DataFrame, order: int = ORDER, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS, max_languages: int = MAX_LANGUAGES) -> PPM:
    # The first ``max_chars`` characters of a longer text.
    rows = docs.select("doc_id", F.substring("text", 1, max_chars).alias("text"), "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id")))
    # Values that few texts have (a column filled with junk has any number of them) are not learned beyond the bound.
    largest = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(max_languages)
    rows = rows.join(F.broadcast(largest.select("lang")), "lang", "left_semi")
    samples: dict[str, list[bytes]] = {}
    for r in bounded_sample(rows, "lang", "doc_id", per_language).collect():  # at most max_languages x per_language texts
        samples.setdefault(r["lang"], []).append(r["text"].encode())
    return PPM({k: sorted(v) for k, v in samples.items()}, order)


def identify(docs: DataFrame, model: PPM) -> DataFrame:
    """All columns of ``docs`` with lang_pred and score (which replace columns of these names)."""
    # Plain arrays, bounded by the sample: workers build the trees from them.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.order, model.tables, model.root_escape))
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    place = keep.index(next(c for c in keep if c.lower() == "text"))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(PPM.restored(*shared.value))
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in text_slices(named, f"c{place}", SLICE_BYTES):
                langs, share = scorer(part.column(place))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(share)], names=[*keep, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def predict_languages(docs: DataFrame, order: int = ORDER, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs, order, per_language, max_chars)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
