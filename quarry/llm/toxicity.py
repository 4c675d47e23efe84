"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Input of a step is one word: the embedding of the word (words seen in at
least ``min_docs`` training texts) next to the mean embedding of its
character trigrams (hashed, so every word has one). Two gated recurrent
passes, left to right and right to left, read a window of words; attention
over the steps pools their states, and a logistic unit scores the pool. A window of
``WINDOW`` words begins at every word; all of them are scored, and the largest is the text's score.

Training runs in numpy on the driver, over at most ``per_label`` texts of each label,
each of at most ``max_chars`` characters, chosen by a hash of the id among
labelled rows that are not held out. It reads windows ``FIT_STEP`` words apart. A text's label goes to its windows: first
to a few drawn ones, then to the highest-scoring one, which is the one that
decides. Few texts are passed more often, so that there are ``FIT_STEPS`` updates at least.

Scoring is vectorised per Arrow batch: the part of every gate that depends on
the word alone is computed once per distinct word, and windows that begin at words in a row take
each step as one array operation over a stretch of words. Attention and output need two numbers
of a state, so states are not kept.

Defined cases: texts without a word, empty and null ones score 0; null ids are held out;
rows repeating an id are scored each by its own text; labels repeating an id
count as toxic if one is; null labels teach nothing; without any label of one
kind every score is 0. Empty tables give empty results. Labels, language, source and
id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_rows, text_slices
from quarry.llm.sampling import bounded_sample, held_out

WINDOW = 32
FIT_STEP = 16  # words from a window to the next in fitting; in scoring it is 1
FORWARD = 6_144  # windows that are scored at a time
FIT_STEPS = 300  # updates at least
PER_LABEL = 1_200
MAX_CHARS = 8_000
MIN_DOCS = 3
HIDDEN, WORD_DIM, CHAR_DIM, CHAR_ROWS = 8, 12, 8, 4096
# Text bytes per scoring step.
SLICE = 1 << 20

_CLASS = np.zeros(256, np.uint8)  # 0: not part of a word; else the byte in lower case
for _b in (*range(48, 58), *range(97, 123), *range(128, 256)):
    _CLASS[_b] = _b
for _b in range(65, 91):
    _CLASS[_b] = _b + 32
_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))
_BYTES = np.arange(1, 257, dtype=np.uint64)
_VALUES = (_BYTES * _POWERS[:, None] ^ (_BYTES << np.uint64(17))).ravel()  # of each byte at each place of a word


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of concatenated texts: lower-case bytes, word starts, word ends, and the text of each word."""
    low = _CLASS[raw]
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    heads = off[:-1][np.diff(off) > 0]  # a text's first byte begins a word, and the byte before ends one
    first[heads] = inside[heads]
    ends = heads[heads > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return low, start, end, np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(start, off)))


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    lead = np.cumsum(size) - size
    # 32 bits hold a slice's positions; a byte's value is looked up by its place in the word.
    kind = np.int32 if len(low) < 1 << 31 else np.int64
    at = np.arange(int(size.sum()), dtype=kind) - np.repeat(lead.astype(kind), size)
    raw = low[np.repeat(start.astype(kind), size) + at]
    if size.max() > len(_POWERS):
        at %= len(_POWERS)
    return np.add.reduceat(_VALUES[at * 256 + raw], lead)


def trigrams(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigrams of ``<word>``, how many each word has)."""
    size = end - start
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    mid = np.repeat(start, size) + place
    here = low[mid].astype(np.int64)
    before = np.where(place > 0, low[np.maximum(mid - 1, 0)], 1).astype(np.int64)
    after = np.where(place < np.repeat(size, size) - 1, low[np.minimum(mid + 1, len(low) - 1)], 2).astype(np.int64)
    code = (before * 65536 + here * 256 + after) * 2654435761 % (1 << 32)
    return (code >> 20) % CHAR_ROWS, size


def windows(doc: np.ndarray, n_docs: int, width: int, step: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over words sorted by text: (first word, words, text) of each, ``step`` words apart."""
    per = np.bincount(doc, minlength=n_docs)
    count = np.where(per > 0, np.maximum(-(-(per - width) // step), 0) + 1, 0)
    of = np.repeat(np.arange(n_docs), count)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    begin = (np.cumsum(per) - per)[of] + nth * step
    return begin, np.minimum(per[of] - nth * step, width), of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-x))


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), between -1 and 1: the states' nonlinearity, a fifth of the cost of tanh. Its slope is (1 - |y|)^2."""
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    """The same between 0 and 1."""
    return 0.5 + 0.5 * _squash(x)


class Network:
    """Parameters, and forward and backward passes over batches of windows."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, d = HIDDEN, WORD_DIM + CHAR_DIM
        self.vocabulary = vocabulary
        scale = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {
            "words": scale(len(vocabulary) + 1, WORD_DIM), "chars": scale(CHAR_ROWS, CHAR_DIM),
            "in": scale(2, d, 3 * h), "bias": np.zeros((2, 3 * h), np.float32), "gate": scale(2, h, 2 * h), "new": scale(2, h, h),
            "attend": scale(2 * h), "out": scale(2 * h), "out_bias": np.zeros(1, np.float32),
        }
        self.p["words"][-1] = 0  # words not learned

    @classmethod
    def restored(cls, vocabulary: np.ndarray, parameters: dict) -> Network:
        net = cls(vocabulary[:0])
        net.vocabulary, net.p = vocabulary, parameters
        return net

    def word_inputs(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
        """Distinct words as model inputs: their rows, and the word of each position."""
        names, first, index = np.unique(word_hashes(low, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.vocabulary, names)
        at[at == len(self.vocabulary)] = max(len(self.vocabulary) - 1, 0)
        known = self.vocabulary[at] == names if len(self.vocabulary) else np.zeros(len(names), bool)
        grams, size = trigrams(low, start[first], end[first])
        return {"row": np.where(known, at, len(self.vocabulary)), "grams": grams, "size": size, "index": index}

    def embed(self, w: dict) -> np.ndarray:
        p = self.p
        heads = np.cumsum(w["size"]) - w["size"]
        chars = np.add.reduceat(p["chars"][w["grams"]], heads, axis=0) / w["size"][:, None].astype(np.float32) if len(heads) else np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate([p["words"][w["row"]], chars], axis=1).astype(np.float32)

    def forward(self, inputs: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """inputs: [2][word, 3H] gate inputs of distinct words; ids, mask: [T, B]. Returns scores, and what backward needs."""
        h, (steps, n) = HIDDEN, ids.shape
        states = np.zeros((2, steps, n, h), np.float32)
        kept = []
        for way in (0, 1):
            state = np.zeros((n, h), np.float32)
            gate, new = self.p["gate"][way], self.p["new"][way]
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                x = inputs[way][ids[t]]
                zr = _gate(x[:, : 2 * h] + state @ gate)
                z, r = zr[:, :h], zr[:, h:]
                c = _squash(x[:, 2 * h :] + (r * state) @ new)
                z = z * mask[t][:, None]
                if keep:
                    kept.append((way, t, state, z, r, c, zr[:, :h]))
                state = state + z * (c - state)
                states[way, t] = state
        both = np.concatenate([states[0], states[1]], axis=2)
        a = both @ self.p["attend"] + np.where(mask > 0, 0, -1e9).astype(np.float32)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        pool = np.einsum("tb,tbh->bh", a, both)
        score = _sigmoid(pool @ self.p["out"] + self.p["out_bias"][0])
        return score, (kept, both, a, pool)

    def gradients(self, w: dict, ids: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        p, h = self.p, HIDDEN
        x = self.embed(w)
        inputs = [x @ p["in"][k] + p["bias"][k] for k in (0, 1)]
        score, (kept, both, a, pool) = self.forward(inputs, ids, mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        delta = ((score - y) / len(y)).astype(np.float32)
        g["out"], g["out_bias"][0] = pool.T @ delta, delta.sum()
        dpool = delta[:, None] * p["out"]
        da = np.einsum("bh,tbh->tb", dpool, both)
        da = a * (da - (a * da).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", da, both)
        dboth = a[:, :, None] * dpool + da[:, :, None] * p["attend"]
        dinputs = [np.zeros_like(v) for v in inputs]
        carry, now = None, None
        for way, t, state, z, r, c, raw_z in reversed(kept):
            if way != now:
                now, carry = way, np.zeros_like(state)
            ds = carry + dboth[t][:, way * h : (way + 1) * h]
            m = mask[t][:, None]
            dz, dc = ds * (c - state), ds * z
            carry = ds * (1 - z)
            dc_in = dc * (1 - np.abs(c)) ** 2
            drs = dc_in @ p["new"][way].T
            g["new"][way] += (r * state).T @ dc_in
            carry = carry + drs * r
            slope = lambda gate: 0.5 * (1 - np.abs(2 * gate - 1)) ** 2
            dzr = np.concatenate([dz * m * slope(raw_z), drs * state * slope(r)], axis=1)
            g["gate"][way] += state.T @ dzr
            carry = carry + dzr @ p["gate"][way].T
            np.add.at(dinputs[way], ids[t], np.concatenate([dzr, dc_in], axis=1))
        dx = np.zeros_like(x)
        for way in (0, 1):
            g["in"][way], g["bias"][way] = x.T @ dinputs[way], dinputs[way].sum(axis=0)
            dx += dinputs[way] @ p["in"][way].T
        np.add.at(g["words"], w["row"], dx[:, :WORD_DIM])
        g["words"][-1] = 0
        np.add.at(g["chars"], w["grams"], np.repeat(dx[:, WORD_DIM:] / w["size"][:, None], w["size"], axis=0).astype(np.float32))
        loss = -np.mean(np.where(y > 0.5, np.log(score + 1e-7), np.log(1 - score + 1e-7)))
        return float(loss), g

    def window_scores(self, raw: np.ndarray, off: np.ndarray, step: int = 1):
        """(score, first word, words, text) of every window, ``step`` words apart."""
        low, start, end, doc = words(raw, off)
        begin, size, of = windows(doc, len(off) - 1, WINDOW, step)
        score = np.zeros(len(begin), np.float32)
        if not len(begin):
            return score, begin, size, of
        w = self.word_inputs(low, start, end)
        x = self.embed(w)
        inputs = [x @ self.p["in"][k] + self.p["bias"][k] for k in (0, 1)]
        # Windows beginning at words in a row are scored together; a shorter one is its text's only one.
        short = np.flatnonzero(size < WINDOW) if step == 1 else np.arange(len(begin))
        t = np.arange(WINDOW)[:, None]
        for k in range(0, len(short), FORWARD):
            part = short[k : k + FORWARD]
            ids = w["index"][np.minimum(begin[part] + t, len(start) - 1)]
            score[part] = self.forward(inputs, ids, (t < size[part]).astype(np.float32))[0]
        if len(short) < len(begin):
            long = np.flatnonzero(size == WINDOW)
            at = begin[long]
            every = np.empty(int(at[-1]) + 1, np.float32)
            for a in range(0, len(every), FORWARD):
                b = min(a + FORWARD, len(every))
                if np.searchsorted(at, a) < np.searchsorted(at, b):
                    every[a:b] = self.in_a_row(inputs, w["index"][a : b + WINDOW - 1])
            score[long] = every[at]
        return score, begin, size, of

    def in_a_row(self, inputs: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Scores of the whole windows that begin at each word but the last ``WINDOW`` - 1, words given by their input row.

        Columns are windows. Gates are 1/2 + 1/2 squash; the halves are in the weights.
        """
        p, h, n = self.p, HIDDEN, len(index) - WINDOW + 1
        logit, out = np.zeros((WINDOW, n), np.float32), np.zeros((WINDOW, n), np.float32)
        gates, fresh, keep, size = (np.empty((k, n), np.float32) for k in (2 * h, h, h, 2 * h))

        def squash(y: np.ndarray, by: np.ndarray) -> None:
            np.abs(y, out=by)
            by += 1
            y /= by

        for way in (0, 1):
            x = np.ascontiguousarray(inputs[way][index].T)
            new = np.ascontiguousarray(p["new"][way].T) * np.float32(0.5)
            # What the next step's gates, attention and output take from a state.
            reads = np.concatenate([p["gate"][way].T, [p["attend"][way * h : (way + 1) * h]], [p["out"][way * h : (way + 1) * h]]]).astype(np.float32)
            state, read = np.zeros((h, n), np.float32), np.zeros((2 * h + 2, n), np.float32)
            for t in range(WINDOW) if way == 0 else range(WINDOW - 1, -1, -1):
                np.add(read[: 2 * h], x[: 2 * h, t : t + n], out=gates)
                squash(gates, size)
                z, r = gates[:h], gates[h:]
                r *= state
                r += state  # twice the reset state
                np.matmul(new, r, out=fresh)
                fresh += x[2 * h :, t : t + n]
                squash(fresh, keep)
                fresh -= state
                np.multiply(z, fresh, out=keep)
                keep += fresh
                keep *= np.float32(0.5)
                state += keep
                np.matmul(reads, state, out=read)
                logit[t] += read[2 * h]
                out[t] += read[2 * h + 1]
        logit -= logit.max(axis=0)
        np.exp(logit, out=logit)
        return _sigmoid((logit * out).sum(axis=0) / logit.sum(axis=0) + p["out_bias"][0])

    def scores(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Score of each text: the largest of its windows, 0 without words."""
        score, _, _, of = self.window_scores(raw, off)
        out = np.zeros(len(off) - 1)
        np.maximum.at(out, of, score)
        return out


def train(texts: list[bytes], labels: list[int], min_docs: int = MIN_DOCS, seed: int = 7, rounds: tuple[int, int] = (5, 6), batch: int = 128, rate: float = 0.01) -> Network | None:
    """Fit on whole texts; None without both labels."""
    y = np.array(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return None
    raw, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    low, start, end, doc = words(raw, off)
    names = word_hashes(low, start, end)
    pairs = np.unique(np.stack([names, doc.astype(np.uint64)]), axis=1)
    kinds, seen = np.unique(pairs[0], return_counts=True)
    net = Network(kinds[seen >= min_docs], seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    begin, size, of = windows(doc, len(texts), WINDOW, FIT_STEP)
    if not len(begin):
        return None
    t = np.arange(WINDOW)[:, None]
    passes = max(1, -(-FIT_STEPS * batch // (len(texts) * (4 * rounds[0] + rounds[1]))))
    for turn in range(sum(rounds)):
        if turn < rounds[0]:  # up to four drawn windows of each text
            order = rng.permutation(len(begin))
            order = order[np.argsort(of[order], kind="stable")]
            rank = np.arange(len(order)) - np.searchsorted(of[order], of[order])
            chosen = order[rank < 4]
        else:  # the window that decides the text's score
            score = np.concatenate([net.window_scores(raw[off[a] : off[min(a + 200, len(texts))]], off[a : min(a + 200, len(texts)) + 1] - off[a], FIT_STEP)[0] for a in range(0, len(texts), 200)])
            order = np.lexsort((-score, of))
            chosen = order[np.unique(of[order], return_index=True)[1]]
        chosen = np.concatenate([rng.permutation(chosen) for _ in range(passes)])
        for k in range(0, len(chosen), batch):
            pick = chosen[k : k + batch]
            at = np.minimum(begin[pick] + t, len(start) - 1)
            used, index = np.unique(at, return_inverse=True)
            w = net.word_inputs(low, start[used], end[used])
            ids = w["index"][index.reshape(at.shape)]
            _, g = net.gradients(w, ids, (t < size[pick]).astype(np.float32), y[of[pick]])
            step += 1
            lr = rate * min(1.0, 3.0 * (1 - turn / sum(rounds)))
            for name, v in net.p.items():
                d = np.clip(g[name], -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * d
                second[name] = 0.999 * second[name] + 0.001 * d * d
                v -= (lr * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, max_chars: int = MAX_CHARS) -> Network | None:
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marked = marked.where(~held_out(F.col("doc_id")))
    # A few times the bound, as some of these texts are missing.
    marked = bounded_sample(marked, "toxic", "doc_id", 2 * per_label)
    # The first ``max_chars`` characters of a longer text.
    rows = docs.select("doc_id", F.substring("text", 1, max_chars).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(marked), "doc_id")
    rows = bounded_sample(rows, "toxic", "doc_id", per_label).select("text", "toxic").collect()  # at most 2 x per_label texts
    pairs = sorted((r["text"].encode(), r["toxic"]) for r in rows)
    return train([t for t, _ in pairs], [v for _, v in pairs])


def score_documents(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, score of every whole text."""
    # Plain arrays, bounded by the sample: workers build the network from them.
    shared = docs.sparkSession.sparkContext.broadcast(None if net is None else (net.vocabulary, net.p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None if shared.value is None else Network.restored(*shared.value)
        for batch in batches:
            for rows in text_slices(batch, limit=SLICE):
                score = np.zeros(rows.num_rows) if model is None else model.scores(*byte_rows(rows.column("text")))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score_documents(docs, fit(docs, labels, per_label, max_chars))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
