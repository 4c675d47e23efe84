"""Importance resampling, periodic runs and source mixing, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import importance, mixing, periodic

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- importance resampling
@given(st.lists(st.binary(max_size=100), max_size=20))
def test_crc32_of_slices(parts):
    raw = np.frombuffer(b"".join(parts) + b"\0", np.uint8)
    end = np.cumsum([len(p) for p in parts]).astype(np.int64)
    start = end - np.array([len(p) for p in parts], np.int64)
    assert importance.crc32_of(raw, start, end).tolist() == [zlib.crc32(p) for p in parts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é.1 ", max_size=40), min_size=1, max_size=6), st.integers(1, 3))
def test_features_are_runs_of_words(texts, runs):
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    bucket, of, n_words = importance.features(np.frombuffer(b"".join(raw), np.uint8), off, 97, runs)
    want = Counter()
    for i, t in enumerate(texts):
        w = lowered(t)
        assert n_words[i] == len(w)
        want.update((i, zlib.crc32(" ".join(w[k : k + n]).encode()) % 97) for n in range(1, runs + 1) for k in range(len(w) - n + 1))
    assert Counter(zip(of.tolist(), bucket.tolist(), strict=True)) == want


def test_planes_hold_counts_and_gains_of_any_size():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (5, 70)) * rng.choice([0, 1, 1000, 70_000], (5, 70))
    doc, bucket = (np.repeat(x, counts.ravel()) for x in np.divmod(np.arange(350), 70))
    made = importance.count_planes(bucket, doc, 5, 70)
    width = importance.plane_bytes(70)
    for row, data in zip(counts, made, strict=True):
        layers = np.unpackbits(np.frombuffer(data, np.uint8).reshape(-1, width), axis=1, bitorder="little")[:, :70]
        assert (sum(layer.astype(np.int64) << k for k, layer in enumerate(layers)) == row).all() if len(layers) else not row.any()
    for gain in (np.zeros(70, np.int64), np.full(70, -1), rng.integers(-8192, 8192, 70)):
        signed, worth = importance.gain_planes(gain)
        bits = np.unpackbits(signed.view(np.uint8), axis=1, bitorder="little")[:, :70].astype(np.int64)
        assert (np.array(worth) @ bits == gain).all()


def brute_resample(rows, target, percent=10, min_words=20, buckets=10_000, runs=1, seed=2024):
    def feats(text):
        w = lowered(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in rows for b in feats(x)), Counter(b for x in target for b in feats(x))
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (ns + buckets) / ((s[b] + 1.0) * (nt + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        f = feats(text)
        h = int(sha(f"{seed}:{'' if doc_id is None else doc_id}")[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(lowered(text)) >= min_words, None])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return Counter((*r[:4], r[5]) for r in out)


@pytest.mark.parametrize("options", [{}, {"percent": 60, "min_words": 3, "buckets": 101, "runs": 2, "seed": 7}])
def test_resample_equals_brute_force(spark, edge_docs, no_docs, options):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    wanted = ["alpha beta gamma", None, "", "the of the of 日本 x1", "alpha beta gamma"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(wanted)], "item_id bigint, text string")
    got = importance.resample(edge_docs, target, **options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resample(rows, wanted, **options)
    none = importance.resample(edge_docs, target.limit(0), **options)
    assert Counter(map(tuple, none.collect())) == brute_resample(rows, [], **options)
    assert importance.resample(no_docs, target, **options).count() == 0


# ---------------------------------------------------------------- periodic runs
def brute_runs(w, exponent=4, length=6):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, exponent * q):
                found[i, j + q - i] = min(q, found.get((i, j + q - i), q))
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


PIECE = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=8), st.integers(1, 9), st.integers(0, 7))


@st.composite
def sequences(draw):
    out = []
    for piece, times, cut in draw(st.lists(PIECE, max_size=6)):
        out += (piece * times)[: max(len(piece) * times - cut, 0)]
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(sequences(), max_size=4), st.sampled_from([(4, 6), (2, 2), (3, 5)]))
def test_runs_equal_brute_force(texts, least):
    assert periodic.runs_of([np.array(t, np.int64) for t in texts], *least) == [brute_runs(t, *least) for t in texts]


@settings(max_examples=100, deadline=None)
@given(sequences(), st.lists(st.integers(1, 5), min_size=1, max_size=5))
def test_squares_are_caught_as_words_are_appended(words, steps):
    catchers, at, k = periodic.Catchers(2), 0, 0
    told = {}
    while at < len(words):
        step = steps[k % len(steps)]
        for a, b, q in catchers.append(np.array(words[at : at + step], np.int64)):
            assert told.get((q, a), 0) < b
            told[q, a] = b
        at, k = at + step, k + 1
        assert told == catchers.runs
        for a, n, q in brute_runs(words[:at], 2, 2):  # runs so far, each ending where it ends now
            assert told[q, a] == a + n


def test_equal_names_are_not_believed(monkeypatch):
    """With names that say nothing, all comparisons propose, and words decide."""
    monkeypatch.setattr(periodic.Catchers, "_same", lambda self, a, b, size: np.ones(len(a), bool))
    words = [1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 5, 3, 3, 3, 3, 3, 3, 3, 9]
    assert periodic.runs_of([np.array(words)]) == [[(0, 10, 2), (11, 7, 1)]]


def test_long_runs_and_many_distances():
    for words in ([0] * 5000, [0, 1, 0] * 1500, ([0] * 40 + [1]) * 60, list(range(300)) * 5 + [7] * 10):
        assert periodic.runs_of([np.array(words)]) == [brute_runs(words)]


def described(text, exponent=4, length=6):
    w = PLAIN.findall(text or "")
    runs = brute_runs(w, exponent, length)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, "".join(f"{a},{n},{q}\n" for a, n, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone))


RUN_TEXTS = [(20, "a b " * 9 + "c"), (21, "x y " * 7 + "\x1c z"), (22, "go\tgo\ngo go\x0bgo\x0cgo\rgo"), (None, "no no no no no no"), (23, "1 2 3 " * 3), (24, "A a " * 4 + "A")]


def test_periodic_runs_equal_brute_force(spark, edge_docs, no_docs):
    docs = edge_docs.select("doc_id", "text", "h").unionByName(spark.createDataFrame([(*r, 0) for r in RUN_TEXTS], "doc_id bigint, text string, h int"))
    rows = docs.collect()
    got = periodic.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
    assert Counter(map(tuple, got.collect())) == Counter((r["doc_id"], *described(r["text"])) for r in rows)
    digest = periodic.periodic_runs(docs, digest=True)
    assert Counter(map(tuple, digest.collect())) == Counter((r["doc_id"], *x[:5], sha(x[5]), sha(x[6])) for r in rows for x in [described(r["text"])])
    assert periodic.periodic_runs(no_docs).count() == 0


def test_planted_runs_follow_their_rule(spark, edge_docs, no_docs):
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(i, "a b c d e f g h i j " * 3) for i in range(100, 400)], "doc_id bigint, text string"))
    want = Counter()
    for doc_id, text in map(tuple, docs.collect()):
        w, h = PLAIN.findall(text or ""), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            text = " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(len(w)))
        want[doc_id, text] += 1
    assert Counter(map(tuple, periodic.with_planted_runs(docs).collect())) == want
    assert periodic.with_planted_runs(no_docs).count() == 0


# ---------------------------------------------------------------- mixing
def brute_fill(rows, budget, most):
    """Levels by sharing anew until none is above: rows of (share, size)."""
    full, level = set(), 0.0
    while True:
        open_ = sum(s for i, (s, _) in enumerate(rows) if i not in full)
        level = (budget - sum(most * z for i, (_, z) in enumerate(rows) if i in full)) / open_ if open_ else math.inf
        now = full | {i for i, (s, z) in enumerate(rows) if z and s * level > most * z}
        if now == full:
            return level
        full = now


def brute_mix(docs, weights=(1, 2, 3), most=3, seed=2024):
    """docs: (doc_id, source, text, prefer)."""
    by = defaultdict(list)
    for doc_id, source, text, prefer in docs:
        by[source].append((doc_id, len(PLAIN.findall(text or "")), prefer))
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(x[1] for x in by[s]) for s in order}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    level = brute_fill([(weight[s], size[s]) for s in order if size[s]], float(sum(size.values())), most)
    out = Counter()
    for s in order:
        target = min(weight[s] * level, float(most * size[s])) if size[s] else 0.0
        c = brute_fill([(p * z, z) for _, z, p in by[s] if z], target, most)
        certain, ranked = [], []
        for doc_id, z, prefer in by[s]:
            copies = min(prefer * c, float(most)) if size[s] else 0.0
            whole = math.floor(copies)
            certain.append(whole * z)
            p = copies - whole
            key = None
            if p > 0 and z:
                u = (int(sha(f"{seed}:{'' if doc_id is None else doc_id}")[:13], 16) + 0.5) / 2.0**52
                odds = (u / (1 - u)) / (p / (1 - p))
                key = min(math.floor(odds / (1 + odds) * 2.0**52), 2**52 - 1)
            ranked.append((key, doc_id is None, doc_id or 0, z, whole, doc_id))
        left = max(math.floor(target + 0.5) - sum(certain), 0)
        for key, _, _, z, whole, doc_id in sorted(ranked, key=lambda r: (r[0] is None, *(r[:5] if r[0] is not None else ()))):
            extra = min(left, z) if key is not None else 0
            left -= extra
            out[doc_id, z, size[s], target, whole * z + extra] += 1
    return out


def mix_rows(edge_docs):
    rows = [(r["doc_id"], r["source"], r["text"], 1) for r in edge_docs.collect()]
    rows += [(1000 + i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i * i % 97), 1 + i % 5) for i in range(300)]
    return rows + [(5000, "é", "one two", 2), (5000, "é", "one two", 2), (5001, "z", "", 1), (None, "hot", "null id", 1), (None, "hot", "null id", 1)]


@pytest.mark.parametrize("cell", [0, 4096])
def test_mix_equals_brute_force(spark, edge_docs, no_docs, cell):
    rows = mix_rows(edge_docs)
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, prefer int").withColumn("level", F.lit(1)).withColumn("target", F.lit("x"))
    got = mixing.mix(docs, cell=cell)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert Counter(map(tuple, got.collect())) == brute_mix([(*r[:3], 1) for r in rows])
    preferred = mixing.mix(docs, weights=(5, 1), most=2, prefer=F.col("prefer"), seed=3, cell=cell)
    assert Counter(map(tuple, preferred.collect())) == brute_mix(rows, (5, 1), 2, 3)
    assert mixing.mix(no_docs, cell=cell).count() == 0


def test_mix_of_texts_without_words(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id bigint, source string, text string")
    assert sorted(map(tuple, mixing.mix(docs).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_taken_words_meet_targets_and_bounds(spark):
    rows = [(i, f"s{i % 4}", "w " * (1 + i * 7 % 50)) for i in range(2000)] + [(9000, "one", "w " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    kept = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    taken, target = Counter(), {}
    for r in kept:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(sum(len(t.split()) for _, _, t in rows))


def test_inclusion_follows_the_probabilities(spark):
    """Over many draws a document is in a sample of fixed size about as often as its inclusion probability says."""
    trials, n = 400, 200
    p = F.col("id") % 2 * 0.3 + 0.2  # they sum to 70
    ranked = spark.range(trials * n).select(F.col("id"), F.floor(F.col("id") / n).alias("trial"), mixing.pareto_rank(F.col("id"), p).alias("rank"))
    drawn = ranked.groupBy("trial").agg(F.slice(F.sort_array(F.collect_list(F.struct("rank", "id"))), 1, 70).alias("s")).select(F.explode("s.id").alias("id"))
    hits = Counter(r["id"] % 2 for r in drawn.collect())
    assert hits[0] / (trials * n / 2) == pytest.approx(0.2, abs=0.01) and hits[1] / (trials * n / 2) == pytest.approx(0.5, abs=0.01)
