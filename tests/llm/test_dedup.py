import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from quarry.llm import components, exact_dedup, passages, simhash, suffix_dedup

from .conftest import SCHEMA, SF001


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- exact
def brute_exact(pairs, keep=max):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        k = keep(known) if known else None
        seen = False
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, k, len(ids), i == k and not seen, hashlib.sha256(t.encode()).hexdigest()))
            seen = seen or i == k
    return Counter(out)


def test_exact_against_brute_force(spark, edge_docs, no_docs):
    pairs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert Counter(rows(exact_dedup.exact_duplicates(edge_docs))) == brute_exact(pairs)
    assert Counter(rows(exact_dedup.exact_duplicates(edge_docs, keep="smallest"))) == brute_exact(pairs, min)
    assert rows(exact_dedup.exact_duplicates(no_docs)) == []


def test_exact_separates_texts_whose_hashes_collide(edge_docs):
    pairs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    one_hash = F.substring(F.md5(F.col("t").cast("binary")), 1, 0).cast("binary")  # every text has the same
    assert Counter(rows(exact_dedup.exact_duplicates(edge_docs, key=one_hash))) == brute_exact(pairs)


def test_exact_rows_that_stay(edge_docs, no_docs):
    kept = exact_dedup.drop_exact_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    want = {(t, k) for (i, k, n, stays, t) in brute_exact([(r["doc_id"], r["text"]) for r in edge_docs.collect()]) if stays}
    got = [(hashlib.sha256((r["text"] or "").encode()).hexdigest(), r["doc_id"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert rows(exact_dedup.drop_exact_duplicates(no_docs)) == []


# ---------------------------------------------------------------- components
def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    edges += [(rng.randint(400, 480), rng.randint(400, 480)) for _ in range(50)]
    rng.shuffle(edges)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = dict(rows(components.components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert got == {x: find(x) for x in linked}
    assert rows(components.components(spark.createDataFrame([], "u bigint, v bigint"))) == []


# ---------------------------------------------------------------- simhash
def brute_fingerprint(text, size=3):
    import re

    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())) if x]
    s = [b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    ones = [sum(xxhash.xxh64_intdigest(x, 42) >> b & 1 for x in s) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(s))


def brute_groups(pairs, radius=2):
    fp = [brute_fingerprint(t) for _, t in pairs]
    group = list(range(len(pairs)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(len(pairs)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= radius:
                group[find(a)] = find(b)
    first = defaultdict(list)
    for a, (i, _) in enumerate(pairs):
        first[find(a)].append(i)
    smallest = {g: min((x for x in ids if x is not None), default=None) for g, ids in first.items()}
    return Counter((i, f"{fp[a]:016x}", smallest[find(a)]) for a, (i, _) in enumerate(pairs)), Counter(smallest.values())


def test_simhash_against_brute_force(spark, edge_docs, no_docs):
    # Texts of up to three words, so that fingerprints within the radius are made by search.
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 60))) for _ in range(120)]
    near = [t + " end" for t in base[:40]] + [t.replace("w1", "w2", 1) for t in base[:60]]
    more = spark.createDataFrame([(1000 + k, t, None, None, None) for k, t in enumerate(base + near)], SCHEMA)
    docs = edge_docs.select("doc_id", "text").union(more.select("doc_id", "text"))
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(rows(simhash.simhash_groups(docs))) == brute_groups(pairs)[0]
    assert rows(simhash.simhash_groups(no_docs)) == []


def test_fingerprint_links_reach_the_radius_and_no_further(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for v in values[:40]:
        values.append(v ^ (1 << rng.randrange(64)))
        values.append(v ^ (1 << rng.randrange(32)) ^ (1 << (32 + rng.randrange(32))))
        values.append(v ^ 0b111 << rng.randrange(60))
    dense = rng.getrandbits(64)
    values += [dense ^ x for x in range(64)]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()
    assert all(((r["u"] ^ r["v"]) & (2**64 - 1)).bit_count() <= 2 for r in links)
    part = {v: v for v in values}

    def find(v):
        while part[v] != v:
            v = part[v]
        return v

    for r in links:
        part[find(r["u"] & (2**64 - 1))] = find(r["v"] & (2**64 - 1))
    for k, a in enumerate(values):
        for b in values[:k]:
            if (a ^ b).bit_count() <= 2:
                assert find(a) == find(b)


def test_bk_tree_follows_only_edges_within_the_radius():
    rng = random.Random(2)
    values = [rng.getrandbits(16) for _ in range(500)]
    tree = simhash.BKTree(values[0])
    for v in values[1:]:
        tree.add(v)
    for q in values[:50]:
        assert sorted(set(tree.within(q, 2))) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def test_near_copies_leave_one_row_of_each_group(spark, edge_docs, no_docs):
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    _, first = brute_groups([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert Counter(r["doc_id"] for r in kept.collect()) == first
    assert rows(simhash.drop_near_duplicates(no_docs)) == []


# ---------------------------------------------------------------- substrings
def brute_repeats(texts, length):
    seen = Counter()
    for t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k : k + length]] += 1
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                cover[k + 1 : k + length + 1] = True
        spans = int((cover[1:] & ~cover[:-1]).sum())
        gone = cover[1:-1]
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def planted(rng, n=60):
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.randint(8, 60)) for _ in range(8)]
    docs = [text(rng.randint(0, 120)) + rng.choice(shared) + text(rng.randint(0, 30)) + rng.choice([*shared, ""]) for _ in range(n)]
    docs += docs[:5] + [d[: len(d) // 2] + "X" + d[len(d) // 2 + 1 :] for d in docs[5:20]] + ["ab" * 300, "a" * 500, "a" * 499 + "b", "", "é" * 120]
    return docs


def test_passages_just_under_and_over_400_bytes(spark):
    """The contract counts bytes: a repeated passage of over 50 words is removed from 400 bytes on, and left below."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    filler = lambda: " ".join(word(6) for _ in range(40))
    rows, want = [], {}
    for k, size in enumerate((300, 398, 399, 400, 401, 700)):
        passage = " ".join(word(5) for _ in range(130))[:size]
        assert len(passage.split()) >= 50
        for copy in (0, 1):
            # Different bytes on both sides, so that nothing beside the passage agrees.
            rows.append((10 * k + copy, filler() + "XY"[copy] + passage + "VW"[copy] + filler()))
            want[10 * k + copy] = size if size >= 400 else 0
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = suffix_dedup.remove_repeats(docs).collect()
    assert {r["doc_id"]: r["n_removed"] for r in out} == want
    assert {r["doc_id"]: r["n_spans"] for r in out} == {k: int(v > 0) for k, v in want.items()}


def test_repeated_strings_against_brute_force(spark, edge_docs, no_docs):
    for seed, length, window, class_rows in ((1, 60, 20, 2000), (2, 60, 20, 2), (3, 100, 40, 2000)):
        docs = planted(random.Random(seed))
        df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").withColumn("key", F.lit(1))
        original = suffix_dedup.repeated_starts
        try:
            suffix_dedup.repeated_starts = lambda d, n, w, c=class_rows: original(d, n, w, c)
            got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.remove_repeats(df, length, window).collect()}
        finally:
            suffix_dedup.repeated_starts = original
        want = brute_repeats([d.encode() for d in docs], length)
        assert [got[k] for k in range(len(docs))] == want
    pairs = [(r["doc_id"], (r["text"] or "").encode()) for r in edge_docs.collect()]
    got = Counter(tuple(r)[:5] for r in suffix_dedup.remove_repeats(edge_docs).collect())
    assert got == Counter((i, *w) for (i, _), w in zip(pairs, brute_repeats([t for _, t in pairs], 400), strict=True))
    assert rows(suffix_dedup.remove_repeats(no_docs)) == []


def test_kept_bytes_and_spans_are_the_text(spark):
    docs = planted(random.Random(7), 30)
    out = suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"), 60, 20).collect()
    for r in out:
        data, at, kept = docs[r["doc_id"]].encode(), 0, b""
        for s in r["spans"]:
            kept += data[at : s["begin"]]
            at = s["end"]
        assert kept + data[at:] == bytes(r["kept"])


def test_copies_of_a_text_are_one_member_of_a_class(spark, monkeypatch):
    body = planted(random.Random(12), 1)[0] * 3
    docs = [body] * 30 + [body[:150] + "X" + body[151:]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    sizes, original = [], suffix_dedup._in_classes

    def counted(rows, length):
        sizes.extend(r["count"] for r in rows.groupBy("suffix").count().collect())
        return original(rows, length)

    monkeypatch.setattr(suffix_dedup, "_in_classes", counted)
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.remove_repeats(df, 60, 20).collect()}
    assert [got[k] for k in range(len(docs))] == brute_repeats([d.encode() for d in docs], 60)
    assert sizes and max(sizes) <= 2


def test_triggers_depend_on_content_alone():
    rng = random.Random(3)
    body = bytes(rng.randrange(97, 101) for _ in range(700))
    texts = [body, b"q" * 50 + body, body + b"z" * 33]
    raw, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    of, at, first, last = suffix_dedup.strings_by_trigger(raw, off, 200, 64)
    seen = [{}, {}, {}]
    for i, t, a, b in zip(of, at, first, last, strict=True):
        for s in range(a, b + 1):
            seen[i][s - off[i]] = t - s
    assert all(len(s) == len(t) - 199 for s, t in zip(seen, texts, strict=True))
    for s in range(501):
        assert seen[0][s] == seen[1][s + 50] == seen[2][s]


# ---------------------------------------------------------------- passages
def test_compact_windows_cover_every_run_once():
    rng = np.random.default_rng(0)
    for n, least in ((30, 5), (60, 1), (12, 12), (3, 5)):
        h = rng.permutation(n).astype(np.uint64)
        found = passages.compact_windows(h, least)
        for i in range(n):
            for j in range(i + least - 1, n):
                c = i + int(h[i : j + 1].argmin())
                assert sum(lo <= i <= c <= j <= hi and c == mid for lo, mid, hi in found) == 1


def brute_passages(texts, least=46, size=5, similarity=0.8):
    """Words in runs of ``least`` shingles that another text has in the same order, at the similarity, along some diagonal."""
    enough = math.ceil(2 * least * similarity / (1 + similarity) - 1e-9)
    hashes = [[tuple(w[k : k + size]) for k in range(len(w) - size + 1)] for w in texts]
    cover = [np.zeros(len(w), bool) for w in texts]
    for a in range(len(texts)):
        for b in range(len(texts)):
            if texts[a] == texts[b] or a == b:
                continue
            for d in range(-len(hashes[b]), len(hashes[a])):
                same = [0 <= k - d < len(hashes[b]) and hashes[a][k] == hashes[b][k - d] for k in range(len(hashes[a]))]
                for k in range(max(0, d), min(len(same), len(hashes[b]) + d) - least + 1):
                    if sum(same[k : k + least]) >= enough:
                        cover[a][k : k + least + size - 1] = True
    return cover


def test_passages_against_brute_force(spark, edge_docs, no_docs):
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randint(0, 3000)}" for _ in range(n)]
    shared = [text(n) for n in (55, 70, 120)]
    docs = [text(rng.randint(5, 60)) + list(rng.choice(shared)) + text(rng.randint(0, 40)) for _ in range(9)] + [text(100), text(30), []]
    edited = list(shared[2])
    edited[60] = "changed"
    docs.append(text(20) + edited + text(20))
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in passages.near_duplicate_passages(df).collect()}
    # Runs that differ from one partner only reach a few words further than from the
    # representative; equal runs are found whole.
    for k, (most, least) in enumerate(zip(brute_passages(docs), brute_passages(docs, similarity=1.0), strict=True)):
        have = np.zeros(len(docs[k]), bool)
        for s in filter(None, got[k]["spans"].split(",")):
            a, b = map(int, s.split("-"))
            have[a:b] = True
        assert (have <= most).all() and (least <= have).all()
        assert got[k]["n_repeated"] == have.sum() and got[k]["n_words"] == len(docs[k])
        assert (got[k]["n_links"] > 0) == bool(most.any()) and got[k]["class_id"] <= k
    out = passages.near_duplicate_passages(edge_docs).collect()
    assert len(out) == edge_docs.count()
    assert all(r["n_repeated"] == 150 for r in out if r["doc_id"] in (1, 2, 3))  # copies repeat as a whole
    assert rows(passages.near_duplicate_passages(no_docs)) == []


def brute_alike(a, b, least=46, similarity=0.8):
    """Shingles of either text in runs of ``least`` with a run of the other whose set of shingles is similar."""
    cover = np.zeros(len(a), bool), np.zeros(len(b), bool)
    runs = [[frozenset(x[k : k + least].tolist()) for k in range(len(x) - least + 1)] for x in (a, b)]
    for i, p in enumerate(runs[0]):
        for j, q in enumerate(runs[1]):
            if len(p & q) >= similarity * len(p | q) - 1e-9:
                cover[0][i : i + least] = cover[1][j : j + least] = True
    return cover


def covered(runs, n):
    out = np.zeros(n, bool)
    for at, size in runs:
        out[at : at + size] = True
    return out


def test_alike_runs_against_sets_with_inserted_and_deleted_words():
    rng = random.Random(8)
    found = 0
    for case in range(60):
        few = 3 if case % 6 == 0 else 5000
        words = [rng.randint(0, few) for _ in range(rng.randint(30, 90))]
        other = list(words)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(other))
            other[k : k + rng.randint(0, 1)] = [rng.randint(0, few)] * rng.randint(0, 1)
        if case % 4 == 0:
            other = other[len(other) // 2 :] + other[: len(other) // 2]
        other = [rng.randint(0, few) for _ in range(rng.randint(0, 20))] + other + other[: rng.randint(0, 60)]
        a, b = (np.array([hash(tuple(x[k : k + 5])) % 2**40 for k in range(len(x) - 4)], np.uint64) for x in (words, other))
        want = brute_alike(a, b)
        for strip in (128, 7):
            got = passages.alike_runs(a, b, 46, 0.8, strip)
            assert (covered(got[0], len(a)) == want[0]).all() and (covered(got[1], len(b)) == want[1]).all()
        found += want[0].any()
    assert found > 20


def spans_of(docs, spark):
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id bigint, text string")
    out = {}
    for r in passages.near_duplicate_passages(df).collect():
        have = np.zeros(len(docs[r["doc_id"]]), bool)
        for s in filter(None, r["spans"].split(",")):
            a, b = map(int, s.split("-"))
            have[a:b] = True
        out[r["doc_id"]] = (have, r)
    return out


def test_passages_with_inserted_and_deleted_words_equal_brute_force(spark):
    rng = random.Random(9)
    text = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    docs = []
    for k in range(24):
        one = text(rng.choice((60, 70, 80, 120)))
        other = list(one)
        for at in range(len(one) // 2, len(one), 55):
            other[at : at + (k % 2)] = [] if k % 2 else ["inserted"]
        docs += [text(10) + one + text(rng.randint(0, 30)), text(rng.randint(0, 30)) + other + text(10)]
    got = spans_of(docs, spark)
    for k in range(0, len(docs), 2):
        hashes = [np.array([hash(tuple(d[i : i + 5])) % 2**40 for i in range(len(d) - 4)], np.uint64) for d in docs[k : k + 2]]
        for i, c in enumerate(brute_alike(*hashes)):
            want = np.zeros(len(docs[k + i]), bool)
            for at in np.flatnonzero(c):
                want[at : at + 5] = True
            assert want.any() and (got[k + i][0] == want).all()


def test_equal_passages_that_begin_with_a_frequent_line(spark):
    rng = random.Random(10)
    text = lambda n: [f"w{rng.randint(0, 50_000)}" for _ in range(n)]
    docs, pairs = [], []
    for size in (40, 45):
        line = text(size)
        docs += [text(20) + line + text(20) for _ in range(40)]
        for _ in range(30):
            rest = text(55 - size)
            pairs.append((len(docs), len(docs) + 1))
            docs += [text(20) + line + rest + text(20) for _ in range(2)]
    rng.shuffle(order := list(range(len(docs))))
    place = {k: i for i, k in enumerate(order)}
    got = spans_of([docs[k] for k in order], spark)
    for pair in pairs:
        assert all(got[place[k]][0][20:75].all() for k in pair)
        assert len({got[place[k]][1]["class_id"] for k in pair}) == 1


def test_runs_with_a_replaced_word_are_missed_one_time_in_125_at_most(spark):
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randint(0, 100_000)}" for _ in range(n)]
    docs = []
    for _ in range(400):
        one = text(50)
        other = list(one)
        other[rng.randint(8, 41)] = "replaced"
        docs += [text(15) + one + text(15), text(15) + other + text(15)]
    got = spans_of(docs, spark)
    missed = sum(not got[k][0].any() for k in range(0, len(docs), 2))
    assert missed <= 8


def test_similar_passages_with_a_frequent_line_are_found(spark):
    """Recall where a third of a passage's signatures are frequent: a 20-word line of 400 texts, passages with a replaced word."""
    rng = random.Random(12)
    text = lambda n: [f"w{rng.randint(0, 100_000)}" for _ in range(n)]
    line = text(20)
    docs = [text(30) + line + text(30) for _ in range(200)]
    first = len(docs)
    for _ in range(100):
        rest = text(40)
        other = list(rest)
        other[rng.randint(5, 34)] = "replaced"
        docs += [text(15) + line + x + text(15) for x in (rest, other)]
    got = spans_of(docs, spark)
    assert not any(got[k][0].any() for k in range(first))
    found = sum(got[k][0].any() and got[k][1]["class_id"] == got[k + 1][1]["class_id"] for k in range(first, len(docs), 2))
    assert found >= 95


def brute_links(docs, spark, least=46, **options):
    """(spans, classes) by comparing every two texts, and those of the operator."""
    hashes = [np.array([hash(tuple(d[i : i + 5])) % 2**60 for i in range(len(d) - 4)], np.uint64) for d in docs]
    cover, root = [np.zeros(len(d), bool) for d in docs], list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if docs[a] == docs[b]:
                continue
            found = passages.alike_runs(hashes[a], hashes[b], least)
            for k, runs in zip((a, b), found, strict=True):
                for at, size in runs:
                    cover[k][at : at + size + 4] = True
            if found[0]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in passages.near_duplicate_passages(df, least, **options).collect()}
    have = [np.zeros(len(d), bool) for d in docs]
    for k, r in got.items():
        for s in filter(None, r["spans"].split(",")):
            a, b = map(int, s.split("-"))
            have[k][a:b] = True
    return (cover, root), (have, [got[k]["class_id"] for k in range(len(docs))])


def test_similar_passages_whose_signatures_are_all_frequent_equal_brute_force(spark):
    """passages that differ by a word and consist mostly of a line that many texts have, or of one of two versions of it."""
    rng = random.Random(14)
    text = lambda n: [f"w{rng.randint(0, 100_000)}" for _ in range(n)]
    docs = []
    for size in (36, 44, 48, 60):  # words of the line: 32 to 56 shingles
        line = text(size)
        for k in range(40):
            some = list(line)
            if k % 4 == 1:
                some[rng.randrange(size)] = "replaced"
            if k % 4 == 2:
                del some[rng.randrange(size)]
            docs.append(text(rng.randint(0, 20)) + some + text(rng.randint(0, 20)))
        for _ in range(12):
            rest = text(58 - size if size < 50 else 10)
            other = list(rest)
            other[rng.randrange(len(rest))] = "other"
            docs += [text(12) + line + x + text(12) for x in (rest, other)]
    few = [f"x{k}" for k in range(4)]  # texts that repeat their shingles
    docs += [text(8) + (few * 20)[k % 3 : 50 + k] + text(8) for k in range(20)]
    rng.shuffle(docs)
    # With eight functions a pair shares no signature three times in a million.
    (cover, classes), (have, got) = brute_links(docs, spark, functions=8)
    assert sum(c.any() for c in cover) > 150
    assert all((a == b).all() for a, b in zip(cover, have, strict=True))
    assert classes == got


def test_links_of_a_group_form_a_star(spark):
    rng = random.Random(13)
    text = lambda n: [f"w{rng.randint(0, 100_000)}" for _ in range(n)]
    shared = text(60)
    docs = [text(20) + shared + text(20) for _ in range(30)] + [text(100)]
    docs.append(docs[0])
    got = spans_of(docs, spark)
    assert len({got[k][1]["class_id"] for k in range(30)}) == 1
    assert all(got[k][0][20:80].all() and got[k][1]["n_links"] >= 1 for k in range(30))
    assert got[30][1]["n_links"] == 0 and got[31][1]["class_id"] == got[0][1]["class_id"]


def test_dropped_tables_leave_others(spark):
    from quarry.llm.common import dropped, shared_table

    one, other = (shared_table(spark.range(5).coalesce(1), "drop-test") for _ in range(2))
    files = [f.removeprefix("file://").removeprefix("file:") for f in (one.inputFiles()[0], other.inputFiles()[0])]
    dropped(one)
    assert not os.path.exists(files[0]) and os.path.exists(files[1]) and other.count() == 5


def test_batches_are_cut_by_text_size():
    from quarry.llm.common import byte_rows, text_slices

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 50, 1, 1)] + [None])], names=["text"])
    parts = list(text_slices(batch, limit=10))
    assert [p.num_rows for p in parts] == [2, 1, 3]
    raw, off = byte_rows(parts[2].column("text"))
    assert bytes(raw) == b"aa" and off.tolist() == [0, 1, 2, 2]


def test_registered_rows_cover_the_table(spark):
    from quarry.llm.queries import QUERIES

    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    for name in ("op3_exact_dedup", "op5_suffix_dedup", "op8_simhash", "op9_passages"):
        assert QUERIES[name](spark, SF001).count() == n


def test_shingle_hashes_by_definition():
    """Each shingle's hash from its words alone, whatever lies beside it; words longer than the table of powers too."""
    from quarry.llm.common import byte_rows
    from quarry.llm.toxicity import _POWERS, word_hashes, words

    mask = 2**64 - 1
    texts = ["a b c d e f g", None, "", "One two", " x " * 9, "w" * 5000 + " tail of some more words", "ß 日本 é ü wörter im text"]
    raw, off = byte_rows(pa.array(texts))
    low, start, end, doc = words(raw, off)
    assert doc.tolist() == [i for i, t in enumerate(texts) for _ in range(len((t or "").split()))]
    hashes = [sum((((int(b) + 1) * int(_POWERS[k % len(_POWERS)]) & mask) ^ ((int(b) + 1) << 17)) for k, b in enumerate(low[s:e])) & mask
              for s, e in zip(start, end, strict=True)]
    assert word_hashes(low, start, end).tolist() == hashes
    h, first, n = passages.shingles(raw, off, 3)
    assert n.tolist() == [len((t or "").split()) for t in texts]
    assert np.diff(first).tolist() == [max(len((t or "").split()) - 2, 0) for t in texts]
    at = 0
    for i in range(len(texts)):
        alone = passages.shingles(*byte_rows(pa.array(texts[i : i + 1], pa.string())), 3)[0]
        assert h[at : at + len(alone)].tolist() == alone.tolist()
        at += len(alone)
    assert at == len(h)
