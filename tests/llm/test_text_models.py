import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from quarry.llm import langid, toxicity
from quarry.llm.common import byte_rows
from quarry.llm.queries import QUERIES

from .conftest import SCHEMA, SF001


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# ---------------------------------------------------------------- language
def brute_bits(samples, order, text):
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for s in samples:
        p = b"\n" * order + s
        for i in range(order, len(p)):
            for k in range(order + 1):
                seen[k][p[i - k : i]][p[i]] += 1
    p, total = b"\n" * order + text, 0.0
    for i in range(order, len(p)):
        for k in range(order, -1, -1):
            c = seen[k].get(p[i - k : i])
            if c is None:
                continue
            n, q = sum(c.values()), len(c)
            if p[i] in c:
                total -= math.log2(c[p[i]] / (n + q))
                break
            total -= math.log2(q / (n + q))
        else:
            total += 8
    return total


def test_code_lengths_against_brute_force():
    rng = random.Random(1)
    samples = {"aa": [b"the cat sat on the mat", b"a cat"], "bb": ["le été à la plage".encode()], "cc": [b"der hund"]}
    texts = ["the cat", "été", "zzz~~~\x01日本", "", "a", "der hund und the cat " * 40] + ["".join(rng.choice("thecadr é\n") for _ in range(60)) for _ in range(20)]
    for order in (0, 1, 4):
        got = langid.Scorer(langid.PPM(samples, order)).bits(pa.array(texts))
        want = [[brute_bits(samples[k], order, t.encode()) for k in sorted(samples)] for t in texts]
        assert np.allclose(got, want, rtol=1e-5, atol=1e-3)


def test_lookup_finds_all_keys_and_no_others():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**62, 5000).astype(np.uint64))
    find = langid.Lookup(keys)
    assert (find(keys) == np.arange(len(keys))).all()
    other = rng.integers(0, 2**62, 5000).astype(np.uint64)
    assert (find(other[~np.isin(other, keys)]) == -1).all()


def test_languages_of_edge_rows(spark, edge_docs, no_docs):
    out = langid.predict_languages(edge_docs).collect()
    texts = Counter((r["doc_id"], r["text"]) for r in edge_docs.collect())
    assert len(out) == sum(texts.values())
    by_id = {r["doc_id"]: r for r in out}
    for i in (4, 5, 6, 7):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0
    assert all(r["lang_pred"] in ("en", "fr", "und") and 0 <= r["score"] <= 1 for r in out)
    assert all(r["held_out"] == fold(r["doc_id"]) for r in out if r["doc_id"] is not None)
    assert langid.predict_languages(no_docs).collect() == []
    unlabelled = spark.createDataFrame([(1, "some words", None, None, None)], SCHEMA)
    assert [tuple(r)[2:] for r in langid.predict_languages(unlabelled).collect()] == [("und", 0.0)]
    clash = langid.identify(edge_docs, langid.fit(edge_docs))
    assert clash.columns == [c for c in edge_docs.columns if c != "score"] + ["lang_pred", "score"] and clash.count() == len(out)


def test_held_out_languages_are_right(spark):
    sf = "/root/testdata/sf0.01"
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in QUERIES["op7_language_id"](spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in out]) > 0.98


def test_labels_lang_and_id_are_no_input_of_a_score(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.fit(docs)
    from pyspark.sql import functions as F

    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 7)
    plain = sorted((r["text"], r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect())
    assert plain == sorted((r["text"], r["lang_pred"], r["score"]) for r in langid.identify(changed, model).collect())


# ---------------------------------------------------------------- toxicity
def arrays(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_words_and_windows():
    raw, off = arrays(["The Été, x!", "", "end", "start a1"])
    low, start, end, doc = toxicity.words(raw, off)
    found = [bytes(low[a:b]).decode() for a, b in zip(start, end, strict=True)]
    assert found == ["the", "Été", "x", "end", "start", "a1"] and doc.tolist() == [0, 0, 0, 2, 3, 3]
    begin, size, of = toxicity.windows(np.repeat([0, 2], [70, 3]), 3, 32, 16)
    assert list(zip(begin.tolist(), size.tolist(), of.tolist(), strict=True)) == [(0, 32, 0), (16, 32, 0), (32, 32, 0), (48, 22, 0), (70, 3, 2)]


def test_gradients_against_differences():
    raw, off = arrays(["you are an idiot and a fool today", "a nice day in the park with you", "hello"])
    low, start, end, doc = toxicity.words(raw, off)
    net = toxicity.Network(np.unique(toxicity.word_hashes(low, start, end)), 1)
    begin, size, _ = toxicity.windows(doc, 3, toxicity.WINDOW)
    t = np.arange(toxicity.WINDOW)[:, None]
    w = net.word_inputs(low, start, end)
    ids, mask, y = w["index"][np.minimum(begin + t, len(start) - 1)], (t < size).astype(np.float32), np.array([1, 0, 0], np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, g = net.gradients(w, ids, mask, y)
    for name, v in net.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), v.shape)
        keep, step, loss = v[at], 1e-3, []
        for d in (step, -step):
            v[at] = keep + d
            loss.append(net.gradients(w, ids, mask, y)[0])
        v[at] = keep
        assert abs((loss[0] - loss[1]) / 2 / step - g[name][at]) < 1e-4


def test_scores_do_not_depend_on_the_batch():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["idiot", "nice", "day", "été", "word"]) + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 200))) for _ in range(40)]
    net = toxicity.train([t.encode() for t in texts], [k % 2 for k in range(40)], rounds=(1, 1))
    alone = np.concatenate([net.scores(*byte_rows(pa.array([t]))) for t in texts])
    assert np.allclose(net.scores(*byte_rows(pa.array(texts))), alone, atol=1e-5)
    assert (alone[[i for i, t in enumerate(texts) if not t]] == 0).all()


def test_toxicity_of_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (2, 0, None), (8, 1, 0), (None, 1, 1), (9, 1, 1)], "doc_id bigint, quality int, toxic int")
    out = toxicity.toxicity(edge_docs, labels).collect()
    assert len(out) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    assert all(r["score"] == 0 for r in out if r["doc_id"] in (4, 5, 6, 7))
    assert toxicity.toxicity(no_docs, labels).collect() == []
    assert {r["score"] for r in toxicity.toxicity(edge_docs, labels.limit(0)).collect()} == {0.0}


def test_windows_in_a_row_score_as_windows_alone():
    """The pass over a stretch of words against the one that also trains, window by window, short and long texts mixed."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["idiot", "nice", "day", "été"]) + str(rng.randint(0, 9)) for _ in range(n)) for n in (0, 5, 31, 32, 33, 90, 1, 0, 200, 12)]
    net = toxicity.train([t.encode() for t in texts], [k % 2 for k in range(10)], rounds=(2, 1))
    raw, off = arrays(texts)
    score, begin, size, of = net.window_scores(raw, off)
    low, start, end, _ = toxicity.words(raw, off)
    w = net.word_inputs(low, start, end)
    inputs = [net.embed(w) @ net.p["in"][k] + net.p["bias"][k] for k in (0, 1)]
    t = np.arange(toxicity.WINDOW)[:, None]
    ids = w["index"][np.minimum(begin + t, len(start) - 1)]
    assert np.allclose(score, net.forward(inputs, ids, (t < size).astype(np.float32))[0], atol=1e-5)
    assert np.bincount(of, minlength=10).tolist() == [0, 1, 1, 1, 2, 59, 1, 0, 169, 1]


def test_few_labels_are_enough_to_find_some(spark):
    sf = "/root/testdata/sf0.01"  # some 320 labelled texts to learn from, 45 of them toxic
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [(labels[r["doc_id"]], r["score"]) for r in QUERIES["op1_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = ([s for y, s in out if y == k] for k in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.75
    assert sum(s >= 0.5 for s in toxic) >= 3 and np.mean([s >= 0.5 for s in clean]) < 0.1


def test_held_out_toxicity_is_found(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [(labels[r["doc_id"]], r["score"]) for r in QUERIES["op1_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    caught = np.mean([s >= 0.5 for y, s in out if y == 1])
    wrong = np.mean([s >= 0.5 for y, s in out if y == 0])
    assert caught > 0.85 and wrong < 0.06


def test_labelled_texts_longer_than_the_bound_are_learned_from(spark):
    words = {"en": "the house and the river are there with many words", "de": "das haus und der fluss sind dort mit vielen worten"}
    docs = [(k, " ".join([words[lang]] * 5) + f" {k}", lang) for k, lang in enumerate(["en", "de"] * 20)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict_languages(df, max_chars=100).collect()}
    assert got == {k: lang for k, _, lang in docs}
    labels = spark.createDataFrame([(k, lang == "de") for k, _, lang in docs], "doc_id bigint, toxic boolean")
    assert toxicity.fit(df, labels, max_chars=100) is not None


def test_languages_are_bounded_by_support(spark):
    """A language column full of junk: the values with most texts are learned, whatever number there is."""
    words = {"en": "the house and the river are there with many words", "de": "das haus und der fluss sind dort mit vielen worten"}
    docs = [(k, " ".join([words[lang]] * 3) + f" {k}", lang) for k, lang in enumerate(["en", "de"] * 20)]
    junk = [(1000 + k, f"zz{k} qq{k}", f"junk{k:03d}") for k in range(60)]
    df = spark.createDataFrame(docs + junk, "doc_id bigint, text string, lang string")
    assert sorted(langid.fit(df, max_languages=2).languages) == ["de", "en"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, langid.fit(df, max_languages=2)).collect()}
    assert all(got[k] == lang for k, _, lang in docs) and set(got.values()) == {"de", "en"}


def test_a_window_is_scored_at_every_word():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["idiot", "nice", "day", "word"]) + str(rng.randint(0, 9)) for _ in range(70)) for _ in range(20)]
    net = toxicity.train([t.encode() for t in texts], [k % 2 for k in range(20)], rounds=(1, 1))
    for text in texts:
        word = text.split()
        runs = [" ".join(word[k : k + 32]) for k in range(len(word) - 31)]
        assert abs(net.scores(*byte_rows(pa.array([text])))[0] - net.scores(*byte_rows(pa.array(runs))).max()) < 1e-5


def test_language_scores_in_small_slices():
    """A slice takes a bounded number of bytes for each of its own, and texts score alike in any slice."""
    import tracemalloc

    from quarry.llm.common import text_slices

    scorer = langid.Scorer(langid.PPM({"en": [b"the cat sat on the mat"], "de": [b"die katze sitzt auf der matte"]}))
    texts = [f"the mat {i} katze auf dem {'cat ' * (i % 50)}" for i in range(20000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    whole = scorer(batch.column(0))
    tracemalloc.start()
    parts = [scorer(part.column(0)) for part in text_slices(batch, "text", langid.SLICE_BYTES)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(parts) > 1 and peak < 160 << 20
    assert [x for langs, _ in parts for x in langs] == whole[0]
    assert np.array_equal(np.concatenate([share for _, share in parts]), whole[1])
