import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import chat, decontam, packing, token_store
from quarry.llm.queries import ORACLE, QUERIES
from quarry.llm.tokens import Encoder, default_vocabulary, worker_encoder

from .conftest import SF001

VOCABULARY = default_vocabulary()
TOK = Tokenizer.from_file(VOCABULARY)


def ids_of(text):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ---------------------------------------------------------------- ids
@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeEÉΣσİß'sṫ́ .,;!<|>\t\x1d１　"))), min_size=1, max_size=6))
def test_ids_equal_the_library(texts):
    flat, sizes = Encoder(VOCABULARY, cache_words=3)(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [ids_of(t) for t in texts]


def test_ids_of_special_names_and_white_space():
    texts = ["<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "a\x1cb", "a b\u0085c　d", "", None, "don't we've 's x.y, z!?"]
    flat, sizes = Encoder(VOCABULARY)(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [ids_of(t) for t in texts]


def test_a_worker_keeps_its_encoder():
    first, again = worker_encoder(VOCABULARY, 1), worker_encoder(VOCABULARY, 1)
    assert first is again and worker_encoder(VOCABULARY, 2) is not first
    for texts in (["one two"], ["two three", None], ["<|endoftext|> one"]):  # words of earlier tasks give the same ids
        flat, sizes = again(pa.array(texts))
        assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [ids_of(t) for t in texts]


# ---------------------------------------------------------------- store
def test_store_round_trip(spark, edge_docs, no_docs, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_token_store(edge_docs, path, VOCABULARY)
    back = token_store.read_token_store(spark, path).collect()
    want = Counter((r["doc_id"], tuple(ids_of(r["text"]))) for r in edge_docs.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in back) == want
    at = 0
    for r in sorted(back, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(back, key=lambda r: r["start"])]
    assert order == sorted(order)
    digest = token_store.with_ids_crc32(token_store.read_token_store(spark, path)).collect()
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in digest) == Counter((i, crc(ids)) for i, ids in want.elements())
    token_store.write_token_store(no_docs, str(tmp_path / "none"), VOCABULARY)
    assert token_store.read_token_store(spark, str(tmp_path / "none")).collect() == []


def test_store_is_encoded_and_read_selectively(spark, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_token_store(spark.read.parquet(f"{SF001}/documents.parquet"), path, VOCABULARY)
    for f in (tmp_path / "store").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        if not meta.num_rows:
            continue
        for k in range(meta.num_columns):
            column = meta.row_group(0).column(k)
            assert column.has_column_index and column.has_offset_index
            assert ("RLE_DICTIONARY" if column.path_in_schema.startswith("ids") else "DELTA_BINARY_PACKED") in column.encodings
    plan = token_store.read_token_store(spark, path, 10, 20, ["doc_id", "n_tokens"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan
    part = token_store.read_token_store(spark, path, 10, 20).collect()
    whole = {r["doc_id"]: r for r in token_store.read_token_store(spark, path).collect()}
    assert sorted(r["doc_id"] for r in part) == list(range(10, 21)) and all(r == whole[r["doc_id"]] for r in part)


# ---------------------------------------------------------------- packing
def test_packs_hold_every_id_once(spark, edge_docs, no_docs):
    pieces = packing.cut_pieces(edge_docs, VOCABULARY)
    packed = packing.pack(pieces).collect()
    cut = defaultdict(list)
    for r in edge_docs.collect():
        ids = ids_of(r["text"])
        for s in range(0, len(ids), 2048):
            cut[(r["doc_id"], s, len(ids))].append(tuple(ids[s : s + 2048]))
    assert Counter((r["doc_id"], r["start"], r["doc_tokens"], tuple(r["ids"])) for r in packed) == Counter((*k, v) for k, vs in cut.items() for v in vs)
    assert all(r["ids_crc32"] == crc(r["ids"]) and r["length"] == len(r["ids"]) for r in packed)
    rows = defaultdict(list)
    for r in packed:
        rows[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    assert sorted(rows) == list(range(len(rows)))
    whole = {r["sequence_id"]: r for r in packing.packed_sequences(packing.pack(pieces)).collect()}
    for k, parts in rows.items():
        at, ids = 0, []
        for offset, length, piece in sorted(parts):
            assert offset == at
            at += length
            ids += piece
        assert at <= 2048 and whole[k]["ids"][:at] == ids and whole[k]["n_ids"] == at
        assert len(whole[k]["ids"]) == (at if at & (at - 1) == 0 else 2048)
    assert packing.pack(packing.cut_pieces(no_docs, VOCABULARY)).collect() == []


def brute_shortest_pack_first(lengths, capacity):
    packs = []
    for n in sorted(lengths, reverse=True):
        least = min(packs, default=None)
        if least is None or least[0] + n > capacity:
            packs.append([n, n])
        else:
            least[0] += n
            least.append(n)
    return len(packs)


@pytest.mark.parametrize("seed", range(6))
def test_histogram_packing_places_all_lengths(seed):
    rng = random.Random(seed)
    lengths = [min(64, max(1, int(rng.gauss(20, 18)))) for _ in range(400)]
    patterns = packing.shortest_pack_first(dict(Counter(lengths)), 64)
    placed = Counter()
    for packs, members in patterns:
        assert sum(members) <= 64
        for n in members:
            placed[n] += packs
    assert placed == Counter(lengths)
    assert sum(p for p, _ in patterns) <= brute_shortest_pack_first(lengths, 64) * 1.02 + 1
    slots = packing.pack_slots(patterns)
    for n, total in Counter(lengths).items():
        assert sorted(r for length, first, ranks, *_ in slots if length == n for r in range(first, first + ranks)) == list(range(total))


def test_little_padding(spark):
    size = Counter()
    for r in QUERIES["op6_packing"](spark, "/root/testdata/sf0.01").select("sequence_id", "length").collect():
        size[r["sequence_id"]] += r["length"]
    assert sum(2048 - n for n in size.values() if n & (n - 1)) < 0.01 * sum(size.values())


# ---------------------------------------------------------------- perspectives
def brute_rotation(turns):
    out = {}
    by = defaultdict(list)
    for c, t, role, text in turns:
        role = (role or "").strip(" ") or "unknown"
        by[c].append((-1 if t is None else t, role, text or ""))
    for c, rows in by.items():
        for me in {r for _, r, _ in rows}:
            at, spans, whole = 0, [], ""
            for _, role, text in sorted(rows):
                head = "<|assistant|>\n" if role == me else f"<|user name={role}|>\n"
                seg = head + text + "\n<|end|>\n"
                if role == me:
                    spans.append((at + len(head), at + len(seg) - 1))
                at += len(seg)
                whole += seg
            out[(c, me)] = (whole, spans)
    return out


def test_rotation_against_brute_force(spark):
    rng = random.Random(8)
    turns = [(c, t, rng.choice(["ann", "bob", "cé", None, " "]), rng.choice(["hi", "", None, "so\nmany words", "日本"])) for c in (1, 2, 3, None) for t in (0, 1, 1, 2, None, 5)]
    turns += [(9, t, rng.choice("ab"), f"turn {t}") for t in range(300)] + [(9, 299, "a", "turn 299")] * 2
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit(1)).withColumn("mask", F.lit("x"))
    got = defaultdict(list)
    for r in chat.render(chat.rotate(df)).collect():
        got[(r["conv_id"], r["perspective"])].append(r)
    want = brute_rotation(turns)
    assert set(got) == set(want)
    for key, chunks in got.items():
        chunks.sort(key=lambda r: r["chunk"])
        text, spans = want[key]
        assert "".join(r["text"] for r in chunks) == text
        assert all(r["n_turns"] <= 64 and text.startswith(r["text"], r["text_start"]) for r in chunks)
        assert [tuple(map(int, s.split("-"))) for r in chunks for s in filter(None, r["target_spans"].split(","))] == spans
    assert chat.render(chat.rotate(df.limit(0))).collect() == []


# ---------------------------------------------------------------- decontamination
def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_contamination(docs, items, window=10):
    import hashlib

    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            b = words(t)
            n = min(window, len(b))
            for k in range(len(b) - n + 1) if b else ():
                for s in range(len(w) - n + 1):
                    if w[s : s + n] == b[k : k + n]:
                        hit.update(range(s, s + n))
                        found.add("null" if item is None else str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def test_contamination_against_brute_force(spark, edge_docs, no_docs):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["The", "of", "été", "É", "x", "y9", "z", "日"]) for _ in range(n))
    items = [(k, text(rng.randint(9, 30))) for k in range(12)] + [(2, "second row of an item, with ten words or more in it"), (None, "Two Words"), (50, "one"), (51, ""), (52, None), (53, "?!")]
    docs = [(k, text(rng.randint(0, 60)) + rng.choice([" ", "-", "\n"]) + (rng.choice(items)[1] or "") + "; " + text(5)) for k in range(40)]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("w", F.lit(1))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").union(edge_docs.select("doc_id", "text")).withColumn("words", F.lit(2)).withColumn("key", F.lit(2))
    every = [(r["doc_id"], r["text"]) for r in df.collect()]
    for limit in (100_000, 3):  # one block, many blocks
        got = Counter(tuple(r) for r in decontam.contamination(df, bench, block_windows=limit).collect())
        assert got == brute_contamination(every, items)
    clean = Counter((i, t) for (i, t) in every if not next(iter(brute_contamination([(i, t)], items)))[5])
    assert Counter((r["doc_id"], r["text"]) for r in decontam.drop_contaminated(df, bench).collect()) == clean
    assert decontam.contamination(no_docs, bench).collect() == []
    none = decontam.contamination(edge_docs, bench.limit(0)).collect()
    assert len(none) == edge_docs.count() and not any(r["contaminated"] for r in none)


# ---------------------------------------------------------------- registered SQL
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF001)
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())


def test_native_operators_run_no_python(spark):
    for name in ("op2_chat_rotation", "op10_decontamination"):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_capitals_with_a_combining_mark_are_the_library_s():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(VOCABULARY)
    texts = ["J\u030cet", "a W\u030a and Y\u030a", "H\u0331at", "T\u0308", "j\u030cet J"]
    flat, sizes = Encoder(VOCABULARY)(pa.array(texts))
    want = [[*tok.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert flat.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]
