import math
import random

from quarry.operators.evaluate import ideal_dcg, ndcg_per_query
from quarry.operators.numbering import number_rows
from quarry.operators.scoring import min_windows


def _brute_window(seq, terms):
    terms = set(terms)
    best = None
    for i in range(len(seq)):
        for j in range(i, len(seq)):
            if terms <= set(seq[i:j + 1]):
                best = j - i + 1 if best is None else min(best, j - i + 1)
                break
    return best


def _hits(spark, cases):
    rows, qt = [], set()
    for cid, (seq, terms) in enumerate(cases):
        for t in terms:
            qt.add((cid, t))
        for inst, s in enumerate(seq if isinstance(seq[0], list) else [seq]):
            for pos, tok in enumerate(s):
                if tok in terms:
                    rows.append((cid, 0, "title", inst, tok, pos))
    hits = spark.createDataFrame(rows, "query_id long, doc_id long, field string, inst int, term string, pos int")
    q = spark.createDataFrame(sorted(qt), "query_id long, term string")
    return {r["query_id"]: r["min_window"] for r in min_windows(hits, q).collect()}


def test_window_hand_cases(spark):
    cases = [("a x b a b".split(), ["a", "b"]), ("a x x b".split(), ["a", "b"]), ("a x x".split(), ["a", "b"]),
             ("x a x".split(), ["a"]), ([["a", "x"], ["b"]], ["a", "b"])]
    got = _hits(spark, cases)
    assert got.get(0) == 2 and got.get(1) == 4 and 2 not in got and got.get(3) == 1
    assert 4 not in got  # a window never spans two header instances


def test_window_random_against_brute_force(spark):
    rnd = random.Random(11)
    cases = []
    for _ in range(150):
        seq = [rnd.choice("abcdx") for _ in range(rnd.randint(1, 25))]
        cases.append((seq, rnd.sample("abcd", rnd.randint(1, 3))))
    got = _hits(spark, cases)
    for cid, (seq, terms) in enumerate(cases):
        assert got.get(cid) == _brute_window(seq, terms)


def _ndcg(rels):
    g = [max(r, 0) for r in rels]
    dcg = sum((2 ** x - 1) / math.log2(i + 2) for i, x in enumerate(g))
    ideal = sum((2 ** x - 1) / math.log2(i + 2) for i, x in enumerate(sorted(g, reverse=True)))
    return dcg / ideal if ideal > 0 else 1.0


def test_ndcg_hand_and_random(spark):
    rnd = random.Random(5)
    lists = {0: [0, 1], 1: [0, 0, 0], 2: [-1, 1, 0], 3: [1, -1]}
    for q in range(4, 40):
        lists[q] = [rnd.choice([-1, 0, 1, 2]) for _ in range(rnd.randint(1, 30))]
    ranked = [(q, d, d + 1) for q, l in lists.items() for d in range(len(l))]
    labels = [(q, d, float(l[d])) for q, l in lists.items() for d in range(len(l))]
    r = spark.createDataFrame(ranked, "query_id long, doc_id long, rank long")
    lab = spark.createDataFrame(labels, "query_id long, doc_id long, rel double")
    got = {x["query_id"]: x["ndcg"] for x in ndcg_per_query(r, lab).collect()}
    assert abs(got[0] - 1 / math.log2(3)) < 1e-12 and got[1] == 1.0
    for q, l in lists.items():
        assert abs(got[q] - _ndcg(l)) < 1e-12


def test_ideal_dcg_chunks(spark, monkeypatch):
    import quarry.operators.evaluate as ev

    monkeypatch.setattr(ev, "IDEAL_CHUNK", 3)
    rels = [1.0] * 10 + [2.0] * 7 + [0.0] * 4
    df = spark.createDataFrame([(1, r) for r in rels], "query_id long, rel double")
    want = sum((2 ** x - 1) / math.log2(i + 2) for i, x in enumerate(sorted(rels, reverse=True)))
    assert abs(ev.ideal_dcg(df).first()["idcg"] - want) < 1e-12


def test_number_rows_hot_group(spark):
    rnd = random.Random(2)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 30), rnd.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, s double, i long")
    from pyspark.sql import functions as F

    out = number_rows(df, [F.col("s").desc(), F.col("i")], "rk", start=1, group_by=["g"], num_partitions=7)
    got = {(r["g"], r["i"]): r["rk"] for r in out.collect()}
    for g in {r[0] for r in rows}:
        members = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))
        for k, r in enumerate(members, 1):
            assert got[(g, r[2])] == k
    flat = number_rows(df.select("i"), ["i"], "id", start=0, num_partitions=5)
    assert sorted((r["i"], r["id"]) for r in flat.collect()) == [(i, i) for i in range(3000)]


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    from quarry.session import checked_broadcast, row_bytes

    def is_broadcast(df):
        return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()

    df = spark.createDataFrame([(1, "x" * 1000, [1.0, 2.0], {"k": "v"}), (2, None, None, None)],
                               "a long, `t.x` string, v array<double>, m map<string,string>")
    long_row, null_row = [r[0] for r in df.orderBy("a").select(row_bytes(df)).collect()]
    assert long_row >= 48 + 1000 + 16 and 48 <= null_row < 100
    assert is_broadcast(checked_broadcast(df))
    assert not is_broadcast(checked_broadcast(df, max_rows=1))
    assert not is_broadcast(checked_broadcast(df, max_bytes=1000))
    empty = checked_broadcast(df.where("false"))
    assert is_broadcast(empty) and empty.count() == 0
