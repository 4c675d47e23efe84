import itertools
import random

import numpy as np
import pytest

from quarry.operators import ltr as lt
from quarry.sources import textfiles as tx


def _data(spark, seed=1, nq=8):
    rnd = random.Random(seed)
    rows = []
    for q in range(nq):
        for d in range(rnd.randint(2, 25)):
            x = [rnd.gauss(0, 1) for _ in range(3)]
            rel = float(rnd.choice([-1, 0, 1]))
            rows.append((q, d, rel, *x, 1.0))
    df = spark.createDataFrame(rows, "query_id long, doc_id long, rel double, a double, b double, c double, k double")
    return rows, df


def test_least_squares_and_ridge_closed_form(spark):
    rows, df = _data(spark)
    x = np.array([r[3:6] for r in rows])
    y = np.array([r[2] for r in rows])
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (0.0, 4.5):
        m = lt.fit_least_squares(df, ["a", "b", "c"], alpha=alpha)
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert np.allclose(m.coef, w, atol=1e-10)
        assert abs(m.intercept - (y.mean() - x.mean(0) @ w)) < 1e-10
    # a constant column is handled (min-norm) without error
    m = lt.fit_least_squares(df, ["a", "k"])
    assert abs(m.coef[1]) < 1e-9


def test_scaler_population_std(spark):
    rows, df = _data(spark)
    s = lt.fit_scaler(df, ["a", "k"])
    x = np.array([r[3] for r in rows])
    assert abs(s.scale[0] - x.std()) < 1e-12 and s.scale[1] == 1.0


def _objective(rows, w, c):
    tot = 0.5 * w @ w
    for q in {r[0] for r in rows}:
        items = [r for r in rows if r[0] == q]
        for i, j in itertools.permutations(items, 2):
            if i[2] != j[2]:
                y = 1 if i[2] > j[2] else -1
                tot += c * max(0.0, 1 - y * (w @ (np.array(i[3:6]) - np.array(j[3:6]))))
    return tot


def test_pairwise_svm_is_optimal(spark):
    rows, df = _data(spark, seed=4, nq=5)
    m = lt.fit_pairwise_svm(df, ["a", "b", "c"], c=3.0)
    f0 = _objective(rows, m.coef, 3.0)
    rnd = np.random.default_rng(0)
    for scale in (1e-1, 1e-2, 1e-3):
        for _ in range(20):
            assert f0 <= _objective(rows, m.coef + rnd.normal(0, scale, 3), 3.0) * (1 + 1e-4)


def test_signal_reader_edge_cases(spark, tmp_path):
    p = tmp_path / "sig.txt"
    p.write_text("query: a b\n  url: u1\n    header: h1\n    header: h2\n    body_hits: a 1 2\n    body_length: 9\n"
                 "query: c\n  url: u2\n    title: T\nquery: a b\n  url: u3\n    title: x\n    pagerank: 4\n")
    recs = {r["url"]: r for r in tx.read_signals(spark, str(p)).collect()}
    assert recs["u1"]["title"] == "" and recs["u1"]["headers"] == ["h1", "h2"] and recs["u1"]["body_hits"] == {"a": [1, 2]}
    assert recs["u3"]["pagerank"] == 4 and recs["u2"]["title"] == "T"
    from quarry.operators.signals import signal_tables

    tokens, stats, avg = signal_tables(tx.read_signals(spark, str(p)))
    # the repeated query keeps only its last block, but all three records count in the averages
    assert sorted(r["url"] for r in stats.collect()) == ["u2", "u3"]
    assert avg.first()["av_body"] == 3


def test_ranked_writer_reader_roundtrip(spark, tmp_path):
    ranked = spark.createDataFrame([("q1", "u2", 1, 0), ("q1", "u1", 2, 0), ("q0", "u9", 1, 1)], "query string, url string, rank long, q_order long")
    path = str(tmp_path / "ranked")
    tx.write_ranked(ranked, path, "q_order")
    back = sorted(tuple(r) for r in tx.read_ranked(spark, path).collect())
    assert back == [("q0", "u9", 1), ("q1", "u1", 2), ("q1", "u2", 1)]
    text = "".join(open(f).read() for f in sorted((tmp_path / "ranked").glob("part-*")))
    assert text == "query: q1\n  url: u2\n  url: u1\nquery: q0\n  url: u9\n"


def test_lines_keep_file_order_over_unequal_parts(spark, tmp_path):
    rnd = random.Random(3)
    folder = tmp_path / "parts"
    folder.mkdir()
    blocks, want_rel, want_rank = [], {}, {}
    for q in range(60):
        lines = [f"query: q{q}"]
        for k in range(rnd.randint(1, 40)):
            rel = rnd.choice([-1.0, 0.0, 1.0])
            lines.append(f"\turl: u{k} {rel}\r")
            want_rel[(f"q{q}", f"u{k}")] = rel
            want_rank[(f"q{q}", f"u{k} {rel}")] = k + 1
        blocks += lines
    # eight parts of very different sizes, cut anywhere
    cuts = sorted(rnd.sample(range(1, len(blocks)), 6))
    cuts = [0, cuts[0], cuts[0] + 1, *cuts[1:], len(blocks)]
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        (folder / f"part-{i:05d}.txt").write_bytes(("\n".join(blocks[a:b]) + "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = {(r["query"], r["url"]): r["rel"] for r in tx.read_labels(spark, str(folder)).collect()}
        ranks = {(r["query"], r["url"]): r["rank"] for r in tx.read_ranked(spark, str(folder)).collect()}
        plain = [r["value"] for r in tx.read_numbered(spark, str(folder)).orderBy("ln").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert plain == blocks
    assert got == want_rel
    assert ranks == want_rank


def test_signal_records_tabs_crlf_repeated_url_and_empty_query(spark, tmp_path):
    from quarry.plans.catalog import _score_signals

    record = "\turl: http://x.y/ab\r\n\t\ttitle: a b\r\n\t\theader: a\r\n\t\tbody_hits: a 1 2\r\n\t\tbody_hits: a 3\r\n\t\tbody_length: 50\r\n\t\tpagerank: 9\r\n\t\tanchor_text: a\r\n\t\tstanford_anchor_count: 2\r\n"
    p = tmp_path / "sig.txt"
    p.write_bytes(("query: a b\r\n" + record + record + "query:\r\n" + record).encode())
    recs = tx.read_signals(spark, str(p)).collect()
    assert [(r["query"], r["url"], r["body_hits"]) for r in sorted(recs, key=lambda r: r["u_seq"])] == [
        ("a b", "http://x.y/ab", {"a": [3]})] * 2 + [("", "http://x.y/ab", {"a": [3]})]
    df = spark.createDataFrame([("a", 10), ("b", 20)], "term string, df long")
    rows = sorted((r["query"], r["url"], round(r["cosine"], 9), round(r["bm25f"], 9)) for r in _score_signals(tx.read_signals(spark, str(p)), df).collect())
    assert len(rows) == 3 and rows[1] == rows[2] and rows[1][2] > 0
    assert rows[0] == ("", "http://x.y/ab", 0.0, 1.0)  # score 0 plus log10(9 + 1)


def _brute_hinge(rows, w):
    loss, grad, n = 0.0, np.zeros(3), 0
    for q in {r[0] for r in rows}:
        for i, j in itertools.permutations([r for r in rows if r[0] == q], 2):
            d = np.array(i[3:6]) - np.array(j[3:6])
            if i[2] > j[2] and 1 - w @ d > 0:
                loss, grad, n = loss + 1 - w @ d, grad - d, n + 1
    return loss, grad, n


def _continuous(spark, rows):
    """The same items with a label of their own each, ties among some."""
    rnd = random.Random(1)
    rows = [(*r[:2], round(rnd.gauss(0, 1), 1 if r[1] % 3 else 9), *r[3:]) for r in rows]
    return rows, spark.createDataFrame(rows, "query_id long, doc_id long, rel double, a double, b double, c double, k double")


def test_violating_pairs_agree_with_brute_force(spark):
    rows, df = _data(spark, seed=9, nq=4)
    weights = [np.array([0.7, -0.4, 0.1]), np.zeros(3), np.array([5.0, 1.0, -3.0])]
    for rows, df in ((rows, df), _continuous(spark, rows)):  # three levels, and about as many as items
        h = lt.PairwiseHinge(df, ["a", "b", "c"])
        assert h.n_pairs() == sum(a[0] == b[0] and a[2] != b[2] for a in rows for b in rows)
        for w, (loss, grad, n) in zip(weights, h.evaluate_all(weights)):
            want = _brute_hinge(rows, w)
            assert abs(loss - want[0]) < 1e-8 and np.allclose(grad, want[1], atol=1e-8) and n == want[2]
    one_level = lt.PairwiseHinge(df.filter("false"), ["a", "b", "c"])
    assert one_level.evaluate_all([np.zeros(3)])[0][0] == 0.0


def test_svm_objective_is_within_its_certified_gap(spark):
    rows, df = _data(spark, seed=2, nq=5)
    m = lt.fit_pairwise_svm(df, ["a", "b", "c"], c=3.0, gap=1e-4)
    assert abs(m.primal - _objective(rows, m.coef, 3.0)) < 1e-6 * m.primal
    assert 0 <= m.primal - m.lower <= 1e-4 * m.primal
    rnd = np.random.default_rng(1)
    for scale in (1.0, 1e-1, 1e-2, 1e-3):  # no weights are below the bound
        for _ in range(20):
            assert _objective(rows, m.coef + rnd.normal(0, scale, 3), 3.0) >= m.lower * (1 - 1e-9)
    with pytest.raises(RuntimeError, match="lower bound"):
        lt.fit_pairwise_svm(df, ["a", "b", "c"], c=3.0, gap=1e-12, max_rounds=1)


def test_dependent_columns_get_no_weight(spark):
    rows, df = _data(spark)
    df = df.withColumn("sum", df["a"] + df["b"])
    m, short = lt.fit_least_squares(df, ["a", "b", "sum", "c"]), lt.fit_least_squares(df, ["a", "b", "c"])
    assert m.coef[2] == 0.0 and np.allclose(m.coef[[0, 1, 3]], short.coef, atol=1e-9)


def test_a_missing_label_is_an_error_in_training(spark):
    f = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.1)], "query_id long, doc_id long, a double")
    full = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.0), (2, 9, 1.0)], "query_id long, doc_id long, rel double")
    assert sorted(map(tuple, lt.labelled(f, full).collect())) == [(1, 1, 0.5, 1.0), (1, 2, 0.1, 0.0)]
    for part in (full.filter("doc_id = 1"), full.selectExpr("query_id", "doc_id", "if(doc_id = 2, null, rel) as rel")):
        with pytest.raises(Exception, match="without a relevance label"):
            lt.labelled(f, part).collect()
