from pyspark.sql import functions as F

from quarry.operators import boolean as bl
from quarry.operators import index as ix

DOCS = [
    ("b2", "1", "the cat sat\non the mat"),
    ("b1", "10", "The dog and the cat"),
    ("b1", "9", "a bird\tsat there"),
    ("b2", "0", ""),
]


def _corpus(spark, docs=DOCS):
    df = spark.createDataFrame([(f"{b}/{f}", b, f, t) for b, f, t in docs], "doc_key string, block string, file string, text string")
    return df


def test_catalogs_and_postings(spark):
    idx = ix.build_index(_corpus(spark))
    cat = {r["doc_name"]: r["doc_id"] for r in idx.catalog.collect()}
    assert cat == {"b1/10": 1, "b1/9": 2, "b2/0": 3, "b2/1": 4}  # byte order of (block, file)
    terms = [r["term"] for r in idx.term_catalog().orderBy("term_id").collect()]
    assert terms == ["The", "dog", "and", "the", "cat", "a", "bird", "sat", "there", "on", "mat"]
    post = sorted(tuple(r) for r in idx.postings.collect())
    assert ("cat", 1) in post and ("cat", 4) in post and ("The", 1) in post
    df = {r["term"]: r["df"] for r in idx.doc_freq.collect()}
    assert df["the"] == 2 and df["The"] == 1 and df["sat"] == 2


def test_boolean_search_cases(spark):
    idx = ix.build_index(_corpus(spark))
    q = spark.createDataFrame([(0, "cat the"), (1, "cat zebra"), (2, "sat  sat"), (3, "dog mat"), (4, "   "), (5, "The")],
                              "query_id long, query string")
    res = bl.boolean_search(q, idx.postings, idx.doc_freq, idx.catalog)
    got = {}
    for r in res.collect():
        got.setdefault(r["query_id"], []).append(r["doc_name"])
    assert sorted(got[0]) == ["b1/10", "b2/1"]
    assert got[1] == [bl.NO_RESULTS]
    assert sorted(got[2]) == ["b1/9", "b2/1"]
    assert got[3] == [bl.NO_RESULTS]
    assert 4 not in got  # blank line dropped
    assert got[5] == ["b1/10"]


def test_merge_equals_index_of_union(spark):
    corpus = _corpus(spark)
    idx = ix.build_index(corpus)
    a = idx.postings.filter(F.col("doc_id") <= 2)
    b = idx.postings.filter(F.col("doc_id") > 2)
    assert sorted(map(tuple, ix.merge_postings(a, b).collect())) == sorted(map(tuple, idx.postings.collect()))


def test_stored_search_prunes_folders_and_reads_two_columns(spark, tmp_path):
    import io
    from contextlib import redirect_stdout

    idx = ix.build_index(_corpus(spark))
    idx.write(str(tmp_path / "index"))
    stored = ix.load_index(spark, str(tmp_path / "index"))
    vocab = spark.createDataFrame([("cat", 2), ("sat", 2)], "term string, df long")
    got = bl.restrict_terms(stored["postings"], vocab)
    assert sorted(map(tuple, got.collect())) == [("cat", 1), ("cat", 4), ("sat", 2), ("sat", 4)]
    text = io.StringIO()
    with redirect_stdout(text):
        got.explain("formatted")
    assert "dynamicpruning" in text.getvalue() and "ReadSchema: struct<term:string,doc_id:bigint>" in text.getvalue()
    q = spark.createDataFrame([(0, "cat the"), (1, "cat zebra")], "query_id long, query string")
    found = lambda post, df, cat: sorted((r["query_id"], r["doc_name"]) for r in bl.boolean_search(q, post, df, cat).collect())
    assert found(stored["postings"], stored["doc_freq"], stored["doc_catalog"]) == found(idx.postings, idx.doc_freq, idx.catalog)


def _write_blocks(spark, tmp_path, sides):
    corpus = _corpus(spark)
    catalog, tokens = ix.doc_catalog(corpus), ix.tokenize(corpus)
    paths = []
    for k, side in enumerate(sides):
        occ = ix.occurrences(tokens, catalog.filter(side))
        paths.append(str(tmp_path / f"block{k}"))
        ix.InvertedIndex(catalog.filter(side), occ, ix.postings(occ), ix.doc_freq(ix.postings(occ))).write(paths[-1])
    return paths


def test_stored_merge_is_the_index_of_the_union_and_moves_no_posting(spark, tmp_path, capsys):
    import pytest

    whole = ix.build_index(_corpus(spark))
    paths = _write_blocks(spark, tmp_path, ["doc_id > 2", "doc_id <= 2"])
    ix.merge_indexes(spark, *paths, str(tmp_path / "merged"))
    merged = ix.load_index(spark, str(tmp_path / "merged"))
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(merged["postings"].select("term", "doc_id"), whole.postings)
    assert same(merged["doc_freq"], whole.doc_freq) and same(merged["doc_catalog"], whole.catalog.select("doc_id", "doc_name"))
    assert same(merged["term_catalog"], whole.term_catalog())
    left, right = (ix.load_index(spark, p)["postings"] for p in paths)
    capsys.readouterr()
    left.unionByName(right).sortWithinPartitions("bucket", "term", "doc_id").explain()
    assert "Exchange" not in capsys.readouterr().out
    overlapping = _write_blocks(spark, tmp_path / "again", ["doc_id <> 2", "doc_id <= 2"])
    with pytest.raises(ValueError, match="overlap"):
        ix.merge_indexes(spark, *overlapping, str(tmp_path / "none"))


def test_files_of_any_name_and_empty_ones_are_documents(spark, tmp_path):
    docs = [("b 1", "_hidden", "a b"), ("b 1", ".dot", "c"), ("b 1", "empty", ""), ("é%20", "x y.txt", "d\n e"), ("b 1", "plain", "a")]
    corpus = spark.createDataFrame(docs, "block string, file string, text string")
    ix.write_corpus_files(corpus, str(tmp_path / "root"))
    (tmp_path / "root" / "no block").write_text("not in a folder")
    back = ix.corpus_from_files(spark, str(tmp_path / "root"), folders_per_task=1)
    assert sorted((r["block"], r["file"], r["text"]) for r in back.collect()) == sorted(docs)
    names = [r["doc_name"] for r in ix.doc_catalog(back).orderBy("doc_id").collect()]
    assert names == ["b 1/.dot", "b 1/_hidden", "b 1/empty", "b 1/plain", "é%20/x y.txt"]


def test_corpus_from_files(spark, tmp_path):
    for b, f, t in DOCS:
        (tmp_path / b).mkdir(exist_ok=True)
        (tmp_path / b / f).write_text(t)
    corpus = ix.corpus_from_files(spark, str(tmp_path))
    idx = ix.build_index(corpus)
    assert ix.corpus_count(corpus).first()["n_docs"] == 4
    ref = ix.build_index(_corpus(spark))
    assert sorted(map(tuple, idx.postings.collect())) == sorted(map(tuple, ref.postings.collect()))


def test_file_corpus_is_read_once_and_not_taken_for_small(spark, tmp_path):
    """One folder with all files: a task for every part of them, and no plan over the listing that a join would broadcast."""
    docs = [("b", str(i), "w" * 40 + f" t{i} " * 200) for i in range(300)]
    ix.write_corpus_files(spark.createDataFrame(docs, "block string, file string, text string"), str(tmp_path))
    corpus = ix.corpus_from_files(spark, str(tmp_path))
    assert "MapInArrow" not in corpus._jdf.queryExecution().optimizedPlan().toString()
    assert len(corpus.inputFiles()) > 1
    assert sorted((r["block"], r["file"], r["text"]) for r in corpus.collect()) == sorted(docs)


def test_terms_are_counted_in_the_row_as_from_tokens(spark, capsys):
    """Whole texts and token rows give the same table, keys that repeat (one document together) and null texts too; no pair is shuffled."""
    docs = [("k1", "b", "1", "x y x \x0b\x0cy\u00a0y z"), ("k1", "b", "1", "y w"), ("k2", "b", "2", None), ("k3", "b", "3", "  z\tz\r\n x "), ("k4", "b", "4", ""), (None, "b", "5", "n")]
    corpus = spark.createDataFrame(docs, "doc_key string, block string, file string, text string")
    catalog = spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3), ("k3", 4), ("k4", 5), (None, 6)], "doc_key string, doc_id long")
    rows = lambda df: sorted(map(tuple, df.select("term", "doc_id", "first_pos", "tf").collect()))
    got = rows(ix.occurrences(corpus, catalog))
    assert got == rows(ix.occurrences(ix.tokenize(corpus), catalog))
    assert ("x", 1, 0, 2) in got and ("y", 2, 0, 2) in got and ("z", 4, 0, 2) in got
    capsys.readouterr()
    ix.occurrences(corpus, catalog).explain()
    once = capsys.readouterr().out.split("HashAggregate")[0]
    assert "Exchange hashpartitioning" not in once


def test_first_occurrence_is_aggregated_by_hash(spark):
    occ = spark.createDataFrame([("b", 2, 0), ("a", 1, 7), ("b", 1, 9), ("c", 1, 2)], "term string, doc_id long, first_pos long")
    assert [r["term"] for r in ix.term_catalog(occ).orderBy("term_id").collect()] == ["c", "a", "b"]


def test_scorer_selection():
    from quarry.operators.scoring import select_scorer

    assert [select_scorer(k) for k in (1, 2, 3, 7)] == ["cosine", "bm25f", "window", "cosine"]
    import pytest

    with pytest.raises(ValueError):
        select_scorer("pagerank")


def test_stored_terms_come_from_one_aggregation_of_the_pairs(spark, tmp_path):
    rows = [("a/1", "a", "1", "x y x z"), ("a/2", "a", "2", "z x"), ("b/1", "b", "1", "q y")]
    idx = ix.build_index(spark.createDataFrame(rows, "doc_key string, block string, file string, text string"))
    ix.InvertedIndex(idx.catalog, idx.occ, idx.postings, None).write(str(tmp_path / "index"))  # no table of frequencies is computed beside it
    stored = ix.load_index(spark, str(tmp_path / "index"))
    assert sorted(map(tuple, stored["doc_freq"].select("term", "df").collect())) == [("q", 1), ("x", 2), ("y", 2), ("z", 2)]
    assert sorted(map(tuple, stored["term_catalog"].select("term_id", "term").collect())) == [(0, "x"), (1, "y"), (2, "z"), (3, "q")]
    assert sorted(map(tuple, stored["doc_freq"].collect())) == sorted(map(tuple, idx.doc_freq.collect()))
