"""The ranking fixture does the whole job: all terms of a benchmark text, every document with a third of them."""

import pytest

from quarry.plans.catalog import QUERIES
from quarry.plans.fixtures import RankFixture, ShortFixture


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    words = [f"w{i}" for i in range(9)]
    # Document d has the first d % 10 words of the first query, so 70 of 100 have a third of them.
    docs = [(d, f"title {d}\nh1\nh2\n" + " ".join(words[: d % 10]) + " filler", "en", "src", 10) for d in range(100)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(0, " ".join(words)), (1, "filler absent"), (2, "filler absent")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(d, d % 2, 0) for d in range(0, 100, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_every_term_and_every_candidate(spark, folder):
    fx = RankFixture(spark, folder)
    terms = [(r["query_id"], r["term"]) for r in fx.qterm.collect()]
    assert sorted(terms) == sorted([(0, f"w{i}") for i in range(9)] + [(q, t) for q in (1, 2) for t in ("filler", "absent")])
    cand = sorted((r["query_id"], r["doc_id"]) for r in fx.cand.collect())
    assert cand == sorted([(0, d) for d in range(100) if d % 10 >= 3] + [(q, d) for q in (1, 2) for d in range(100)])


def test_named_queries_give_all_pairs(spark, folder):
    assert QUERIES["field_tf"](spark, folder).count() == 70 * 9 * 5 + 2 * 100 * 2 * 5
    assert QUERIES["bm25f"](spark, folder).count() == 270
    assert [(r["query_id"], r["doc_id"], r["min_window"]) for r in QUERIES["min_window"](spark, folder).orderBy("doc_id").collect()] == [(0, d, 9) for d in range(9, 100, 10)]
    assert QUERIES["query_terms"](spark, folder).filter("query_id = 0").count() == 9


def test_short_queries_keep_their_list(spark, folder):
    fx = ShortFixture(spark, folder)
    assert fx.qterm.groupBy("query_id").count().agg({"count": "max"}).first()[0] <= 5
    assert fx.cand.groupBy("query_id").count().agg({"count": "max"}).first()[0] <= 50
