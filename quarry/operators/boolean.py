"""Conjunctive (AND) keyword search over the inverted index (Q21, Q22, Q27, Q39-Q42).

A whole batch of query lines runs as one job. Each query is seeded with
the documents of its rarest term; every candidate is then checked against
the postings of all the query's terms with one semi join on
(term, doc_id), so a stop word never multiplies the work by its list length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import ascii_strip, ws_terms
from quarry.operators.index import term_bucket
from quarry.operators.numbering import number_rows
from quarry.session import checked_broadcast, checkpointed

NO_RESULTS = "no results found"


def query_lines(lines: DataFrame, text_col: str = "query") -> DataFrame:
    """Batch of query lines: blank lines dropped, whitespace stripped (Q11)."""
    return lines.withColumn(text_col, ascii_strip(text_col)).filter(F.length(text_col) > 0)


def query_term_set(queries: DataFrame) -> DataFrame:
    """(query_id, term): distinct terms of each query."""
    return queries.select("query_id", F.explode(F.array_distinct(ws_terms("query"))).alias("term"))


def unknown_terms(queries: DataFrame, doc_freq: DataFrame) -> DataFrame:
    """(query_id, term) for query terms absent from the index (Q27)."""
    return query_term_set(queries).join(doc_freq.select("term"), "term", "left_anti").select("query_id", "term")


def query_terms(queries: DataFrame, doc_freq: DataFrame, term_catalog: DataFrame | None = None) -> DataFrame:
    """(query_id, term, df[, term_id], ord): known terms, rarest first (Q39).

    The order is (df, term_id) as in the reference when a term catalog is
    given, else (df, term). The window is per query: bounded by query length.
    """
    qt = query_term_set(queries).join(doc_freq, "term")
    tie = "term"
    if term_catalog is not None:
        qt = qt.join(term_catalog, "term")
        tie = "term_id"
    w = Window.partitionBy("query_id").orderBy("df", tie)
    return qt.withColumn("ord", F.row_number().over(w).cast("bigint"))


def boolean_search(queries: DataFrame, postings: DataFrame, doc_freq: DataFrame, catalog: DataFrame) -> DataFrame:
    """(query_id, query, doc_name): matching document names, or one
    'no results found' row for a query with an unknown term or an empty
    intersection (Q40-Q42), in no order: see ``sorted_results``."""
    queries = query_lines(queries)
    # one lookup of every (query, term) in the df table serves both the unknown-term
    # check and the rarest-first order
    looked = checkpointed(query_term_set(queries).join(doc_freq, "term", "left"))
    bad = looked.filter(F.col("df").isNull()).select("query_id").distinct()
    known = looked.join(bad, "query_id", "left_anti")
    qt = known.withColumn("ord", F.row_number().over(Window.partitionBy("query_id").orderBy("df", "term")).cast("bigint"))
    qt = checked_broadcast(qt.select("query_id", "term", "df", "ord"))
    n_terms = qt.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))

    # Postings of the batch vocabulary only (each list read once per batch).
    batch_post = checkpointed(restrict_terms(postings, qt))

    seed = qt.filter(F.col("ord") == 1).select("query_id", "term").join(batch_post, "term").select("query_id", "doc_id")
    # Every candidate x every term of its query (the seed term matches trivially).
    checks = seed.join(qt.select("query_id", "term"), "query_id")
    hit = checks.join(batch_post, ["term", "doc_id"], "left_semi")
    matched = (
        hit.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("k"))
        # one row per query of the checked query-term table: a proven bound
        .join(F.broadcast(n_terms), "query_id")
        .filter(F.col("k") == F.col("n_terms"))
        .select("query_id", "doc_id")
    )
    matched = checkpointed(matched)  # read by the hit rows and by the no-result check
    names = matched.join(catalog.select("doc_id", "doc_name"), "doc_id").select("query_id", "doc_name")
    # Results take their query text from a broadcast side: a query with millions of hits
    # is never shuffled onto one task by query_id. Queries without hits get the sentinel.
    qtext = checked_broadcast(queries.select("query_id", "query"))
    found = names.join(qtext, "query_id")
    empty = qtext.join(matched.select("query_id").distinct(), "query_id", "left_anti")
    return found.select("query_id", "query", "doc_name").unionByName(
        empty.select("query_id", "query", F.lit(NO_RESULTS).alias("doc_name")))


def sorted_results(results: DataFrame, queries: DataFrame) -> DataFrame:
    """``results`` with ``pos``, the 1-based place of a name in its query's sorted list (Q42).

    Names are numbered without the query's text, which would be moved and written once for every hit; it
    is joined back from ``queries``, which has each query_id once.
    """
    texts = checked_broadcast(query_lines(queries).select("query_id", "query"))
    placed = number_rows(results.select("query_id", "doc_name"), ["doc_name"], "pos", group_by=["query_id"])
    return placed.join(texts, "query_id").select("query_id", "query", "doc_name", "pos")


def restrict_terms(postings: DataFrame, vocab: DataFrame) -> DataFrame:
    """(term, doc_id) of the terms of ``vocab`` (term, df).

    Of a stored index the join is on the folder column too, so Spark prunes folders at run time by
    the terms' hashes (dynamic partition pruning, wherever the vocabulary side can be broadcast), and only
    the columns term and doc_id are read.
    """
    terms = checked_broadcast(vocab.filter(F.col("df") > 0).select("term").distinct())
    if "bucket" in postings.columns:
        terms = terms.withColumn("bucket", term_bucket("term")).filter(F.col("bucket") >= 0)
        return postings.join(terms, ["bucket", "term"], "left_semi").select("term", "doc_id")
    return postings.select("term", "doc_id").join(terms, "term", "left_semi")
