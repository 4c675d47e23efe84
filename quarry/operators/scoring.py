"""Relevance scorers over the aligned signals (Q50-Q57).

``tf`` rows are (query_id, doc_id, term, q_tf, df, tf_<field>...),
``stats`` rows are (query_id, doc_id, body_length, pagerank, len_<field>...).
All scorers run as one join of the two on the pair key followed by one
aggregation on the same key, so the join's partitioning is reused.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import idiv, sublinear
from quarry.operators.signals import FIELDS, N_DOCS, idf
from quarry.session import checked_broadcast

KEYS = ["query_id", "doc_id"]


# The reference's tuned weights (Q57), field order url, title, header, body, anchor.
@dataclass(frozen=True)
class CosineParams:
    weights: tuple = (1, 4, 4, 2, 400)
    length_smooth: int = 15000


@dataclass(frozen=True)
class BM25FParams:
    b: tuple = (0.99, 0.3, 0.1, 0.3, 0.01)
    w: tuple = (18, 59, 17, 1, 15)
    k1: float = 7.0
    pagerank_weight: float = 1.0


@dataclass(frozen=True)
class WindowParams:
    boost: float = 2.7
    cosine: CosineParams = field(default_factory=CosineParams)


def averages_row(avg: DataFrame) -> dict:
    """The one-row averages table as literals; a zero average is an error as in the reference."""
    row = avg.first().asDict()
    for f in FIELDS:
        if not row[f"av_{f}"]:
            raise ZeroDivisionError(f"average {f} length is 0")
    return row


def _cosine_term(p: CosineParams):
    dv = sum((F.lit(float(c)) * sublinear(f"tf_{f}") for c, f in zip(p.weights, FIELDS)), F.lit(0.0))
    return sublinear("q_tf") * F.col("idf") * dv / (F.col("body_length") + F.lit(p.length_smooth)).cast("double")


def _bm25_weight(p: BM25FParams, av: dict):
    w = F.lit(0.0)
    for b, wf, f in zip(p.b, p.w, FIELDS):
        ratio = idiv(F.col(f"len_{f}"), int(av[f"av_{f}"])).cast("double")
        norm = F.lit(1.0) + F.lit(float(b)) * (ratio - F.lit(1.0))
        w = w + F.lit(float(wf)) * F.col(f"tf_{f}").cast("double") / norm
    return w


def score_pairs(tf: DataFrame, stats: DataFrame, avg: DataFrame, cosine: CosineParams = CosineParams(),
                bm25: BM25FParams = BM25FParams(), n_docs: int = N_DOCS, window: WindowParams = WindowParams()) -> DataFrame:
    """(query_id, doc_id, cosine, bm25f, bm25f_text, window_cosine): Q50, Q51, Q52 in one
    aggregation, and the cosine under the window scorer's own parameters.

    ``tf`` rows that have their pair's stats already (``copies``: how many rows of ``stats`` the pair has) are summed without a join.
    """
    av = averages_row(avg)
    wt = _bm25_weight(bm25, av)
    terms = {"cosine": _cosine_term(cosine), "window_cosine": _cosine_term(window.cosine), "bm25f_text": F.col("idf") * wt / (F.lit(bm25.k1) + wt)}
    # A pair whose query has no terms keeps its row: score 0 plus the prior.
    if "copies" in tf.columns:
        sums = tf.withColumn("idf", idf("df", n_docs)).groupBy(*KEYS).agg(*[F.sum(c * F.col("copies")).alias(k) for k, c in terms.items()])
        agg = stats.select(*KEYS, "pagerank").groupBy(*KEYS).agg(F.max("pagerank").alias("pagerank")).join(sums, KEYS, "left")
        agg = agg.select(*KEYS, "pagerank", *[F.coalesce(k, F.lit(0.0)).alias(k) for k in terms])
    else:
        cols = ["body_length", "pagerank"] + [f"len_{f}" for f in FIELDS]
        rows = stats.select(*KEYS, *cols).join(tf, KEYS, "left").withColumn("idf", idf("df", n_docs))
        agg = rows.groupBy(*KEYS).agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(k) for k, c in terms.items()], F.max("pagerank").alias("pagerank"))
    prior = F.lit(bm25.pagerank_weight) * F.log10(F.col("pagerank").cast("double") + 1.0)
    return agg.select(*KEYS, "cosine", (F.col("bm25f_text") + prior).alias("bm25f"), "bm25f_text", "window_cosine")


def min_windows(hits: DataFrame, qterms: DataFrame) -> DataFrame:
    """(query_id, doc_id, window): smallest span of positions covering every
    distinct query term inside one field instance, minimised over the
    instances (Q53-Q55). Pairs with no covering instance get no row (infinity).

    One sweep per instance: its hits in order of position, carrying the last
    place of every term of the query. Once all have one, the best window that ends at a hit begins
    at the smallest of them. A state holds as many numbers as the query has terms, and an
    instance's hits are no longer than its text; no row is made per hit and term.
    """
    g = [*KEYS, "field", "inst"]
    # (query, term) pairs are few per query: broadcast after a count, so the hits of a
    # hot query are not shuffled onto one task by query_id
    terms = qterms.select("query_id", "term").distinct().groupBy("query_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    terms = checked_broadcast(terms)
    x = hits.select(*g, "term", F.col("pos").cast("bigint").alias("pos")).join(terms, "query_id").withColumn("t", F.array_position("terms", F.col("term")))
    per = x.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("hits"), F.max(F.size("terms")).alias("n"), F.size(F.collect_set("t")).alias("k"))
    per = per.filter(F.col("n") == F.col("k"))  # only an instance that has all terms can be covered
    none = F.lit(None).cast("bigint")
    start = F.struct(F.array_repeat(none, F.col("n")).alias("last"), none.alias("best"))

    def step(state, hit):
        last = F.transform(state["last"], lambda p, i: F.when(i + 1 == hit["t"], hit["pos"]).otherwise(p))
        # a term without a place yet: no window ends here
        open_ = F.exists(last, lambda p: p.isNull())
        return F.struct(last.alias("last"), F.when(open_, state["best"]).otherwise(F.least(state["best"], hit["pos"] - F.array_min(last) + 1)).alias("best"))

    per_inst = per.select(*KEYS, F.aggregate("hits", start, step, lambda s: s["best"]).alias("w"))
    return per_inst.groupBy(*KEYS).agg(F.min("w").cast("bigint").alias("min_window"))


def smallest_window_scores(cos: DataFrame, windows: DataFrame, queries: DataFrame, p: WindowParams = WindowParams()) -> DataFrame:
    """(query_id, doc_id, score): cosine x (n_q / w * (B - 1) + 1); no window -> factor 1 (Q56).

    n_q counts the lower-cased query's tokens with repeats, as the reference does.
    """
    from quarry.functions.text import lower_ws_terms

    nq = queries.select("query_id", F.size(lower_ws_terms("query")).cast("double").alias("n_q"))
    own = "window_cosine" if "window_cosine" in cos.columns else "cosine"
    s = cos.select(*KEYS, F.col(own).alias("cosine")).join(windows, KEYS, "left").join(checked_broadcast(nq), "query_id")
    boost = F.coalesce(F.col("n_q") / F.col("min_window") * F.lit(p.boost - 1.0), F.lit(0.0)) + F.lit(1.0)
    return s.select(*KEYS, (boost * F.col("cosine")).alias("score"))


def select_scorer(method) -> str:
    """Scorer choice (Q59): 1 / 'cosine', 2 / 'bm25f', 3 / 'window'; the reference
    falls back to cosine for any other number, names are checked."""
    if isinstance(method, int):
        return {2: "bm25f", 3: "window"}.get(method, "cosine")
    if method not in ("cosine", "bm25f", "window"):
        raise ValueError(f"unknown scorer {method!r}")
    return method
