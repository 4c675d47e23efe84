"""Ranking documents per query (Q58).

Ties on the score fall to doc_id ascending (the reference's order among
equal scores depends on object identity). Scores are compared rounded to
9 decimals so float summation order cannot flip an exact tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.numbering import number_rows

SCORE_DIGITS = 9


def rank_documents(scored: DataFrame, score_col: str = "score", top_k: int | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank): 1-based rank per query by score descending.

    Uses the range-partitioned numbering, so one query holding a large
    share of the candidates is spread over many tasks.
    """
    s = scored.select("query_id", "doc_id", F.round(F.col(score_col), SCORE_DIGITS).alias("score"))
    ranked = number_rows(s, [F.col("score").desc(), F.col("doc_id").asc()], "rank", start=1, group_by=["query_id"])
    if top_k is not None:
        ranked = ranked.filter(F.col("rank") <= top_k)
    return ranked
