"""quarry: a Spark-native text-retrieval analytics engine.

Inverted indexes, boolean search, field relevance signals, scorers,
learned rankers and NDCG evaluation, all expressed as Spark DataFrame
plans (no row-at-a-time Python UDFs).
"""

__version__ = "0.1.0"
