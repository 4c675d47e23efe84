"""Corpus pipeline: language ID, exact dedup, near dedup, decontamination, packing.

A stage takes (spark, docs, sf_dir) and returns the rows it keeps with all
columns of ``docs``; the last returns packed pieces. Between stages the rows
are written and read back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, exact_dedup, langid, packing, simhash
from quarry.llm.common import read, shared_table
from quarry.llm.tokens import default_vocabulary


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter (``und``) go."""
    hidden = docs.withColumnsRenamed({c: f"_kept_{c}" for c in docs.columns if c.lower() in ("lang_pred", "score")})
    known = langid.identify(hidden, langid.fit(docs)).where(F.col("lang_pred") != langid.UNKNOWN).drop("lang_pred", "score")
    return known.toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = packing.cut_pieces(docs, default_vocabulary())
    return packing.pack(pieces.drop("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# SQL cannot express the language model, the tokenizer or the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
