from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm.tokens import default_vocabulary

from .conftest import SF001
from .test_dedup import brute_exact, brute_groups
from .test_tokens_and_text import brute_contamination, ids_of


def test_stages_take_effect_and_keep_clean_rows(spark, edge_docs):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").unionByName(edge_docs, allowMissingColumns=True).limit(400)
    docs = docs.withColumn("score", F.lit(1.5))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "packing"]
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    stages = dict(corpus_pipeline.STAGES)

    known = stages["language_id"](spark, docs, SF001).cache()
    assert known.columns == docs.columns
    assert Counter(pairs(known)) == Counter((i, t) for i, t in pairs(docs) if t and any(ch.isalpha() for ch in t))

    single = stages["exact_dedup"](spark, known, SF001).cache()
    assert Counter(i for i, _ in pairs(single)) == Counter(i for i, _, _, kept, _ in brute_exact(pairs(known)).elements() if kept)

    apart = stages["simhash_near_dedup"](spark, single, SF001).cache()
    assert Counter(i for i, _ in pairs(apart)) == brute_groups(pairs(single))[1]

    clean = stages["decontamination"](spark, apart, SF001).cache()
    dirty = Counter({r[0] for r in brute_contamination(pairs(apart), items) if r[5]})
    assert Counter(i for i, _ in pairs(clean)) == Counter(i for i, _ in pairs(apart)) - dirty
    assert clean.columns == docs.columns

    packed = stages["packing"](spark, clean, SF001)
    assert packed.agg(F.sum("length")).first()[0] == sum(len(ids_of(t)) for _, t in pairs(clean))
    assert default_vocabulary().endswith("word_bpe_49k.json")


def test_run_is_the_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    want = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in docs.collect())
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF001).collect()) == want
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_empty_tables(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.collect() == []
