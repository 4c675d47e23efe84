"""Inverted index construction and maintenance (Q01-Q04, Q20, Q28-Q33).

Index tokens are case-sensitive ``str.split()`` tokens. Document ids are
1-based in (block, file) byte order; term ids are 0-based in order of first
occurrence across the corpus. Posting lists hold distinct ascending doc ids
(no tf, no positions), exactly what the boolean searcher needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.batches import slices
from quarry.functions.text import ws_terms
from quarry.operators.numbering import number_rows
from quarry.session import checked_broadcast, checkpointed

# Doc ids per posting-list chunk: bounds the array view of a stop-word list.
POSTING_CHUNK = 1 << 16
# Folders of a stored index's postings, by a hash of the term.
BUCKETS = 16
# Files that a scan of a file corpus hands on at a time, and characters of text that a task takes.
FILES_A_BATCH = 256
TEXT_A_BATCH = 1 << 20
# Bits of a position in a text: a document id and a position make one number, so that a minimum of both is aggregated by hash.
POSITION_BITS = 31


def corpus_from_documents(documents: DataFrame) -> DataFrame:
    """Corpus view of the ``documents`` table: block = source, file = doc_id as text (Q01)."""
    return documents.select(
        F.col("doc_id").alias("doc_key"),
        F.col("source").alias("block"),
        F.col("doc_id").cast("string").alias("file"),
        "text",
    )


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def corpus_from_files(spark: SparkSession, root: str, folders_per_task: int = 16) -> DataFrame:
    """Corpus scan of ``root/<block>/<file>`` plain-text files (Q01).

    The driver lists the block folders; tasks list the files of their folders, and the files, dealt over all tasks whatever
    their folder, are read once into a table: a plan over the listing would be taken for as small as the list of
    folders, and what is joined to it be broadcast. Names are what the file system has (a scan by path would leave out empty
    files and those that begin with ``_`` or ``.``, and encode blanks). Bytes that are not UTF-8 become replacement
    characters. ``root`` is a path that the executors reach through Arrow's file systems (local or mounted, hdfs, s3, gcs).
    """
    from pyarrow import fs as afs

    store, at = _file_system(root.rstrip("/"))
    blocks = sorted(f.base_name for f in store.get_file_info(afs.FileSelector(at)) if f.type == afs.FileType.Directory)
    folders = spark.createDataFrame([(b,) for b in blocks], "block string").repartition(max(1, -(-len(blocks) // folders_per_task)))

    def listed(batches):
        import pyarrow as pa

        for batch in batches:
            for block in batch.column("block").to_pylist():
                found = store.get_file_info(afs.FileSelector(f"{at}/{block}"))
                names = sorted(f.base_name for f in found if f.type == afs.FileType.File)
                yield pa.RecordBatch.from_pydict({"block": [block] * len(names), "file": names}, pa.schema([("block", pa.string()), ("file", pa.string())]))

    def scan(batches):
        import pyarrow as pa

        schema = pa.schema([(c, pa.string()) for c in ("doc_key", "block", "file", "text")])
        rows, size = [], 0
        for batch in batches:
            for name in batch.to_pylist():
                with store.open_input_stream(f"{at}/{name['block']}/{name['file']}") as f:
                    text = f.read().decode("utf-8", "replace")
                rows.append({"doc_key": f"{name['block']}/{name['file']}", **name, "text": text})
                size += len(text)
                if len(rows) == FILES_A_BATCH or size > TEXT_A_BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = checkpointed(folders.mapInArrow(listed, "block string, file string")).repartition(tasks)
    return checkpointed(files.mapInArrow(scan, "doc_key string, block string, file string, text string"))


def write_corpus_files(corpus: DataFrame, root: str) -> None:
    """Write (block, file, text) rows as ``root/<block>/<file>``, each task its own rows."""
    store, at = _file_system(root.rstrip("/"))

    def put(batches):
        import pyarrow as pa

        made = set()
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in made:
                    store.create_dir(f"{at}/{row['block']}")
                    made.add(row["block"])
                with store.open_output_stream(f"{at}/{row['block']}/{row['file']}") as f:
                    f.write((row["text"] or "").encode())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    store.create_dir(at)
    corpus.select("block", "file", "text").mapInArrow(put, "n bigint").agg(F.sum("n")).first()


def corpus_count(corpus: DataFrame) -> DataFrame:
    """Number of documents in the collection (Q02)."""
    return corpus.agg(F.count(F.lit(1)).alias("n_docs"))


def tokenize(corpus: DataFrame) -> DataFrame:
    """(doc_key, pos, term): one row per whitespace token, pos 0-based (Q12, Q30)."""
    toks = corpus.select("doc_key", F.posexplode(ws_terms("text")).alias("pos", "term"))
    return toks.withColumn("pos", F.col("pos").cast("bigint"))


def doc_catalog(corpus: DataFrame) -> DataFrame:
    """(doc_id, doc_name, doc_key): 1-based ids in (block, file) order (Q28)."""
    keys = corpus.select("doc_key", "block", "file", F.concat_ws("/", "block", "file").alias("doc_name"))
    return number_rows(keys, ["block", "file"], "doc_id", start=1).select("doc_id", "doc_name", "doc_key")


def _row_terms(texts: DataFrame) -> DataFrame:
    """(doc_id, term, first_pos, tf): the distinct terms of each row's text, counted in the row itself.

    ``bytes.split`` parts at the same ASCII whitespace as ``ws_terms``.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        for batch in batches:
            size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0))
            for rows in slices(batch, size, TEXT_A_BATCH):
                terms, places, counts, n = [], [], [], []
                for text in rows.column("text").cast(pa.binary()).to_pylist():
                    first, count = {}, {}
                    for i, term in enumerate((text or b"").split()):
                        if term in count:
                            count[term] += 1
                        else:
                            first[term], count[term] = i, 1
                    terms += first
                    places += first.values()
                    counts += count.values()
                    n.append(len(first))
                ids = rows.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.binary()).cast(pa.string(), safe=False), pa.array(places, pa.int64()), pa.array(counts, pa.int64())],
                                                 names=["doc_id", "term", "first_pos", "tf"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id bigint, term string, first_pos bigint, tf bigint")


def occurrences(tokens: DataFrame, catalog: DataFrame) -> DataFrame:
    """(term, doc_id, first_pos, tf): one row per distinct (term, document) of ``tokens``, or of a corpus with whole texts.

    A text lies in one row, so its terms are counted there: its row meets its document id, and neither tokens nor
    pairs cross a shuffle (Q20, Q31). Only texts whose key comes several times are one document together, and aggregated.
    """
    ids = catalog.select("doc_key", "doc_id")
    if "text" not in tokens.columns:
        occ = tokens.groupBy("term", "doc_key").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("tf"))
        return occ.join(checked_broadcast(ids), "doc_key").drop("doc_key")
    corpus, ids = tokens.select("doc_key", "text"), checked_broadcast(ids)
    several = corpus.groupBy("doc_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_key")
    several = checked_broadcast(several)
    once = _row_terms(corpus.join(several, "doc_key", "left_anti").join(ids, "doc_key"))
    again = _row_terms(corpus.join(several, "doc_key", "left_semi").join(ids, "doc_key"))
    again = again.groupBy("doc_id", "term").agg(F.min("first_pos").alias("first_pos"), F.sum("tf").alias("tf"))
    return once.unionByName(again).select("term", "first_pos", "tf", "doc_id")


def _first() -> Column:
    """Document id and position of a term's first occurrence as one number."""
    return F.min(F.shiftleft("doc_id", POSITION_BITS) + F.col("first_pos"))


def _numbered_terms(first: DataFrame) -> DataFrame:
    return number_rows(first.select("term", "first"), ["first"], "term_id", start=0).select("term_id", "term")


def term_catalog(occ: DataFrame) -> DataFrame:
    """(term_id, term): 0-based ids in first-occurrence order (Q29)."""
    return _numbered_terms(occ.groupBy("term").agg(_first().alias("first")))


def postings(occ: DataFrame) -> DataFrame:
    """(term, doc_id): the long posting table, distinct pairs (Q31)."""
    return occ.select("term", "doc_id")


def doc_freq(post: DataFrame) -> DataFrame:
    """(term, df): document frequency; map-side partial counts absorb stop words (Q32)."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def posting_lists(post: DataFrame, chunk: int = POSTING_CHUNK) -> DataFrame:
    """(term, chunk, n, doc_ids): ascending doc-id arrays cut by doc-id range.

    A stop word's list is split into chunks of at most ``chunk`` ids, so no
    row (and no single aggregation buffer) grows with the corpus (Q31).
    """
    return (
        post.withColumn("chunk", F.floor(F.col("doc_id") / F.lit(chunk)).cast("bigint"))
        .groupBy("term", "chunk")
        .agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"))
        .withColumn("n", F.size("doc_ids").cast("bigint"))
    )


def merge_postings(a: DataFrame, b: DataFrame) -> DataFrame:
    """Merge two block indexes: the union of their ascending lists (Q33)."""
    return a.select("term", "doc_id").unionByName(b.select("term", "doc_id")).distinct()


@dataclass
class InvertedIndex:
    catalog: DataFrame  # doc_id, doc_name, doc_key
    occ: DataFrame  # term, doc_id, first_pos, tf
    postings: DataFrame  # term, doc_id
    doc_freq: DataFrame  # term, df

    def term_catalog(self) -> DataFrame:
        return term_catalog(self.occ)

    def write(self, path: str, mode: str = "overwrite", buckets: int = BUCKETS) -> None:
        """Index write (Q03): postings in folders by a hash of the term, sorted by term, so a search reads
        the folders of its terms and Parquet row-group min/max on ``term`` replace the offset dictionary."""
        n = int(self.postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        post = self.postings.withColumn("bucket", term_bucket("term", buckets))
        (post.repartitionByRange(n, "bucket", "term", "doc_id").sortWithinPartitions("bucket", "term", "doc_id")
         .write.mode(mode).partitionBy("bucket").parquet(f"{path}/postings"))
        self.catalog.select("doc_id", "doc_name").write.mode(mode).parquet(f"{path}/doc_catalog")
        # The pairs are aggregated by term once, for both tables; range partitioning samples its input before it reads it.
        terms = checkpointed(self.occ.groupBy("term").agg(F.count(F.lit(1)).alias("df"), _first().alias("first")))
        _numbered_terms(terms).write.mode(mode).parquet(f"{path}/term_catalog")
        doc_freq = terms.select("term", "df")
        doc_freq.repartitionByRange(n, "term").sortWithinPartitions("term").write.mode(mode).parquet(f"{path}/doc_freq")


def term_bucket(term, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(F.col(term) if isinstance(term, str) else term), F.lit(buckets)).cast("int")


def build_index(corpus: DataFrame) -> InvertedIndex:
    """Corpus -> catalog, occurrences, postings and document frequencies (E1)."""
    catalog = doc_catalog(corpus)
    # The (term, doc) table is the index itself: materialise it once, every
    # other table (postings, df, term ids, codecs) derives from it.
    occ = checkpointed(occurrences(corpus, catalog))
    post = postings(occ)
    return InvertedIndex(catalog=catalog, occ=occ, postings=post, doc_freq=doc_freq(post))


def load_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Index load (Q04): the stored tables, joined on demand instead of held in memory."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("postings", "doc_catalog", "term_catalog", "doc_freq")}


def merge_indexes(spark: SparkSession, a: str, b: str, path: str, mode: str = "overwrite") -> None:
    """Merge two stored block indexes into a third (Q33).

    The doc ids of the blocks must not overlap (checked: an error otherwise), so a term's merged list is the lists of both,
    and no posting has to meet another: the postings are copied folder by folder, without a shuffle. Document
    frequencies are added; term ids follow the first occurrence, a block with smaller doc ids first.
    """
    left, right = load_index(spark, a), load_index(spark, b)
    ends = [idx["doc_catalog"].agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first() for idx in (left, right)]
    if None not in (ends[0]["lo"], ends[1]["lo"]) and ends[0]["lo"] > ends[1]["lo"]:
        left, right, ends = right, left, ends[::-1]
    if None not in (ends[0]["lo"], ends[1]["lo"]) and ends[0]["hi"] >= ends[1]["lo"]:
        raise ValueError(f"doc ids of the indexes overlap: {ends}")
    both = left["postings"].unionByName(right["postings"])
    both.sortWithinPartitions("bucket", "term", "doc_id").write.mode(mode).partitionBy("bucket").parquet(f"{path}/postings")
    left["doc_catalog"].unionByName(right["doc_catalog"]).write.mode(mode).parquet(f"{path}/doc_catalog")
    df = left["doc_freq"].unionByName(right["doc_freq"]).groupBy("term").agg(F.sum("df").alias("df"))
    df.sortWithinPartitions("term").write.mode(mode).parquet(f"{path}/doc_freq")
    new = right["term_catalog"].join(left["term_catalog"].select("term"), "term", "left_anti")
    ranked = left["term_catalog"].select(F.lit(0).alias("part"), "term_id", "term").unionByName(new.select(F.lit(1).alias("part"), "term_id", "term"))
    ranked = number_rows(ranked.withColumnRenamed("term_id", "old"), ["part", "old"], "term_id", start=0)
    ranked.select("term_id", "term").write.mode(mode).parquet(f"{path}/term_catalog")
