"""Gap, variable-byte and gamma posting compression, and the index-size report (Q34-Q38).

Posting lists are handled in doc-id range chunks (``index.POSTING_CHUNK``):
gaps inside a chunk come from the sorted chunk array, and the first gap of
a chunk is taken against the last id of the term's previous non-empty
chunk. Windows by term run over a thin table (term, chunk, one or two numbers)
that is joined back on (term, chunk): arrays and streams are never shuffled by
term alone. A byte stream of a whole list is the concatenation of its
chunks' streams, so no task ever holds a stop word's full list.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import codecs
from quarry.functions.batches import slices
from quarry.operators.index import POSTING_CHUNK, posting_lists
from quarry.session import checkpointed

# Bits of gamma codes, or ids, that a task turns into arrays at a time; a longer list is taken alone.
SLICE_BITS = 1 << 21
SLICE_IDS = 1 << 18


def _with_base(chunks: DataFrame, end: str, running: bool) -> DataFrame:
    """``chunks`` with ``base``: ``end`` of the term's chunk before (or the sum of all before), 0 for its first.

    Only terms with a chunk beyond the first id range meet the window over thin rows (term, chunk, end).
    """
    w = Window.partitionBy("term").orderBy("chunk")
    before = F.sum(end).over(w.rowsBetween(Window.unboundedPreceding, -1)) if running else F.lag(end).over(w)
    later = chunks.filter(F.col("chunk") > 0)
    thin = chunks.select("term", "chunk", end).join(later.select("term").distinct(), "term", "left_semi")
    thin = thin.select("term", "chunk", F.coalesce(before, F.lit(0)).cast("bigint").alias("base"))
    first = chunks.filter(F.col("chunk") == 0).withColumn("base", F.lit(0).cast("bigint"))
    return first.unionByName(later.join(thin, ["term", "chunk"]).select(*first.columns))


def gap_lists(post: DataFrame, chunk: int = POSTING_CHUNK) -> DataFrame:
    """(term, chunk, n, doc_ids, gaps): d-gaps of every chunk (Q34). Postings are aggregated once."""
    pl = checkpointed(posting_lists(post, chunk).withColumn("end", F.element_at("doc_ids", -1)))
    pl = _with_base(pl, "end", running=False)
    gaps = F.transform(
        "doc_ids", lambda x, i: x - F.when(i == 0, F.col("base")).otherwise(F.element_at("doc_ids", i))
    )
    return pl.withColumn("gaps", gaps).drop("end")


def gaps_long(post: DataFrame, chunk: int = POSTING_CHUNK) -> DataFrame:
    """(term, doc_id, gap) one row per posting (Q34)."""
    g = gap_lists(post, chunk)
    return g.select("term", F.explode(F.arrays_zip("doc_ids", "gaps")).alias("z")).select(
        "term", F.col("z.doc_ids").alias("doc_id"), F.col("z.gaps").alias("gap")
    )


def _lengths(lists) -> np.ndarray:
    return np.asarray(lists.value_lengths()).astype(np.int64)


def decode_gaps(chunks: DataFrame, gaps_col: str = "gaps") -> DataFrame:
    """(term, doc_id) from per-chunk gap arrays: a running sum inside each chunk
    plus the sum of the earlier chunks (Q35). Ids are made where their chunk is: none crosses a shuffle."""
    import pyarrow as pa

    c = chunks.select("term", "chunk", gaps_col, F.aggregate(gaps_col, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("chunk_sum"))
    c = _with_base(checkpointed(c), "chunk_sum", running=True)

    def run(batches):
        for batch in batches:
            for rows in slices(batch, _lengths(batch.column("gaps")), SLICE_IDS):
                n = _lengths(rows.column("gaps"))
                row = np.repeat(np.arange(len(n)), n)
                ids = np.asarray(rows.column("base"))[row] + codecs.list_sums(np.asarray(rows.column("gaps").flatten()), n)
                yield pa.RecordBatch.from_arrays([rows.column("term").take(pa.array(row)), pa.array(ids)], names=["term", "doc_id"])

    return c.select("term", "base", F.col(gaps_col).alias("gaps")).mapInArrow(run, "term string, doc_id bigint")


def vb_postings(post: DataFrame, chunk: int = POSTING_CHUNK) -> DataFrame:
    """(term, chunk, n, vb): VB stream (BINARY) of each chunk's gaps (Q36)."""
    return gap_lists(post, chunk).select("term", "chunk", "n", F.unhex(codecs.vb_encode(F.col("gaps"))).alias("vb"))


def vb_roundtrip(vb: DataFrame) -> DataFrame:
    """(term, doc_id) decoded back from ``vb_postings`` (Q35 + Q36)."""
    return decode_gaps(vb.withColumn("gaps", codecs.vb_decode(F.lower(F.hex("vb")))))


def gamma_postings(post: DataFrame, chunk: int = POSTING_CHUNK) -> DataFrame:
    """(term, chunk, n, code_len, gamma): the gamma stream of the whole list in bytes (BINARY), cut at chunks (Q37).

    A chunk's codes begin at a bit offset of the list's stream, rarely at a whole byte. The byte belongs to the chunk that has
    its first bit; a chunk passes the bits before its own first byte on, as (term, byte, value), and
    the owner's last byte takes them in. The list's last byte is filled with ones. Chunks of a term, in order,
    join to the list's stream, and none is ever held with another. Lists are packed by array operations, many at a time.
    """
    import pyarrow as pa

    code_len = F.aggregate("gaps", F.lit(0).cast("bigint"), lambda a, x: a + codecs.gamma_bits(x))
    g = _with_base(checkpointed(gap_lists(post, chunk).select("term", "chunk", "n", "gaps", code_len.alias("code_len"))), "code_len", running=True)

    def run(batches):
        for batch in batches:
            for rows in slices(batch, np.asarray(batch.column("code_len")), SLICE_BITS):
                offset = np.asarray(rows.column("base")) % 8
                packed, n_bytes = codecs.gamma_pack(np.asarray(rows.column("gaps").flatten()), _lengths(rows.column("gaps")), offset)
                first, shared = np.cumsum(n_bytes) - n_bytes, offset > 0  # the first byte is an earlier chunk's
                own = np.ones(len(packed), bool)
                own[first[shared]] = False
                ends = np.concatenate([[0], np.cumsum(n_bytes - shared)]).astype(np.int32)
                stream = pa.BinaryArray.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(packed[own].tobytes())])
                passed = pa.array(packed[first].astype(np.int32), mask=~shared)
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("term", "chunk", "n", "code_len", "base")), passed, stream],
                                                 names=["term", "chunk", "n", "code_len", "base", "passed", "gamma"])

    columns = "term string, chunk bigint, n bigint, code_len bigint, base bigint, passed int, gamma binary"
    g = checkpointed(g.select("term", "chunk", "n", "code_len", "base", "gaps").mapInArrow(run, columns))
    end = F.col("base") + F.col("code_len")
    passed = g.filter("passed is not null").select("term", F.floor(F.col("base") / 8).cast("bigint").alias("byte"), F.col("passed").alias("value"))
    # The list's last byte is filled with ones.
    lasts = g.groupBy("term").agg(F.max(end).alias("total")).filter(F.col("total") % 8 > 0)
    ones = lasts.select("term", F.floor(F.col("total") / 8).cast("bigint").alias("byte"), (F.pow(F.lit(2), F.pmod(-F.col("total"), F.lit(8))) - 1).cast("int").alias("value"))
    passed = passed.unionByName(ones).groupBy("term", "byte").agg(F.bit_or("value").alias("value"))
    # The last byte of a chunk: own bits, and what later chunks passed.
    own = g.filter(F.length("gamma") > 0).withColumn("byte", F.floor((end - 1) / 8).cast("bigint")).join(passed, ["term", "byte"], "left")
    size = F.length("gamma")
    last = F.conv(F.hex(F.substring("gamma", size, F.lit(1))), 16, 10).cast("int").bitwiseOR(F.coalesce("value", F.lit(0)))
    stream = F.concat(F.substring("gamma", F.lit(1), size - 1), F.unhex(F.lpad(F.hex(last), 2, "0")))
    out = own.select("term", "chunk", "n", "code_len", stream.alias("gamma"))
    return out.unionByName(g.filter(F.length("gamma") == 0).select("term", "chunk", "n", "code_len", "gamma"))


def gamma_roundtrip(gam: DataFrame) -> DataFrame:
    """(term, doc_id) decoded back from ``gamma_postings`` (Q35 + Q37).

    A chunk takes back the bits at its end that the next chunks' bytes or its own last byte hold: its codes are the
    bits from its offset on, over its own bytes and the last byte of the chunk before.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    g = checkpointed(_with_base(checkpointed(gam), "code_len", running=True))
    # The byte in which a chunk begins, if another owns it: the owner's last one. Only lists of several chunks have such.
    inside = g.filter(F.col("base") % 8 > 0)
    lists = inside.select("term").distinct()
    lasts = g.filter(F.length("gamma") > 0).join(lists, "term", "left_semi").select(
        "term", (F.ceil(F.col("base") / 8).cast("bigint") + F.length("gamma") - 1).alias("at"), F.substring("gamma", F.length("gamma"), F.lit(1)).alias("head"))
    inside = inside.withColumn("at", F.floor(F.col("base") / 8).cast("bigint")).join(lasts, ["term", "at"]).withColumn("gamma", F.concat("head", "gamma"))
    g = g.filter(F.col("base") % 8 == 0).unionByName(inside.select(*g.columns))

    def run(batches):
        for batch in batches:
            for rows in slices(batch, np.asarray(batch.column("code_len")), SLICE_BITS):
                streams = rows.column("gamma")
                n_bytes = np.asarray(pc.binary_length(streams)).astype(np.int64)
                data = np.frombuffer(b"".join(streams.to_pylist()), np.uint8)
                gaps, n = codecs.gamma_unpack(data, n_bytes, np.asarray(rows.column("base")) % 8, np.asarray(rows.column("code_len")))
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([rows.column("term"), rows.column("chunk"), pa.ListArray.from_arrays(ends, pa.array(gaps))], names=["term", "chunk", "gaps"])

    return decode_gaps(g.select("term", "chunk", "code_len", "base", "gamma").mapInArrow(run, "term string, chunk bigint, gaps array<bigint>"))


def index_size(post: DataFrame, chunk: int = POSTING_CHUNK) -> DataFrame:
    """(term, df, text_bytes, int32_bytes, vb_bytes, gamma_bytes) per term (Q38).

    Closed forms of the four layouts: space-separated decimal ids plus a
    newline; 4 bytes per id; VB bytes per gap; gamma bits per gap, padded
    once per list.
    """
    g = gap_lists(post, chunk)
    add = lambda column, f: F.aggregate(column, F.lit(0).cast("bigint"), lambda a, x: a + f(x).cast("bigint"))
    sums = g.select("term", "n", add("doc_ids", lambda x: F.length(x.cast("string")) + 1).alias("t"),
                    add("gaps", codecs.vb_bytes).alias("v"), add("gaps", codecs.gamma_bits).alias("g"))
    per = sums.groupBy("term").agg(F.sum("n").cast("bigint").alias("df"), F.sum("t").alias("text_bytes"), F.sum("v").alias("vb_bytes"), F.sum("g").alias("gamma_bits"))
    return per.select(
        "term", "df", "text_bytes", (F.col("df") * 4).alias("int32_bytes"), "vb_bytes",
        F.ceil(F.col("gamma_bits") / 8).cast("bigint").alias("gamma_bytes"),
    )


def index_size_total(sizes: DataFrame) -> DataFrame:
    """One row: total postings and bytes of each layout (the ``du`` of the reference's run)."""
    return sizes.agg(
        F.sum("df").alias("postings"), F.sum("text_bytes").alias("text_bytes"), F.sum("int32_bytes").alias("int32_bytes"),
        F.sum("vb_bytes").alias("vb_bytes"), F.sum("gamma_bytes").alias("gamma_bytes"),
    )
