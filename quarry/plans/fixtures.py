"""Ranking and search fixtures derived from the driver tables (FIXTURES.md §3).

``documents`` becomes a five-field collection: the url is built from
source / lang / doc_id, line 1 is the title, lines 2 and 3 are headers,
the rest is the body, and two docs in three carry an anchor (the title,
counted ``doc_id % 5 + 1`` times). A query is all terms of a ``benchmark`` text, and every document with at least a
third of its distinct terms, in any field, is a candidate. Relevance is
``quality - toxic`` from ``labels`` and is used by NDCG and the learners only.
Every view scales with the tables it reads.

``ShortFixture`` is what the learners and the query file work on: two to five terms of a text (its most frequent ones, or, of
every fourth item, its first words), and of each query the fixed number of candidates that a search engine's first
stage gives: of those with all its terms, or all but one of three or more, the ones with most terms, then fewest
occurrences (short ones).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.batches import slices
from quarry.functions.text import ascii_lower, ws_terms
from quarry.operators import signals as sig
from quarry.session import checked_broadcast, checkpointed
from quarry.sources.tables import table

# A candidate has at least one in MATCH_PART of a query's distinct terms.
MATCH_PART = 3
# Terms of a short query: QUERY_TERMS, and up to QUERY_SPAN - 1 more by item.
QUERY_TERMS = 2
QUERY_SPAN = 4
# Candidates of a short query: the first stage's list.
CANDIDATES = 50
# Queries whose id is a multiple of this repeat their rarest term, so that query counts above 1 occur.
REPEAT_EVERY = 3
# Characters of text that a task counts at a time.
TEXT_A_BATCH = 1 << 20


def field_instances(documents: DataFrame) -> DataFrame:
    """(doc_id, field, inst, txt, weight) -- five fields per document."""
    return _instances(documents).select("doc_id", F.inline("fields"))


def _instances(documents: DataFrame) -> DataFrame:
    """(doc_id, fields): a document's field instances in one row."""
    d = documents.select("doc_id", "text", "lang", "source")
    ext = F.when(F.col("doc_id") % 7 == 0, ".pdf").when(F.col("doc_id") % 7 == 1, ".php").otherwise("")
    url = F.concat(F.lit("http://"), "source", F.lit(".example.com/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), ext)
    title = F.regexp_extract("text", "^([^\\n]*)", 1)
    h0 = F.regexp_extract("text", "^[^\\n]*\\n([^\\n]*)", 1)
    h1 = F.regexp_extract("text", "^[^\\n]*\\n[^\\n]*\\n([^\\n]*)", 1)
    body = F.regexp_replace("text", "^[^\\n]*\\n?[^\\n]*\\n?[^\\n]*\\n?", "")
    def inst(field, i, txt, weight=F.lit(1)):
        return F.struct(F.lit(field).alias("field"), F.lit(i).alias("inst"), txt.alias("txt"), weight.cast("bigint").alias("weight"))

    anchor_txt = F.when(F.col("doc_id") % 3 != 0, title)
    rows = F.array(
        inst("url", 0, url), inst("title", 0, title), inst("header", 0, h0), inst("header", 1, h1),
        inst("body", 0, body), inst("anchor", 0, anchor_txt, F.col("doc_id") % 5 + 1),
    )
    rows = F.filter(rows, lambda r: r["txt"].isNotNull())
    return d.select("doc_id", rows.alias("fields"))


def _inst_terms():
    return F.when(F.col("field") == "url", F.regexp_extract_all(ascii_lower("txt"), F.lit("[a-z0-9]+"), 0)).otherwise(
        ws_terms(ascii_lower("txt")))


def field_tokens(inst: DataFrame) -> DataFrame:
    """(doc_id, field, inst, weight, term, pos): url runs for the url, ASCII-lowered whitespace tokens elsewhere."""
    toks = inst.select("doc_id", "field", "inst", "weight", F.posexplode(_inst_terms()).alias("pos", "term"))
    return toks.select("doc_id", "field", "inst", "weight", F.col("pos").cast("bigint").alias("pos"), "term")


def _read_rows(batches, vocabulary: dict[bytes, int]):
    """Arrow batches of ``_instances`` -> (doc_ids, [[(field, inst, weight, text, tokens, place of each in the vocabulary or -1)]]), some
    TEXT_A_BATCH bytes at a time.

    Bytes are lowered and split at ASCII characters alone, as ``_inst_terms`` does.
    """
    import re

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    run = re.compile(rb"[a-z0-9]+")
    for batch in batches:
        lists = batch.column("fields")
        sizes = np.add.reduceat(np.append(np.asarray(pc.binary_length(lists.flatten().field("txt"))), 0), np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()) if batch.num_rows else np.zeros(0)
        for rows in slices(batch, sizes, TEXT_A_BATCH):
            fields = rows.column("fields")
            flat = fields.flatten()
            texts = flat.field("txt").cast(pa.binary()).to_pylist()
            names, insts, weights = (flat.field(c).to_pylist() for c in ("field", "inst", "weight"))
            found, at = [], 0
            for n in pc.list_value_length(fields).to_pylist():
                row = []
                for k in range(at, at + n):
                    text = texts[k].lower()
                    tokens = run.findall(text) if names[k] == "url" else text.split()
                    row.append((names[k], insts[k], weights[k], texts[k], tokens, [vocabulary.get(t, -1) for t in tokens]))
                found.append(row)
                at += n
            yield rows.column("doc_id"), found


def _counted_rows(vocabulary: dict[bytes, int]):
    """mapInArrow body over ``_instances``: of each row the url, the fields' weighted lengths, and the counts of the vocabulary's terms."""
    names = sig.FIELDS

    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        field = {f: i for i, f in enumerate(names)}
        for ids, rows in _read_rows(batches, vocabulary):
            urls, lens, ends, tids, counts = [], np.zeros((len(rows), len(names)), np.int64), [0], [], []
            for k, row in enumerate(rows):
                url, seen = None, {}
                for name, _, weight, text, tokens, places in row:
                    i = field[name]
                    lens[k, i] += weight * len(tokens)
                    if name == "url":
                        url = text
                    for t, n in Counter(places).items():
                        if t >= 0:
                            c = seen.get(t)
                            if c is None:
                                c = seen[t] = [0] * (1 + len(names))
                            c[0] += n
                            c[1 + i] += n * weight
                urls.append(url)
                tids += seen
                counts += seen.values()
                ends.append(len(tids))
            counts = np.array(counts, np.int64).reshape(-1, 1 + len(names))
            terms = pa.StructArray.from_arrays([pa.array(tids, pa.int32()), *[pa.array(np.ascontiguousarray(c)) for c in counts.T]], names=["tid", "n", *names])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(urls, pa.binary()).cast(pa.string(), safe=False), *[pa.array(np.ascontiguousarray(c)) for c in lens.T],
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), terms)],
                names=["doc_id", "url", *[f"len_{f}" for f in names], "terms"])

    return run


def _matched_rows(query_ids: list, words: dict[int, list[int]], need: list[int]):
    """mapInArrow body over (doc_id, tids): the queries of which a document has enough terms. ``words``: of a term the places of its queries."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        of_term, least, ids = {t: np.array(q) for t, q in words.items()}, np.array(need, np.int64), pa.array(query_ids, pa.int64())
        for batch in batches:
            ends, found = [0], []
            for tids in batch.column("tids").to_pylist():
                lists = [of_term[t] for t in tids if t in of_term]
                if lists:
                    found.append(np.flatnonzero(np.bincount(np.concatenate(lists), minlength=len(least)) >= least))
                    ends.append(ends[-1] + len(found[-1]))
                else:
                    ends.append(ends[-1])
            queries = ids.take(pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in batch.schema.names if c != "tids"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), queries)],
                                             names=[*[c for c in batch.schema.names if c != "tids"], "queries"])

    return run


def _covered_rows(vocabulary: dict[bytes, int], query_ids: list, terms: list[set[int]]):
    """mapInArrow body over ``_instances``: the hits of the queries of which an instance has all terms."""
    rare: dict[int, int] = {}
    for own in terms:
        for t in own:
            rare[t] = rare.get(t, 0) + 1
    by_term: dict[int, list[int]] = {}
    for q, own in enumerate(terms):
        by_term.setdefault(min(own, key=lambda t: (rare[t], t)), []).append(q)

    def run(batches):
        import pyarrow as pa

        kinds = [("query_id", pa.int64()), ("doc_id", pa.int64()), ("field", pa.string()), ("inst", pa.int32()), ("weight", pa.int64()), ("term", pa.string()), ("pos", pa.int64())]
        for ids, rows in _read_rows(batches, vocabulary):
            out = [[] for _ in kinds]
            for doc, row in zip(ids.to_pylist(), rows, strict=True):
                for name, inst, weight, _, tokens, places in row:
                    has = set(places)
                    for q in [q for t in has for q in by_term.get(t, ()) if terms[q] <= has]:
                        for pos, (t, token) in enumerate(zip(places, tokens, strict=True)):
                            if t in terms[q]:
                                for column, value in zip(out, (query_ids[q], doc, name, inst, weight, token.decode(), pos), strict=True):
                                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(out, kinds, strict=True)], names=[c for c, _ in kinds])

    return run


@dataclass
class RankFixture:
    """Lazily built views; those that several plans share are written once, so that plans stay short (a cached
    table's plan is part of every plan over it)."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def documents(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "documents")

    @cached_property
    def inst(self) -> DataFrame:
        return field_instances(self.documents)

    @cached_property
    def tok(self) -> DataFrame:
        return field_tokens(self.inst)

    @cached_property
    def words(self) -> list[str]:
        """The benchmark's distinct terms, on the driver as a task's texts are counted against all of them; a term's place is its ``tid``."""
        return sorted(r["term"] for r in self.bench_terms.select("term").distinct().collect())

    @cached_property
    def vocabulary(self) -> dict[bytes, int]:
        return {t.encode(): i for i, t in enumerate(self.words)}

    @cached_property
    def tids(self) -> DataFrame:
        """(tid, term)"""
        return checkpointed(self.spark.createDataFrame(list(enumerate(self.words)), "tid int, term string"))

    @cached_property
    def counted(self) -> DataFrame:
        """A row for each row of ``documents``: doc_id, url, len_url .. len_anchor, terms (tid, n, url .. anchor: plain count, and
        weighted ones by field). A text lies in one row, so its terms are counted there and no token crosses a shuffle."""
        struct = "struct<tid:int,n:bigint," + ",".join(f"{f}:bigint" for f in sig.FIELDS) + ">"
        schema = "doc_id bigint, url string, " + ", ".join(f"len_{f} bigint" for f in sig.FIELDS) + f", terms array<{struct}>"
        d = _instances(self.documents).withColumn("doc_id", F.col("doc_id").cast("bigint"))
        return checkpointed(d.mapInArrow(_counted_rows(self.vocabulary), schema))

    @cached_property
    def several(self) -> DataFrame:
        """(doc_id): ids of more than one row; such rows are one document together."""
        n = self.counted.select("doc_id").where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        return checked_broadcast(n.filter("n > 1").select("doc_id"))

    @cached_property
    def doc_terms(self) -> DataFrame:
        """A row for each document: doc_id, urls, len_url .. len_anchor, terms."""
        rows = self.counted.where("doc_id is not null")
        lens = [f"len_{f}" for f in sig.FIELDS]
        once = rows.join(self.several, "doc_id", "left_anti").select(
            "doc_id", F.filter(F.array("url"), lambda u: u.isNotNull()).alias("urls"), *lens, "terms")
        again = rows.join(self.several, "doc_id", "left_semi")
        sums = again.select("doc_id", F.inline("terms")).groupBy("doc_id", "tid").agg(*[F.sum(c).alias(c) for c in ("n", *sig.FIELDS)])
        sums = sums.groupBy("doc_id").agg(F.collect_list(F.struct("tid", "n", *sig.FIELDS)).alias("terms"))
        again = again.groupBy("doc_id").agg(F.collect_list("url").alias("urls"), *[F.sum(c).alias(c) for c in lens]).join(sums, "doc_id")
        return once.unionByName(again)

    @cached_property
    def df(self) -> DataFrame:
        """(term, df): body document frequency + 1 (the +1 of the df dictionary) of the query vocabulary."""
        body = self.counted.select(F.explode("terms").alias("t")).filter("t.body > 0").groupBy("t.tid").agg((F.count(F.lit(1)) + 1).alias("df"))
        return checkpointed(body.join(F.broadcast(self.tids), "tid").select("term", "df"))

    @cached_property
    def bench_terms(self) -> DataFrame:
        """(item_id, term, pos): distinct terms of every benchmark text, and where each comes first."""
        b = table(self.spark, self.sf_dir, "benchmark")
        words = b.select("item_id", F.posexplode(ws_terms(ascii_lower("text"))).alias("pos", "term"))
        return words.groupBy("item_id", "term").agg(F.min("pos").alias("pos"))

    @cached_property
    def item_terms(self) -> DataFrame:
        """(query_id, term, pos, df): the distinct terms of each benchmark text, df 1 if no body has it."""
        return self.bench_terms.join(self.df, "term", "left").select(
            F.col("item_id").alias("query_id"), "term", "pos", F.coalesce("df", F.lit(1)).cast("bigint").alias("df"))

    @cached_property
    def qterm(self) -> DataFrame:
        """(query_id, term, df): the distinct terms of each query."""
        return checkpointed(self.item_terms.select("query_id", "term", "df"))

    @cached_property
    def queries(self) -> DataFrame:
        """(query_id, query): the query text, frequent terms first; some repeat the rarest."""
        key = F.struct((-F.col("df")).alias("k"), F.col("term"))
        w = self.qterm.groupBy("query_id").agg(F.sort_array(F.collect_list(key)).alias("t"))
        again = F.when(F.col("query_id") % REPEAT_EVERY == 0, F.slice("t.term", -1, 1)).otherwise(F.array().cast("array<string>"))
        return w.select("query_id", F.array_join(F.concat(F.col("t.term"), again), " ").alias("query"))

    @cached_property
    def bool_queries(self) -> DataFrame:
        """Boolean-search batch: each query, the same with an unknown term, one with a repeated term, and its three most frequent terms."""
        words, number = F.split("query", " "), F.col("query_id").cast("string")
        forms = F.array(F.col("query"), F.concat_ws(" ", "query", F.concat(F.lit("zzzz"), number)),
                        F.concat_ws(" ", F.element_at(words, 1), "query"), F.array_join(F.slice(words, 1, 3), " "))
        q = self.queries.select("query_id", F.posexplode(forms).alias("form", "query"))
        return q.select((F.col("query_id") * 4 + F.col("form")).alias("query_id"), "query")

    @cached_property
    def vocab_tok(self) -> DataFrame:
        """Field tokens that are a term of any query; counted, the vocabulary is broadcast."""
        return checkpointed(self.tok.join(checked_broadcast(self.qterm.select("term").distinct()), "term", "left_semi"))

    @cached_property
    def query_words(self) -> list[tuple[int, list[int]]]:
        """(query_id, tids) of every query, on the driver."""
        rows = self.qterm.join(F.broadcast(self.tids), "term").groupBy("query_id").agg(F.array_sort(F.collect_set("tid")).alias("tids")).collect()
        return sorted(((r["query_id"], r["tids"]) for r in rows), key=lambda r: (r[0] is not None, r[0]))

    @cached_property
    def matched(self) -> DataFrame:
        """``doc_terms`` of documents that are a candidate, with the queries they are one of.

        A candidate has at least one in MATCH_PART of a query's distinct terms, in any field. A document's terms lie in
        its row and are counted there against all queries, so what is counted never crosses a shuffle.
        """
        words: dict[int, list[int]] = {}
        for q, (_, tids) in enumerate(self.query_words):
            for t in tids:
                words.setdefault(t, []).append(q)
        need = [-(-len(tids) // MATCH_PART) for _, tids in self.query_words]
        ids = [q for q, _ in self.query_words]
        d = self.doc_terms.withColumn("tids", F.col("terms.tid"))
        schema = d.drop("tids").withColumn("queries", F.array().cast("array<bigint>")).schema
        return checkpointed(d.mapInArrow(_matched_rows(ids, words, need), schema).filter(F.size("queries") > 0))

    @cached_property
    def cand(self) -> DataFrame:
        """(query_id, doc_id): documents with at least one in MATCH_PART of a query's distinct terms, in any field."""
        return self.matched.select(F.explode("queries").alias("query_id"), "doc_id")

    @cached_property
    def pair_tf(self) -> DataFrame:
        """A row for each candidate pair with what ``field_tf`` takes of its document, ``tids`` and ``counts`` of its terms, and
        with its stats; ``copies`` is the number of its rows in ``doc_stats``."""
        d = self.matched.select("*", F.col("terms.tid").alias("tids"), F.size("urls").cast("bigint").alias("copies"))
        return d.select(F.explode("queries").alias("query_id"), "doc_id", *self._stats(), "copies", "tids", F.col("terms").alias("counts"))

    @cached_property
    def hits(self) -> DataFrame:
        """Query-term occurrences of candidates: (query_id, doc_id, field, inst, weight, term, pos)."""
        near = self.vocab_tok.join(checked_broadcast(self.cand), "doc_id")
        return near.join(checked_broadcast(self.qterm.select("query_id", "term")), ["query_id", "term"])

    @cached_property
    def window_hits(self) -> DataFrame:
        """``hits`` of the instances that have all terms of a query: no other can be covered, and their documents are candidates.

        An instance lies in one row and is compared there. Only rows of a document that comes several times, whose
        instances are one together, are joined by their tokens.
        """
        cols = ["query_id", "doc_id", "field", "inst", "weight", "term", "pos"]
        d = _instances(self.documents).withColumn("doc_id", F.col("doc_id").cast("bigint")).where("doc_id is not null")
        ids, terms = [q for q, _ in self.query_words], [set(t) for _, t in self.query_words]
        schema = "query_id bigint, doc_id bigint, field string, inst int, weight bigint, term string, pos bigint"
        once = d.join(self.several, "doc_id", "left_anti").mapInArrow(_covered_rows(self.vocabulary, ids, terms), schema)
        tok = checkpointed(self.tok.join(self.several, "doc_id", "left_semi").join(checked_broadcast(self.qterm.select("term").distinct()), "term", "left_semi"))
        per = Window.partitionBy("query_id").orderBy("df", "term")
        rarest = checked_broadcast(self.qterm.withColumn("rn", F.row_number().over(per)).filter("rn = 1").select("query_id", "term"))
        inst = checked_broadcast(tok.join(rarest, "term").select("query_id", "doc_id", "field", "inst").distinct())
        again = tok.join(inst, ["doc_id", "field", "inst"]).join(checked_broadcast(self.qterm.select("query_id", "term")), ["query_id", "term"])
        return once.unionByName(again.select(*cols))

    @cached_property
    def labels(self) -> DataFrame:
        lab = table(self.spark, self.sf_dir, "labels")
        return lab.select("doc_id", (F.col("quality") - F.col("toxic")).cast("double").alias("rel"))

    @cached_property
    def judged(self) -> DataFrame:
        """(query_id, doc_id, rel): the candidates that have a label."""
        return checkpointed(self.cand.join(self.labels, "doc_id").select("query_id", "doc_id", "rel"))

    @cached_property
    def lens(self) -> DataFrame:
        """(doc_id, len_url .. len_anchor): weighted token counts per field, 0 if none (wide)."""
        # token counts straight from the arrays' sizes: no explode needed
        sized = self.inst.select("doc_id", "field", "inst", (F.size(_inst_terms()) * F.col("weight")).alias("weight"))
        return sig.field_lengths(sized, ["doc_id"])

    def _stats(self) -> list:
        """Columns of a document that its pairs have."""
        pagerank = (F.col("doc_id") % 10).cast("bigint").alias("pagerank")
        return [*[f"len_{f}" for f in sig.FIELDS], F.col("len_body").alias("body_length"), pagerank]

    @cached_property
    def doc_stats(self) -> DataFrame:
        """(query_id, doc_id, url, body_length, pagerank, len_*) per candidate pair."""
        by_url = self.matched.select("doc_id", "queries", F.explode("urls").alias("url"), *self._stats())
        return by_url.select(F.explode("queries").alias("query_id"), *[c for c in by_url.columns if c != "queries"])

    @cached_property
    def qvec(self) -> DataFrame:
        """(query_id, term, q_tf, df) with q_tf from the query text."""
        return sig.query_vector(self.queries, self.df, lower=False)

    @cached_property
    def qvec_tids(self) -> DataFrame:
        """``qvec`` with the terms' ``tid``."""
        return self.qvec.join(F.broadcast(self.tids), "term")

    def split(self, train: bool):
        """Train (query_id % 4 <> 0) / test (= 0) halves for the learners."""
        cond = (F.col("query_id") % 4 != 0) if train else (F.col("query_id") % 4 == 0)
        return cond


class ShortFixture(RankFixture):
    """Short queries, and a fixed number of candidates of each: the pairs grow with the queries alone."""

    @cached_property
    def qterm(self) -> DataFrame:
        """(query_id, term, df): two to five terms of each text."""
        r = self.item_terms
        frequent = F.when(F.col("query_id") % QUERY_SPAN != QUERY_SPAN - 1, -F.col("df")).otherwise(F.col("pos"))
        rn = F.row_number().over(Window.partitionBy("query_id").orderBy(frequent, "term"))  # the words of one benchmark text
        chosen = r.withColumn("rn", rn).filter(F.col("rn") <= QUERY_TERMS + F.col("query_id") % QUERY_SPAN)
        chosen = checkpointed(chosen.select("query_id", "term", "df"))
        # Items with the same query ask it once.
        same = chosen.groupBy("query_id").agg(F.array_sort(F.collect_list("term")).alias("terms"))
        once = same.groupBy("terms", F.col("query_id") % REPEAT_EVERY == 0).agg(F.min("query_id").alias("query_id")).select("query_id")
        return checkpointed(chosen.join(once, "query_id", "left_semi"))

    @cached_property
    def cand(self) -> DataFrame:
        """(query_id, doc_id): the CANDIDATES documents with most of a query's terms, then fewest occurrences, then the smaller id.

        A document may miss one term of three or more, none of fewer.
        """
        t = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
        q = self.qterm.select("query_id", "term", F.greatest(t - 1, F.least(t, F.lit(2))).alias("need"))
        q = checked_broadcast(q.join(F.broadcast(self.tids), "term").drop("term"))
        doc_terms = self.doc_terms.select("doc_id", F.col("terms.tid").alias("tid"), F.col("terms.n").alias("n")).repartition("doc_id")
        doc_terms = doc_terms.select("doc_id", F.inline(F.arrays_zip("tid", "n")))
        had = doc_terms.join(q, "tid").groupBy("doc_id", "query_id").agg(F.count(F.lit(1)).alias("k"), F.max("need").alias("need"), F.sum("n").alias("n"))
        best = Window.partitionBy("query_id").orderBy(F.col("k").desc(), "n", "doc_id")  # cut per task before the shuffle
        had = had.filter(F.col("k") >= F.col("need")).withColumn("rk", F.row_number().over(best))
        return checkpointed(had.filter(F.col("rk") <= CANDIDATES).select("query_id", "doc_id"))

    @cached_property
    def matched(self) -> DataFrame:
        queries = checked_broadcast(self.cand.groupBy("doc_id").agg(F.collect_list("query_id").alias("queries")))
        return checkpointed(self.doc_terms.join(queries, "doc_id"))

    @cached_property
    def window_hits(self) -> DataFrame:
        return RankFixture.window_hits.func(self).join(checked_broadcast(self.cand), ["query_id", "doc_id"], "left_semi")


def signal_records(fx: RankFixture) -> DataFrame:
    """The fixture as signal-file records: one per candidate (query, doc) with the
    raw title / headers / anchor text, the query terms' body positions,
    body length and pagerank (the input of the signal-file writer)."""
    inst = fx.inst
    title = inst.filter(F.col("field") == "title").select("doc_id", F.col("txt").alias("title"))
    url = inst.filter(F.col("field") == "url").select("doc_id", F.col("txt").alias("url"))
    heads = inst.filter(F.col("field") == "header").groupBy("doc_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("inst", "txt"))), lambda s: s["txt"]).alias("headers"))
    anchors = inst.filter(F.col("field") == "anchor").select(
        "doc_id", F.array(F.struct(F.col("txt").alias("text"), F.col("weight").cast("int").alias("cnt"))).alias("anchors"))
    body = fx.hits.filter(F.col("field") == "body").groupBy("query_id", "doc_id", "term").agg(
        F.array_sort(F.collect_list(F.col("pos").cast("int"))).alias("ps"))
    body = body.groupBy("query_id", "doc_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "ps"))).alias("body_hits"))
    r = (fx.doc_stats.select("query_id", "doc_id", F.col("body_length").cast("int").alias("body_length"),
                             F.col("pagerank").cast("int").alias("pagerank"))
         .join(fx.queries, "query_id").join(title, "doc_id").join(url, "doc_id").join(heads, "doc_id")
         .join(anchors, "doc_id", "left").join(body, ["query_id", "doc_id"], "left"))
    return r.select(
        F.col("query_id").alias("q_order"), "query", "url", "title", "headers",
        F.coalesce("body_hits", F.create_map().cast("map<string,array<int>>")).alias("body_hits"),
        "body_length", "pagerank", F.coalesce("anchors", F.array().cast("array<struct<text:string,cnt:int>>")).alias("anchors"),
    )
