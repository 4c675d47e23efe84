"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written straight from the operator definitions, row by row in SQL: windows
and plain joins where the Spark plans use range numbering, pivots and
chunked ideal-DCG sums. Views ``documents``, ``benchmark`` and ``labels``
are registered by the caller.
"""

from __future__ import annotations

# ASCII whitespace class and letter tables, as in quarry.functions.text.
WS = r"'[ \t\n\r\x0B\f]+'"
UP = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
LO = "'abcdefghijklmnopqrstuvwxyz'"


def low(x: str) -> str:
    return f"translate({x}, {UP}, {LO})"


def ws(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {WS}), lambda s: s <> '')"


TOK = f"""tok as (
  select doc_id, unnest(range(len(a))) as pos, unnest(a) as term
  from (select doc_id, {ws('text')} as a from documents)
)"""

CAT = """cat as (
  select row_number() over (order by source, cast(doc_id as varchar)) as cid,
         doc_id, source || '/' || cast(doc_id as varchar) as doc_name
  from documents
)"""

POST = """post as (select distinct t.term, c.cid as doc_id from tok t join cat c using (doc_id))"""
DF = """dfreq as (select term, count(*) as df from post group by term)"""
TCAT = """tcat as (
  select row_number() over (order by fd, fp) - 1 as term_id, term
  from (select t.term, min(c.cid) as fd, arg_min(t.pos, c.cid * 100000000 + t.pos) as fp
        from tok t join cat c using (doc_id) group by t.term)
)"""

INDEX = ",\n".join([TOK, CAT, POST, DF])

# A query is all terms of a benchmark text; a document with a third of them is a candidate.
QUERIES = f"""bt as (select distinct item_id, unnest({ws(low('text'))}) as term from benchmark),
fx_qterm as (
  select item_id as query_id, term, df, case when item_id % 3 = 0 and last = 1 then 2 else 1 end as q_tf
  from (select b.item_id, b.term, coalesce(f.df, 1) as df, row_number() over (partition by b.item_id order by coalesce(f.df, 1), b.term desc) as last
        from bt b left join fx_df f using (term))
),
"""
CANDIDATES = """fx_dt as (select distinct doc_id, term from fx_tok where term in (select term from fx_qterm)),
fx_cand as (
  select m.query_id, m.doc_id
  from (select q.query_id, d.doc_id, count(*) as k from fx_qterm q join fx_dt d using (term) group by q.query_id, d.doc_id) m
  join (select query_id, count(*) as n from fx_qterm group by query_id) using (query_id)
  where k >= ceil(n / 3)
),
"""
# Two to five terms of a text, and 50 candidates: the first stage's list that learners work on.
SHORT_QUERIES = f"""bt as (select item_id, term, min(pos) as pos from (
  select item_id, unnest(a) as term, unnest(range(len(a))) as pos from (select item_id, {ws(low('text'))} as a from benchmark)) group by item_id, term),
fx_chosen as (
  select *, list(term) over (partition by query_id order by term rows between unbounded preceding and unbounded following) as terms
  from (select b.item_id as query_id, b.term, coalesce(f.df, 1) as df,
               row_number() over (partition by b.item_id order by case when b.item_id % 4 <> 3 then -coalesce(f.df, 1) else b.pos end, b.term) as rn
        from bt b left join fx_df f using (term))
  where rn <= 2 + query_id % 4
),
fx_qterm as (
  select query_id, term, df, case when query_id % 3 = 0 and row_number() over (partition by query_id order by df, term desc) = 1 then 2 else 1 end as q_tf
  from fx_chosen
  qualify query_id = min(query_id) over (partition by terms, query_id % 3 = 0)
),
"""
SHORT_CANDIDATES = """fx_dt as (select doc_id, term, count(*) as n from fx_tok where term in (select term from fx_qterm) group by doc_id, term),
fx_cand as (
  select query_id, doc_id
  from (select query_id, doc_id, row_number() over (partition by query_id order by k desc, n, doc_id) as rk
        from (select q.query_id, d.doc_id, count(*) as k, sum(d.n) as n from fx_qterm q join fx_dt d using (term) group by q.query_id, d.doc_id) m
        join (select query_id, count(*) as t from fx_qterm group by query_id) using (query_id)
        where k >= greatest(t - 1, least(t, 2)))
  where rk <= 50
),
"""


def _fixture(queries: str, candidates: str) -> str:
    return f"""fx_inst as (
  select doc_id, 'url' as field, 0 as inst,
         'http://' || source || '.example.com/' || lang || '/' || cast(doc_id as varchar)
         || case when doc_id % 7 = 0 then '.pdf' when doc_id % 7 = 1 then '.php' else '' end as txt,
         cast(1 as bigint) as weight from documents
  union all select doc_id, 'title', 0, regexp_extract(text, '^([^\\n]*)', 1), 1 from documents
  union all select doc_id, 'header', 0, regexp_extract(text, '^[^\\n]*\\n([^\\n]*)', 1), 1 from documents
  union all select doc_id, 'header', 1, regexp_extract(text, '^[^\\n]*\\n[^\\n]*\\n([^\\n]*)', 1), 1 from documents
  union all select doc_id, 'body', 0, regexp_replace(text, '^[^\\n]*\\n?[^\\n]*\\n?[^\\n]*\\n?', ''), 1 from documents
  union all select doc_id, 'anchor', 0, regexp_extract(text, '^([^\\n]*)', 1), doc_id % 5 + 1
    from documents where doc_id % 3 <> 0
),
fx_tok as (
  select doc_id, field, inst, weight, unnest(range(len(a))) as pos, unnest(a) as term
  from (select doc_id, field, inst, weight,
               case when field = 'url' then regexp_extract_all({low('txt')}, '[a-z0-9]+')
                    else {ws(low('txt'))} end as a
        from fx_inst)
),
fx_df as (select term, count(distinct doc_id) + 1 as df from fx_tok where field = 'body' group by term),
{queries}fx_query as (
  select query_id, string_agg(term, ' ' order by df desc, term) || coalesce(max(case when q_tf = 2 then ' ' || term end), '') as query
  from fx_qterm group by query_id
),
{candidates}fx_judged as (select c.query_id, c.doc_id, cast(l.quality - l.toxic as double) as rel from fx_cand c join labels l using (doc_id)),
fx_hits as (
  select c.query_id, t.doc_id, t.field, t.inst, t.weight, t.term, t.pos
  from fx_cand c join fx_tok t using (doc_id) join fx_qterm q on q.query_id = c.query_id and q.term = t.term
),
fx_len as (
  select d.doc_id, f.field, cast(coalesce(sum(t.weight), 0) as bigint) as len
  from documents d cross join (values ('url'), ('title'), ('header'), ('body'), ('anchor')) f(field)
  left join fx_tok t on t.doc_id = d.doc_id and t.field = f.field
  group by d.doc_id, f.field
),
fx_avg as (
  select l.field, cast(sum(l.len) // count(*) as bigint) as av from fx_cand c join fx_len l using (doc_id) group by l.field
),
fx_tf as (
  select c.query_id, c.doc_id, q.term, f.field, cast(coalesce(sum(h.weight), 0) as bigint) as tf
  from fx_cand c join fx_qterm q using (query_id)
  cross join (values ('url'), ('title'), ('header'), ('body'), ('anchor')) f(field)
  left join fx_hits h on h.query_id = c.query_id and h.doc_id = c.doc_id and h.term = q.term and h.field = f.field
  group by c.query_id, c.doc_id, q.term, f.field
),
prm as (
  select * from (values ('url', 1, 0.99, 18), ('title', 4, 0.3, 59), ('header', 4, 0.1, 17),
                        ('body', 2, 0.3, 1), ('anchor', 400, 0.01, 15)) p(field, cw, bb, ww)
),
fx_pair as (
  select query_id, doc_id, l.len as body_len, doc_id % 10 as pagerank
  from fx_cand c join fx_len l using (doc_id) where l.field = 'body'
),
fx_term as (
  select t.query_id, t.doc_id, t.term,
         sum(p.cw * case when t.tf = 0 then 0e0 else 1 + log10(t.tf) end) as sc,
         sum(p.ww * t.tf / (1 + cast(p.bb as double) * (l.len // a.av - 1))) as w
  from fx_tf t join prm p using (field) join fx_len l using (doc_id, field) join fx_avg a using (field)
  group by t.query_id, t.doc_id, t.term
),
fx_score as (
  select s.query_id, s.doc_id,
         sum((1 + log10(q.q_tf)) * log10(98999 // q.df) * s.sc) / (max(p.body_len) + 15000) as cosine,
         sum(log10(98999 // q.df) * s.w / (7 + s.w)) as bm25f_text,
         sum(log10(98999 // q.df) * s.w / (7 + s.w)) + log10(max(p.pagerank) + 1) as bm25f
  from fx_term s join fx_qterm q using (query_id, term) join fx_pair p using (query_id, doc_id)
  group by s.query_id, s.doc_id
),
fx_win as (
  with c as (
    select query_id, doc_id, field, inst
    from (select query_id, doc_id, field, inst, count(distinct term) as k from fx_hits group by all)
    join (select query_id, count(*) as k from fx_qterm group by query_id) using (query_id, k)
  ),
  h as (select f.* from fx_hits f join c using (query_id, doc_id, field, inst)),
  -- a window that starts at a hit ends at the latest of every term's first place from there on
  s as (select distinct query_id, doc_id, field, inst, pos as lo from h),
  n as (
    select s.query_id, s.doc_id, s.field, s.inst, s.lo, h.term, min(h.pos) as nxt
    from s join h on h.query_id = s.query_id and h.doc_id = s.doc_id and h.field = s.field and h.inst = s.inst and h.pos >= s.lo
    group by all
  ),
  e as (
    select query_id, doc_id, lo, max(nxt) as hi, count(*) as m from n group by query_id, doc_id, field, inst, lo
  )
  select e.query_id, e.doc_id, cast(min(hi - lo + 1) as bigint) as min_window
  from e join (select query_id, count(*) as n from fx_qterm group by query_id) t on t.query_id = e.query_id and t.n = e.m
  group by e.query_id, e.doc_id
),
fx_sw as (
  select s.query_id, s.doc_id,
         (coalesce(n.nq / w.min_window * 1.7, 0) + 1) * s.cosine as score
  from fx_score s left join fx_win w using (query_id, doc_id)
  join (select query_id, cast(sum(q_tf) as double) as nq from fx_qterm group by query_id) n using (query_id)
)"""


FX = _fixture(QUERIES, CANDIDATES)
FX_SHORT = _fixture(SHORT_QUERIES, SHORT_CANDIDATES)


def _ranked(score: str) -> str:
    return f"""select query_id, doc_id, row_number() over (partition by query_id order by round({score}, 9) desc, doc_id) as rank"""


def _ndcg_sql(src: str, score: str) -> str:
    return f"""ranked as ({_ranked(score)} from {src} join fx_judged using (query_id, doc_id)),
j as (select r.query_id, r.rank, greatest(c.rel, 0) as g from ranked r join fx_judged c using (query_id, doc_id)),
ideal as (select query_id, g, row_number() over (partition by query_id order by g desc) as ik from j),
nd as (
  select d.query_id, case when i.idcg > 0 then d.dcg / i.idcg else 1e0 end as ndcg
  from (select query_id, sum((pow(2, g) - 1) / log2(rank + 1)) as dcg from j group by query_id) d
  join (select query_id, sum((pow(2, g) - 1) / log2(ik + 1)) as idcg from ideal group by query_id) i using (query_id)
)"""


def _with(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


ORACLE: dict[str, str] = {
    "corpus_count": "select count(*) as n_docs from documents",
    "tokenize": _with(TOK) + "select doc_id, pos, term from tok",
    "doc_catalog": _with(CAT) + "select cid as doc_id, doc_name from cat",
    "term_catalog": _with(TOK, CAT, TCAT) + "select term_id, term from tcat",
    "term_doc_pairs": _with(TOK, CAT, TCAT) + "select tc.term_id, c.cid as doc_id, t.pos from tok t join cat c using (doc_id) join tcat tc using (term)",
    "postings": _with(INDEX) + "select term, doc_id from post",
    "posting_lists": _with(INDEX) + """select term, doc_id // 65536 as chunk, count(*) as n,
        string_agg(cast(doc_id as varchar), ',' order by doc_id) as doc_ids from post group by term, doc_id // 65536""",
    "doc_freq": _with(INDEX) + "select term, df from dfreq",
    "merge_indexes": _with(INDEX) + "select term, doc_id from post",
    "vocab_df": _with(INDEX, FX_SHORT) + "select b.term, coalesce(d.df + 1, 1) as df from (select distinct term from bt) b left join dfreq d using (term)",
    "field_tokens": _with(FX_SHORT) + "select doc_id, field, inst, weight, term, pos from fx_tok",
    "field_tf": _with(FX) + "select query_id, doc_id, term, field, tf from fx_tf",
    "field_lengths": _with(FX_SHORT) + "select doc_id, field, len from fx_len",
    "avg_lengths": _with(FX) + """select max(case when field = 'url' then av end) as av_url, max(case when field = 'title' then av end) as av_title,
        max(case when field = 'header' then av end) as av_header, max(case when field = 'body' then av end) as av_body,
        max(case when field = 'anchor' then av end) as av_anchor from fx_avg""",
    "idf": _with(FX) + "select query_id, term, cast(q_tf as bigint) as q_tf, df, round(log10(98999 // df), 9) as idf from fx_qterm",
    "signal_vectors": _with(FX) + """select query_id, doc_id, term, cast(max(q.q_tf) as bigint) as q_tf,
        cast(sum(case when field = 'url' then tf else 0 end) as bigint) as tf_url, cast(sum(case when field = 'title' then tf else 0 end) as bigint) as tf_title,
        cast(sum(case when field = 'header' then tf else 0 end) as bigint) as tf_header, cast(sum(case when field = 'body' then tf else 0 end) as bigint) as tf_body,
        cast(sum(case when field = 'anchor' then tf else 0 end) as bigint) as tf_anchor, round(log10(98999 // max(q.df)), 9) as idf
        from fx_tf join fx_qterm q using (query_id, term) group by query_id, doc_id, term""",
    "sublinear_tf": _with(FX) + "select query_id, doc_id, term, field, tf, round(case when tf = 0 then 0e0 else 1 + log10(tf) end, 9) as stf from fx_tf",
    "cosine": _with(FX) + "select query_id, doc_id, round(cosine, 9) as score from fx_score",
    "bm25f": _with(FX) + "select query_id, doc_id, round(bm25f, 9) as score from fx_score",
    "bm25f_text": _with(FX) + "select query_id, doc_id, round(bm25f_text, 9) as score from fx_score",
    "min_window": _with(FX) + "select query_id, doc_id, min_window from fx_win",
    "smallest_window": _with(FX) + "select query_id, doc_id, round(score, 9) as score from fx_sw",
    "rank_cosine": _with(FX) + _ranked("cosine") + " from fx_score",
    "rank_bm25f": _with(FX) + _ranked("bm25f") + " from fx_score",
    "rank_window": _with(FX) + _ranked("score") + " from fx_sw",
    "ndcg_per_query": _with(FX, _ndcg_sql("fx_score", "bm25f")) + "select query_id, round(ndcg, 9) as ndcg from nd",
    "mean_ndcg": "\nunion all\n".join(
        f"(select * from (" + _with(FX, _ndcg_sql(src, sc)) + f"select '{name}' as scorer, round(avg(ndcg), 9) as mean_ndcg, count(*) as n_queries from nd))"
        for name, src, sc in (("cosine", "fx_score", "cosine"), ("bm25f", "fx_score", "bm25f"), ("window", "fx_sw", "score"))
    ),
}

BOOL = """bq as (
  select query_id * 4 as query_id, query from fx_query
  union all select query_id * 4 + 1, query || ' zzzz' || cast(query_id as varchar) from fx_query
  union all select query_id * 4 + 2, split_part(query, ' ', 1) || ' ' || query from fx_query
  union all select query_id * 4 + 3, array_to_string(string_split(query, ' ')[1:3], ' ') from fx_query
),
bqt as (select distinct query_id, unnest(""" + ws("query") + """) as term from bq)"""

ORACLE["unknown_terms"] = _with(INDEX, FX, BOOL) + "select query_id, term from bqt where term not in (select term from dfreq)"
ORACLE["query_terms"] = _with(INDEX, TCAT, FX, BOOL) + """select query_id, term, df, term_id,
    row_number() over (partition by query_id order by df, term_id) as ord
    from bqt join dfreq using (term) join tcat using (term)"""
BOOL_SEARCH = """, good as (
    select query_id from bq where query_id not in (select query_id from bqt where term not in (select term from dfreq))),
  nt as (select query_id, count(*) as n from bqt where query_id in (select query_id from good) group by query_id),
  m as (select b.query_id, p.doc_id from bqt b join post p using (term) join nt using (query_id)
        group by b.query_id, p.doc_id having count(*) = max(nt.n))
select bq.query_id, bq.query, coalesce(cat.doc_name, 'no results found') as doc_name,
       row_number() over (partition by bq.query_id order by cat.doc_name) as pos
from bq left join m using (query_id) left join cat on cat.cid = m.doc_id"""
ORACLE["boolean_search"] = _with(INDEX, FX, BOOL) + BOOL_SEARCH

GAPS = """gaps as (
  select term, doc_id, doc_id // 65536 as chunk, doc_id - coalesce(lag(doc_id) over (partition by term order by doc_id), 0) as gap
  from post
),
vbx as (
  select *, case when gap < 128 then 1 when gap < 16384 then 2 when gap < 2097152 then 3
                 when gap < 268435456 then 4 when gap < 34359738368 then 5 else 6 end as k
  from gaps
),
gmx as (select *, repeat('1', length(bin(gap)) - 1) || '0' || substr(bin(gap), 2) as code from gaps)"""

VB_HEX = """array_to_string(list_transform(range(k - 1, -1, -1),
    lambda i: printf('%02x', ((gap >> (7 * i)) & 127) + case when i = 0 then 128 else 0 end)), '')"""

ORACLE["gap_encode"] = _with(INDEX, GAPS) + "select term, doc_id, gap from gaps"
ORACLE["gap_roundtrip"] = _with(INDEX) + "select term, doc_id from post"
ORACLE["gamma_roundtrip"] = _with(INDEX) + "select term, doc_id from post"
ORACLE["vb_postings"] = _with(INDEX, GAPS) + f"""select term, chunk, count(*) as n, string_agg({VB_HEX}, '' order by doc_id) as vb
    from vbx group by term, chunk"""
ORACLE["gamma_postings"] = _with(INDEX, GAPS) + """, c as (
    select term, chunk, count(*) as n, sum(length(code)) as b from gmx group by term, chunk),
  o as (select *, sum(b) over (partition by term order by chunk) as till from c),
  l as (select term, string_agg(code, '' order by doc_id) as bits from gmx group by term),
  p as (select term, bits || repeat('1', cast((8 - length(bits) % 8) % 8 as integer)) as bits from l),
  y as (select term, bits, unnest(range(0, length(bits) // 8)) as at from p),
  h as (select y.term, o.chunk, o.n, y.at, printf('%02x', list_reduce(list_transform(range(1, 9), lambda i: cast(substr(y.bits, 8 * y.at + i, 1) as integer)), lambda a, x: 2 * a + x)) as hex
        from y join o on o.term = y.term and 8 * y.at >= o.till - o.b and 8 * y.at < o.till)
select o.term, o.chunk, o.n, coalesce(string_agg(h.hex, '' order by h.at), '') as gamma
from o left join h on h.term = o.term and h.chunk = o.chunk group by o.term, o.chunk, o.n"""
SIZE = """sizes as (
  select term, count(*) as df, cast(sum(length(cast(doc_id as varchar))) + count(*) as bigint) as text_bytes, 4 * count(*) as int32_bytes,
         cast(sum(k) as bigint) as vb_bytes, cast(ceil(sum(2 * length(bin(gap)) - 1) / 8) as bigint) as gamma_bytes
  from vbx group by term
)"""
ORACLE["index_size"] = _with(INDEX, GAPS, SIZE) + "select * from sizes"
ORACLE["index_size_total"] = _with(INDEX, GAPS, SIZE) + """select cast(sum(df) as bigint) as postings, cast(sum(text_bytes) as bigint) as text_bytes,
    cast(sum(int32_bytes) as bigint) as int32_bytes, cast(sum(vb_bytes) as bigint) as vb_bytes, cast(sum(gamma_bytes) as bigint) as gamma_bytes from sizes"""


def _subl(x: str) -> str:
    return f"(case when {x} = 0 then 0e0 else 1 + log10({x}) end)"


def _feat(add: int, extra: str = "", tr: str = "") -> str:
    cols = ",\n    ".join(
        f"sum(case when t.field = '{f}' then q.q_tf * log10(98999 // q.df) * {_subl('t.tf')} else 0 end) / (max(p.body_len) + {add}) as f_{f}"
        for f in ("url", "title", "header", "body", "anchor"))
    return f"""select t.query_id, t.doc_id{tr},
    {cols}{extra}
  from fx_tf t join fx_qterm q using (query_id, term) join fx_pair p using (query_id, doc_id)
  group by t.query_id, t.doc_id"""


F10 = """fx_avg_s as (
  select (c.query_id % 4 <> 0) as tr, l.field, sum(l.len) // count(*) as av
  from fx_cand c join fx_len l using (doc_id) group by 1, 2
),
fx_term_s as (
  select t.query_id, t.doc_id, t.term, sum(p.ww * t.tf / (1 + cast(p.bb as double) * (l.len // a.av - 1))) as w
  from fx_tf t join prm p using (field) join fx_len l using (doc_id, field)
  join fx_avg_s a on a.field = t.field and a.tr = (t.query_id % 4 <> 0)
  group by t.query_id, t.doc_id, t.term
),
fx_bm_s as (
  select s.query_id, s.doc_id, sum(log10(98999 // q.df) * s.w / (7 + s.w)) as bm25f_text
  from fx_term_s s join fx_qterm q using (query_id, term) group by s.query_id, s.doc_id
),
fx_f4 as (""" + _feat(4000) + """),
fx_url as (select doc_id, txt as url from fx_inst where field = 'url'),
fx_f10 as (
  select f.*, b.bm25f_text, cast(f.doc_id % 10 as double) as pagerank,
         cast(coalesce(least(p.body_len, w.min_window), p.body_len) as double) as win_size,
         case when strpos(u.url, '.pdf') > 0 then 1e0 else 0e0 end as pdf,
         case when strpos(u.url, '.php') > 0 then 1e0 else 0e0 end as php
  from fx_f4 f join fx_bm_s b using (query_id, doc_id) join fx_pair p using (query_id, doc_id)
  join fx_url u using (doc_id) left join fx_win w using (query_id, doc_id)
)"""

F10_COLS = ["f_url", "f_title", "f_header", "f_body", "f_anchor", "bm25f_text", "pagerank", "win_size", "pdf", "php"]
F5_COLS = F10_COLS[:5]


def _scaled(src: str, cols: list, train_pred: str) -> str:
    stats = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in cols)
    out = ", ".join(f"({c} - m_{c}) / case when s_{c} > 0 then s_{c} else 1 end as {c}" for c in cols)
    return f"""sc as (select {stats} from {src} where {train_pred}),
scaled as (select query_id, doc_id, {out} from {src} cross join sc)"""


ORACLE["features5"] = _with(FX, "f5 as (" + _feat(5000) + ")") + "select query_id, doc_id, " + ", ".join(
    f"round({c}, 9) as {c}" for c in F5_COLS) + " from f5"
ORACLE["features10"] = _with(FX, F10) + "select query_id, doc_id, " + ", ".join(
    f"round({c}, 9) as {c}" for c in F10_COLS) + " from fx_f10"
ORACLE["scaled_features"] = _with(FX, F10, _scaled("fx_f10", F10_COLS, "query_id % 4 <> 0")) + "select query_id, doc_id, " + ", ".join(
    f"round({c}, 9) as {c}" for c in F10_COLS) + " from scaled"
ORACLE["pair_count"] = _with(FX) + """select a.query_id, cast(sum(case when a.rel <> b.rel then 1 else 0 end) as bigint) as n_pairs
    from fx_judged a join fx_judged b using (query_id) group by a.query_id"""

_HW = (1.0, -2.0, 0.5, 3.0, -1.0)
_MARGIN = " + ".join(f"{w} * (a.{c} - b.{c})" for w, c in zip(_HW, F5_COLS))

def _hinge(fx: str) -> str:
    return _with(fx, "f5 as (select * from (" + _feat(5000) + ") where query_id % 4 <> 0 and (query_id, doc_id) in (select query_id, doc_id from fx_judged))", _scaled("f5", F5_COLS, "true"),
                             """tr as (select s.*, c.rel from scaled s join fx_judged c using (query_id, doc_id)),
pr as (select a.*, b.f_url as b_url, 1 - (""" + _MARGIN + """) as h, """ + ", ".join(
    f"a.{c} - b.{c} as d_{c}" for c in F5_COLS) + """ from tr a join tr b on a.query_id = b.query_id and a.rel > b.rel),
v as (select 'loss' as name, sum(h) as value from pr where h > 0
      """ + "\n      ".join(f"union all select 'grad_{c}', -sum(d_{c}) from pr where h > 0" for c in F5_COLS) + """)""") + \
    "select name, round(value, 6) + 0.0 as value from v"


ORACLE["pair_hinge"] = _hinge(FX)

QU = """fx_q as (select query_id, query from fx_query),
fx_u as (select doc_id, txt as url from fx_inst where field = 'url')"""
ORACLE["signal_file_scores"] = _with(FX, QU) + """select q.query, u.url, round(s.cosine, 9) as cosine, round(s.bm25f, 9) as bm25f,
    round(w.score, 9) as window_
    from fx_score s join fx_sw w using (query_id, doc_id) join fx_q q using (query_id) join fx_u u using (doc_id)"""
ORACLE["label_file"] = _with(FX, QU) + "select q.query, u.url, c.rel from fx_judged c join fx_q q using (query_id) join fx_u u using (doc_id)"
ORACLE["ranked_file"] = _with(FX, _ndcg_sql("fx_score", "bm25f"), QU) + "select q.query, round(nd.ndcg, 9) as ndcg from nd join fx_q q using (query_id)"

ORACLE["search_stream"] = "select query, doc_name from (" + ORACLE["boolean_search"] + ")"
ORACLE["vocab_file_df"] = ORACLE["vocab_df"]
ORACLE["query_file_search"] = "select query, doc_name from (" + _with(INDEX, FX_SHORT, BOOL) + BOOL_SEARCH + ")"

LABELLED = "f5 as (" + _feat(5000) + "),\nltr as (select f.*, c.rel from f5 f join fx_judged c using (query_id, doc_id))"
ORACLE["feature_labels"] = _with(FX_SHORT, LABELLED) + "select query_id, doc_id, " + ", ".join(
    f"round({c}, 9) as {c}" for c in F5_COLS) + ", rel from ltr where query_id % 4 <> 0"


def _normal_equations(name: str, alpha: float) -> str:
    """CTE ``name`` (w0 .. w4, intercept): centred normal equations over the training rows, eliminated column by column;
    a column that depends on the ones before it gets weight 0."""
    d = len(F5_COLS)
    mean = "select avg(rel) as my, " + ", ".join(f"avg({c}) as m{i}" for i, c in enumerate(F5_COLS)) + " from ltr where query_id % 4 <> 0"
    x = [f"({c} - m{i})" for i, c in enumerate(F5_COLS)] + ["(rel - my)"]
    first = [f"sum({x[i]} * {x[j]}) + {alpha if i == j else 0.0} as a{i}_{j}" for i in range(d) for j in range(i, d + 1)]
    parts = [f"{name}_m as ({mean})", f"{name}_0 as (select {', '.join(first)} from ltr cross join {name}_m where query_id % 4 <> 0)"]
    cells = [(i, j) for i in range(d) for j in range(i, d + 1)]
    parts[1] = parts[1].replace("(select ", "(select *, " + ", ".join(f"a{i}_{i} as o{i}" for i in range(d)) + " from (select ", 1) + ")"
    for k in range(d):
        step = f"case when a{k}_{k} > 1e-9 * o{k} then a{k}_{{i}} / a{k}_{k} * a{k}_{{j}} else 0 end"
        cols = [f"a{i}_{j}" + (f" - {step.format(i=i, j=j)} as a{i}_{j}" if i > k else "") for i, j in cells]
        parts.append(f"{name}_{k + 1} as (select {', '.join(cols + [f'o{i}' for i in range(d)])} from {name}_{k})")
    last = f"{name}_{d}"
    for k in reversed(range(d)):
        rest = "".join(f" - a{k}_{j} * w{j}" for j in range(k + 1, d))
        parts.append(f"{name}_w{k} as (select *, case when a{k}_{k} > 1e-9 * o{k} then (a{k}_{d}{rest}) / a{k}_{k} else 0 end as w{k} from {last})")
        last = f"{name}_w{k}"
    weights = ", ".join(f"w{k}" for k in range(d))
    parts.append(f"{name} as (select {weights}, my - ({' + '.join(f'w{k} * m{k}' for k in range(d))}) as intercept from {last} cross join {name}_m)")
    return ",\n".join(parts)


def _predicted(name: str) -> str:
    score = " + ".join(f"w{k} * {c}" for k, c in enumerate(F5_COLS))
    return f"{name}_p as (select query_id, doc_id, intercept + {score} as score from ltr cross join {name} where query_id % 4 = 0)"


POINTWISE = {"ols": 0.0, "ridge": 4.5}
for _name, _alpha in POINTWISE.items():
    ORACLE[f"rank_{_name}"] = _with(FX_SHORT, LABELLED, _normal_equations(_name, _alpha), _predicted(_name)) + _ranked("score") + f" from {_name}_p"
ORACLE["pointwise_ndcg"] = "\nunion all\n".join(
    "(select * from (" + _with(FX_SHORT, LABELLED, _normal_equations(n, a), _predicted(n), _ndcg_sql(f"{n}_p", "score"))
    + f"select '{n}' as learner, round(avg(ndcg), 9) as mean_ndcg, count(*) as n_queries from nd))" for n, a in POINTWISE.items())
_SEVEN = "cast(printf('%.7g', value) as double) + 0.0"
ORACLE["pointwise_weights"] = _with(FX_SHORT, LABELLED, *(_normal_equations(n, a) for n, a in POINTWISE.items())) + "\nunion all\n".join(
    f"select '{n}' as learner, '{c}' as feature, {_SEVEN.replace('value', w)} as weight from {n}"
    for n in POINTWISE for c, w in [*((c, f"w{k}") for k, c in enumerate(F5_COLS)), ("intercept", "intercept")])
ORACLE["pair_gap"] = _hinge(FX_SHORT).rsplit("v as (", 1)[0] + """v as (
    select count(*) as n, sum(h) as loss, """ + ", ".join(f"sum(d_{c}) as g_{c}" for c in F5_COLS) + f""" from pr where h > 0),
g as (select 6.0 * n as alpha, 0.5 * {sum(x * x for x in _HW)} + 6.0 * loss as primal, 36.0 * ({' + '.join(f'g_{c} * g_{c}' for c in F5_COLS)}) as square, n from v),
t as (select 'violating' as name, n::double as value from g union all select 'primal', primal from g
      union all select 'dual', alpha - 0.5 * square from g union all select 'gap', primal - (alpha - 0.5 * square) from g)
select name, cast(printf('%.9g', value) as double) as value from t"""
ORACLE["svm_certificate"] = _with(FX_SHORT) + """, p as (
    select cast(sum(case when a.rel <> b.rel then 1 else 0 end) as bigint) as n_pairs from fx_judged a join fx_judged b using (query_id) where a.query_id % 4 <> 0)
select learner, true as certified, n_pairs from p cross join (values ('svm'), ('svm10')) t(learner)"""
ORACLE["vector_ops"] = _with(FX_SHORT) + f""", v as (
    select t.query_id, t.doc_id, t.term, max(q.q_tf) as q_tf, sum(case when field = 'title' then tf else 0 end)::bigint as a, sum(case when field = 'body' then tf else 0 end)::bigint as b, max(p.body_len) as len
    from fx_tf t join fx_qterm q using (query_id, term) join fx_pair p using (query_id, doc_id) group by t.query_id, t.doc_id, t.term)
select query_id, doc_id, round(sum({_subl('q_tf')} * {_subl('b')}), 9) as dot, string_agg(cast(b - a as varchar), ',' order by term) as difference,
       string_agg(printf('%.9f', b::double / (len + 5000)), ',' order by term) as scaled
from v group by query_id, doc_id"""

ORACLE["merged_terms"] = _with(INDEX, TCAT) + "select term_id, term, df from tcat join dfreq using (term)"
ORACLE["file_corpus_postings"] = _with(INDEX) + "select term, p.doc_id, doc_name from post p join cat on cat.cid = p.doc_id"
