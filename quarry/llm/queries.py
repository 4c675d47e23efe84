"""Registered queries of this subpackage: (spark, sf_dir) -> the contract's digest rows, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from quarry.llm import chat, decontam, exact_dedup, importance, langid, mixing, packing, passages, periodic, simhash, suffix_dedup, token_store, toxicity
from quarry.llm.common import read, shared_path
from quarry.llm.tokens import default_vocabulary


def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_chat_rotation(spark, sf_dir):
    return chat.render(chat.rotate(read(spark, sf_dir, "conversations")))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"), keep="largest")


def op4_token_store(spark, sf_dir):
    path = shared_path(spark, "token-store")
    token_store.write_token_store(read(spark, sf_dir, "documents"), path, default_vocabulary())
    return token_store.with_ids_crc32(token_store.read_token_store(spark, path))


def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("spans", "kept")


def op6_packing(spark, sf_dir):
    pieces = packing.cut_pieces(read(spark, sf_dir, "documents"), default_vocabulary())
    return packing.pack(pieces.drop("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_language_id(spark, sf_dir):
    return langid.predict_languages(read(spark, sf_dir, "documents"))


def op8_simhash(spark, sf_dir):
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


def op9_passages(spark, sf_dir):
    return passages.near_duplicate_passages(read(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_importance(spark, sf_dir):
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark, sf_dir):
    return periodic.periodic_runs(periodic.with_planted_runs(read(spark, sf_dir, "documents")), digest=True)


def op13_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_chat_rotation, op3_exact_dedup, op4_token_store, op5_suffix_dedup, op6_packing, op7_language_id, op8_simhash,
    op9_passages, op10_decontamination, op11_importance, op12_periodic_runs, op13_mixing)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# crc32 of UTF-8 bytes: a table of a byte's eight steps, then a step for each byte.
_CRC_TABLE = "SELECT list(c ORDER BY b) AS tab FROM (SELECT b, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c FROM (SELECT unnest(range(0, 256)) AS b))"


def _crc(text: str) -> str:
    """crc32 of a VARCHAR column; the table ``tab`` must be in scope."""
    digits = f"hex(encode({text}))"
    each = f"list_transform(range(1, length({digits}), 2), lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)"
    return f"xor(list_reduce({each}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"


ORACLE = {
    "op2_chat_rotation": """
        WITH t AS (SELECT conv_id, coalesce(nullif(trim(coalesce(role, '')), ''), 'unknown') AS speaker, coalesce(text, '') AS text, turn FROM conversations),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS position FROM t),
        s AS (SELECT o.conv_id, v.perspective, position, o.speaker = v.perspective AS speaks,
                     CASE WHEN o.speaker = v.perspective THEN '<|assistant|>' ELSE '<|user name=' || o.speaker || '|>' END || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS segment
              FROM o JOIN (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t) v ON o.conv_id IS NOT DISTINCT FROM v.c),
        p AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM s)
        SELECT conv_id, perspective, (position // 64)::BIGINT AS chunk, count(*) AS n_turns, string_agg(segment, '' ORDER BY position) AS text, min(b) AS text_start,
               sum(speaks::INT)::BIGINT AS n_targets,
               coalesce(string_agg(CASE WHEN speaks THEN (b + 14) || '-' || (b + length(segment) - 1) END, ',' ORDER BY position), '') AS target_spans
        FROM p GROUP BY conv_id, perspective, position // 64
    """,
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        n AS (SELECT doc_id, t, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                     row_number() OVER (PARTITION BY t, doc_id) AS i FROM d WINDOW w AS (PARTITION BY t))
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND i = 1 AS kept, sha256(t) AS text_sha256 FROM n
    """,
    "op10_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
        b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_WORDS} AS ws FROM benchmark),
        w AS (SELECT DISTINCT item, ws[i : i + least(len(ws), 10) - 1] AS win FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
        k AS (SELECT DISTINCT len(win) AS n FROM w),
        o AS (SELECT r, i, n, ws[i : i + n - 1] AS win FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) JOIN k ON i + n - 1 <= len(ws)),
        h AS (SELECT o.r, o.i, o.n, w.item FROM o JOIN w ON o.win = w.win),
        c AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM (SELECT r, i, unnest(range(0, n)) AS j FROM h) GROUP BY r),
        m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
    """,
    "op11_importance": f"""
        WITH tab AS ({_CRC_TABLE}),
        d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
        dw AS (SELECT r, unnest(ws) AS word FROM d),
        bw AS (SELECT unnest(ws) AS word FROM (SELECT {_WORDS} AS ws FROM benchmark)),
        v AS (SELECT word, {_crc("word")} % 10000 AS b FROM (SELECT word FROM dw UNION SELECT word FROM bw), tab),
        s AS (SELECT b, count(*) AS n FROM dw JOIN v USING (word) GROUP BY b),
        t AS (SELECT b, count(*) AS n FROM bw JOIN v USING (word) GROUP BY b),
        g AS (SELECT i.b, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE)
                                          / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain
              FROM (SELECT unnest(range(0, 10000)) AS b) i LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
        w AS (SELECT r, sum(gain)::BIGINT AS weight FROM dw JOIN v USING (word) JOIN g USING (b) GROUP BY r),
        k AS (SELECT r, doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
                     coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
              FROM d LEFT JOIN w USING (r)),
        o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM k WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM o) THEN rank END AS rank FROM k LEFT JOIN o USING (r)
    """,
    "op12_periodic_runs": f"""
        WITH tab AS ({_CRC_TABLE}),
        x AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws, CASE WHEN doc_id IS NOT NULL THEN {_crc("doc_id::VARCHAR")} END AS h FROM documents, tab),
        y AS (SELECT *, len(ws) AS n, h // 10 AS g, h // 10 % greatest(len(ws), 1) AS a FROM x),
        z AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM y),
        d AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM z),
        t AS (SELECT r, n, unnest(range(0, n)) AS i, unnest(ws) AS word FROM d),
        e AS (SELECT u.r, u.i, v.i - u.i AS q FROM t u JOIN t v ON u.r = v.r AND u.word = v.word AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
        f AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM e),
        c AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM f GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
        s AS (SELECT r, start, length, min(q) AS period FROM c GROUP BY r, start, length),
        m AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM s GROUP BY r),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1),
        gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM s),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM t ANTI JOIN gone USING (r, i) GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
               sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM d LEFT JOIN m USING (r) LEFT JOIN b USING (r) LEFT JOIN kept USING (r)
    """,
    "op13_mixing": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS z, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
        o AS (SELECT *, sum(3 * z) OVER (ORDER BY 3 * z / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS given,
                     sum(w) OVER (ORDER BY 3 * z / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, sum(z) OVER () AS total FROM s WHERE z > 0),
        l AS (SELECT min_by(per_weight, 3 * z / w) AS per_weight FROM (SELECT *, (total - coalesce(given, 0))::DOUBLE / open::DOUBLE AS per_weight FROM o) WHERE w * per_weight <= 3 * z),
        t AS (SELECT source, z, least(w * coalesce(per_weight, 0), (3 * z)::DOUBLE) AS target FROM s, l),
        c AS (SELECT r, doc_id, d.source, size, z, target, CASE WHEN z > 0 THEN floor(target / z) ELSE 0 END::BIGINT AS whole, CASE WHEN z > 0 THEN target / z - floor(target / z) ELSE 0 END AS p,
                     (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT *, (u / (1 - u)) / (p / (1 - p)) AS odds FROM c WHERE p > 0 AND size > 0),
        a AS (SELECT r, sum(size) OVER (PARTITION BY source ORDER BY floor(odds / (1 + odds) * 4503599627370496::DOUBLE), doc_id NULLS LAST, size, r) - size AS before FROM k)
        SELECT doc_id, size, z AS source_size, target, (whole * size + coalesce(least(greatest(floor(target + 0.5)::BIGINT - whole * z - before, 0), size), 0))::BIGINT AS taken
        FROM c LEFT JOIN a USING (r)
    """,
}
