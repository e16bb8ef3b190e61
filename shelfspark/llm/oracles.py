"""DuckDB SQL for the contract queries that SQL can express; written from the contract, not from the operators."""

from __future__ import annotations

OP6 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)
), r AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1
), rep AS (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_capitals
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id
), f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
           + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
           + CASE WHEN 100 * n_capitals > 40 * word_chars THEN 32 ELSE 0 END)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM f
"""


def _crc_table() -> str:
    """The 256 remainders of the reflected polynomial 0xEDB88320, from its definition."""
    out = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        out.append(str(i))
    return ", ".join(out)


OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), c AS (
  SELECT doc_id, octet_length(encode(t))::BIGINT + 1 AS size,
         xor(list_reduce(list_concat([4294967295::BIGINT],
           list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT)),
           lambda a, x: xor(a >> 8, [@TABLE@][(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS crc
  FROM d
), b AS (
  SELECT *, ('0x' || substr(md5('=' || doc_id || '|=' || size || '|=' || crc), 1, 8))::BIGINT % 4096 AS bucket FROM c
), n AS (
  SELECT *, row_number() OVER (ORDER BY bucket, doc_id, size, crc) - 1 AS i, count(*) OVER () AS n FROM b
), s AS (
  SELECT *, ceil(sqrt(n))::BIGINT AS a FROM n
), p AS (
  SELECT *, (n + a - 1) // a AS b FROM s
), walk AS (
  SELECT i, n, a, b, i AS v, 0 AS k FROM p
  UNION ALL
  SELECT i, n, a, b,
    CASE WHEN k % 6 % 2 = 0
      THEN (((v // b) + ('0x' || substr(md5('@SEED@:' || (k % 6) || ':' || (v % b)), 1, 15))::BIGINT % a) % a) * b + v % b
      ELSE (v // b) * b + ((v % b) + ('0x' || substr(md5('@SEED@:' || (k % 6) || ':' || (v // b)), 1, 15))::BIGINT % b) % b END,
    k + 1
  FROM walk WHERE k = 0 OR k % 6 <> 0 OR v >= n
), done AS (
  SELECT i, v FROM walk WHERE k > 0 AND k % 6 = 0 AND v < n
)
SELECT doc_id, size, crc::BIGINT AS text_crc32, 'rows' AS law, (v % 16)::INTEGER AS shard, (v // 16)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM p JOIN done USING (i)
"""

OP1 = r"""
WITH it AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, ws[i:least(i + 9, len(ws))] AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM it WHERE len(ws) > 0)
), dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), sizes AS (SELECT DISTINCT len(win) AS n FROM win),
spots AS (
  SELECT doc_id, n, i, ws[i:i + n - 1] AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw, sizes WHERE len(ws) >= n)
), found AS (
  SELECT s.doc_id, w.item_id, s.i, s.n FROM spots s JOIN win w ON w.win = s.win
), hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM found) GROUP BY doc_id
)
SELECT dw.doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON hit.doc_id = dw.doc_id LEFT JOIN ids ON ids.doc_id = dw.doc_id
"""

OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, ws[i:i + 3] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
        GROUP BY 1, 2) p JOIN n a ON a.doc_id = p.a JOIN n b ON b.doc_id = p.b
  WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
"""

OP12 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

ORACLE_SQL = {
    "op12_fill_in_middle": OP12,
    "op9_jaccard_join": OP9,
    "op1_decontamination": OP1,
    "op6_quality_rules": OP6,
    "op7_sharding": OP7.replace("@TABLE@", _crc_table()).replace("@SEED@", "20240917"),
}
