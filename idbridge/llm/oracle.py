"""DuckDB SQL for the queries that SQL can express."""

# the given pattern with both cases of every letter: a case flag would also fold letters beyond ASCII
_ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
           "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")


def _matches(kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
        SELECT doc_id, '{kind}' AS kind, place AS start_, place + length(m) AS end_, v AS value FROM (
            SELECT doc_id, m, v, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS place
            FROM (SELECT doc_id, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(vs) AS v,
                         unnest(gaps[1:len(ms)]) AS gap
                  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms,
                               regexp_extract_all(t, '{pattern}', {group}) AS vs,
                               regexp_split_to_array(t, '{pattern}') AS gaps FROM d)))
        WHERE length(v) >= {least}"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _linked(k: int) -> str:
    """Sets of k-word shingles ``s`` and the smallest document reachable over links, ``least_of``."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
     s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(
                  range(1, greatest(len(ws) - {k - 1}, 1) + 1), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) END AS sh
           FROM w),
     e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
     link AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b USING (g) WHERE a.doc_id != b.doc_id
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
     reach(u, v) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.u, link.v FROM reach r JOIN link ON link.u = r.v),
     least_of AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY 1)
"""


ORACLE_SQL = {
    "op1_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
     b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
     bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS m,
                   unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1),
                                         lambda i: array_to_string(ws[i:i + 9], ' '))) AS win
            FROM b WHERE len(ws) > 0),
     dw AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS win
            FROM d, (SELECT DISTINCT m FROM bw), unnest(range(1, len(ws) - m + 2)) AS r(i)),
     hit AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, win)),
     cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit
               FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY 1),
     names AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
               FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN names USING (doc_id)
""",
    "op2_minhash_neardup": _linked(4) + "SELECT doc_id, len(sh) AS n_shingles, component_id, doc_id = component_id AS kept "
                                        "FROM s JOIN least_of USING (doc_id)",
    "op4_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     win AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS g FROM w, unnest(range(1, len(ws) - 33)) AS r(i)),
     again AS (SELECT g FROM win GROUP BY 1 HAVING count(*) > 1),
     gone AS (SELECT DISTINCT doc_id, p FROM win JOIN again USING (g), unnest(range(i, i + 35)) AS r(p)),
     word AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS r(p)),
     kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
              FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op5_secrets": f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
     base AS ({_matches("assign", _ASSIGN, 2, 6)} UNION ALL {_matches("access", "AKIA[A-Z0-9]+", 0, 20)}
              UNION ALL {_matches("hex", "[0-9a-f]+", 0, 24)}),
     bare AS (SELECT * FROM ({_matches("owned", "[A-Za-z0-9+/_-]+", 0, 20)}) AS x
              WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
                AND NOT EXISTS (SELECT 1 FROM base b
                                WHERE b.doc_id = x.doc_id AND b.start_ < x.end_ AND x.start_ < b.end_)),
     every AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
     owner AS (SELECT value, count(DISTINCT source) AS owners
               FROM every JOIN d USING (doc_id) GROUP BY 1),
     judged AS (SELECT e.*, CASE WHEN owners >= 3 THEN 'example' ELSE 'live' END AS verdict,
                       list_position(['assign', 'access', 'hex', 'owned'], kind) AS nth,
                       concat_ws(':', kind, CAST(start_ AS BIGINT), CAST(end_ AS BIGINT)) AS span
                FROM every e JOIN owner USING (value)),
     said AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                     count(*) FILTER (kind = 'hex') AS n_hex,
                     string_agg(span, ',' ORDER BY start_, nth) FILTER (kind != 'owned') AS base,
                     string_agg(span, ',' ORDER BY start_, nth) AS spans,
                     count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
              FROM judged WHERE kind != 'owned' OR verdict = 'live' GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN said USING (doc_id)
""",
    "op10_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
     g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
""",
    "op11_jaccard_join": _linked(5) + "SELECT doc_id, len(sh) AS n_shingles, component_id FROM s JOIN least_of USING (doc_id)",
}
