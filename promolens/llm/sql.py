"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from promolens.llm.decontaminate import COMMON, UNITS

BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP3 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, hex, (SELECT string_agg(translate(
        lpad(to_base(('0x' || substr(hex, i, 10))::BIGINT, 32), 8, '0'), '%s', '%s'), '' ORDER BY i)
      FROM (VALUES (1), (11), (21), (31)) v(i)) AS payload_digest FROM p),
f AS (SELECT hex, min(page_id) AS first FROM d GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d JOIN f USING (hex)
""" % BASE32

#: All strings of 50 bytes as hexadecimal digits.
OP4 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS g FROM (SELECT doc_id, x, unnest(range(0, n - 49)) AS i FROM b WHERE n >= 50)),
m AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g),
gone AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w JOIN m USING (g) WHERE first < doc_id),
marked AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY i) AS span FROM gone),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM marked GROUP BY doc_id, span),
left_over AS (
  SELECT doc_id, coalesce(lag(s.b) OVER (PARTITION BY doc_id ORDER BY s.a), 0) AS a, s.a AS b FROM spans s
  UNION ALL SELECT b.doc_id, coalesce(max(s.b), 0), any_value(b.n) FROM b LEFT JOIN spans s USING (doc_id) GROUP BY b.doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * l.a + 1, 2 * (l.b - l.a)), '' ORDER BY l.a) AS x
  FROM left_over l JOIN b USING (doc_id) GROUP BY doc_id),
counts AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(kept.x)) AS kept_sha256
FROM b JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

OP5 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) t(i)),
marked AS (
  SELECT *, CASE WHEN role IN ('user', 'assistant', 'system', 'tool') THEN length(role)
    ELSE 1 + length(regexp_replace(role, '([\\#<:=])', '\\\1', 'g')) END AS title,
    length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) AS body FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(4 + title + 2 + body + 9)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

#: Breadth-first search from every vector over the links.
OP9 = """
WITH RECURSIVE ok AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, least(vec_id, m) AS component_id,
  coalesce(vec_id = least(vec_id, m), FALSE) AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""

OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, m) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""

#: Words with marks of names (p), names that open a sentence (q), numbers (n) and units (u); w reads q as plain words,
#: v as names; p holds the places of v's plain words.  Then all ways of their windows, as text instead of hashes.
OP7 = r"""
WITH src AS (
  SELECT 0 AS side, doc_id AS id, hash(text)::UBIGINT AS row, text FROM documents
  UNION ALL SELECT 1, item_id, 0, text FROM benchmark WHERE item_id IS NOT NULL),
opened AS (
  SELECT side, id, row, text, regexp_replace(regexp_replace(text, '(^\s*|[.!?:\n"“”«(]\s*)(\p{Lu}\p{Ll}+)', '\1' || chr(2) || 'q\2', 'g'),
    chr(2) || 'q(COMMON)($|[^\p{L}\p{N}])', '\1\2', 'g') AS t FROM src),
named AS (
  SELECT side, id, row, text, regexp_replace(regexp_replace(t,
    '([\p{Ll},;] )(\p{Lu}\p{Ll}+)', '\1' || chr(2) || 'p\2', 'g'),
    '([\p{Ll},;] )(\p{Lu}\p{Ll}+)', '\1' || chr(2) || 'p\2', 'g') AS t FROM opened),
marked AS (
  SELECT side, id, row, CASE WHEN regexp_matches(text, '[0-9]') THEN regexp_replace(
    lower(regexp_replace(t, '([0-9]+)', ' ' || chr(2) || 'n\1 ', 'g')),
    '(' || chr(2) || 'n[0-9]+ +)(UNITS)($|[^\p{L}\p{N}])', '\1' || chr(2) || 'u\2\3', 'g') ELSE lower(t) END AS t FROM named),
a AS (
  SELECT side, id, row, list_filter(regexp_split_to_array(t, '[^\p{L}\p{N}' || chr(2) || ']+'), lambda x: x <> '') AS a FROM marked),
wv AS (
  SELECT row_number() OVER () AS r, side, id, row, list_transform(a, lambda x: CASE WHEN x[1:2] = chr(2) || 'q' THEN x[3:] ELSE x END) AS w,
    list_transform(a, lambda x: CASE WHEN x[1:2] = chr(2) || 'q' THEN chr(2) || 'p' || x[3:] ELSE x END) AS v
  FROM a WHERE len(a) > 0),
texts AS (
  SELECT *, list_filter(list_transform(v, lambda x, i: CASE WHEN x[1] = chr(2) THEN 0 ELSE i END), lambda i: i > 0) AS p,
    len(list_filter(v, lambda x: x[1] = chr(2))) AS marks FROM wv),
lengths AS (SELECT DISTINCT len(w) AS n FROM texts WHERE side = 1 AND len(w) < 5),
spots AS (
  SELECT * EXCLUDE i, i AS place, 5 AS n FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts)
  UNION ALL
  SELECT * EXCLUDE (i, n), i AS place, n FROM (
    SELECT texts.*, unnest(range(1, len(w) - n + 2)) AS i, n FROM texts JOIN lengths ON side = 0 AND len(w) > n)),
win AS (SELECT *, w[place:place + n - 1] AS ww, v[place:place + n - 1] AS vw FROM spots),
told AS (
  SELECT *, array_to_string(list_transform(ww, lambda x: CASE WHEN x[1] = chr(2) THEN x[3:] ELSE x END), ' ') AS plain,
    array_to_string(list_transform(ww, lambda x: CASE WHEN x[1] = chr(2) THEN x[1:2] ELSE x END), ' ') AS typed_w,
    array_to_string(list_transform(vw, lambda x: CASE WHEN x[1] = chr(2) THEN x[1:2] ELSE x END), ' ') AS typed_v,
    len(list_filter(ww, lambda x: x[1] = chr(2))) AS mw, len(list_filter(vw, lambda x: x[1] = chr(2))) AS mv FROM win),
dense AS (SELECT r FROM told WHERE n = 5 AND len(v) >= 5 AND len(p) >= 3 GROUP BY r HAVING max(mv) > 2),
beside AS (
  SELECT told.*, list_filter(p, lambda x: x >= place)[1:3] AS after, list_reverse(list_filter(p, lambda x: x <= place + 4))[1:3] AS before
  FROM told SEMI JOIN dense USING (r) WHERE n = 5),
ways AS (
  SELECT side, id, row, place, plain AS h, NULL AS slots, FALSE AS wide FROM told
  UNION ALL SELECT side, id, row, place, typed_w, ww, FALSE FROM told WHERE n = 5 AND mw BETWEEN 1 AND 2
  UNION ALL SELECT side, id, row, place, typed_v, vw, TRUE FROM told WHERE n = 5 AND vw <> ww AND mv <= 2
  UNION ALL SELECT side, id, row, place, typed_v, vw, TRUE FROM told WHERE n = 4 AND marks > 0 AND mv = 1
  UNION ALL SELECT side, id, row, place, typed_v, vw, TRUE FROM told WHERE n = 5 AND len(v) < 5 AND mv > 0 AND len(v) - mv >= 3
  UNION ALL
  SELECT side, id, row, place, 'right ' || typed_v || array_to_string(list_transform(after, lambda x: ' ' || (x - place) || ' ' || v[x]), ''), vw, TRUE
  FROM beside WHERE len(after) = 3 AND after[3] > place + 4
  UNION ALL
  SELECT side, id, row, place, 'left ' || typed_v || array_to_string(list_transform(before, lambda x: ' ' || (x - place) || ' ' || v[x]), ''), vw, TRUE
  FROM beside WHERE len(before) = 3 AND before[3] < place),
total AS (SELECT id AS item_id, count(DISTINCT place) AS n_windows FROM ways WHERE side = 1 GROUP BY 1),
hits AS (
  SELECT DISTINCT d.id AS doc_id, d.row, b.id AS item_id, b.place AS spot, d.place - b.place AS shift, d.slots, b.slots AS islots, d.wide
  FROM ways d JOIN ways b ON d.side = 0 AND b.side = 1 AND d.h = b.h AND (d.slots IS NULL) = (b.slots IS NULL) AND d.wide = b.wide),
zipped AS (
  SELECT doc_id, row, item_id, shift, wide, unnest(islots) AS a, unnest(slots) AS b FROM hits WHERE slots IS NOT NULL),
pairs AS (SELECT DISTINCT * FROM zipped WHERE a[1] = chr(2)),
clash AS (
  SELECT doc_id, row, item_id, shift, FALSE AS wide FROM pairs WHERE NOT wide GROUP BY ALL
  HAVING count(*) > count(DISTINCT a) OR count(*) > count(DISTINCT b)
  UNION ALL
  SELECT doc_id, row, item_id, shift, TRUE FROM (SELECT DISTINCT * EXCLUDE wide FROM pairs) GROUP BY ALL
  HAVING count(*) > count(DISTINCT a) OR count(*) > count(DISTINCT b)),
found AS (
  SELECT h.doc_id, h.row, h.item_id, count(DISTINCT spot) AS n_matched FROM hits h LEFT JOIN clash c
    ON h.doc_id IS NOT DISTINCT FROM c.doc_id AND h.row = c.row AND h.item_id = c.item_id AND h.shift = c.shift AND h.wide = c.wide
  WHERE h.slots IS NULL OR c.item_id IS NULL GROUP BY ALL)
SELECT DISTINCT doc_id, item_id, n_windows, n_matched, n_matched / n_windows AS share
FROM found JOIN total USING (item_id) WHERE n_matched >= 0.6::DOUBLE * n_windows
""".replace("UNITS", "|".join(UNITS)).replace("COMMON", "|".join(COMMON))

#: CRC-32 bit by bit; levels by recursion; siblings looked up level by level; folds by recursion.
OP13 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text, list_reduce(list_prepend(4294967295::UBIGINT,
    flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, v: CASE WHEN xor(c, v) & 1 = 1 THEN xor(xor(c, v) >> 1, 3988292384::UBIGINT) ELSE xor(c, v) >> 1 END) AS crc
  FROM documents),
f AS (
  SELECT r, doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    n_chars::HUGEINT AS n, n_chars::HUGEINT + CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN 1 ELSE 0 END AS m,
    coalesce(strlen(text) || ':' || text, '-') AS z FROM d),
leaves AS (
  SELECT r, doc_id, coalesce('=' || lang, '-') AS g, sha256(a || coalesce(strlen(n::VARCHAR) || ':' || n, '-') || z) AS h,
    sha256(a || coalesce(strlen(m::VARCHAR) || ':' || m, '-') || z) AS changed FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, r) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
low(g, level, i, n, h) AS (
  SELECT g, 0, i, n, h FROM placed
  UNION ALL SELECT g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY g, level, i // 2, n),
subroots AS (
  SELECT g, level, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, i, n, h) AS (
  SELECT 0, i, n, h FROM subroots
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 2, n),
steps AS (
  SELECT p.r, l.level AS k, (p.i >> l.level) & 1 AS is_right, s.h AS sibling
  FROM placed p JOIN low l ON l.g = p.g AND l.i = p.i >> l.level AND l.n > 1
  LEFT JOIN low s ON s.g = p.g AND s.level = l.level AND s.i = xor(l.i, 1)
  UNION ALL
  SELECT p.r, b.level + t.level, (b.i >> t.level) & 1, s.h
  FROM placed p JOIN subroots b ON b.g = p.g JOIN high t ON t.i = b.i >> t.level AND t.n > 1
  LEFT JOIN high s ON s.level = t.level AND s.i = xor(t.i, 1)),
proofs AS (SELECT r, sha256(string_agg(sibling, '' ORDER BY k)) AS p FROM steps WHERE sibling IS NOT NULL GROUP BY r),
folds(r, k, h) AS (
  SELECT r, 0, changed FROM placed
  UNION ALL SELECT f.r, f.k + 1, sha256(CASE WHEN sibling IS NULL THEN h WHEN is_right = 1 THEN sibling || h ELSE h || sibling END)
  FROM folds f JOIN steps s ON s.r = f.r AND s.k = f.k),
ends AS (SELECT r, arg_max(h, k) AS h FROM folds GROUP BY r)
SELECT p.doc_id, p.h AS leaf, b.h AS subroot, t.h AS root, coalesce(q.p, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM placed p JOIN subroots b ON b.g = p.g JOIN high t ON t.n = 1 JOIN ends e ON e.r = p.r LEFT JOIN proofs q ON q.r = p.r
"""

SQL: dict[str, str] = {
    "op3_warc": OP3,
    "op4_suffix": OP4,
    "op5_chat": OP5,
    "op6_jaccard": OP6,
    "op7_decontaminate": OP7,
    "op9_vectors": OP9,
    "op13_merkle": OP13,
}
