"""DuckDB SQL for the queries that SQL can express on whole tables. The others (packing, extraction,
mixing by hashed order, learned filters, randomness tests, the pipeline) are tested against brute force."""

_REACH = """
reach(id, root) AS (
  SELECT id, id FROM node
  UNION
  SELECT r.id, e.b FROM reach r JOIN edge e ON e.a = r.root
),
part AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
"""

# five hex digits of the SHA-1 are four base32 digits
_BASE32 = "translate({}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')".format(
    " || ".join(
        f"to_base(CAST('0x' || substr(digest, {5 * i + 1}, 5) AS BIGINT), 32, 4)" for i in range(8)
    )
)

OP2 = f"""
WITH page AS (
  SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
),
coded AS (
  SELECT page_id, url, octet_length(encode(payload)) AS payload_bytes, {_BASE32} AS payload_digest,
         max(page_id) OVER (PARTITION BY digest) AS holder
  FROM page
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to, url
FROM coded
"""

OP4 = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
win AS (
  SELECT doc_id, p, substr(digits, 2 * p + 1, 200) AS bytes
  FROM (SELECT doc_id, digits, unnest(range(length(digits) // 2 - 99)) AS p FROM doc)
),
hit AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, p) AS k FROM win
  ) WHERE k > 1
),
island AS (
  SELECT doc_id, p, sum(CASE WHEN p - before <= 100 THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id ORDER BY p) AS k
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hit)
),
span AS (
  SELECT doc_id, min(p) AS low, max(p) + 100 AS high FROM island GROUP BY doc_id, k
),
gap AS (
  SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS a, low AS b FROM span
  UNION ALL
  SELECT doc_id, max(high), NULL FROM span GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(
    CASE WHEN b IS NULL THEN substr(digits, 2 * a + 1) ELSE substr(digits, 2 * a + 1, 2 * (b - a)) END,
    '' ORDER BY a) AS digits
  FROM gap JOIN doc USING (doc_id) GROUP BY doc_id
),
total AS (SELECT doc_id, sum(high - low) AS n, count(*) AS k FROM span GROUP BY doc_id)
SELECT doc_id, CAST(length(doc.digits) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept.digits, doc.digits))) AS kept_sha256
FROM doc LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS z FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.z, c.z) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
),
ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP9 = f"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM word
),
shingle AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM shingled),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingle x JOIN shingle y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
),
node AS (SELECT doc_id AS id FROM documents),
edge AS (SELECT a, b FROM link),
{_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM shingled JOIN part ON doc_id = id
"""

OP10 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
unit AS (SELECT vec_id, label, z, sqrt(list_inner_product(z, z)) AS size FROM v),
edge AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM unit x JOIN unit y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE x.size > 0 AND y.size > 0 AND list_inner_product(x.z, y.z) / (x.size * y.size) >= 0.98
),
node AS (SELECT vec_id AS id FROM embeddings),
{_REACH},
degree AS (SELECT a, count(*) AS n FROM edge GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN part ON vec_id = id LEFT JOIN degree ON vec_id = a
"""

_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP12 = f"""
WITH item AS (
  SELECT item_id, w, least(len(w), 10) AS l
  FROM (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark) WHERE len(w) > 0
),
phrase AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS phrase
  FROM (SELECT item_id, l, w, unnest(range(1, len(w) - l + 2)) AS i FROM item)
),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
),
place AS (
  SELECT r, l, p, array_to_string(w[p:p + l - 1], ' ') AS phrase FROM (
    SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM doc, (SELECT DISTINCT l FROM phrase)
  )
),
hit AS (SELECT r, p, l, item_id FROM place JOIN phrase USING (l, phrase)),
word AS (
  SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + l)) AS q FROM hit) GROUP BY r
),
named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL)
  GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(word.n, 0) AS n_hit,
       coalesce(named.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""

# CRC-32 of a key, byte by byte and bit by bit
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    range(1, length(key) + 1), lambda i: ascii(key[i])::BIGINT)), lambda c, b: list_reduce(
    list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""


def _edit(value: str, cost: str, label: str) -> str:
    """Eight digits of cost and an audit, with one more edit in front."""
    total = f"CAST(CAST(left({value}, 8) AS BIGINT) + {cost} AS VARCHAR)"
    return f"lpad({total}, 8, '0') || '{label}' || substr({value}, 9)"


_KEPT = {  # by state: the initial that may be kept and the state it leads to
    0: "CASE code WHEN 's' THEN {} WHEN 'u' THEN {} END".format(_edit("v1", "extra", "K"), _edit("v2", "extra", "K")),
    1: f"CASE code WHEN 'u' THEN {_edit('v2', 'extra', 'K')} END",
    2: f"CASE code WHEN 'a' THEN {_edit('v3', 'extra', 'K')} END",
    3: f"CASE code WHEN 'u' THEN {_edit('v2', 'extra', 'K')} END",
}
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
_CONSUMED = ", ".join(
    f"least({_edit(f'v{q}', '4', 'D')}, CASE WHEN NOT gone THEN {_KEPT[q]} END, "
    f"CASE WHEN NOT gone THEN {_edit(f'v{_NEXT[q]}', '3 + extra', 'R')} END) AS b{q}"
    for q in range(4)
)
_INSERTED = ", ".join(
    f"least(b{q}, {_edit(f'b{_NEXT[q]}', '3', 'I')}, {_edit(f'b{_NEXT[_NEXT[q]]}', '6', 'II')})" for q in range(4)
)

OP13 = f"""
WITH RECURSIVE given AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
),
fault AS (SELECT *, xor({_CRC}, 4294967295) % 20 AS f FROM given),
damaged AS (
  SELECT c, turn, role AS r0, md5(text) AS t0, unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy,
         CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fault WHERE f <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r0, t0, copy) AS i FROM damaged
),
judged AS (
  SELECT *, left(role, 1) AS code, body = '' AS blank,
         body <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS repeated,
         right(body, 1) NOT IN ('.', '!', '?') AS cut,
         lead(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS following
  FROM (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM placed)
),
turn AS (
  SELECT *, blank OR repeated AS gone, cut AND NOT blank AND NOT repeated AS truncated,
         CASE WHEN cut AND NOT blank AND NOT repeated THEN 3 ELSE 0 END AS extra
  FROM judged
),
conv AS (
  SELECT c, count(*) AS n, count_if(blank) AS blank, count_if(repeated) AS duplicate,
         count_if(truncated) AS truncated,
         count_if(following IS NOT NULL AND code || following NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM turn GROUP BY c
),
go(c, i, v0, v1, v2, v3) AS (
  SELECT c, n, '00000000', '00000006II', '00000003I', '00000000' FROM conv
  UNION ALL
  SELECT c, i - 1, {_INSERTED}
  FROM (SELECT go.c, go.i, {_CONSUMED} FROM go JOIN turn ON turn.c = go.c AND turn.i = go.i)
),
best AS (
  SELECT c, CAST(left(v0, 8) AS BIGINT) AS cost, substr(v0, 9) AS audit,
         length(replace(substr(v0, 9), 'D', '')) AS size
  FROM go WHERE i = 0
),
edit AS (
  SELECT c, j, size, audit[j] AS e, j - length(replace(audit[1:j], 'I', '')) AS inserted,
         length(replace(audit[1:j], 'D', '')) AS pos
  FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS j FROM best)
),
line AS (
  SELECT edit.c, j,
         CASE WHEN e = 'K' THEN role WHEN (pos + size) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' ||
         CASE WHEN e = 'I' THEN '' ELSE text END AS line
  FROM edit LEFT JOIN turn ON turn.c = edit.c AND turn.i = j - inserted
  WHERE e <> 'D'
),
digest AS (SELECT c, sha256(string_agg(line, chr(10) ORDER BY j)) AS repaired FROM line GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM given)
LEFT JOIN conv USING (c) LEFT JOIN best USING (c) LEFT JOIN digest USING (c)
"""

ORACLES = {
    "op2_warc": OP2,
    "op4_suffix": OP4,
    "op5_topk": OP5,
    "op9_minhash": OP9,
    "op10_covertree": OP10,
    "op12_positional": OP12,
    "op13_dialogue": OP13,
}
