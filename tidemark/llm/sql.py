"""SQL over the test tables, for the queries whose whole result SQL can express."""

from __future__ import annotations

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def similar(k: int, percent: int, more: str = "") -> str:
    """Components of documents by the Jaccard similarity of their k-word shingles."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(ws) - {k - 2}, 2)), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) END AS sh
  FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id{more}
FROM s JOIN c USING (doc_id)"""


DECONTAMINATION = rf"""
WITH p AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(coalesce({LOWER}, ''), (SELECT word FROM p)) AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(ws)) AS k, unnest(list_transform(
    range(1, len(ws) - least(10, len(ws)) + 2),
    lambda q: array_to_string(ws[q:q + least(10, len(ws)) - 1], ' '))) AS g
  FROM i WHERE len(ws) > 0),
d AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), (SELECT word FROM p)) AS ws
  FROM documents),
places AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS q
  FROM d, (SELECT DISTINCT k FROM windows)),
found AS (
  SELECT doc_id, q, windows.k, item FROM places JOIN windows
  ON places.k = windows.k AND array_to_string(ws[q:q + places.k - 1], ' ') = g),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(q, q + k)) AS place FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT page_id, payload, array_to_string(list_transform(
    range(1, 41), lambda i: right('000' || bin(CAST('0x' || hex[i] AS INTEGER)), 4)), '') AS b
  FROM p),
digests AS (
  SELECT page_id, payload, array_to_string(list_transform(range(0, 32),
    lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_reduce(list_transform(range(1, 6),
      lambda k: CAST(b[5 * i + k] AS INTEGER)), lambda x, y: 2 * x + y)]), '') AS digest
  FROM bits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM digests)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts"""


def crc32(text: str) -> str:
    """The unsigned checksum of a text of ASCII and of letters up to U+00FF, byte by byte."""
    byte = f"""CASE WHEN ord({text}[i]) < 128 THEN [CAST(ord({text}[i]) AS BIGINT)]
      ELSE [195, -1, -1, -1, -1, -1, -1, -1, -1, CAST(ord({text}[i]) AS BIGINT) - 64] END"""
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    range(1, len({text}) + 1), lambda i: {byte} || [-1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
      ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""


def leaf(text: str) -> str:
    values = [*(f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")), text]
    return f"sha256({' || '.join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)})"


MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0
      THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS seen,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM documents),
nodes AS (
  SELECT source, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n),
tops AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n FROM nodes WHERE n = 1),
above AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM above WHERE n > 1 GROUP BY level, pos // 3, n),
tree AS (
  SELECT source, level, pos, n, digest, pos // 3 AS up FROM nodes),
sides AS (
  SELECT a.source, a.level, a.pos,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM tree a JOIN tree b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.up = b.up
  WHERE a.n > 1 GROUP BY ALL),
top_sides AS (
  SELECT a.level, a.pos,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM above a JOIN above b ON a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY ALL),
paths AS (
  SELECT doc_id, leaves.source, 0 AS part, level, l, r FROM leaves JOIN sides
    ON leaves.source IS NOT DISTINCT FROM sides.source
    AND sides.pos = leaves.pos // CAST(pow(3, level) AS BIGINT)
  UNION ALL
  SELECT doc_id, leaves.source, 1, level, l, r FROM leaves JOIN tops
    ON leaves.source IS NOT DISTINCT FROM tops.source
    JOIN top_sides ON top_sides.pos = tops.pos // CAST(pow(3, level) AS BIGINT)),
whole AS (
  SELECT doc_id, list({{'l': l, 'r': r}} ORDER BY part, level) AS path FROM paths GROUP BY doc_id),
proofs AS (
  SELECT doc_id, leaf, subroot, seen, coalesce(path, []) AS path
  FROM leaves JOIN tops ON leaves.source IS NOT DISTINCT FROM tops.source LEFT JOIN whole USING (doc_id)),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM above WHERE n = 1) AS root,
    sha256(array_to_string(list_transform(path, lambda p: p.l || p.r), '')) AS proof_sha256,
    list_reduce(list_prepend(seen, list_transform(path, lambda p: p.l || ' ' || p.r)),
      lambda d, p: sha256(replace(p, ' ', d))) AS folded_root FROM proofs)
SELECT *, folded_root = root AS verified FROM folded"""

SPELLING = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce({LOWER}, ''), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (
  SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
keyed AS (SELECT run, k, doc_id || ':' || run AS name FROM counted),
summed AS (SELECT run, k, {crc32("name")} AS h FROM keyed),
planted AS (
  SELECT k, CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:]
    ELSE run END AS word FROM summed),
v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM planted WHERE length(word) >= 5
  GROUP BY word HAVING sum(k) >= 3),
cut AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT DISTINCT a.word AS x, b.word AS y FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT a.word, b.word FROM cut a JOIN cut b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
ranked AS (
  SELECT x AS word, y, v.n, count(*) OVER (PARTITION BY x) AS n_near,
    row_number() OVER (PARTITION BY x ORDER BY v.n DESC, y) AS place
  FROM pairs JOIN v ON pairs.y = v.word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN r.n >= 2 * v.n THEN r.y END AS form, CASE WHEN r.n >= 2 * v.n THEN r.n END AS form_n
  FROM v LEFT JOIN ranked r ON r.word = v.word AND r.place = 1),
walk AS (
  SELECT word, word AS at_word, form FROM forms
  UNION ALL SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON walk.form = forms.word)
SELECT word, forms.form, at_word AS root, n, n_near, form_n
FROM forms JOIN (SELECT word, at_word FROM walk WHERE form IS NULL) USING (word)"""


def all_sql() -> dict[str, str]:
    return {
        "op6_near_duplicates": similar(4, 80, ", doc_id = component_id AS kept"),
        "op7_decontamination": DECONTAMINATION,
        "op9_archives": ARCHIVES,
        "op11_similar_documents": similar(3, 90),
        "op12_spelling": SPELLING,
        "op13_manifest": MANIFEST,
    }
