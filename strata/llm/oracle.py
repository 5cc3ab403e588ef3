"""DuckDB SQL for the operators' queries that SQL can express, on the whole tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
          + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, list_slice(w, i, i + least(len(w), 10) - 1) AS win, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
cuts AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT c.doc_id, c.i, c.n, x.item FROM cuts c JOIN windows x USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
  (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_KEY = _LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, i, line, {_KEY} AS key FROM (
    SELECT doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
frequent AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key
  HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f USING (key) GROUP BY doc_id
"""

_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: The base columns of the licence scan (not what its templates add).
LICENSE_BASE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {', '.join(map(str, _PHRASES))}) t(p, label)),
places AS (
  SELECT doc_id, label, i - 1 AS word FROM (
    SELECT doc_id, w, p, label, unnest(range(1, len(w) - len(p) + 2)) AS i
    FROM d, phrases WHERE len(w) >= len(p) AND list_has_all(w, p))
  WHERE list_slice(w, i, i + len(p) - 1) = p)
SELECT doc_id, any_value(len(w))::BIGINT AS n_words, count(label)::BIGINT AS n_base,
  min(word) AS first_word, max(word) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM d LEFT JOIN places USING (doc_id) GROUP BY doc_id
"""

#: crc32 of a string, over its UTF-8 bytes: the table of 256 entries, then one step a byte.
_CRC_TABLE = """crc AS (SELECT list(c ORDER BY b) AS crc_table FROM (
  SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1
    THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, b) AS c FROM range(256) t(b)))"""


def _crc32(value: str) -> str:
    """Unsigned crc32 of a string; the query joins the one row of ``crc``."""
    byte = f"('0x' || substr(hex(encode({value})), 2 * i + 1, 2))::BIGINT"
    return (f"xor(4294967295::BIGINT, list_reduce(list_transform(range(octet_length(encode({value}"
            f"))), lambda i: {byte}), lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8), "
            "4294967295::BIGINT))")


def _field(value: str) -> str:
    return (f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || "
            f"({value})::VARCHAR, '-')")


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(
        _field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: All nodes of all sources and of the tree above them, grown upwards in one recursion; then every
#: leaf climbs through its runs, with its own digest and with the one that it claims.
MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_leaf(_LOWER.format('text'))} END AS claim
  FROM documents, crc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM docs),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM ranked
  UNION ALL
  SELECT tree, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16, n),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
  FROM tops WHERE n > 1 GROUP BY level, pos // 16, n),
steps AS (
  SELECT tree, level, pos, n, false AS top, digest FROM nodes
  UNION ALL SELECT '', level, pos, n, true, digest FROM tops),
runs AS (
  SELECT tree, top, level, pos // 16 AS run, list(struct_pack(pos, digest) ORDER BY pos) AS members
  FROM steps WHERE n > 1 GROUP BY ALL),
sides AS (
  SELECT s.tree, s.top, s.level, s.pos,
    coalesce(list_aggregate(list_transform(list_filter(members, lambda m: m.pos < s.pos),
      lambda m: m.digest), 'string_agg', ''), '') AS l,
    coalesce(list_aggregate(list_transform(list_filter(members, lambda m: m.pos > s.pos),
      lambda m: m.digest), 'string_agg', ''), '') AS r
  FROM steps s JOIN runs u ON u.tree = s.tree AND u.top = s.top AND u.level = s.level
    AND u.run = s.pos // 16),
climb AS (
  SELECT r.pos AS id, r.tree AS home, r.tree, false AS top, 0 AS level, r.pos,
    coalesce(claim, leaf) AS digest, '' AS proof FROM ranked r
  UNION ALL
  SELECT c.id, c.home, CASE WHEN s.pos IS NULL THEN '' ELSE c.tree END,
    c.top OR s.pos IS NULL, CASE WHEN s.pos IS NULL THEN 0 ELSE c.level + 1 END,
    CASE WHEN s.pos IS NULL THEN b.pos ELSE c.pos // 16 END,
    CASE WHEN s.pos IS NULL THEN c.digest ELSE sha256(s.l || c.digest || s.r) END,
    c.proof || coalesce(s.l || s.r, '')
  FROM climb c LEFT JOIN sides s ON s.tree = c.tree AND s.top = c.top AND s.level = c.level
    AND s.pos = c.pos JOIN subroots b ON b.tree = c.home WHERE NOT (c.top AND s.pos IS NULL)),
ends AS (SELECT home, id, digest, proof FROM climb c WHERE top
  QUALIFY row_number() OVER (PARTITION BY home, id ORDER BY level DESC) = 1)
SELECT r.doc_id, r.leaf, b.digest AS subroot, t.digest AS root, sha256(e.proof) AS proof_sha256,
  e.digest AS folded_root, e.digest = t.digest AS verified
FROM ranked r JOIN ends e ON e.home = r.tree AND e.id = r.pos JOIN subroots b ON b.tree = r.tree,
  (SELECT digest FROM tops WHERE n = 1) t
"""

#: Near words by what is left of them when one place is taken out, not by automata.
SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, {_LOWER.format('run')} AS run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents) GROUP BY ALL HAVING length(run) >= 7),
hashed AS (SELECT run, k, {_crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc),
faulty AS (SELECT k, CASE WHEN h % 31 <> 0 THEN run
  ELSE left(run, h % length(run)) || substr(run, h % length(run) + 2) END AS word FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM faulty WHERE length(word) >= 7
  GROUP BY word HAVING sum(k) >= 2),
holes AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word AS u, b.word AS v FROM holes a JOIN holes b USING (i, rest)
    WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, b.word FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM holes a JOIN words b ON a.rest = b.word),
best AS (
  SELECT u, count(*) AS n_near, max(n) AS best_n, arg_min(v, struct_pack(m := -n, w := encode(v))) AS best
  FROM near JOIN words ON word = v GROUP BY u),
judged AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best ON u = word),
way AS (
  SELECT word, word AS root, 0 AS step FROM judged
  UNION ALL SELECT w.word, j.form, step + 1 FROM way w JOIN judged j ON j.word = w.root
    WHERE j.form IS NOT NULL)
SELECT j.word, form, arg_max(w.root, w.step) AS root, n, n_near, form_n
FROM judged j JOIN way w USING (word) GROUP BY ALL
"""

QUERIES: dict[str, str] = {
    "op2_winnowing_decontamination": DECONTAMINATION,
    "op6_cuckoo_line_dedup": LINE_DEDUP,
    "op12_merkle_manifest": MERKLE,
    "op13_spelling_variants": SPELLING,
}
