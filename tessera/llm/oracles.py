"""DuckDB SQL for the operators whose results SQL can state in full."""

from __future__ import annotations

#: Bytes that end a word, as a character class.
BLANK = r"\x20\x09-\x0D"


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = (f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform(range(0, 8), "
            "lambda k: ((ord(c) >> k::INTEGER) & 1)::UBIGINT)))")
    step = "lambda s, b: xor(s >> 1, 3988292384::UBIGINT * (xor(s, b) & 1::UBIGINT))"
    return f"xor(list_reduce({bits}, {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


def least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


def then(state: str, cost: str, letter: str, where: str = "true") -> str:
    return f"CASE WHEN {state} IS NOT NULL AND {where} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}} END"


#: The best (cost, audit) of each state after any insertions, from those before them.
PUT_U = least("pu", then("pn", "3", "I"), then("ps", "3", "I"), then("pa", "3", "I"))
PUT_A = least("pa", then("bu", "3", "I"))
STAY = "CASE WHEN initial = '{}' THEN 'K' ELSE 'R' END"
COST = "(CASE WHEN initial = '{}' THEN 0 ELSE 3 END + cut)"


def edit(state: str, to: str) -> str:
    return (f"CASE WHEN {state} IS NOT NULL AND NOT go THEN {{'c': {state}.c + {COST.format(to)}, "
            f"'a': {state}.a || {STAY.format(to)}}} END")


NONE = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR))"
REPAIR = f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM named, unnest(range(0, CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies(i)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn,
         regexp_extract(text, '([^{BLANK}])[{BLANK}]*$', 1) AS tail, substr(role, 1, 1) AS initial
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         CASE WHEN rn > 1 AND lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS illegal
  FROM placed),
steps AS (SELECT conv_id, rn, role, text, initial, fault IN ('blank', 'duplicate') AS go, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut FROM faulty),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS rn, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS pn, {NONE} AS ps, {NONE} AS pu, {NONE} AS pa
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, rn, {then('pn', '4', 'D')},
         {least(then('ps', '4', 'D'), then('pn', 'cut', 'K', "NOT go AND initial = 's'"))},
         {least(then('bu', '4', 'D'), edit('pn', 'u'), edit('ps', 'u'), edit('ba', 'u'))},
         {least(then('ba', '4', 'D'), edit('bu', 'a'))}
  FROM (SELECT *, {PUT_A} AS ba
        FROM (SELECT s.*, w.pn, w.ps, w.pu, w.pa, {PUT_U} AS bu
              FROM walk AS w JOIN steps AS s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.rn = w.rn + 1))),
ends AS (
  SELECT conv_id, {least('pn', 'ba')} AS best
  FROM (SELECT *, {PUT_A} AS ba FROM (SELECT *, {PUT_U} AS bu FROM walk
        WHERE rn = coalesce((SELECT max(rn) FROM steps WHERE steps.conv_id IS NOT DISTINCT FROM walk.conv_id), 0)))),
letters AS (
  SELECT conv_id, best.a AS audit, i, best.a[i::INTEGER] AS letter, length(regexp_replace(best.a[1:i::INTEGER], 'I', '', 'g')) AS rn,
         length(regexp_replace(best.a[1:i::INTEGER], 'D', '', 'g')) AS place
  FROM ends, unnest(range(1, length(best.a) + 1)) AS t(i)),
kept AS (
  SELECT l.*, s.role, s.text, bool_or(l.letter = 'K' AND s.initial = 's') OVER (PARTITION BY l.conv_id) AS system
  FROM letters AS l LEFT JOIN steps AS s ON s.conv_id IS NOT DISTINCT FROM l.conv_id AND s.rn = l.rn AND l.letter <> 'I'
  WHERE l.letter <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS text
  FROM kept GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, sum(illegal)::BIGINT AS illegal
  FROM faulty GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, e.best.c AS cost, e.best.a AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM ends AS e LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN texts AS t ON t.conv_id IS NOT DISTINCT FROM e.conv_id"""


def enc(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def leaf(text: str) -> str:
    return f"sha256({' || '.join(map(enc, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


NEXT = "list_transform(range(0, (len(nodes) + 15) // 16), lambda i: sha256(array_to_string(nodes[i * 16 + 1:i * 16 + 16], '')))"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def climbed(name: str, at: str, i: str, levels: str, key: str) -> str:
    """Recursive relation `name`: siblings and folded hash from (key, i, at) of `at` up the levels of `levels`."""
    own = f"w.i - w.i % 16"
    left, right = (f"array_to_string(l.nodes[{own} + 1:w.i], '')", f"array_to_string(l.nodes[w.i + 2:{own} + 16], '')")
    return f"""{name} AS (
  SELECT *, 0 AS level, '' AS path FROM {at}
  UNION ALL
  SELECT w.* REPLACE (w.i // 16 AS i, sha256({left} || w.hash || {right}) AS hash, w.level + 1 AS level, w.path || {left} || {right} AS path)
  FROM {name} AS w JOIN {levels} AS l ON l.level = w.level {key}
  WHERE len(l.nodes) > 1)"""


MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc32("coalesce(doc_id::VARCHAR, '')")} % 5 = 0 THEN {leaf(LOWER)} ELSE {leaf('text')} END AS hash,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {leaf('text')}) - 1 AS i
  FROM documents),
levels AS (
  SELECT source, 0 AS level, list(leaf ORDER BY i) AS nodes FROM leaves GROUP BY source
  UNION ALL
  SELECT source, level + 1, {NEXT} FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j FROM levels WHERE len(nodes) = 1),
upper AS (
  SELECT 0 AS level, list(subroot ORDER BY j) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, {NEXT} FROM upper WHERE len(nodes) > 1),
{climbed('below', 'leaves', 'i', 'levels', 'AND l.source IS NOT DISTINCT FROM w.source')},
inner_paths AS (SELECT * FROM below QUALIFY row_number() OVER (PARTITION BY source, doc_id, leaf ORDER BY level DESC) = 1),
tops AS (SELECT p.doc_id, p.leaf, s.subroot, s.j AS i, p.hash, p.path AS inner_path FROM inner_paths AS p JOIN subroots AS s ON s.source IS NOT DISTINCT FROM p.source),
{climbed('above', 'tops', 'i', 'upper', '')}
SELECT doc_id, leaf, subroot, root, sha256(inner_path || path) AS proof_sha256, hash AS folded_root, hash = root AS verified
FROM above, (SELECT nodes[1] AS root FROM upper WHERE len(nodes) = 1)
QUALIFY row_number() OVER (PARTITION BY doc_id, leaf, subroot ORDER BY level DESC) = 1"""

DIGITS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
BASE32 = ("array_to_string(list_transform(range(0, 32), lambda i: " + DIGITS +
          "[((('0x' || hex[((i // 4) * 5 + 1)::INTEGER:((i // 4) * 5 + 5)::INTEGER])::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1]), '')")
ARCHIVE = f"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
owned AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS owner FROM payloads)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest, CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM owned"""

LOWERED = LOWER.replace("text", "coalesce(text, '')", 1)
COMPONENTS = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^{BLANK}]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                 ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words),
sizes AS (SELECT d.doc_id, count(s.s) AS n FROM documents AS d LEFT JOIN shingles AS s USING (doc_id) GROUP BY d.doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles AS a JOIN shingles AS b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached AS r JOIN links AS l ON l.x = r.y)
SELECT r.x AS doc_id, any_value(n) AS n_shingles, min(r.y) AS component_id FROM reached AS r JOIN sizes ON sizes.doc_id = r.x GROUP BY r.x"""

ORACLES = {
    "op4_warc_revisits": ARCHIVE,
    "op9_parity_join": COMPONENTS,
    "op11_conversation_repair": REPAIR,
    "op13_merkle_manifest": MANIFEST,
}
