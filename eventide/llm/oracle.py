"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from . import chat, licenses

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _escaped(column: str) -> str:
    sql = rf"replace({column}, '\', '\\')"
    for c in chat.CONTROL:
        sql = f"replace({sql}, {_text(c)}, {_text(c[0] + chr(92) + c[1:])})"
    return sql


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, id, CASE id WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(id)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_text(chat.START)} || {_escaped('role')} || chr(10) || {_escaped('text')} || {_text(chat.END)} || chr(10))) AS BIGINT)
    AS formatted_chars
FROM turns GROUP BY conv_id
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_WORDS = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item_id, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS n
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) u(s) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM d, lengths, unnest(range(1, len(w) - n + 2)) u(s)
),
found AS (SELECT doc_id, s, p.n, item_id FROM places p JOIN windows USING (win)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM found, unnest(range(s, s + n)) u(place) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Blocks are counted by intervals: an occurrence of a template's word lies in the blocks that start after the
# word's last occurrence before it, so its first block adds one to a running count and the next after it takes one.
_TEMPLATES = list(enumerate(licenses.TEMPLATES))
LICENSES = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos, len(w) AS n FROM d),
phrases(label, first, k, phrase) AS (VALUES {", ".join(
    f"({_text(t.label)}, {_text(t.words[0])}, {len(t.words)}, {_text(' '.join(t.words))})"
    for _, t in _TEMPLATES if t.ordered)}),
places AS (
  SELECT doc_id, label, pos FROM p JOIN phrases ON word = first JOIN d USING (doc_id)
  WHERE array_to_string(w[pos + 1:pos + k], ' ') = phrase
),
notices(number, label, span, need, size) AS (VALUES {", ".join(
    f"({i}, {_text(t.label)}, {t.span(1.0)}, {t.need}, {len(set(t.words))})" for i, t in _TEMPLATES if not t.ordered)}),
tokens(number, word) AS (VALUES {", ".join(
    f"({i}, {_text(w)})" for i, t in _TEMPLATES if not t.ordered for w in sorted(set(t.words)))}),
occurrences AS (
  SELECT doc_id, number, label, span, need, size, pos, n,
    lag(pos) OVER (PARTITION BY doc_id, number, word ORDER BY pos) AS prev
  FROM p JOIN tokens USING (word) JOIN notices USING (number)
),
steps AS (
  SELECT doc_id, number, label, span, need, size, n, greatest(pos - span + 1, coalesce(prev + 1, 0), 0) AS s, 1 AS d FROM occurrences
  UNION ALL SELECT doc_id, number, label, span, need, size, n, pos + 1, -1 FROM occurrences
),
counted AS (
  SELECT doc_id, label, need, size, s <= greatest(n - span, 0) AS inside,
    sum(sum(d)) OVER (PARTITION BY doc_id, number ORDER BY s) AS shared
  FROM steps GROUP BY doc_id, number, label, span, need, size, n, s
),
met AS (
  SELECT doc_id, label, CAST(shared AS DOUBLE) / size AS c FROM counted WHERE inside AND shared >= need
  UNION ALL SELECT doc_id, label, 1.0 FROM places
),
base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY doc_id
),
labelled AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(c) AS score FROM met GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN labelled USING (doc_id)
"""

# CRC-32 byte by byte, its table from the polynomial; near words by their texts with one code point taken out:
# equal lengths share such a text at one place, lengths one apart are such a text of each other.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
VARIANTS = f"""
WITH table_of AS MATERIALIZED (
  SELECT list(list_reduce([b] || range(8), lambda c, k: {_CRC_STEP}) ORDER BY b) AS crc FROM range(256) r(b)
),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS k, encode(doc_id || ':' || run) AS bytes
  FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
  GROUP BY doc_id, run
),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(octet_length(bytes)), lambda i: CAST(('0x' || substr(hex(bytes), 2 * i + 1, 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, table_of
),
slips AS (
  SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slips WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
),
less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) u(i)
),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (rest, i)
  WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION ALL SELECT DISTINCT w.word, w.n, l.word, l.n FROM words w JOIN less l ON l.rest = w.word
  UNION ALL SELECT DISTINCT l.word, l.n, w.word, w.n FROM words w JOIN less l ON l.rest = w.word
),
ranked AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k
  FROM pairs
),
best AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE k = 1) r USING (word)
),
walk AS (
  SELECT word, form AS root FROM best WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, best.form FROM walk JOIN best ON best.word = walk.root WHERE best.form IS NOT NULL
),
last AS (SELECT walk.word, root FROM walk JOIN best ON best.word = walk.root WHERE best.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM best LEFT JOIN last USING (word)
""".replace("WITH table_of", "WITH RECURSIVE table_of", 1)

ORACLE = {
    "op2_chat_format": CHAT,
    "op5_exact_dedup": EXACT_DEDUP,
    "op10_decontaminate": DECONTAMINATE,
    "op11_license_scan": LICENSES,
    "op13_spelling_variants": VARIANTS,
}
