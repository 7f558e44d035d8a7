"""DuckDB SQL of the operators that SQL can express on whole tables, by other methods than the operators' own."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: crc32 of UTF-8 text: ``crc_table.t`` is the table of the reflected polynomial, one step a byte
_CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def _crc(text: str) -> str:
    byte = "lambda i: (strpos('0123456789ABCDEF', substr(hex(encode({0})), 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hex(encode({0})), 2 * i + 2, 1)) - 1"
    each = f"list_transform(range(strlen({text})), {byte.format(text)})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {each}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


SQL: dict[str, str] = {}

SQL["op2_exact_topk"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 5
"""

SQL["op4_debruijn_dedup"] = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM docs WHERE len(w) >= 50),
windows AS (SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + 49), ' ')) AS h FROM starts),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
later AS (SELECT doc_id, s FROM windows JOIN firsts USING (h) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
-- the last window that starts at or before a word covers it or none does
near AS (SELECT w.doc_id, w.i, w.word, l.s FROM words w ASOF LEFT JOIN later l ON w.doc_id = l.doc_id AND w.i >= l.s),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE s IS NOT NULL AND i < s + 50) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE s IS NULL OR i >= s + 50) AS text
  FROM near GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

SQL["op9_jaccard_join"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, s, s + 4), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""

SQL["op12_spelling_variants"] = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents WHERE text IS NOT NULL
),
each AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM each, crc_table),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n
  FROM hashed
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  -- equal but for one place, or one with a code point more
  SELECT DISTINCT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT DISTINCT c.word, w.word FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT DISTINCT w.word, c.word FROM cuts c JOIN words w ON w.word = c.rest
),
near AS (
  SELECT p.word, w.n, count(*) OVER (PARTITION BY p.word) AS n_near, p.other, o.n AS other_n,
         row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.other) AS nth
  FROM pairs p JOIN words w ON w.word = p.word JOIN words o ON o.word = p.other
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN near ON near.word = w.word AND nth = 1
),
chain AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
),
ends AS (SELECT c.word, c.at FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, e.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word
"""


# -- conversations: best (cost, audit) of the rest from each state, from the last row back to the first.  A
# value is the cost in twelve digits and then the audit, so the least text is the cheapest, ties by audit.
_NONE = "'900000000000'"


def _plus(cost: str, letter: str, rest: str) -> str:
    return f"lpad(CAST(CAST(left({rest}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{letter}' || substr({rest}, 13)"


def _move(state: str, keeps: dict[str, str], asked: str) -> str:
    """The best edit of a row in a state: it goes, stays, or gets the role that the state asks for."""
    stay = " ".join(f"WHEN NOT must AND initial = '{i}' THEN {_plus('cut', 'K', to)}" for i, to in keeps.items())
    change = _plus("2 + cut", "R", asked)
    return f"least({_plus('3', 'D', state)}, CASE {stay} ELSE {_NONE} END, CASE WHEN must THEN {_NONE} ELSE {change} END)"


def _inserts(e: str, s: str, u: str, a: str) -> str:
    """Columns e, s, u, a with the rows that may be inserted first."""
    one, two = (lambda x: _plus("2", "I", x)), (lambda x: _plus("4", "II", x))
    return f"least({e}, {one(u)}, {two(a)}) AS e, least({s}, {one(u)}, {two(a)}) AS s, least({u}, {one(a)}) AS u, least({a}, {one(u)}) AS a"


SQL["op13_conversation_repair"] = f"""
WITH RECURSIVE {_CRC},
ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
keyed AS (
  SELECT i.c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(r.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations r JOIN ids i ON i.conv_id IS NOT DISTINCT FROM r.conv_id
),
faults AS (SELECT c, turn, role, text, {_crc('k')} % 20 AS f FROM keyed, crc_table),
after AS (
  SELECT c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM faults WHERE f <> 0
),
placed AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM after
),
judged AS (
  SELECT *, left(role, 1) AS initial, regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g') AS solid,
         row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
  FROM placed
),
lattice AS (
  SELECT c, i, turn, role, text, initial, solid = '' AS blank, solid <> '' AND again AS duplicate,
         solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS truncated, solid = '' OR again AS must,
         CASE WHEN solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut,
         i > 1 AND before || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM judged
),
counts AS (
  SELECT c, max(i) AS n, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE illegal) AS illegal
  FROM lattice GROUP BY c
),
rest AS (
  SELECT c, n AS i, {_inserts("'000000000000'", _NONE, _NONE, "'000000000000'")} FROM counts
  UNION ALL
  SELECT c, i, {_inserts('de', 'ds', 'du', 'da')} FROM (
    SELECT r.c, r.i - 1 AS i, {_move('r.e', {'s': 'r.s', 'u': 'r.u'}, 'r.u')} AS de, {_move('r.s', {'u': 'r.u'}, 'r.u')} AS ds,
           {_move('r.u', {'a': 'r.a'}, 'r.a')} AS du, {_move('r.a', {'u': 'r.u'}, 'r.u')} AS da
    FROM rest r JOIN lattice l ON l.c = r.c AND l.i = r.i WHERE r.i > 0) moved
),
best AS (SELECT c, CAST(left(e, 12) AS BIGINT) AS cost, substr(e, 13) AS audit FROM rest WHERE i = 0),
letters AS (
  SELECT c, k, letter, sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY k) AS i,
         sum(CASE WHEN letter = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY k) AS place
  FROM (SELECT c, unnest(range(1, length(audit) + 1)) AS k, unnest(string_split(audit, '')) AS letter FROM best WHERE audit <> '')
),
lines AS (
  SELECT x.c, x.k, x.letter, x.place, l.role, l.text,
         max(CASE WHEN x.place = 1 AND x.letter = 'K' AND l.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.c) AS system
  FROM letters x LEFT JOIN lattice l ON l.c = x.c AND l.i = x.i AND x.letter <> 'I' WHERE x.letter <> 'D'
),
repaired AS (
  SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
                       chr(10) ORDER BY k) AS text
  FROM lines GROUP BY c
)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired.text, '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.c = ids.c LEFT JOIN best ON best.c = ids.c LEFT JOIN repaired ON repaired.c = ids.c
"""
