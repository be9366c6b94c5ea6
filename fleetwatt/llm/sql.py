"""Equivalent SQL of the queries that SQL can express.

Tokenizers, learnt models and connected components have none; the result of the byte-string and
embedding queries would be too slow to make in SQL on whole tables. Tests hold those against
plain versions.
"""

from fleetwatt.llm.line_dedup import PERCENT
from fleetwatt.llm.quality import (
    COMMON_WORDS, GUARD_CHARS, GUARD_WORDS, MAX_CLASS_DISTANCE, MAX_REPEAT_PCT, MAX_WORD_DISTANCE, MIN_WORDS, N_COMMON, WINDOW,
)

ORACLE: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"

_LINES = rf"""WITH lines AS (
  SELECT doc_id, i - 1 AS pos, l AS line, list_sort(list_distinct(regexp_extract_all(l, '{_WORD}'))) AS words FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, pos) AS copy FROM lines WHERE len(words) > 0),
sets AS (SELECT doc_id, pos, words, len(words) AS n FROM ranked WHERE copy = 1),
single AS (SELECT doc_id, pos, n, unnest(words) AS w FROM sets),
counted AS (SELECT *, count(*) OVER (PARTITION BY w) AS df FROM single),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY df, w) AS place FROM counted),
prefix AS (SELECT * FROM placed WHERE place <= n - CAST(ceil({PERCENT} * n / 100e0) AS BIGINT) + 1),
met AS (
  SELECT DISTINCT x.doc_id, x.pos, y.doc_id AS doc2, y.pos AS pos2 FROM prefix x JOIN prefix y ON x.w = y.w
  AND (y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.pos < x.pos)
  AND 100 * x.n >= {PERCENT} * y.n AND 100 * y.n >= {PERCENT} * x.n),
gone AS (
  SELECT DISTINCT met.doc_id, met.pos FROM met JOIN sets a ON met.doc_id = a.doc_id AND met.pos = a.pos
  JOIN sets b ON met.doc2 = b.doc_id AND met.pos2 = b.pos
  WHERE 100 * len(list_intersect(a.words, b.words)) >= {PERCENT} * (a.n + b.n - len(list_intersect(a.words, b.words)))),
removed AS (
  SELECT doc_id, pos FROM ranked WHERE copy > 1 UNION SELECT doc_id, pos FROM gone),
state AS (
  SELECT l.doc_id, l.pos, l.line, len(l.words) > 0 AS worded, r.pos IS NOT NULL AS out
  FROM lines l LEFT JOIN removed r ON l.doc_id = r.doc_id AND l.pos = r.pos),
texts AS (
  SELECT doc_id, count(*) FILTER (WHERE worded) AS n_lines, count(*) FILTER (WHERE out) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT out), '') AS text FROM state GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t.text, '')) AS text_sha256
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id"""
ORACLE["op2_line_dedup"] = _LINES

_LISTS = " ".join(
    f"WHEN '{lang}' THEN [{', '.join(f'{chr(39)}{w}{chr(39)}' for w in words)}]" for lang, words in COMMON_WORDS.items()
)
_KNOWN = ", ".join(f"'{lang}'" for lang in COMMON_WORDS)


def _distance(counts: str, total: str, reference: str, n: int) -> str:
    p, q, m = f"({counts}[i] / {total}::DOUBLE)", f"{reference}[i]", f"(({counts}[i] / {total}::DOUBLE + {reference}[i]) / 2e0)"
    term = lambda a: f"CASE WHEN {a} > 0 THEN {a} * log2({a} / {m}) ELSE 0e0 END"
    return f"sqrt(greatest(list_sum(list_transform(range(1, {n + 1}), lambda i: {term(p)} + {term(q)})) / 2e0, 0e0))"


ORACLE["op3_quality_rules"] = rf"""WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    CASE WHEN lang IN ({_KNOWN}) THEN lang ELSE '' END AS lang FROM documents),
parts AS (
  SELECT *, len(w) AS n_words, array_to_string(w, '') AS joined, regexp_replace(array_to_string(w, ''), '\p{{L}}', '', 'g') AS rest,
    CASE lang {_LISTS} END AS common, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM base),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + {WINDOW}), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(greatest(0, len(w) - {WINDOW - 1}))) AS i FROM parts)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS place FROM twice WHERE c > 1) GROUP BY doc_id),
counted AS (
  SELECT p.doc_id, lang, n_words, length(joined) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    length(joined) - length(regexp_replace(joined, '\p{{Lu}}', '', 'g')) AS capital, length(joined) - length(rest) AS letters,
    length(rest) - length(regexp_replace(rest, '[0-9]', '', 'g')) AS digits,
    length(rest) - length(regexp_replace(rest, '[.,;:?''"()-]', '', 'g')) AS marks, length(t) - length(joined) AS spaces, length(rest) AS other,
    list_transform(common, lambda c: len(list_filter(w, lambda x: x = c))) AS found
  FROM parts p LEFT JOIN repeated r ON p.doc_id = r.doc_id),
hist AS (
  SELECT *, [letters - capital, capital, digits, marks, other - digits - marks, spaces] AS chars,
    coalesce(list_append(found, n_words - list_sum(found)), list_append(list_transform(range({N_COMMON}), lambda i: 0), n_words)) AS words FROM counted),
sums AS (
  SELECT lang, sum(n_words) AS n, [{', '.join(f'sum(chars[{i}])' for i in range(1, 7))}] AS chars,
    [{', '.join(f'sum(words[{i}])' for i in range(1, N_COMMON + 2))}] AS words FROM hist GROUP BY lang),
refs AS (
  SELECT lang, list_transform(chars, lambda x: x / list_sum(chars)::DOUBLE) AS rc, list_transform(words, lambda x: x / n::DOUBLE) AS rw FROM sums),
judged AS (
  SELECT h.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
    CASE WHEN list_sum(chars) >= {GUARD_CHARS} THEN {_distance('chars', 'list_sum(chars)', 'rc', 6)} END AS cd,
    CASE WHEN n_words >= {GUARD_WORDS} AND h.lang <> '' THEN {_distance('words', 'n_words', 'rw', N_COMMON + 1)} END AS wd
  FROM hist h LEFT JOIN refs ON h.lang = refs.lang)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(cd, 0e0) <= {MAX_CLASS_DISTANCE}e0 AND coalesce(wd, 0e0) <= {MAX_WORD_DISTANCE}e0 AS kept,
  round(cd, 6) AS class_distance, round(wd, 6) AS word_distance FROM judged"""

ORACLE["op4_arc_to_warc"] = """WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d),
g AS (SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to, true AS digest_ok FROM g"""
