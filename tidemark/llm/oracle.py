"""The operators' queries in DuckDB SQL, where SQL can express them.

Not expressed: token ids and packing (1), approximate search (2), keyed permutations (3), a trained
model (4), licences (8; tests hold them against plain Python), and so the pipeline.
"""

from __future__ import annotations

from tidemark.llm import mixing, quality, secrets
from tidemark.llm.rows import SPACE_RUN


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


def _often(pattern: str) -> str:
    """Whether the line x matches once in so many words or more often."""
    words = f"(len(regexp_extract_all(x, {_text(SPACE_RUN)})) + 1)"
    return f"(regexp_matches(x, {_text(pattern)}) AND len(regexp_extract_all(x, {_text(pattern)})) * {quality.WORDS_PER_MATCH} >= {words})"


OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, {_WORDS} AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
),
tri AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
),
twice AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2)) AS v(j) GROUP BY doc_id
),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, {_text(quality.SYMBOLS)}, '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    length(array_to_string(ls, '')) AS all_chars,
    length(array_to_string(list_filter(list_distinct(ls), lambda x: NOT (
      (length(x) - length(regexp_replace(x, {_text(quality.SYMBOLS)}, '', 'g'))) * 8 > length(x)
      OR {_often(quality.BAD_PUNCTUATION)} OR {_often(quality.NAVIGATION)} OR {_often(quality.BOILERPLATE)})), '')) AS passing
  FROM w LEFT JOIN rep USING (doc_id)
),
f AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * (all_chars - passing) <= {quality.MAX_LOST_PERCENT} * all_chars AS kept
FROM f
"""


def _number(*parts: str) -> str:
    return "('0x' || substr(md5(" + " || '/' || ".join(parts) + "), 1, 15))::BIGINT"


_CAP, _SEED = mixing.MAX_COPIES, _text(mixing.SEED)
_PASSED = "floor({0} * rate + off) - floor({1} * rate + off)"

OP9 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, '') AS key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
),
c AS (
  SELECT *, {_number(_SEED, "key")} AS h,
    CASE WHEN size < 32 THEN size::INTEGER
      ELSE (length(bin(size)) - 1) * 16 + floor(size / 2.0 ** (length(bin(size)) - 5))::INTEGER % 16 END AS class
  FROM d
),
r AS (SELECT *, h >> {60 - mixing.SLOT_BITS} AS slot FROM c),
cells AS (SELECT source, class, slot, count(*) AS n, sum(size)::BIGINT AS words FROM r GROUP BY ALL),
sources AS (
  SELECT source, sum(words)::BIGINT AS source_size, {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM cells GROUP BY source
),
units AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum({_CAP} * source_size) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS unit
  FROM sources
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (SELECT source, source_size, least(({_CAP} * source_size)::DOUBLE, max(unit) OVER () * weight) AS target FROM units),
placed AS (
  SELECT cells.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    {_number(_SEED, "'offset'", "coalesce(cells.source, chr(0))")} / {float(1 << 60)!r} AS off,
    coalesce(sum(n) OVER (PARTITION BY cells.source ORDER BY class, slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
    words * {mixing.LARGE} > source_size * n AS large
  FROM cells JOIN targets ON cells.source IS NOT DISTINCT FROM targets.source
),
eased AS (
  SELECT * REPLACE (CASE WHEN large OR coalesce(rest, 0) = 0 THEN rate
    ELSE least(greatest((target - in_large) / rest, 0.0), {float(_CAP)!r}) END AS rate)
  FROM (
    SELECT *, coalesce(sum(CASE WHEN large THEN trunc(({_PASSED.format("(before + n)", "before")}) * words / n)::BIGINT END) OVER (PARTITION BY source), 0) AS in_large,
      sum(CASE WHEN NOT large THEN words END) OVER (PARTITION BY source) AS rest
    FROM placed
  )
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, class, slot ORDER BY h, key, size) AS rank FROM r),
taken AS (
  SELECT doc_id, size, source_size, target, least({_PASSED.format("(before + rank)", "(before + rank - 1)")}, {_CAP})::INTEGER AS copies
  FROM ranked JOIN eased ON ranked.source IS NOT DISTINCT FROM eased.source AND ranked.class = eased.class AND ranked.slot = eased.slot
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM taken
"""


def _spans(kind: int, pattern: str, value: int, least: int, texts: str = "d") -> str:
    p = _text(pattern)
    return f"""
  SELECT doc_id, t, {kind} AS kind, v,
    (sum(length(g)) OVER o + coalesce(sum(length(m)) OVER p, 0))::BIGINT AS start, (sum(length(g)) OVER o + sum(length(m)) OVER o)::BIGINT AS stop
  FROM (
    SELECT doc_id, t, i, string_split_regex(t, {p})[i] AS g, regexp_extract_all(t, {p})[i] AS m, regexp_extract_all(t, {p}, {value})[i] AS v
    FROM (SELECT doc_id, t, unnest(range(1, len(regexp_extract_all(t, {p})) + 1)) AS i FROM {texts} WHERE regexp_matches(t, {p}))
  )
  WINDOW o AS (PARTITION BY doc_id ORDER BY i), p AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  QUALIFY length(v) >= {least}"""


_NAMES = str(list(secrets.KINDS))
# RE2 needs no possessive repetition.
_ALLOWED = _text(secrets.ALLOWED.replace("*+", "*"))
_LIMIT = "CASE " + " ".join(f"WHEN regexp_matches(s, {_text(p)}) THEN {bits}" for p, bits in secrets.CLASSES if p) + f" ELSE {secrets.CLASSES[-1][1]} END"
_W = secrets.WINDOW

OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_spans(0, secrets.ASSIGN, 1, secrets.MIN_VALUE)} UNION ALL {_spans(1, secrets.ACCESS, 0, 0)} UNION ALL {_spans(2, secrets.HEX, 0, 0)}),
reached AS (
  SELECT doc_id, t, start, stop, coalesce(max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past
  FROM base
),
blanked AS (
  SELECT doc_id, string_agg(substr(t, past + 1, greatest(start - past, 0)) || repeat(' ', greatest(stop - greatest(start, past), 0)), '' ORDER BY start, stop)
    || substr(any_value(t), max(stop) + 1) AS t
  FROM reached GROUP BY doc_id
),
rest AS (SELECT d.doc_id, coalesce(b.t, d.t) AS t FROM d LEFT JOIN blanked b USING (doc_id)),
candidate AS ({_spans(3, secrets.CANDIDATE, 0, 0, "rest")}),
alone AS (SELECT *, v AS s FROM candidate WHERE NOT regexp_matches(v, {_ALLOWED})),
windows AS (SELECT doc_id, start, s, i, unnest(string_split(substr(s, i, {_W}), '')) AS ch FROM (SELECT *, unnest(range(1, length(s) - {_W} + 2)) AS i FROM alone)),
counts AS (SELECT doc_id, start, s, i, ch, count(*) AS n FROM windows GROUP BY ALL),
bits AS (
  SELECT doc_id, start, s, max(b) AS b
  FROM (SELECT doc_id, start, s, i, round(log2({_W}.0) - sum(n * log2(n)) / {_W}, 6) AS b FROM counts GROUP BY ALL) GROUP BY ALL
),
entropy AS (SELECT a.* EXCLUDE (s) FROM alone a JOIN bits USING (doc_id, start, s) WHERE b >= {_LIMIT}),
everything AS (
  SELECT doc_id, kind, start, {_NAMES}[kind + 1] || ':' || start || ':' || stop AS written, stop
  FROM (SELECT doc_id, kind, start, stop FROM base UNION ALL SELECT doc_id, kind, start, stop FROM entropy)
),
g AS (
  SELECT doc_id, count_if(kind = 0) AS n0, count_if(kind = 1) AS n1, count_if(kind = 2) AS n2, count_if(kind = 3) AS n3,
    coalesce(string_agg(written, ',' ORDER BY start, kind, stop) FILTER (kind < 3), '') AS based, string_agg(written, ',' ORDER BY start, kind, stop) AS spans
  FROM everything GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
  coalesce(n3, 0)::BIGINT AS n_entropy, sha256(coalesce(based, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
reach AS (SELECT x AS a, y AS b FROM links UNION SELECT reach.a, links.y FROM reach JOIN links ON reach.b = links.x),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least(least.b, d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
"""

OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
one AS (SELECT w, count(*) AS c FROM p GROUP BY w),
two AS (SELECT v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY v, w),
scored AS (
  SELECT p.doc_id, p.v IS NOT NULL AND two.c < 2 AS backed,
    CASE WHEN two.c >= 2 THEN ln(two.c / context.c) ELSE ln(one.c / (SELECT sum(c) FROM one)) + CASE WHEN p.v IS NULL THEN 0 ELSE ln(0.4) END END AS log
  FROM p JOIN one ON one.w = p.w LEFT JOIN two ON two.v = p.v AND two.w = p.w LEFT JOIN one context ON context.w = p.v
),
g AS (SELECT doc_id, count(*) AS n, count_if(backed) AS b, sum(log) AS log FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(b, 0)::BIGINT AS n_backed_off, round(coalesce(log, 0), 6)::DOUBLE AS log_score, round(log / n, 6) AS mean_log_score
FROM d LEFT JOIN g USING (doc_id)
"""

ORACLE = {
    "op5_jaccard_join": OP5,
    "op6_secret_scan": OP6,
    "op7_language_model": OP7,
    "op9_mixing": OP9,
    "op10_quality_rules": OP10,
}
