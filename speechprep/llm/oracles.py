"""Queries of this subpackage as SQL for an independent engine, where SQL can say it."""

from __future__ import annotations

from speechprep.llm import codes, decontam, linededup, mixing
from speechprep.llm.chat import CONTROL
from speechprep.llm.quality import DEFAULT

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[\x20\x09-\x0D]+"

WARC = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), leaders AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS leader FROM payloads
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + ((
    ('0x' || substr(hex, 10 * (i // 8)::INT + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)
  ), '') AS payload_digest,
  CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> leader THEN leader END AS refers_to, NULL::VARCHAR AS error
FROM leaders
"""


def _escaped(text: str) -> str:
    return "".join("\\" + c if c in "|[]<>/\\" and c not in "<>/" else c for c in text)


_CONTROLS = "|".join(_escaped(c[0]) + r"\\*" + _escaped(c[1:]) for c in CONTROL)
_GUARDED = f"(length({{0}}) + len(regexp_extract_all({{0}}, '{_CONTROLS}')))"
CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({len('<|im_start|>') + 1 + len('<|im_end|>') + 1} + {_GUARDED.format('role')}
    + {_GUARDED.format('text')})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '{_SPACE}'), lambda x: x <> '') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s + 1:s + 2], ' ') AS shingle
  FROM (SELECT *, unnest(range(greatest(len(ws) - 1, 1))) AS s FROM words WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), roots AS (
  SELECT a, min(b) AS root FROM reached GROUP BY a
)
SELECT a AS doc_id, coalesce(n, 0) AS n_shingles, root AS component_id, a = root AS kept
FROM roots LEFT JOIN sizes ON sizes.doc_id = a
"""


def _quality() -> str:
    lengths = sorted(DEFAULT.ngram_chars)
    parts = []
    for n in (3, *lengths):
        parts.append(f"""grams_{n} AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, gram) AS often FROM (
    SELECT doc_id, s, array_to_string(ws[s + 1:s + {n}], ' ') AS gram
    FROM (SELECT *, unnest(range(len(ws) - {n - 1})) AS s FROM words WHERE len(ws) >= {n}))
), covered_{n} AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word)) AS chars
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + {n})) AS p FROM grams_{n} WHERE often > 1)
  JOIN placed USING (doc_id, p) GROUP BY doc_id
)""")
    dup = ", ".join(f"coalesce(c{n}.chars, 0)::BIGINT AS dup_chars_{n}" for n in lengths)
    joins = " ".join(f"LEFT JOIN covered_{n} c{n} ON c{n}.doc_id = w.doc_id" for n in (3, *lengths))
    bad = " OR ".join(
        f"dup_chars_{n} > {share}::DOUBLE * word_chars" for n, share in DEFAULT.ngram_chars.items()
    )
    return f"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''),
    '{_SPACE}'), lambda x: x <> '') AS ws FROM documents
), placed AS (
  SELECT doc_id, unnest(range(len(ws))) AS p, unnest(ws) AS word FROM words
), {", ".join(parts)}, lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) > 1 AS later
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), by_line AS (
  SELECT doc_id, count(*) AS n, sum(length(line)) AS chars, count(*) FILTER (WHERE later) AS n_dup,
    coalesce(sum(length(line)) FILTER (WHERE later), 0)::BIGINT AS dup_chars
  FROM lines GROUP BY doc_id
), measured AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.n_dup, 0) AS n_dup_lines, coalesce(c3.n_words, 0) AS n_repeat_words,
    coalesce(l.dup_chars, 0) AS dup_line_chars, {dup},
    coalesce(l.n, 0) AS all_lines, coalesce(l.chars, 0) AS line_chars
  FROM words w LEFT JOIN by_line l ON l.doc_id = w.doc_id {joins}
)
SELECT * EXCLUDE (all_lines, line_chars),
  n_words < {DEFAULT.least_words} OR n_repeat_words > {DEFAULT.repeat_words}::DOUBLE * n_words
    AS base_failed,
  NOT base_failed AND NOT (n_dup_lines > {DEFAULT.lines}::DOUBLE * all_lines
    OR dup_line_chars > {DEFAULT.line_chars}::DOUBLE * line_chars OR {bad}) AS kept
FROM measured
"""


MIDDLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(ls)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(ls) + 1) AS h1,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(ls) + 1) AS h2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
    WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(ls[1:least(h1, h2)], '') AS p,
    array_to_string(ls[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
    array_to_string(ls[greatest(h1, h2) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def all_oracles() -> dict[str, str]:
    return {
        "op2_warc": WARC,
        "op4_line_dedup": linededup.ORACLE,
        "op5_chat": CHAT,
        "op7_near_duplicates": NEAR,
        "op8_quality": _quality(),
        "op10_decontamination": decontam.ORACLE,
        "op11_mixing": mixing.oracle((1, 2, 3), 3, 7),
        "op12_fill_in_middle": MIDDLE,
        "op13_vector_codes": codes.oracle(4, 16, 256, 4, 1024),
    }
