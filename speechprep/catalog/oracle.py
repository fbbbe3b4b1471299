"""The queries once more, as plain SQL for an independent engine.

Strings are SQL for DuckDB over the same tables. Patterns use the same code
point classes as the library, since regex engines differ on what white space is.
"""

from __future__ import annotations

from ..functions.text import HAN, JYA_BRACKETS, JYA_DELETED, PUNCTUATION, TDH_DELETED, WS
from .adapters import (
    BLOCK_MS,
    BLOCK_SAMPLES,
    FRAME_CHARS,
    LANGUAGES,
    MARKS,
    RECORDING_BLOCKS,
)
from .queries import AUDIO_ROOT, DATE, LANGUAGE, MIN_SILENCE, OFFSET_DB

PART = 4096


def lit(text: str) -> str:
    """A SQL string literal; unprintable characters are written with chr()."""
    out, plain = [], ""
    for ch in text:
        if ch.isprintable():
            plain += ch
        else:
            out += ["'" + plain.replace("'", "''") + "'", f"chr({ord(ch)})"]
            plain = ""
    out.append("'" + plain.replace("'", "''") + "'")
    return "(" + " || ".join(out) + ")"


def sub(x: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {to}, 'g')"


def delete(x: str, chars: str) -> str:
    return f"translate({x}, {lit(chars)}, '')"


# ------------------------------------------------------------------------ text


def collapse(x: str) -> str:
    return f"trim({sub(x, f'[{WS}]+', lit(' '))})"


def clean(x: str) -> str:
    x = sub(x, r"\[[^" + "\n" + r"]*?\]")
    x = sub(x, r"\([^" + "\n" + r"]*?\)")
    return collapse(f"nfc_normalize({delete(x, PUNCTUATION)})")


def tdh(x: str) -> str:
    x = sub(x, "--+", "' '")
    x = f"replace({x}, '-', '')"
    x = sub(x, "…+", "' '")
    x = sub(x, r"\.+", "' '")
    for old, new in ((":", "ː"), ("᷉", "̃"), ("̵", "")):
        x = f"replace({x}, chr({ord(old)}), {f'chr({ord(new)})' if new else lit('')})"
    return clean(delete(x, TDH_DELETED))


def nru(x: str) -> str:
    for old, new in (("...", "…"), ("◊", "|"), ("F", ""), ("D", ""), ("<", ""), (">", "")):
        x = f"replace({x}, {lit(old)}, {lit(new)})"
    x = sub(x, "m+…", "'mmm…'")
    return clean(sub(x, "ʰ+", "'ʰ'"))


def jya(x: str) -> str:
    # keep apostrophes of @words: token by token, after the first @
    pieces = f"regexp_extract_all({x}, {lit(f'[{WS}]+|[^{WS}]+')})"
    at = "position('@' in p)"
    kept = (
        f"CASE WHEN {at} > 0 THEN substr(p, 1, {at}) || "
        f"replace(substr(p, {at} + 1), '''', chr(57344)) ELSE p END"
    )
    x = f"array_to_string(list_transform({pieces}, lambda p: {kept}), '')"
    x = sub(x, rf"@([^{WS}]+)[{WS}]*[{HAN}]+", r"'\1'")
    x = sub(x, f"[{HAN}]+")
    x = delete(x, "@X")
    x = sub(x, "-{2,}", "' '")
    x = f"replace({x}, '-', '')"
    x = sub(x, "[.…]+", "' '")
    x = f"replace({x}, chr(609), 'g')"
    x = delete(x, JYA_DELETED)
    x = clean(f"lower({sub(x, r'\p{Nd}+')})")
    return collapse(f"replace({delete(x, JYA_BRACKETS)}, chr(57344), '''')")


def skipped(x: str) -> str:
    return f"(contains({x}, 'fin peu audible') OR contains({x}, 'BEGAIEMENT'))"


def esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def esc_attr(x: str) -> str:
    return f"replace({esc(x)}, '\"', '&quot;')"


# ------------------------------------------------------------------- relations

_MARK = " ".join(f"WHEN {i} THEN {lit(m)}" for i, m in enumerate(MARKS))
_LANG = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGES.items())

TEXTS = f"""texts AS (SELECT doc_id, text || CASE doc_id % {len(MARKS)} {_MARK} END AS text,
  CASE lang {_LANG} END AS language FROM documents)"""

_SEC = "(({0} // 1000)::varchar || '.' || lpad(({0} % 1000)::varchar, 3, '0'))"
_T0, _T1 = "(turn * 30000)", "(turn * 30000 + length(text) * 1000 // 64)"
NODES = f"""raw AS (SELECT *, (conv_id * 7 + turn) % 13 AS k FROM conversations),
nodes AS (SELECT printf('conv%05d', conv_id) AS recording, turn AS pos,
  printf('S%03d', turn + 1) AS sent_id,
  CASE k WHEN 0 THEN '[note] ' || text WHEN 1 THEN '[only a note] (aside) !'
    WHEN 2 THEN text || ' (x), !' WHEN 3 THEN NULL WHEN 4 THEN text || ' fin peu audible'
    ELSE text END AS text,
  CASE WHEN k IN (5, 10) THEN NULL WHEN k = 6 THEN 'x'
    WHEN k = 7 THEN '  ' || {_SEC.format(_T0)} || ' ' ELSE {_SEC.format(_T0)} END AS t0,
  CASE WHEN k = 10 THEN NULL WHEN k = 8 THEN 'nan' WHEN k = 9 THEN 'inf'
    ELSE {_SEC.format(_T1)} END AS t1,
  CASE k WHEN 3 THEN 'no text' WHEN 10 THEN 'no audio' WHEN 5 THEN 'no timecode' END AS reason
  FROM raw),
timed AS (SELECT *, start_s, end_s, end_s - start_s AS duration_s FROM (SELECT *,
  CASE WHEN trim(t0) <> 'nan' THEN try_cast(trim(t0) AS double) END AS start_s,
  CASE WHEN trim(t1) <> 'nan' THEN try_cast(trim(t1) AS double) END AS end_s FROM nodes))"""


def _kept(text: str, skip: str) -> str:
    return f"""kept AS (SELECT recording || '_' || sent_id || '.wav' AS path, {text} AS sentence,
  printf('%.3f', duration_s) AS duration, recording, start_s, end_s, duration_s FROM timed
  WHERE reason IS NULL AND duration_s > 1 AND duration_s <= 20 AND NOT {skip} AND {text} <> '')"""


def _why(text: str, skip: str) -> str:
    return f"""why AS (SELECT recording, pos, sent_id, CASE WHEN reason IS NOT NULL THEN reason
  WHEN {skip} THEN 'skip marker' WHEN {text} = '' THEN 'empty after cleanup'
  WHEN duration_s IS NULL THEN 'bad timecode' WHEN duration_s <= 1 THEN 'too short'
  WHEN duration_s > 20 THEN 'too long' END AS reason FROM timed)"""


CLIPS = """clips AS (SELECT printf('conv%05d', conv_id) || '_' || printf('S%03d', turn + 1) || '.wav'
  AS path, text AS sentence, printf('conv%05d', conv_id) AS recording, turn FROM conversations)"""

SPLIT = """keys AS (SELECT DISTINCT regexp_replace(path, '_S[0-9]+.*\\.wav$', '') AS rec FROM rows_),
ranked AS (SELECT rec, row_number() OVER (ORDER BY md5(rec || ':42') || ':' || rec) AS rank,
  count(*) OVER () AS n FROM keys),
members AS (SELECT rec, CASE WHEN rank <= n - 2 * (n // 10) THEN 'train'
  WHEN rank <= n - n // 10 THEN 'valid' ELSE 'test' END AS split FROM ranked),
assigned AS (SELECT r.*, m.rec, m.split FROM rows_ r JOIN members m
  ON regexp_replace(r.path, '_S[0-9]+.*\\.wav$', '') = m.rec)"""

ELEMENTS = """found AS (SELECT printf('page%06d', page_id) AS recording, page_id % 9 = 4 AS void,
  regexp_extract_all(html, '<p>([^<]+)</p>', 1) AS p,
  regexp_extract_all(html, '<li>(?:<a[^>]*>)?([^<]+)', 1) AS li FROM pages),
chosen AS (SELECT recording, void, CASE WHEN len(p) > 0 THEN p ELSE li END AS texts FROM found),
elements AS (SELECT recording, void, unnest(range(len(texts))) AS i, unnest(texts) AS body
  FROM chosen),
nodes AS (SELECT recording, i, 'N' || (CASE WHEN i % 6 = 5 THEN i - 1 ELSE i END) AS sent_id,
  CASE WHEN i % 11 <> 6 THEN body END AS text, i * 10 AS t0, i * 10 + 5 AS t1,
  CASE WHEN i % 11 = 6 THEN 'no text' WHEN i % 7 = 3 OR void THEN 'no audio'
    WHEN i % 5 = 4 THEN 'no timecode' END AS reason FROM elements),
spans AS (SELECT recording, min(i) AS pos, sent_id, max_by(text, i) AS text, max(t0) AS t0,
  max(t1) AS t1, count(*) AS n FROM nodes WHERE reason IS NULL GROUP BY recording, sent_id)"""

_FILE = """'/corpus/audio/' || c_mktsegment || '/' || CASE WHEN c_custkey % 10 = 9 THEN '_tmp'
  ELSE '' END || c_name"""
FILES = f"""files AS (SELECT c_custkey, {_FILE} || CASE c_custkey % 4 WHEN 0 THEN '.wav'
  WHEN 1 THEN '.WAV' WHEN 2 THEN '.Wav' ELSE '.mp3' END AS path,
  CASE WHEN c_custkey % 10 = 9 THEN '_tmp' ELSE '' END || c_name AS stem,
  CASE c_custkey % 4 WHEN 0 THEN '.wav' WHEN 1 THEN '.WAV' WHEN 2 THEN '.Wav' ELSE '.mp3' END
  AS suffix FROM customer),
xmls AS (SELECT '/corpus/xml/' || stem || '.xml' AS path, stem FROM (SELECT unnest(
  CASE c_custkey % 4 WHEN 0 THEN [c_name] WHEN 1 THEN [lower(c_name), upper(c_name)]
  WHEN 2 THEN [upper(c_name), c_name] ELSE [] END) AS stem FROM customer))"""

WAVE = f"""blocks AS (SELECT printf('rec%05d', vec_id // {RECORDING_BLOCKS}) AS recording,
  vec_id % {RECORDING_BLOCKS} AS block_no, list_transform(embedding, lambda x:
    greatest(least(floor(x::double * 32767), 32767), -32768)::bigint) AS samples FROM embeddings),
points AS (SELECT recording, block_no * {BLOCK_SAMPLES} + unnest(range(len(samples))) AS pos,
  unnest(samples) AS x FROM blocks),
energy AS (SELECT recording, pos // 16 AS ms, sum(x * x)::bigint AS energy FROM points
  GROUP BY recording, pos // 16),
loud AS (SELECT recording, count(*) AS n_samples, sum(x * x) AS squares FROM points
  GROUP BY recording),
level AS (SELECT recording, n_samples, round_even(n_samples / 16, 0)::bigint AS length_ms,
  floor(sqrt(squares::double / n_samples))::bigint AS rms FROM loud)"""

SILENCE = f"""windows AS (SELECT recording, ms, sum(energy) OVER w AS e, count(*) OVER w AS n
  FROM energy WINDOW w AS (PARTITION BY recording ORDER BY ms
  ROWS BETWEEN CURRENT ROW AND {MIN_SILENCE - 1} FOLLOWING)),
silent AS (SELECT w.recording, ms, length_ms FROM windows w JOIN level l USING (recording)
  WHERE n = {MIN_SILENCE} AND floor(sqrt(e::double / {MIN_SILENCE * 16}))
    <= rms * pow(10.0::double, {-OFFSET_DB / 20.0}::double)),
marked AS (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY recording ORDER BY ms)
  <= {MIN_SILENCE} THEN 0 ELSE 1 END AS opens FROM silent),
grouped AS (SELECT *, sum(opens) OVER (PARTITION BY recording ORDER BY ms) AS g FROM marked),
ranges AS (SELECT recording, any_value(length_ms) AS length_ms, min(ms) AS start_ms,
  max(ms) + {MIN_SILENCE} AS end_ms FROM grouped GROUP BY recording, g),
cuts AS (SELECT recording, (start_ms + end_ms) // 2 AS cut FROM ranges
  WHERE start_ms > 0 AND end_ms < length_ms UNION ALL
  SELECT recording, 0 FROM level WHERE recording NOT IN
    (SELECT recording FROM ranges WHERE start_ms = 0 AND end_ms = length_ms)),
chunks AS (SELECT recording, row_number() OVER w - 1 AS chunk_no, cut AS start_ms,
  coalesce(lead(cut) OVER w, length_ms) AS end_ms FROM cuts JOIN level USING (recording)
  WINDOW w AS (PARTITION BY recording ORDER BY cut))"""

EVENTS = """chunks AS (SELECT printf('rec%05d', user_id) AS recording, event_id AS chunk_no,
  round(value * 100)::bigint AS length_ms, least(round(value * 100)::bigint, 25000) AS capped,
  CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0
    THEN ' ' WHEN event_id % 17 = 0 THEN 'NA' WHEN event_id % 19 = 0
    THEN event_type || '  <' || props || '> & "x"' ELSE event_type || ' ' || props END
    AS prediction FROM events),
timed AS (SELECT *, sum(capped) OVER (PARTITION BY recording ORDER BY chunk_no)::bigint AS t1
  FROM chunks),
kept AS (SELECT *, t1 - capped AS t0, (t1 - capped) / 1000 AS start_s, t1 / 1000 AS end_s,
  row_number() OVER w AS k FROM timed WHERE prediction <> ''
  WINDOW w AS (PARTITION BY recording ORDER BY chunk_no))"""

_TOKENS = f"list_filter(regexp_split_to_array(prediction, {lit(f'[{WS}]+')}), lambda w: w <> '')"
NUMBERED = f"""worded AS (SELECT *, {_TOKENS} AS words FROM kept),
numbered AS (SELECT *, (1 + coalesce(sum(1 + len(words)) OVER (PARTITION BY recording
  ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::bigint AS ann
  FROM worded),
words AS (SELECT recording, chunk_no, ann, unnest(range(len(words))) AS i, unnest(words) AS word
  FROM numbered)"""

# Edit distance of words by dynamic programming, a row of the table per reference word.
_ENDS = lit(" \t\n\r")
_SPLIT = "list_filter(string_split({0}, ' '), lambda w: w <> '')"


def _squeeze(x: str) -> str:
    return f"trim({sub(x, f'[{WS}]{{2,}}', lit(' '))}, {_ENDS})"


_PAIRS = f"""pairs AS (SELECT a.conv_id, a.turn, a.role, {_squeeze('a.text')} AS ref,
  {_squeeze('b.text')} AS hyp FROM conversations a
  JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn)"""
WORD_PAIRS = f"""WITH RECURSIVE {_PAIRS},
wp AS (SELECT conv_id, turn, {_SPLIT.format('ref')} AS r, {_SPLIT.format('hyp')} AS h FROM pairs),
dp AS (SELECT conv_id, turn, r, h, 0 AS i, range(len(h) + 1) AS d FROM wp UNION ALL
  SELECT conv_id, turn, r, h, i + 1, list_reduce(range(1, len(h) + 1),
    lambda acc, j: list_append(acc, least(acc[-1] + 1, d[j + 1] + 1,
      d[j] + CASE WHEN h[j] = r[i + 1] THEN 0 ELSE 1 END)), [(i + 1)::bigint])
  FROM dp WHERE i < len(r)),
scored AS (SELECT conv_id, turn, d[-1] AS edits, len(r) AS ref_words FROM dp WHERE i = len(r))"""
# Bytes are what DuckDB compares, so characters are recoded to one byte each.
_CODE = "array_to_string(list_transform(string_split({0}, ''), lambda c: chr((33 + list_position(v, c))::int)), '')"
CHAR_PAIRS = f"""WITH {_PAIRS},
cp AS (SELECT *, list_distinct(string_split(ref || hyp, '')) AS v FROM pairs),
scored AS (SELECT conv_id, turn, role, levenshtein({_CODE.format('ref')}, {_CODE.format('hyp')})
  AS edits, length(ref) AS ref_chars FROM cp)"""

_TURN_CHARS = """SELECT DISTINCT unnest(string_split(replace(text, ' ', '|'), '')) AS char
  FROM conversations"""


def _vocab(where: str, joined: str) -> str:
    return f"""chars AS (SELECT DISTINCT char FROM ({_TURN_CHARS} {where}
  UNION ALL SELECT '|' WHERE {joined}) WHERE char <> ''),
vocab AS (SELECT char, row_number() OVER (ORDER BY char) - 1 AS id FROM chars
  UNION ALL SELECT '[UNK]', (SELECT count(*) FROM chars)
  UNION ALL SELECT '[PAD]', (SELECT count(*) + 1 FROM chars))"""


FULL_VOCAB = _vocab(
    "",
    """(SELECT count(*) FROM conversations WHERE turn % 2 = 0) >= 2
    OR (SELECT count(*) FROM conversations WHERE turn % 2 = 1) >= 2""",
)

_WORD = "printf('%02x%02x', {0} & 255, ({0} >> 8) & 255)"
_LONG = _WORD + " || printf('%02x%02x', ({0} >> 16) & 255, ({0} >> 24) & 255)"
CLIP_BYTES = f"""spans AS (SELECT printf('clip%07d.wav', vec_id) AS file,
  printf('rec%05d', vec_id // {RECORDING_BLOCKS}) AS recording,
  trunc((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 0.5::double) / 1000 * 16000)::bigint AS a,
  trunc(((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 5 + vec_id % 23) / 1000::double
    + 0.002::double) * 16000)::bigint AS b FROM embeddings),
bodies AS (SELECT file, count(*) AS n, string_agg({_WORD.format('x')}, '' ORDER BY pos) AS body
  FROM spans s JOIN points p ON s.recording = p.recording AND pos >= a AND pos < b GROUP BY file),
clip_bytes AS (SELECT file, n, body, '52494646' || {_LONG.format('(36 + 2 * n)')}
  || '57415645666d74201000000001000100803e0000007d00000200100064617461' || {_LONG.format('(2 * n)')}
  AS header FROM bodies)"""

LABELLED = f"""clips AS (SELECT printf('clip%07d.wav', vec_id) AS path,
  printf('rec%05d', vec_id // {RECORDING_BLOCKS}) AS recording, list_extract(['fin', 'mot à mot', 'so say'],
    (vec_id % 3 + 1)::int) || ' ' || vec_id || ' ' || coalesce(label, -1) AS sentence,
  trunc((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 0.5::double) / 1000 * 16000)::bigint AS a,
  trunc(((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 5 + vec_id % 23) / 1000::double
    + 0.002::double) * 16000)::bigint AS b FROM embeddings),
alphabet AS (SELECT list(DISTINCT c ORDER BY c) AS chars FROM (SELECT
  unnest(string_split(replace(sentence, ' ', '|'), '')) AS c FROM clips)),
bounded AS (SELECT path, recording, a, least(b, n_samples) AS b, list_transform(
  string_split(replace(sentence, ' ', '|'), ''), lambda c: list_position(chars, c) - 1) AS labels,
  ('0x' || substr(md5(path), 1, 8))::bigint
    % greatest(ceil((SELECT count(*) FROM clips) / 400)::bigint, 1) AS shard
  FROM clips JOIN loud USING (recording), alphabet WHERE a < least(b, n_samples)),
batched AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY b - a DESC, path) - 1) // 8
  AS batch_no FROM bounded)"""

ENCODED = """encoded AS (SELECT conv_id * 100000 + turn AS utt, text, length(text) AS n,
  list_transform(list_filter(string_split(text, ' '), lambda w: w <> ''), lambda w: length(w))
    AS labels FROM conversations),
sharded AS (SELECT *, ('0x' || substr(md5(utt::varchar), 1, 8))::bigint
  % greatest(ceil((SELECT count(*) FROM encoded) / 400)::bigint, 1) AS shard FROM encoded),
batched AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY n DESC, utt) - 1) // 8
  AS batch_no FROM sharded)"""

_BLANK = FRAME_CHARS.index("[PAD]")
_CHARS = "[" + ", ".join(f"'{c}'" for c in FRAME_CHARS) + "]"


def _ctc(scores: str, keys: str) -> str:
    """Frames of 8 classes in a 64-value list to text."""
    return f"""frames AS (SELECT {keys}, unnest(range(8)) AS f, unnest(list_transform(range(8),
    lambda f: {scores}[(f * 8 + 1)::int : (f * 8 + 8)::int])) AS s FROM src),
best AS (SELECT {keys}, f, list_position(s, list_max(s)) - 1 AS id FROM frames),
seen AS (SELECT *, lag(id) OVER (PARTITION BY {keys} ORDER BY f) AS prev FROM best),
texts AS (SELECT {keys}, string_agg({_CHARS}[id + 1], '' ORDER BY f)
  FILTER (WHERE id IS DISTINCT FROM prev AND id <> {_BLANK}) AS t FROM seen GROUP BY {keys})"""


def _eaf(words: bool, language: str | None, media: str | None) -> str:
    n = r"chr(10)"
    tab = "numbered" if words else "plain"
    pre = (
        f"{NUMBERED}"
        if words
        else "plain AS (SELECT *, k AS ann, []::varchar[] AS words FROM kept)"
    )
    ann = (
        "'        <ANNOTATION>' || chr(10) || '            <{tag} ' || {attrs} || '>' || chr(10) "
        "|| '                <ANNOTATION_VALUE>' || {value} || '</ANNOTATION_VALUE>' || chr(10) "
        "|| '            </{tag}>' || chr(10) || '        </ANNOTATION>' || chr(10)"
    )
    slot = "'        <TIME_SLOT TIME_SLOT_ID=\"ts' || {0} || '\" TIME_VALUE=\"' || {1} || '\"/>' || chr(10)"
    tx = ann.format(
        tag="ALIGNABLE_ANNOTATION",
        attrs="'ANNOTATION_ID=\"a' || ann || '\" TIME_SLOT_REF1=\"ts' || (2 * k - 1) || "
        "'\" TIME_SLOT_REF2=\"ts' || (2 * k) || '\"'",
        value=esc("prediction"),
    )
    wd = ann.format(
        tag="REF_ANNOTATION",
        attrs="'ANNOTATION_ID=\"a' || (ann + i + 1) || '\" ANNOTATION_REF=\"a' || ann || '\"' || "
        "CASE WHEN i > 0 THEN ' PREVIOUS_ANNOTATION=\"a' || (ann + i) || '\"' ELSE '' END",
        value=esc("word"),
    )
    group = f"recording, chunk_no // {PART}"
    word_section = (
        f"UNION ALL SELECT recording, 5, chunk_no // {PART}, string_agg({wd}, '' "
        f"ORDER BY chunk_no, i) FROM words GROUP BY {group}"
        if words
        else ""
    )
    media_line = (
        "'        <MEDIA_DESCRIPTOR MEDIA_URL=\"file://' || " + esc_attr(media)
        + " || '\" MIME_TYPE=\"audio/x-wav\"/>' || chr(10)"
        if media
        else "''"
    )
    ref = f' LANG_REF="{language}"' if language else ""
    lang = (
        f"'    <LANGUAGE LANG_DEF=\"{language}\" LANG_ID=\"{language}\" "
        f"LANG_LABEL=\"{language}\"/>' || {n}"
        if language
        else "''"
    )
    return f"""WITH {EVENTS}, {pre},
facts AS (SELECT c.recording, coalesce(max(t.ann + len(t.words)), 0) AS last_id,
  coalesce(max(len(t.words)), 0) > 0 AS w FROM chunks c LEFT JOIN {tab} t
  ON c.recording = t.recording AND c.chunk_no = t.chunk_no GROUP BY c.recording)
SELECT recording, 0 AS section, 0 AS part_no, '<?xml version="1.0" encoding="UTF-8"?>' || {n}
  || '<ANNOTATION_DOCUMENT AUTHOR="" DATE="{DATE}" FORMAT="3.0" VERSION="3.0"' || {n}
  || '    xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"' || {n}
  || '    xsi:noNamespaceSchemaLocation="http://www.mpi.nl/tools/elan/EAFv3.0.xsd">' || {n}
  || '    <HEADER MEDIA_FILE="" TIME_UNITS="milliseconds">' || {n} || {media_line}
  || '        <PROPERTY NAME="lastUsedAnnotationId">' || last_id || '</PROPERTY>' || {n}
  || '    </HEADER>' || {n} || '    <TIME_ORDER>' || {n} AS body FROM facts
UNION ALL SELECT recording, 1, chunk_no // {PART}, string_agg({slot.format('(2 * k - 1)', 't0')}
  || {slot.format('(2 * k)', 't1')}, '' ORDER BY chunk_no) FROM {tab} GROUP BY {group}
UNION ALL SELECT recording, 2, 0, '    </TIME_ORDER>' || {n}
  || '    <TIER{ref} LINGUISTIC_TYPE_REF="tx" TIER_ID="tx">' || {n} FROM facts
UNION ALL SELECT recording, 3, chunk_no // {PART}, string_agg({tx}, '' ORDER BY chunk_no)
  FROM {tab} GROUP BY {group}
UNION ALL SELECT recording, 4, 0, '    </TIER>' || {n} || CASE WHEN w THEN
  '    <TIER LINGUISTIC_TYPE_REF="word" PARENT_REF="tx" TIER_ID="word">' || {n} ELSE '' END FROM facts
{word_section}
UNION ALL SELECT recording, 6, 0, CASE WHEN w THEN '    </TIER>' || {n} ELSE '' END
  || '    <LINGUISTIC_TYPE GRAPHIC_REFERENCES="false" LINGUISTIC_TYPE_ID="tx" TIME_ALIGNABLE="true"/>'
  || {n} || CASE WHEN w THEN '    <LINGUISTIC_TYPE CONSTRAINTS="Symbolic_Subdivision" '
  || 'GRAPHIC_REFERENCES="false" LINGUISTIC_TYPE_ID="word" TIME_ALIGNABLE="false"/>' || {n}
  ELSE '' END || {lang} || CASE WHEN w THEN '    <CONSTRAINT DESCRIPTION="Symbolic subdivision of '
  || 'a parent annotation. Annotations refering to the same parent are ordered" '
  || 'STEREOTYPE="Symbolic_Subdivision"/>' || {n} ELSE '' END
  || '</ANNOTATION_DOCUMENT>' || {n} FROM facts"""


def _pangloss_doc() -> str:
    form = "CASE WHEN w = '' THEN '<W><FORM /></W>' ELSE '<W><FORM>' || " + esc("w") + " || '</FORM></W>' END"
    body = (
        "'<S id=\"' || recording || '_S' || printf('%03d', k) || '\"><AUDIO start=\"' || "
        "printf('%.1f', start_s) || '\" end=\"' || printf('%.1f', end_s) || "
        "'\" /><FORM kindOf=\"phono\">' || " + esc("prediction") + " || '</FORM>' || "
        f"array_to_string(list_transform(string_split(prediction, ' '), lambda w: {form}), '') || '</S>'"
    )
    return f"""WITH {EVENTS}, all_ AS (SELECT c.recording, count(k.chunk_no) AS n FROM chunks c
  LEFT JOIN kept k ON c.recording = k.recording AND c.chunk_no = k.chunk_no GROUP BY c.recording)
SELECT recording, 0 AS section, 0 AS part_no, '<?xml version=''1.0'' encoding=''utf-8''?>' || chr(10)
  || '<TEXT id="' || recording || '" xml:lang="{LANGUAGE}"' || CASE WHEN n = 0 THEN ' />' ELSE '>' END
  AS body FROM all_
UNION ALL SELECT recording, 1, chunk_no // {PART}, string_agg({body}, '' ORDER BY chunk_no)
  FROM kept GROUP BY recording, chunk_no // {PART}
UNION ALL SELECT recording, 2, 0, '</TEXT>' FROM all_ WHERE n > 0"""


def _resampled() -> str:
    base = 0.99  # of the source rate, which is the lower one
    t = f"greatest(least(((j - 7) - p / 2.0::double) * {base}::double, 6.0), -6.0)"
    kernel = f"""CASE WHEN t = 0 THEN 1 ELSE sin(t * pi()) / (t * pi()) END
      * pow(cos(t * pi() / 12.0), 2) * {base}::double"""
    return f"""WITH {WAVE},
taps AS (SELECT p, j, {kernel} AS h FROM (SELECT p, j, {t} AS t FROM range(2) a(p), range(15) b(j))),
out_ AS (SELECT s.recording, 2 * (s.pos - (j - 7)) + p AS pos, x * h AS part
  FROM points s CROSS JOIN taps)
SELECT o.recording, o.pos, round(sum(part), 3) AS x FROM out_ o JOIN level l
  ON o.recording = l.recording WHERE o.pos >= 0 AND o.pos < 2 * l.n_samples GROUP BY 1, 2"""


def _normalized(fn) -> str:
    return f"WITH {TEXTS} SELECT doc_id, {fn('text')} AS sentence FROM texts"


def all_oracles() -> dict[str, str]:
    kept_nru = f"{NODES}, {_kept(nru('text'), skipped('text'))}"
    kept = f"{NODES}, {_kept(clean('text'), 'false')}"
    why = f"{NODES}, {_why(nru('text'), skipped('text'))}"
    clip_split = f"{CLIPS}, rows_ AS (SELECT * FROM clips), {SPLIT}"
    return {
        "q_clean_markup": _normalized(clean),
        "q_normalize_tdh": _normalized(tdh),
        "q_normalize_nru": _normalized(nru),
        "q_normalize_jya": _normalized(jya),
        "q_normalize_dispatch": f"""WITH {TEXTS} SELECT doc_id, language,
            CASE language WHEN 'tdh' THEN {tdh('text')} WHEN 'nru' THEN {nru('text')}
            WHEN 'jya' THEN {jya('text')} ELSE {clean('text')} END AS sentence FROM texts""",
        "q_registered_language": f"""WITH {TEXTS} SELECT doc_id,
            '<' || {clean("replace(text, 'e', '3')")} || '>' AS sentence FROM texts
            WHERE NOT contains(text, 'peu')""",
        "q_csv_round_trip": f"""WITH {CLIPS} SELECT path, sentence, recording, turn FROM clips""",
        "q_skip_filter": f"""WITH {TEXTS} SELECT doc_id, language FROM texts
            WHERE NOT (coalesce(language, '') = 'nru' AND {skipped('text')})""",
        "q_xml_escape": f"""SELECT page_id, {esc('html')} AS content, {esc_attr('html')} AS attribute
            FROM pages""",
        "q_recording_scan": f"""WITH {FILES}, s AS (SELECT path, stem, suffix,
            lower(suffix) = '.wav' AND NOT starts_with(stem, '_tmp') AS flat,
            suffix = '.wav' AS recursive FROM files) SELECT * FROM s WHERE flat OR recursive""",
        "q_pair_join": f"""WITH {FILES}, c AS (SELECT f.path, x.path AS annotation, row_number()
            OVER (PARTITION BY f.path ORDER BY x.stem = f.stem DESC, x.path) AS rn
            FROM files f LEFT JOIN xmls x ON lower(x.stem) = lower(f.stem))
            SELECT path, annotation FROM c WHERE rn = 1""",
        "q_missing_annotation": f"""WITH {FILES} SELECT path FROM files WHERE lower(stem) NOT IN
            (SELECT lower(stem) FROM xmls)""",
        "q_annotation_spans": f"""WITH {ELEMENTS} SELECT recording, pos, sent_id, text,
            t0::varchar AS t_start, t1::varchar AS t_end FROM spans""",
        "q_annotation_rejects": f"""WITH {ELEMENTS} SELECT recording, reason, count(*) AS n
            FROM nodes WHERE reason IS NOT NULL GROUP BY ALL
            UNION ALL SELECT recording, 'replaced', sum(n - 1)::bigint FROM spans
            GROUP BY recording HAVING sum(n - 1) > 0""",
        "q_empty_annotation": f"""WITH {ELEMENTS} SELECT recording AS stem FROM found
            WHERE recording NOT IN (SELECT recording FROM spans)""",
        "q_manifest": f"WITH {kept_nru} SELECT path, sentence, duration, recording FROM kept",
        "q_rejects": f"WITH {why} SELECT * FROM why WHERE reason IS NOT NULL",
        "q_reject_counts": f"""WITH {why} SELECT reason, count(*) AS n,
            count(DISTINCT recording) AS n_recordings FROM why WHERE reason IS NOT NULL
            GROUP BY reason""",
        "q_duration_filter": f"""WITH {NODES} SELECT recording, sent_id,
            printf('%.3f', duration_s) AS duration FROM timed
            WHERE duration_s > 1 AND duration_s <= 20""",
        "q_total_minutes": f"""WITH {kept} SELECT count(*) AS n_clips, printf('%.1f',
            coalesce(sum(duration_s::decimal(28, 6))::double, 0) / 60) AS minutes FROM kept""",
        "q_clip_window": f"""WITH {kept} SELECT path,
            greatest(trunc(start_s * 16000)::bigint, 0) AS start_sample,
            trunc((end_s + 0.2::double) * 16000)::bigint AS end_sample FROM kept""",
        "q_clip_join": f"""WITH {CLIPS}, {NODES}, stored AS (SELECT recording || '_' || sent_id
            || '.wav' AS path, length(text) AS n_chars FROM nodes WHERE reason IS NULL)
            SELECT c.path, coalesce(s.n_chars, -1) AS n_chars FROM clips c LEFT JOIN stored s ON c.path = s.path""",
        "q_audio_contract": """SELECT c_name || '.wav' AS path, CASE WHEN c_custkey % 9 = 0
            THEN 'not mono' ELSE 'wrong rate' END AS reason FROM customer
            WHERE c_custkey % 9 = 0 OR c_nationkey % 5 = 0""",
        "q_recording_key": f"""WITH {CLIPS} SELECT path, recording FROM clips""",
        "q_group_split": f"WITH {clip_split} SELECT rec AS recording, split FROM members",
        "q_split_rows": f"WITH {clip_split} SELECT path, sentence, split FROM assigned",
        "q_split_summary": f"""WITH {clip_split} SELECT s.split, count(DISTINCT rec) AS n_recordings,
            count(rec) AS n_clips FROM (VALUES ('train'), ('valid'), ('test')) s(split)
            LEFT JOIN assigned a ON a.split = s.split GROUP BY s.split""",
        "q_split_leakage": f"""WITH {CLIPS}, rows_ AS (SELECT recording || 't' || turn || '_S1.wav'
            AS path, recording FROM clips), {SPLIT} SELECT recording, min(split) AS first_split,
            max(split) AS last_split, count(*) AS n_clips FROM assigned GROUP BY recording
            HAVING min(split) <> max(split)""",
        "q_vocab": f"WITH {FULL_VOCAB} SELECT char, id FROM vocab",
        "q_vocab_json": f"""WITH {FULL_VOCAB} SELECT '{{' || string_agg(to_json(char)::varchar || ':'
            || id, ',' ORDER BY id) || '}}' AS json FROM vocab""",
        "q_label_encode": f"""WITH {FULL_VOCAB}, {TEXTS}, m AS (SELECT map(list(char), list(id)) AS m
            FROM vocab) SELECT doc_id, array_to_string(list_transform(list_filter(string_split(
            replace(text, ' ', '|'), ''), lambda c: c <> ''), lambda c:
            coalesce(m[c], m['[UNK]'])), ' ') AS labels FROM texts, m""",
        "q_label_decode": f"""WITH {FULL_VOCAB}, {CLIPS}, m AS (SELECT list(char) AS known FROM chars)
            SELECT path, trim(array_to_string(list_transform(string_split(sentence || '漢 @', ''), lambda c:
            CASE WHEN c IN (' ', '|') THEN ' ' WHEN list_contains(known, c) THEN c ELSE '[UNK]' END),
            ''), {_ENDS}) AS sentence FROM clips, m""",
        "q_feature_scale": """WITH e AS (SELECT vec_id, unnest(range(64)) AS pos,
            unnest(embedding)::double AS x FROM embeddings), m AS (SELECT vec_id, avg(x) AS mu,
            var_pop(x) AS va FROM e GROUP BY vec_id) SELECT vec_id, pos,
            round((x - mu) / sqrt(va + 1e-7), 5) AS x FROM e JOIN m USING (vec_id)""",
        "q_length_batches": f"""WITH {ENCODED} SELECT utt, shard, batch_no, n AS n_values
            FROM batched""",
        "q_pad_batches": f"""WITH {ENCODED}, longest AS (SELECT *,
            ((max(n) OVER w + 15) // 16) * 16 AS n_in, max(len(labels)) OVER w AS n_lab
            FROM batched WINDOW w AS (PARTITION BY shard, batch_no))
            SELECT utt, n_in AS n_values, round(list_sum(list_transform(string_split(text, ''),
            lambda c: unicode(c) / 128)), 4) AS sum_values, n_in AS n_mask, n AS sum_mask,
            array_to_string(list_concat(labels, list_transform(range(n_lab - len(labels)),
            lambda i: -100)), ' ') AS labels FROM longest""",
        "q_padding_options": f"""WITH {ENCODED}, longest AS (SELECT *,
            greatest(max(n) OVER w, 300) AS n_in,
            ((greatest(max(len(labels)) OVER w, 40) + 7) // 8) * 8 AS n_lab
            FROM batched WINDOW w AS (PARTITION BY shard, batch_no))
            SELECT utt, n_in AS n_values, n AS sum_mask, n_lab AS n_labels,
            n_lab - len(labels) AS n_ignored FROM longest""",
        "q_pcm_decode": f"""WITH {WAVE} SELECT recording, pos, x / 32768 AS x FROM points""",
        "q_ctc_decode": f"""WITH src AS (SELECT vec_id AS utt, embedding FROM embeddings),
            {_ctc('embedding', 'utt, embedding')} SELECT utt,
            coalesce(trim(replace(t, '|', ' ')), '') AS prediction FROM texts""",
        "q_transcribe": f"""WITH {WAVE}, src AS (SELECT * FROM blocks),
            {_ctc('samples', 'recording, block_no, samples')} SELECT recording,
            block_no AS chunk_no, 64::bigint AS n_samples, coalesce(trim(replace(t, '|', ' ')), '')
            AS prediction FROM texts""",
        "q_wer": f"""{WORD_PAIRS} SELECT count(*) AS n_pairs, sum(edits)::bigint AS edits,
            sum(ref_words)::bigint AS ref_words, round(sum(edits) / sum(ref_words), 6) AS wer
            FROM scored""",
        "q_wer_by_recording": f"""{WORD_PAIRS} SELECT conv_id, count(*) AS n_pairs,
            sum(edits)::bigint AS edits, sum(ref_words)::bigint AS ref_words,
            round(sum(edits) / sum(ref_words), 6) AS wer FROM scored GROUP BY conv_id""",
        "q_cer": f"""{CHAR_PAIRS} SELECT count(*) AS n_pairs, sum(edits)::bigint AS edits,
            sum(ref_chars)::bigint AS ref_chars, round(sum(edits) / sum(ref_chars), 6) AS cer
            FROM scored""",
        "q_cer_by_role": f"""{CHAR_PAIRS} SELECT role, count(*) AS n_pairs,
            sum(edits)::bigint AS edits, sum(ref_chars)::bigint AS ref_chars,
            round(sum(edits) / sum(ref_chars), 6) AS cer FROM scored GROUP BY role""",
        "q_best_step": """WITH r AS (SELECT user_id, event_id, value, row_number() OVER
            (PARTITION BY user_id ORDER BY value, event_id) AS rn FROM events)
            SELECT user_id AS run, event_id AS best_step, value AS best_wer FROM r WHERE rn = 1""",
        "q_early_stop": """WITH h AS (SELECT user_id AS run, event_id AS step, value AS wer,
            row_number() OVER w AS n, min(value) OVER (PARTITION BY user_id ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM events
            WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
            i AS (SELECT *, max(CASE WHEN best IS NULL OR wer < best THEN n END) OVER
            (PARTITION BY run ORDER BY step) AS improved FROM h)
            SELECT run, count(*) AS n_evals, coalesce(min(step) FILTER (WHERE n - improved >= 10), -1)
            AS stop_step
            FROM i GROUP BY run""",
        "q_latest_checkpoint": """SELECT user_id AS run, max(event_id) AS number,
            'checkpoint-' || max(event_id) AS checkpoint FROM events GROUP BY user_id""",
        "q_downmix": """SELECT vec_id, unnest(range(32)) AS pos, unnest(list_transform(range(1, 33),
            lambda i: round((embedding[i]::double + embedding[i + 32]::double) / 2, 6))) AS mean,
            unnest(list_transform(embedding[1:32], lambda x: round(x::double, 6))) AS first
            FROM embeddings""",
        "q_frame_energy": f"WITH {WAVE} SELECT recording, ms, energy FROM energy",
        "q_dbfs": f"""WITH {WAVE} SELECT recording, n_samples, length_ms, rms, CASE WHEN rms > 0
            THEN round(20 * log10(rms / 32768), 6) END AS dbfs FROM level""",
        "q_silence_ranges": f"WITH {WAVE}, {SILENCE} SELECT recording, start_ms, end_ms FROM ranges",
        "q_chunks": f"""WITH {WAVE}, {SILENCE} SELECT recording, chunk_no,
            printf('chunk_%06d.wav', chunk_no) AS chunk, start_ms, end_ms FROM chunks""",
        "q_source_times": f"""WITH {WAVE}, {SILENCE} SELECT recording, chunk_no,
            start_ms / 1000 AS start_s, end_ms / 1000 AS end_s, (end_ms - start_ms) / 1000
            AS duration_s FROM chunks""",
        "q_truncate": f"""WITH {WAVE} SELECT recording, block_no, len(samples[1:40]) AS n,
            list_sum(samples[1:40])::bigint AS total FROM blocks""",
        "q_chunk_duration": f"""WITH {EVENTS} SELECT recording, chunk_no, capped / 1000 AS duration_s
            FROM chunks""",
        "q_clip_samples": f"""WITH {WAVE}, spans AS (SELECT printf('clip%07d.wav', vec_id) AS path,
            printf('rec%05d', vec_id // {RECORDING_BLOCKS}) AS recording,
            trunc((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 0.5::double) / 1000 * 16000)::bigint AS a,
            trunc(((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 5 + vec_id % 23) / 1000::double
              + 0.002::double) * 16000)::bigint AS b FROM embeddings)
            SELECT path, count(*) AS n, sum(x)::bigint AS total, min_by(x, pos) AS first,
            max_by(x, pos) AS last FROM spans s JOIN points p ON s.recording = p.recording
            AND pos >= a AND pos < b GROUP BY path""",
        "q_wav_round_trip": f"""WITH {WAVE}, spans AS (SELECT printf('clip%07d.wav', vec_id) AS path,
            printf('rec%05d', vec_id // {RECORDING_BLOCKS}) AS recording,
            trunc((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 0.5::double) / 1000 * 16000)::bigint AS a,
            trunc(((vec_id % {RECORDING_BLOCKS} * {BLOCK_MS} + 5 + vec_id % 23) / 1000::double
              + 0.002::double) * 16000)::bigint AS b FROM embeddings)
            SELECT path, count(*) AS n, sum(x)::bigint AS total, min_by(x, pos) AS first,
            max_by(x, pos) AS last FROM spans s JOIN points p ON s.recording = p.recording
            AND pos >= a AND pos < b GROUP BY path""",
        "q_clip_files": f"""WITH {WAVE}, {CLIP_BYTES} SELECT file, (44 + 2 * n)::bigint AS bytes,
            md5(from_hex(header || body)) AS md5 FROM clip_bytes""",
        "q_ordered_scan": f"""WITH {CLIPS} SELECT path, recording, row_number() OVER
            (ORDER BY path, recording) - 1 AS pos FROM clips""",
        "q_listing": """WITH groups AS (SELECT DISTINCT vec_id // 25 AS k FROM embeddings),
            named AS (SELECT k % 97 AS length, k % 5 = 0 AS top,
            CASE WHEN k % 7 = 3 THEN '_tmp' ELSE '' END || 'take' || k AS base,
            CASE k % 4 WHEN 0 THEN '.wav' WHEN 1 THEN '.WAV' WHEN 2 THEN '.xml'
              ELSE '.wav.txt' END AS ending,
            CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'd' || k % 7 || '/'
              ELSE 'd' || k % 7 || '/n' || k % 11 || '/' END AS folder FROM groups),
            kinds AS (SELECT *, unnest(['deep', 'flat', 'annotation']) AS kind FROM named)
            SELECT kind, folder || base || ending AS path, base AS stem, length FROM kinds
            WHERE CASE kind WHEN 'deep' THEN ending = '.wav' WHEN 'flat' THEN top
              AND lower(ending) = '.wav' AND NOT starts_with(base, '_tmp')
              ELSE top AND ending = '.xml' END""",
        "q_checkpoint_listing": """WITH groups AS (SELECT DISTINCT vec_id // 25 AS k FROM embeddings)
            SELECT 'checkpoint-' || k * 50 AS name, 'checkpoint-' || max(k * 50) OVER () AS checkpoint
            FROM groups WHERE k % 3 <> 0""",
        "q_training_rows": f"""WITH {WAVE}, {LABELLED}, own AS (SELECT path, avg(x / 32768) AS mu,
            var_pop(x / 32768) AS va, min_by(x, pos) AS x0, max_by(x, pos) AS x1 FROM batched s
            JOIN points p ON s.recording = p.recording AND pos >= a AND pos < b GROUP BY path),
            longest AS (SELECT *, max(b - a) OVER w AS n_values, max(len(labels)) OVER w AS n_lab
            FROM batched WINDOW w AS (PARTITION BY shard, batch_no))
            SELECT path, shard, batch_no, n_values, b - a AS n_own,
            round(((x0 / 32768 - mu) / sqrt(va + 1e-7))::float::double, 4) + 0.0::double AS first,
            round(((x1 / 32768 - mu) / sqrt(va + 1e-7))::float::double, 4) + 0.0::double AS last,
            round(va / (va + 1e-7), 3) AS power, array_to_string(list_concat(labels,
            list_transform(range(n_lab - len(labels)), lambda i: -100)), ' ') AS labels
            FROM longest JOIN own USING (path)""",
        "q_resample": _resampled(),
        "q_timeline": f"""WITH {EVENTS} SELECT recording, chunk_no, (t1 - capped) / 1000 AS start_s,
            t1 / 1000 AS end_s, capped / 1000 AS duration_s FROM timed""",
        "q_prediction_table": f"""WITH {EVENTS} SELECT recording,
            printf('chunk_%06d.wav', chunk_no) AS "Chunk", coalesce(prediction, '') AS "Prediction",
            (t1 - capped) / 1000 AS "Start", t1 / 1000 AS "End", capped / 1000 AS "Duration"
            FROM timed""",
        "q_nonempty": f"""WITH {EVENTS} SELECT recording, chunk_no, prediction FROM chunks
            WHERE prediction <> ''""",
        "q_plain_text": f"""WITH {EVENTS} SELECT recording, 1 AS section, chunk_no // {PART} AS part_no,
            string_agg(' ' || prediction, '' ORDER BY chunk_no) AS body FROM kept
            GROUP BY recording, chunk_no // {PART}""",
        "q_document_files": f"""WITH {EVENTS}, parts AS (SELECT recording, chunk_no // {PART} AS part_no,
            string_agg(' ' || prediction, '' ORDER BY chunk_no) AS body FROM kept
            GROUP BY recording, chunk_no // {PART})
            SELECT '{AUDIO_ROOT}_result/' || recording || '.txt' AS file, part_no,
            octet_length(encode(body))::bigint AS bytes, md5(body) AS md5 FROM parts""",
        "q_prediction_csv": f"""WITH {EVENTS}, fields AS (SELECT recording, chunk_no,
            coalesce(prediction, '') AS p, (t1 - capped) / 1000 AS a, t1 / 1000 AS b,
            capped / 1000 AS d FROM timed),
            lines AS (SELECT recording, chunk_no, printf('chunk_%06d.wav', chunk_no) || ','
              || CASE WHEN regexp_matches(p, '[",\r\n]')
                 THEN '"' || replace(p, '"', '""') || '"' ELSE p END
              || ',' || a || ',' || b || ',' || d || chr(10) AS line FROM fields)
            SELECT recording, 1 AS section, chunk_no // {PART} AS part_no,
            string_agg(line, '' ORDER BY chunk_no) AS body FROM lines
            GROUP BY recording, chunk_no // {PART}
            UNION ALL SELECT DISTINCT recording, 0, 0, 'Chunk,Prediction,Start,End,Duration' || chr(10)
            FROM chunks""",
        "q_pangloss_rows": f"""WITH {EVENTS} SELECT recording, chunk_no, recording || '_S'
            || printf('%03d', k) AS sentence_id, printf('%.1f', start_s) AS t_start,
            printf('%.1f', end_s) AS t_end, prediction FROM kept""",
        "q_pangloss_words": f"""WITH {EVENTS}, w AS (SELECT recording, recording || '_S'
            || printf('%03d', k) AS sentence_id, string_split(prediction, ' ') AS words FROM kept)
            SELECT recording, sentence_id, unnest(range(len(words))) AS pos, unnest(words) AS word
            FROM w""",
        "q_pangloss_doc": _pangloss_doc(),
        "q_eaf_slots": f"""WITH {EVENTS} SELECT recording, 'ts' || (2 * k - 1) AS ts_id, t0 AS ms
            FROM kept UNION ALL SELECT recording, 'ts' || (2 * k), t1 FROM kept""",
        "q_eaf_phono": f"""WITH {EVENTS}, {NUMBERED} SELECT recording, 'a' || ann AS ann_id,
            'ts' || (2 * k - 1) AS ts1, 'ts' || (2 * k) AS ts2, prediction AS value FROM numbered""",
        "q_eaf_words": f"""WITH {EVENTS}, {NUMBERED} SELECT recording, 'a' || (ann + i + 1) AS ann_id,
            'a' || ann AS parent, CASE WHEN i > 0 THEN 'a' || (ann + i) END AS prev, word AS value
            FROM words""",
        "q_eaf_doc": _eaf(True, LANGUAGE, f"'{AUDIO_ROOT}/' || recording || '.wav'"),
        "q_eaf_doc_plain": _eaf(False, None, None),
        "q_result_path": f"""WITH {FILES} SELECT path, replace(left(path, length(path)
            - length(suffix)), '{AUDIO_ROOT}', '{AUDIO_ROOT}_result') || '.tsv' AS table_file,
            replace(left(path, length(path) - length(suffix)), '{AUDIO_ROOT}',
            '{AUDIO_ROOT}_result') || '.eaf' AS tier_file FROM files""",
    }
