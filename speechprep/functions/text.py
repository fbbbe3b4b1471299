"""Text cleanup as Column expressions.

Every language is a pair of native steps around one shared cleanup: ``before``
rewrites the raw transcript, then markup is removed, the text is composed (NFC)
and white space is collapsed, then ``after`` may finish the text. Spark has no
function for NFC, so that step is an Arrow UDF; keeping it in the shared part
means a table that mixes languages makes one trip to Python.

White space and digits are spelled out as code point classes, because the
``\\s`` of the JVM knows fewer characters than Unicode white space does. In
classes, single Latin characters and one outer range for all the others keep the
test that almost every character fails down to one comparison.
"""

from __future__ import annotations

import re
import unicodedata
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .values import once

ColumnFn = Callable[[Column], Column]

# ---------------------------------------------------------------- fixed values
# Unicode white space, as members of a character class.
WS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# Ideographs removed from jya transcripts, as members of a character class.
HAN = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2FA1F}"
# Punctuation deleted for every language.
PUNCTUATION = ",;!?"
# Characters deleted from tdh transcripts.
TDH_DELETED = '"=_/§X'
# Characters deleted from nru transcripts.
NRU_DELETED = "FD<>"
# Characters deleted from jya transcripts.
JYA_DELETED = "\"“”'=_/\\&#%|ǀ+<>:：（），？\ufeff\u200b\u200c\u200d"
# Brackets deleted from jya transcripts once their contents are gone.
JYA_BRACKETS = "()[]{}"
# Private-use stand-in that carries an apostrophe through the jya deletions.
JYA_APOSTROPHE = "\ue000"
# Raw nru transcripts holding one of these are not used.
NRU_SKIPPED = ("fin peu audible", "BEGAIEMENT")
# Bytes of texts that go through NFC, and back to Spark, together.
COMPOSED_BYTES = 1 << 20
# -----------------------------------------------------------------------------

# The same white space for the JVM only: Latin members, then the rest in a range.
SPACES = (
    rf"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0[\x{{1680}}-\x{{3000}}&&[{WS}]]]+"
)


def _compose_and_collapse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Strings take several times the room of the batch they came in, so about
    ``COMPOSED_BYTES`` of a batch are strings at a time."""
    normalize = unicodedata.normalize
    for batch in batches:
        rows = max(1, len(batch) * COMPOSED_BYTES // max(1, batch.nbytes))
        for start in range(0, len(batch), rows):
            texts = batch.slice(start, rows).to_pylist()
            yield pa.array(
                [None if t is None else " ".join(normalize("NFC", t).split()) for t in texts],
                pa.string(),
            )


# Declared non-deterministic so that Catalyst neither copies the call into filters
# on its result nor runs the steps before it twice.
_composed = F.arrow_udf(_compose_and_collapse, T.StringType()).asNondeterministic()


def delete_chars(text: Column, chars: str, more: str = "") -> Column:
    """Delete every one of ``chars``, and what the class members ``more`` match."""
    latin = [c for c in chars if ord(c) < 0x100]
    other = [c for c in chars if ord(c) >= 0x100]
    members = re.sub(r"([^\w\s])", r"\\\1", "".join(latin)) + more
    if other:
        listed = "".join(rf"\x{{{ord(c):X}}}" for c in other)
        members += rf"[\x{{{ord(min(other)):X}}}-\x{{{ord(max(other)):X}}}&&[{listed}]]"
    return F.regexp_replace(text, f"[{members}]", "")


def collapse_spaces(text: Column) -> Column:
    """White-space runs become one space; the ends are stripped."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def _where_any(text: Column, marks: tuple[str, ...], fix: ColumnFn) -> Column:
    """``fix(text)`` where the text holds one of the marks. Looking for a mark is
    far cheaper than a regex pass, and most texts hold none."""

    def guarded(t: Column) -> Column:
        found = reduce(or_, [F.contains(t, F.lit(m)) for m in marks])
        return F.when(found, fix(t)).otherwise(t)

    return once(text, guarded)


def strip_markup(text: Column, punctuation: bool = True) -> Column:
    """Remove bracketed notes (within one line) and punctuation."""
    text = _where_any(text, ("]",), lambda t: F.regexp_replace(t, r"\[[^\n]*?\]", ""))
    text = _where_any(text, (")",), lambda t: F.regexp_replace(t, r"\([^\n]*?\)", ""))
    return delete_chars(text, PUNCTUATION) if punctuation else text


def clean_markup(text: Column, compose: bool = True, punctuation: bool = True) -> Column:
    """The cleanup every language shares. Not idempotent: apply it once. Punctuation may
    be gone already: it ends no bracketed note, so it can go before or after these."""
    text = strip_markup(text, punctuation)
    return _composed(text) if compose else collapse_spaces(text)


def _replace(text: Column, old: str, new: str = "") -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _spaced_runs(text: Column, between: str = "") -> Column:
    """Dashes in a row, and dots, become a space, which is collapsed later. Members of
    the class ``between`` are about to be deleted and part no run; the deletion of all
    else that goes, single dashes too, can then be one pass."""
    gap = f"[{between}]*" if between else ""
    runs = rf"-{gap}-[-{between}]*|[.…][.…{between}]*"
    return _where_any(text, ("-", ".", "…"), lambda t: F.regexp_replace(t, runs, " "))


def _before_tdh(text: Column) -> Column:
    text = _spaced_runs(text)
    text = _replace(text, ":", "\u02d0")
    text = _replace(text, "\u1dc9", "\u0303")
    return delete_chars(text, "-\u0335" + TDH_DELETED + PUNCTUATION)


def _before_nru(text: Column) -> Column:
    text = _replace(text, "...", "…")
    text = _replace(text, "◊", "|")
    text = delete_chars(text, NRU_DELETED)
    text = _where_any(text, ("m…",), lambda t: F.regexp_replace(t, "m+…", "mmm…"))
    return _where_any(text, ("ʰʰ",), lambda t: F.regexp_replace(t, "ʰ+", "ʰ"))


def _before_jya(text: Column) -> Column:
    ideograph = rf"[\x{{3400}}-\x{{2FA1F}}&&[{HAN}]]"
    # an apostrophe inside an @word is kept, any other one is deleted below
    kept = F.regexp_replace(text, rf"((?:@|\G(?!\A))[^{WS}']*)'", f"$1{JYA_APOSTROPHE}")
    # @word followed by its gloss in ideographs: keep the word only
    word = F.regexp_replace(kept, rf"@([^{WS}]+)[{WS}]*{ideograph}+", "$1")
    text = F.when(F.contains(text, F.lit("@")), word).otherwise(text)
    text = _spaced_runs(text, f"@X{ideograph}")
    text = _replace(text, "\u0261", "g")
    text = delete_chars(text, "-@X" + JYA_DELETED + PUNCTUATION, rf"\p{{Nd}}{ideograph}")
    return F.lower(text)


def _after_jya(text: Column) -> Column:
    # the text has no white space but single spaces here
    text = _replace(delete_chars(text, JYA_BRACKETS), JYA_APOSTROPHE, "'")
    return F.trim(_where_any(text, ("  ",), lambda t: F.regexp_replace(t, "  +", " ")))


@dataclass(frozen=True)
class Language:
    """Language-specific steps around the shared cleanup."""

    before: ColumnFn
    after: ColumnFn | None = None
    bare: bool = False  # ``before`` has deleted the shared punctuation


_NORMALIZERS: dict[str, Language] = {
    "tdh": Language(_before_tdh, bare=True),
    "nru": Language(_before_nru),
    "jya": Language(_before_jya, _after_jya, bare=True),
}

_SKIPS: dict[str, ColumnFn] = {
    "nru": lambda text: F.contains(text, F.lit(NRU_SKIPPED[0]))
    | F.contains(text, F.lit(NRU_SKIPPED[1])),
}


def register_normalizer(code: str, before: ColumnFn, after: ColumnFn | None = None) -> None:
    """Add or replace a language. ``before`` and ``after`` map Column to Column;
    a pandas or arrow UDF is accepted too."""
    _NORMALIZERS[code] = Language(before, after)


def register_skip(code: str, predicate: ColumnFn) -> None:
    """Add or replace the predicate that drops raw transcripts of a language."""
    _SKIPS[code] = predicate


def _by_language(language, table: dict[str, ColumnFn], value: Column, default: Column) -> Column:
    """Choose per run (``language`` is a code or None) or per row (a Column)."""
    if not isinstance(language, Column):
        fn = table.get(language) if language is not None else None
        return fn(value) if fn else default
    chosen = None
    for code, fn in table.items():
        branch = chosen.when if chosen is not None else F.when
        chosen = branch(language == code, fn(value))
    return chosen.otherwise(default) if chosen is not None else default


def normalize(text: Column, language: str | Column | None = None, compose: bool = True) -> Column:
    """Normalise a transcript for a language; unknown codes get the shared
    cleanup only. ``compose=False`` leaves NFC out, which keeps the expression
    native."""
    if isinstance(language, str) and language not in _NORMALIZERS:
        warnings.warn(f"no normalizer for {language!r}: shared cleanup only", stacklevel=2)
    before = {code: lang.before for code, lang in _NORMALIZERS.items()}
    after = {code: lang.after for code, lang in _NORMALIZERS.items() if lang.after}
    bare = isinstance(language, str) and language in _NORMALIZERS and _NORMALIZERS[language].bare
    text = clean_markup(_by_language(language, before, text, text), compose, not bare)
    if not isinstance(language, Column):
        return _by_language(language, after, text, text)
    # the branches share one cleaned text
    return once(text, lambda t: _by_language(language, after, t, t))


def is_blank(text: Column, language: str | Column | None = None) -> Column:
    """True where :func:`normalize` gives the empty string. NFC never blanks a
    text, so this stays native."""
    return normalize(text, language, compose=False) == ""


def is_skipped(text: Column, language: str | Column | None = None) -> Column:
    """True where the raw transcript is marked as unusable for its language."""
    return _by_language(language, _SKIPS, text, F.lit(False))


def escape_text(text: Column) -> Column:
    """XML element content."""
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def escape_attribute(text: Column) -> Column:
    """XML attribute value in double quotes."""
    return F.replace(escape_text(text), F.lit('"'), F.lit("&quot;"))


def split_on_space(text: Column) -> Column:
    """Words between single spaces; two spaces in a row give an empty word."""
    return F.split(text, " ")


def split_words(text: Column) -> Column:
    """Words between white-space runs; no empty words."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")

