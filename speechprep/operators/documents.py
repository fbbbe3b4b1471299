"""Transcript documents from timed predictions: text, annotation XML, tier XML.

A document is text in order, and a long recording may give a very long one. So
documents are produced as parts: rows ``recording, section, part_no, body``
whose bodies, concatenated in (section, part_no) order, are the document. A part
covers a fixed range of chunk numbers, so no task ever holds more than that of a
recording. The relations behind a tier document (slots, annotations, words) are
available as tables too.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import values as v
from . import running
from .timeline import chunk_file, non_empty, timed_by

PART = 4_096  # chunk numbers per document part

# ---------------------------------------------------------------- fixed values
XML_DECLARATION = "<?xml version='1.0' encoding='utf-8'?>\n"
EAF_OPENING = '''<?xml version="1.0" encoding="UTF-8"?>
<ANNOTATION_DOCUMENT AUTHOR="" DATE="{date}" FORMAT="3.0" VERSION="3.0"
    xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"
    xsi:noNamespaceSchemaLocation="http://www.mpi.nl/tools/elan/EAFv3.0.xsd">
    <HEADER MEDIA_FILE="" TIME_UNITS="milliseconds">
{media}        <PROPERTY NAME="lastUsedAnnotationId">{last_id}</PROPERTY>
    </HEADER>
    <TIME_ORDER>
'''
EAF_MEDIA = '''        <MEDIA_DESCRIPTOR MEDIA_URL="file://{media}" MIME_TYPE="audio/x-wav"/>
'''
EAF_SLOT = '''        <TIME_SLOT TIME_SLOT_ID="{slot}" TIME_VALUE="{ms}"/>
'''
EAF_TX_TIER = '''    </TIME_ORDER>
    <TIER{language} LINGUISTIC_TYPE_REF="tx" TIER_ID="tx">
'''
EAF_TIER_LANGUAGE = ' LANG_REF="{code}"'
EAF_SENTENCE = '''        <ANNOTATION>
            <ALIGNABLE_ANNOTATION ANNOTATION_ID="{id}" TIME_SLOT_REF1="{from_slot}" TIME_SLOT_REF2="{to_slot}">
                <ANNOTATION_VALUE>{value}</ANNOTATION_VALUE>
            </ALIGNABLE_ANNOTATION>
        </ANNOTATION>
'''
EAF_TIER_END = "    </TIER>\n"
EAF_WORD_TIER = '''    <TIER LINGUISTIC_TYPE_REF="word" PARENT_REF="tx" TIER_ID="word">
'''
EAF_WORD = '''        <ANNOTATION>
            <REF_ANNOTATION ANNOTATION_ID="{id}" ANNOTATION_REF="{parent}"{previous}>
                <ANNOTATION_VALUE>{value}</ANNOTATION_VALUE>
            </REF_ANNOTATION>
        </ANNOTATION>
'''
EAF_PREVIOUS = ' PREVIOUS_ANNOTATION="{id}"'
EAF_TX_TYPE = '''    <LINGUISTIC_TYPE GRAPHIC_REFERENCES="false" LINGUISTIC_TYPE_ID="tx" TIME_ALIGNABLE="true"/>
'''
EAF_WORD_TYPE = '''    <LINGUISTIC_TYPE CONSTRAINTS="Symbolic_Subdivision" GRAPHIC_REFERENCES="false" LINGUISTIC_TYPE_ID="word" TIME_ALIGNABLE="false"/>
'''
EAF_LANGUAGE = '''    <LANGUAGE LANG_DEF="{code}" LANG_ID="{code}" LANG_LABEL="{code}"/>
'''
EAF_CONSTRAINT = '''    <CONSTRAINT DESCRIPTION="Symbolic subdivision of a parent annotation. Annotations refering to the same parent are ordered" STEREOTYPE="Symbolic_Subdivision"/>
'''
EAF_CLOSING = "</ANNOTATION_DOCUMENT>\n"
# -----------------------------------------------------------------------------

_WORDS = "_words"


def _text(*pieces: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def _fill(form: str, **values: Column | str) -> Column:
    """A form with columns, or texts, in its ``{places}``."""
    pieces = re.split(r"\{(\w+)\}", form)
    return _text(*(values[p] if i % 2 else p for i, p in enumerate(pieces) if i % 2 or p))


def _corpus() -> Column:
    """A document is named after its recording, without folders."""
    return v.file_name(F.col("recording"))


def _parts(pieces: DataFrame, section: int, body: str, part: int) -> DataFrame:
    """Concatenate one text column in chunk order, one row per part."""
    joined = F.expr(f"listagg(`{body}`, '') within group (order by chunk_no)")
    return pieces.groupBy("recording", F.col(running.block_col(part)).alias("part_no")).agg(
        joined.alias("body")
    ).select("recording", F.lit(section).alias("section"), "part_no", "body")


def _edge(facts: DataFrame, section: int, body: Column) -> DataFrame:
    """A section that is one short row per recording."""
    return facts.select(
        "recording",
        F.lit(section).alias("section"),
        F.lit(0).cast("bigint").alias("part_no"),
        body.alias("body"),
    )


# ------------------------------------------------------------------ plain text


def plain_text(
    predictions: DataFrame, recordings: DataFrame | None = None, part: int = PART
) -> DataFrame:
    """Texts in order, a space before each. With ``recordings``, those without any
    text get an empty document."""
    pieces = running.with_block(non_empty(predictions), "chunk_no", part)
    body = _parts(pieces.withColumn("_body", _text(" ", F.col("prediction"))), 1, "_body", part)
    if recordings is None:
        return body
    return _edge(recordings, 0, F.lit("")).unionByName(body)


# ------------------------------------------------------------ prediction table

TABLE_COLUMNS = ("Chunk", "Prediction", "Start", "End", "Duration")


def _csv_field(value: Column) -> Column:
    quoted = _text('"', F.replace(value, F.lit('"'), F.lit('""')), '"')
    return F.when(value.rlike('[",\\r\\n]'), quoted).otherwise(value)


def prediction_csv(predictions: DataFrame, recordings: DataFrame, part: int = PART) -> DataFrame:
    """Prediction tables as comma separated documents, header first."""
    table = running.with_block(predictions, "chunk_no", part)
    cells = [
        chunk_file(F.col("chunk_no")),
        F.coalesce("prediction", F.lit("")),
        *[F.col(c).cast("string") for c in ("start_s", "end_s", "duration_s")],
    ]
    line = _text(F.concat_ws(",", *map(_csv_field, cells)), "\n")
    header = _edge(recordings, 0, F.lit(",".join(TABLE_COLUMNS) + "\n"))
    return header.unionByName(_parts(table.withColumn("_body", line), 1, "_body", part))


# -------------------------------------------------------------- annotation XML


def sentences(predictions: DataFrame, part: int = PART) -> DataFrame:
    """Non-empty predictions numbered from 1, with a sentence id."""
    kept = non_empty(predictions)
    numbered = running.before(
        kept, ["recording"], "chunk_no", {"_earlier": ("sum", F.lit(1))}, part
    )
    return (
        numbered.withColumn("sentence_no", F.col("_earlier") + 1)
        .withColumn("sentence_id", v.numbered("%s_S%03d", _corpus(), F.col("sentence_no")))
        .drop("_earlier")
    )


def sentence_words(numbered: DataFrame) -> DataFrame:
    """One row per word of a sentence, split on single spaces."""
    return numbered.select(
        "recording",
        "sentence_id",
        F.posexplode(tx.split_on_space(F.col("prediction"))).alias("pos", "word"),
    )


def _form(text: Column, attributes: str = "") -> Column:
    """A FORM element; an empty one is written short."""
    return F.when(text == "", F.lit(f"<FORM{attributes} />")).otherwise(
        _text(f"<FORM{attributes}>", tx.escape_text(text), "</FORM>")
    )


def sentence_element(numbered: DataFrame) -> Column:
    words = F.transform(
        tx.split_on_space(F.col("prediction")), lambda w: _text("<W>", _form(w), "</W>")
    )
    return _text(
        '<S id="', _xml_attribute(F.col("sentence_id")),
        '"><AUDIO start="', v.format_seconds(F.col("start_s"), 1),
        '" end="', v.format_seconds(F.col("end_s"), 1), '" />',
        _form(F.col("prediction"), ' kindOf="phono"'),
        F.array_join(words, ""),
        "</S>",
    )


def _xml_attribute(value: Column) -> Column:
    """Attribute text that survives attribute-value normalisation."""
    escaped = tx.escape_attribute(value)
    for char, code in (("\r", "&#13;"), ("\n", "&#10;"), ("\t", "&#09;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    return escaped


def annotation_xml(
    predictions: DataFrame, recordings: DataFrame, language: str, part: int = PART
) -> DataFrame:
    """Annotation documents as parts. ``recordings`` lists every recording that
    gets a document, also those without any text."""
    numbered = sentences(predictions, part)
    body = _parts(numbered.withColumn("_body", sentence_element(numbered)), 1, "_body", part)
    counts = non_empty(predictions).groupBy("recording").agg(F.count("*").alias("n"))
    facts = recordings.select("recording").join(counts, "recording", "left")
    tag = _text(
        '<TEXT id="', _xml_attribute(_corpus()),
        '" xml:lang="', _xml_attribute(F.lit(language)), '"',
    )
    empty = F.col("n").isNull()
    opening = _edge(facts, 0, _text(XML_DECLARATION, tag, F.when(empty, " />").otherwise(">")))
    closing = _edge(facts.filter(~empty), 2, F.lit("</TEXT>"))
    return opening.unionByName(body).unionByName(closing)


# -------------------------------------------------------------------- tier XML


def _with_words(predictions: DataFrame, words: bool) -> DataFrame:
    split = tx.split_words(F.col("prediction")) if words else F.array().cast("array<string>")
    return non_empty(predictions).withColumn(_WORDS, split)


def annotations(predictions: DataFrame, words: bool = True, part: int = PART) -> DataFrame:
    """Number sentences, their annotations and time slots.

    Sentences and words share one counter: a sentence comes first, then its
    words. Adds ``sentence_no``, ``ann_no`` and the word list.
    """
    return running.before(
        _with_words(predictions, words),
        ["recording"],
        "chunk_no",
        {
            "sentence_no": ("sum", F.lit(1)),
            "ann_no": ("sum", F.size(_WORDS) + 1),
        },
        part,
    ).withColumns(
        {
            "sentence_no": F.col("sentence_no") + 1,
            "ann_no": F.col("ann_no") + 1,
            "start_ms": v.to_millis(F.col("start_s")),
            "end_ms": v.to_millis(F.col("end_s")),
        }
    )


def timed_annotations(
    chunks: DataFrame, length: str, per_second: int, words: bool = True, part: int = PART
) -> DataFrame:
    """``annotations`` of chunks that are not timed yet: start, end and numbers come
    from one running sum over ``recording, chunk_no`` with the chunks' lengths."""
    split = tx.split_words(F.col("prediction")) if words else F.array().cast("array<string>")
    has_text = F.coalesce(F.col("prediction") != "", F.lit(False))
    listed = F.when(has_text, split).otherwise(F.array().cast("array<string>"))
    summed = running.before(
        chunks.withColumns({"_kept": has_text.cast("int"), _WORDS: listed}),
        ["recording"],
        "chunk_no",
        {
            "_offset": ("sum", F.col(length)),
            "sentence_no": ("sum", F.col("_kept")),
            "ann_no": ("sum", F.size(_WORDS) + F.col("_kept")),
        },
        part,
    )
    times = timed_by(summed.filter("_kept = 1"), "_offset", length, per_second)
    return times.drop("_kept").withColumns(
        {
            "sentence_no": F.col("sentence_no") + 1,
            "ann_no": F.col("ann_no") + 1,
            "start_ms": v.to_millis(F.col("start_s")),
            "end_ms": v.to_millis(F.col("end_s")),
        }
    )


def _slot(offset: int) -> Column:
    return _text("ts", (2 * F.col("sentence_no") - 1 + offset).cast("string"))


def _ann(number: Column) -> Column:
    return _text("a", number.cast("string"))


def time_slots(numbered: DataFrame) -> DataFrame:
    """Two slots per sentence: its start and its end."""
    slots = F.array(
        F.struct(_slot(0).alias("ts_id"), F.col("start_ms").alias("ms")),
        F.struct(_slot(1).alias("ts_id"), F.col("end_ms").alias("ms")),
    )
    return numbered.select("recording", F.inline(slots))


def sentence_annotations(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "recording",
        _ann(F.col("ann_no")).alias("ann_id"),
        _slot(0).alias("ts1"),
        _slot(1).alias("ts2"),
        F.col("prediction").alias("value"),
    )


def word_annotations(numbered: DataFrame) -> DataFrame:
    """Words point at their sentence and at the word before them."""
    word_no = F.col("ann_no") + F.col("pos") + 1
    return numbered.select(
        "recording", "ann_no", F.posexplode(_WORDS).alias("pos", "value")
    ).select(
        "recording",
        _ann(word_no).alias("ann_id"),
        _ann(F.col("ann_no")).alias("parent"),
        F.when(F.col("pos") > 0, _ann(word_no - 1)).alias("prev"),
        "value",
    )


def _slot_lines() -> Column:
    return F.concat(
        *(
            _fill(EAF_SLOT, slot=_slot(i), ms=F.col(bound).cast("string"))
            for i, bound in enumerate(("start_ms", "end_ms"))
        )
    )


def _sentence_lines() -> Column:
    value = tx.escape_text(F.col("prediction"))
    return _fill(
        EAF_SENTENCE, id=_ann(F.col("ann_no")), from_slot=_slot(0), to_slot=_slot(1), value=value
    )


def _word_lines() -> Column:
    def lines(word: Column, pos: Column) -> Column:
        number = F.col("ann_no") + pos + 1
        previous = F.when(pos > 0, _fill(EAF_PREVIOUS, id=_ann(number - 1))).otherwise("")
        return _fill(
            EAF_WORD,
            id=_ann(number),
            parent=_ann(F.col("ann_no")),
            previous=previous,
            value=tx.escape_text(word),
        )

    return F.array_join(F.transform(_WORDS, lines), "")


def tier_xml(
    predictions: DataFrame,
    recordings: DataFrame,
    language: str | None,
    date: str,
    words: bool = True,
    part: int = PART,
    numbered: DataFrame | None = None,
) -> DataFrame:
    """Tier documents as parts. ``recordings`` lists every recording that gets a
    document; a ``media`` column, if there, names its audio file. ``date`` is the
    time stamp of the header, so output is repeatable. ``numbered`` are the predictions'
    annotations, if they are known."""
    if numbered is None:
        numbered = annotations(predictions, words, part)
    pieces = numbered.withColumns(
        {"_slots": _slot_lines(), "_tx": _sentence_lines(), "_word": _word_lines()}
    )
    # one pass builds the three bodies of a part; it needs no further shuffle
    listed = lambda c: F.expr(f"listagg({c}, '') within group (order by chunk_no)")
    bodies = pieces.groupBy("recording", running.block_col(part)).agg(
        listed("_slots").alias("_slots"), listed("_tx").alias("_tx"), listed("_word").alias("_word")
    )
    sections = F.array(
        *[
            F.struct(F.lit(n).alias("section"), F.col(c).alias("body"))
            for n, c in ((1, "_slots"), (3, "_tx"), (5, "_word"))
        ]
    )
    body = (
        bodies.select("recording", F.col(running.block_col(part)).alias("part_no"), F.inline(sections))
        .filter(F.col("body") != "")
        .select("recording", "section", "part_no", "body")
    )

    # ids run from 1 without gaps, so the last one is their number
    counts = _with_words(predictions, words).groupBy("recording").agg(
        F.sum(F.size(_WORDS) + 1).alias("last_id"),
        F.max(F.size(_WORDS)).alias("most_words"),
    )
    media = "media" in recordings.columns
    facts = recordings.select("recording", *(["media"] if media else [])).join(
        counts, "recording", "left"
    )
    has_words = F.coalesce(F.col("most_words"), F.lit(0)) > 0
    code = tx.escape_attribute(F.lit(language)) if language else None

    media_line = F.lit("")
    if media:
        known = F.coalesce(F.col("media"), F.lit(""))
        line = _fill(EAF_MEDIA, media=tx.escape_attribute(F.col("media")))
        media_line = F.when(known != "", line).otherwise("")
    with_words = lambda text: F.when(has_words, text).otherwise("")
    last_id = F.coalesce(F.col("last_id"), F.lit(0)).cast("string")
    header = _fill(EAF_OPENING, date=date, media=media_line, last_id=last_id)
    tx_tier = _fill(EAF_TX_TIER, language=_fill(EAF_TIER_LANGUAGE, code=code) if language else "")
    word_tier = _text(EAF_TIER_END, with_words(EAF_WORD_TIER))
    footer = _text(
        with_words(EAF_TIER_END),
        EAF_TX_TYPE,
        with_words(EAF_WORD_TYPE),
        _fill(EAF_LANGUAGE, code=code) if language else "",
        with_words(EAF_CONSTRAINT),
        EAF_CLOSING,
    )
    edges = [(0, header), (2, tx_tier), (4, word_tier), (6, footer)]
    # one row per edge from a single pass over the recordings
    edge_rows = facts.select(
        "recording",
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("section"), b.alias("body")) for n, b in edges])
        ),
    ).select("recording", "section", F.lit(0).cast("bigint").alias("part_no"), "body")
    return edge_rows.unionByName(body)
