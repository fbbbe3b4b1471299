"""From recordings and annotation spans to a sentence manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import values as v
from .lookup import lookup

# ---------------------------------------------------------------- fixed values
MIN_SECONDS = 1.0  # exclusive
MAX_SECONDS = 20.0  # inclusive
TAIL_SECONDS = 0.2  # kept after the end of a sentence
SAMPLE_RATE = 16_000
# -----------------------------------------------------------------------------

# names seldom repeat, and there are about as many documents as recordings
NAME_SALTS = 4


def pair_annotations(recordings: DataFrame, annotations: DataFrame) -> DataFrame:
    """Add ``annotation``, the path of a recording's annotation document, or null.

    ``recordings`` and ``annotations`` have ``path`` and ``stem``. A document of
    the same stem wins over one that differs in case; among several the lowest
    path wins. Documents are reduced to one per spelling and one per folded
    spelling first, so neither lookup multiplies rows, whatever stems repeat.
    """
    exact = annotations.groupBy("stem").agg(F.min("path").alias("_exact"))
    folded = annotations.groupBy(F.lower("stem").alias("_folded")).agg(
        F.min("path").alias("_loose")
    )
    found = lookup(recordings, exact, "stem", ["path"], "left", NAME_SALTS)
    found = found.withColumn("_folded", F.lower("stem"))
    found = lookup(found, folded, "_folded", ["path"], "left", NAME_SALTS)
    return found.withColumn("annotation", F.coalesce("_exact", "_loose")).select(
        *recordings.columns, "annotation"
    )


def missing_annotations(recordings: DataFrame, annotations: DataFrame) -> DataFrame:
    """Recordings that have no annotation document."""
    stems = annotations.select(F.lower("stem").alias("_folded")).distinct()
    folded = recordings.withColumn("_folded", F.lower("stem"))
    missing = lookup(folded, stems, "_folded", ["path"], "left_anti", NAME_SALTS)
    return missing.select(*recordings.columns)


def duration_kept(seconds: Column) -> Column:
    return (seconds > MIN_SECONDS) & (seconds <= MAX_SECONDS)


def clip_name(stem: Column, sent_id: Column) -> Column:
    return F.concat(stem, F.lit("_"), F.coalesce(sent_id, F.lit("None")), F.lit(".wav"))


def with_times(nodes: DataFrame) -> DataFrame:
    """Add ``start_s``, ``end_s`` and ``duration_s``, null where not a number."""
    start, end = v.parse_seconds(F.col("start")), v.parse_seconds(F.col("end"))
    return nodes.withColumns({"start_s": start, "end_s": end}).withColumn(
        "duration_s", F.col("end_s") - F.col("start_s")
    )


def classify_spans(
    nodes: DataFrame, language: str | Column | None = None
) -> DataFrame:
    """Add ``sentence`` and ``why`` a node gives no clip: the first rule that drops
    it, or null."""
    text, duration = F.col("text"), F.col("duration_s")
    usable = F.when(F.col("reason").isNull(), text)  # no others are normalised
    typed = with_times(nodes).withColumn("sentence", tx.normalize(usable, language))
    why = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(tx.is_skipped(text, language), "skip marker")
        .when(F.col("sentence") == "", "empty after cleanup")
        .when(duration.isNull() | F.isnan(duration), "bad timecode")
        .when(duration <= MIN_SECONDS, "too short")
        .when(duration > MAX_SECONDS, "too long")
    )
    return typed.withColumn("why", why)


def build_manifest(
    nodes: DataFrame, language: str | Column | None = None
) -> DataFrame:
    """Kept sentences with their cleaned text, clip name and duration.

    The cheap native filters come first; text is normalised once, and only for
    sentences of a fitting length.
    """
    timed = with_times(nodes.filter(F.col("reason").isNull()))
    fitting = timed.filter(
        duration_kept(F.col("duration_s")) & ~tx.is_skipped(F.col("text"), language)
    )
    cleaned = fitting.withColumn("sentence", tx.normalize(F.col("text"), language))
    return cleaned.filter(F.col("sentence") != "").select(
        clip_name(F.col("recording"), F.col("sent_id")).alias("path"),
        "sentence",
        v.format_seconds(F.col("duration_s"), 3).alias("duration"),
        "recording",
        "start_s",
        "end_s",
        "duration_s",
    )


def rejects(nodes: DataFrame, language: str | Column | None = None) -> DataFrame:
    """Nodes that give no clip, one row each, with the reason."""
    return (
        classify_spans(nodes, language)
        .filter(F.col("why").isNotNull())
        .select("recording", "pos", "sent_id", F.col("why").alias("reason"))
    )


def empty_annotations(paired: DataFrame, nodes: DataFrame) -> DataFrame:
    """Annotated recordings whose document holds no usable span."""
    spans = (
        nodes.filter(F.col("reason").isNull())
        .select(F.col("recording").alias("stem"))
        .distinct()
    )
    return paired.filter(F.col("annotation").isNotNull()).join(spans, "stem", "left_anti")


def within_recordings(
    manifest: DataFrame, lengths: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Split a manifest into sentences that start inside their recording, and rejects
    for those that start past its end or whose recording has no length. ``lengths`` is
    ``recording, seconds``."""
    timed = lookup(manifest, lengths, "recording", ["path"], "left")
    inside = F.col("start_s") < F.col("seconds")
    kept = timed.filter(inside).select(*manifest.columns)
    why = F.when(F.col("seconds").isNull(), "unreadable audio").otherwise("empty clip")
    lost = timed.filter(~F.coalesce(inside, F.lit(False)))
    return kept, lost.select("recording", "path", why.alias("reason"))


def unique_names(recordings: DataFrame) -> DataFrame:
    """``recordings`` with stems that are unique: of equal ones (``A.wav`` and
    ``A.WAV``) the first by path keeps it, and the others get a mark of their path."""
    first = recordings.groupBy("stem").agg(F.min("path").alias("_first"))
    known = lookup(recordings, first, "stem", ["path"], salts=NAME_SALTS)
    mark = F.substring(F.md5(F.col("path").cast("binary")), 1, 8)
    name = F.when(F.col("path") == F.col("_first"), F.col("stem")).otherwise(
        F.concat("stem", F.lit("~"), mark)
    )
    return known.withColumn("stem", name).select(*recordings.columns)


def total_minutes(manifest: DataFrame) -> DataFrame:
    """Minutes of speech kept. Adds up exactly, so the order of rows is no matter."""
    seconds = F.sum(F.col("duration_s").cast("decimal(28,6)")).cast("double")
    return manifest.agg(
        F.count("*").alias("n_clips"),
        v.format_seconds(F.coalesce(seconds, F.lit(0.0)) / 60, 1).alias("minutes"),
    )


def clip_windows(
    spans: DataFrame, rate: int = SAMPLE_RATE, tail: float = TAIL_SECONDS
) -> DataFrame:
    """Add ``start_sample`` and ``end_sample`` (exclusive, before clamping to the
    recording). A start before 0 counts as 0."""
    return spans.withColumns(
        {
            "start_sample": F.greatest((F.col("start_s") * rate).cast("bigint"), F.lit(0)),
            "end_sample": ((F.col("end_s") + tail) * rate).cast("bigint"),
        }
    )


def join_clips(manifest: DataFrame, clips: DataFrame) -> DataFrame:
    """Manifest rows with the clip of the same name."""
    return manifest.join(clips, "path")


def missing_clips(manifest: DataFrame, clips: DataFrame) -> DataFrame:
    """Manifest rows whose clip is not there."""
    return manifest.join(clips.select("path").distinct(), "path", "left_anti")


def contract_violations(
    clips: DataFrame, rate: int = SAMPLE_RATE
) -> DataFrame:
    """Clips that are not mono or not at the expected rate, with the reason."""
    reason = F.when(F.col("channels") != 1, "not mono").when(
        F.col("sr") != rate, "wrong rate"
    )
    return clips.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def require_contract(clips: DataFrame, rate: int = SAMPLE_RATE) -> DataFrame:
    """The same rule as a hard stop: the job fails on the first violation."""
    message = F.concat(F.col("path"), F.lit(" is not mono audio at the expected rate"))
    return clips.filter(
        F.when((F.col("channels") == 1) & (F.col("sr") == rate), F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )
    )
