"""The three stages of a corpus, put together from the operators.

1. ``prepare``: recordings and annotations to a manifest, clips and rejects;
   ``split`` of the manifest.
2. ``training_rows``: a split and its clips to encoded, batched, padded rows.
3. ``transcribe``: recordings and a model to timed predictions; ``export``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import batches, documents, infer, manifest, signal, silence, split, timeline
from ..operators.vocab import IGNORED_LABEL, Alphabet
from ..session import settle
from ..sinks import files as file_sinks
from ..sources import annotations, audio, files
from ..sources.storage import plain_path

RATE = audio.TARGET_RATE


# ------------------------------------------------------------------ preparation


@dataclass(frozen=True)
class Transcribed:
    """Timed predictions, and the recordings that could not be read."""

    predictions: DataFrame
    failures: DataFrame  # path, recording, error


@dataclass(frozen=True)
class Prepared:
    """Relations of a prepared corpus, lazy views on what ``prepare`` read."""

    manifest: DataFrame  # path, sentence, duration, recording, start_s, end_s, duration_s
    rejects: DataFrame  # recording, pos, sent_id, reason
    missing: DataFrame  # recordings without annotation
    empty: DataFrame  # recordings whose annotation holds no span
    unreadable: DataFrame  # recordings whose audio cannot be read
    headers: DataFrame  # wav headers of the recordings in the manifest


def prepare(
    spark: SparkSession, wav_dir: str, xml_dir: str, language: str | None = None
) -> Prepared:
    """Pair, parse, filter and normalise. No audio is decoded for this: only wav
    headers are read, to tell which sentences start after the recording ends.

    Directories, documents and headers are read here, once; the relations that
    come out are computed from checkpoints of them.
    """
    found = settle(files.scan_recordings(spark, wav_dir))
    listed = settle(files.scan_annotations(spark, xml_dir))
    # from here on a recording is known by a name of its own
    paired = settle(manifest.unique_names(manifest.pair_annotations(found, listed)))
    recordings = paired.drop("annotation")
    nodes = settle(annotations.parse_files(paired))
    headers = settle(audio.read_headers(recordings))
    kept, past_end = manifest.within_recordings(
        manifest.build_manifest(nodes, language),
        headers.filter(F.col("error").isNull()).select(
            F.col("stem").alias("recording"), (F.col("frames") / F.col("sr")).alias("seconds")
        ),
    )
    used = kept.select(F.col("recording").alias("stem")).distinct()
    return Prepared(
        manifest=kept,
        rejects=manifest.rejects(nodes, language).unionByName(past_end, allowMissingColumns=True),
        missing=paired.filter(F.col("annotation").isNull()).drop("annotation"),
        empty=manifest.empty_annotations(paired, nodes),
        unreadable=headers.filter(F.col("error").isNotNull()).select("path", "error"),
        headers=headers.join(used, "stem", "left_semi"),
    )


def clips(prepared: Prepared) -> DataFrame:
    """``recording, path, samples`` of every manifest row. Only the bytes of kept
    sentences are read."""
    windows = manifest.clip_windows(prepared.manifest).select(
        "recording", "path", "start_sample", "end_sample"
    )
    return audio.read_windows(prepared.headers, windows, "path")


# --------------------------------------------------------------------- training


def training_rows(
    rows: DataFrame, prepared: Prepared, alphabet: Alphabet, batch_size: int = batches.BATCH_SIZE
) -> DataFrame:
    """Manifest rows to padded batches of scaled features and labels.

    Batches are made from the bounds of the clips, which are narrow rows; the task that
    gets a batch reads the audio of its clips, scales and pads it. Audio is not
    shuffled.
    """
    windows = manifest.clip_windows(prepared.manifest).select(
        "recording", "path", "start_sample", "end_sample"
    )
    joined = manifest.join_clips(rows.select("path", "sentence"), windows)
    batched = batches.length_batches(
        joined, "path", F.col("end_sample") - F.col("start_sample"), batch_size, rows
    ).withColumn("labels", alphabet.encode(F.col("sentence")))

    def make(clips_: list[dict], samples: list[np.ndarray]):
        longest = max(map(len, samples), default=0)
        most_labels = max((len(c["labels"]) for c in clips_), default=0)
        for clip, own in zip(clips_, samples):
            inputs, mask = np.zeros(longest, np.float32), np.zeros(longest, np.int32)
            inputs[: len(own)], mask[: len(own)] = batches.scaled(own), 1
            labels = clip["labels"] + [IGNORED_LABEL] * (most_labels - len(clip["labels"]))
            yield clip["clip"], clip["shard"], clip["batch_no"], inputs, labels, mask

    return audio.read_batches(
        prepared.headers,
        batched.withColumnRenamed("path", "clip"),  # the path read is the recording's
        ["shard", "batch_no"],
        make,
        schemas.TRAINING_ROWS,
    )


def split_corpus(rows: DataFrame, seed: int = split.SEED) -> DataFrame:
    return split.assign_splits(rows, seed)


# ---------------------------------------------------------------- transcription


def find_recordings(spark: SparkSession, directory: str) -> DataFrame:
    """``path, stem`` of all recordings below a directory. The stem is the path
    within the directory, since names may repeat in its folders."""
    inside = F.substr("path", F.lit(len(plain_path(directory)) + 2))
    return files.scan_recordings(spark, directory, recursive=True).select(
        "path", F.regexp_replace(inside, r"\.[^.]+$", "").alias("stem")
    )


def transcribe(
    recordings: DataFrame,
    make_scorer,
    chars: Column,
    blank: int,
    min_silence: int = silence.MIN_SILENCE_MS,
    offset_db: float = silence.SILENCE_OFFSET_DB,
    times: str = "scored",
    scale: bool = True,
) -> Transcribed:
    """Segment on silence, score and decode every chunk, and time the results.
    Predictions are lazy: store them before exporting, or chunks are scored again.
    ``scale=False`` gives the scorer the 16-bit samples as they are.

    ``times="scored"`` adds up the scored lengths, ``times="source"`` uses the
    bounds of the chunk in its recording; they differ after a chunk that was too
    long to be scored whole.
    """
    headers = settle(audio.read_headers(recordings))
    segments = settle(audio.segment(headers, min_silence, offset_db))
    samples = audio.read_windows(headers, signal.chunk_windows(segments), "chunk_no")
    scored = infer.transcribe(samples, make_scorer, chars, blank, scale)
    if times == "scored":
        timed = timeline.timeline(scored, "n_samples", RATE)
    else:
        timed = timeline.source_times(scored.join(segments, ["recording", "chunk_no"]))
    failed = headers.filter(F.col("error").isNotNull())
    return Transcribed(timed, failed.select("path", F.col("stem").alias("recording"), "error"))


def export(
    predictions: DataFrame,
    recordings: DataFrame,
    root: str,
    language: str,
    date: str,
    words: bool = True,
    failures: DataFrame | None = None,
) -> DataFrame:
    """Write every recording's table, annotation XML, tier XML and text next to
    each other under ``<root>_result``; returns ``file, bytes`` rows. Recordings in
    ``failures`` get no files.

    ``predictions`` is read once per format: pass a stored table, not the lazy
    result of a scoring run.
    """
    if failures is not None:
        recordings = recordings.join(failures.select("path"), "path", "left_anti")
    listed = recordings.select(F.col("stem").alias("recording"), F.col("path").alias("media"))
    kinds = {
        "tsv": documents.prediction_csv(predictions, listed),
        "xml": documents.annotation_xml(predictions, listed, language),
        "eaf": documents.tier_xml(predictions, listed, language, date, words),
        "txt": documents.plain_text(predictions, listed),
    }
    written = None
    for extension, parts in kinds.items():
        targets = listed.select(
            "recording",
            timeline.result_path(F.col("media"), plain_path(root), extension).alias("file"),
        )
        result = file_sinks.write_documents(parts, targets)
        written = result if written is None else written.unionByName(result)
    return written
