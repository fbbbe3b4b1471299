"""One query per operator, over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import values as v
from ..operators import (
    batches,
    ctc,
    documents,
    history,
    infer,
    manifest,
    metrics,
    ordering,
    signal,
    silence,
    split,
)
from ..operators import timeline as tl
from ..operators import vocab as vc
from ..session import shared_folder
from ..sinks import files as sinks
from ..sources import annotations, audio, files, tiles
from ..sources.storage import plain_path
from . import adapters as a

Query = Callable[[SparkSession, str], DataFrame]

DATE = "2024-01-01T00:00:00+00:00"
LANGUAGE = "tdh"
AUDIO_ROOT = "/corpus/audio"
MIN_SILENCE, OFFSET_DB, TILE_MS = 5, 1, 100

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ------------------------------------------------------------------------ text


@query
def q_clean_markup(spark, sf):
    return a.raw_texts(spark, sf).select("doc_id", tx.clean_markup(F.col("text")).alias("sentence"))


def _normalized(spark, sf, language):
    return a.raw_texts(spark, sf).select(
        "doc_id", tx.normalize(F.col("text"), language).alias("sentence")
    )


@query
def q_normalize_tdh(spark, sf):
    return _normalized(spark, sf, "tdh")


@query
def q_normalize_nru(spark, sf):
    return _normalized(spark, sf, "nru")


@query
def q_normalize_jya(spark, sf):
    return _normalized(spark, sf, "jya")


@query
def q_normalize_dispatch(spark, sf):
    return a.raw_texts(spark, sf).select(
        "doc_id", "language", tx.normalize(F.col("text"), F.col("language")).alias("sentence")
    )


@query
def q_registered_language(spark, sf):
    code = "catalog"
    tx.register_normalizer(
        code,
        lambda text: F.replace(text, F.lit("e"), F.lit("3")),
        lambda text: F.concat(F.lit("<"), text, F.lit(">")),
    )
    tx.register_skip(code, lambda text: F.contains(text, F.lit("peu")))
    text = F.col("text")
    kept = a.raw_texts(spark, sf).filter(~tx.is_skipped(text, code))
    return kept.select("doc_id", tx.normalize(text, code).alias("sentence"))


@query
def q_csv_round_trip(spark, sf):
    options = files.table_options("\t")
    fields = "path string, sentence string, recording string, turn bigint"
    line = F.to_csv(F.struct("path", "sentence", "recording", "turn"), options)
    return a.clips(spark, sf).select(F.from_csv(line, fields, options).alias("r")).select("r.*")


@query
def q_skip_filter(spark, sf):
    kept = ~tx.is_skipped(F.col("text"), F.col("language"))
    return a.raw_texts(spark, sf).filter(kept).select("doc_id", "language")


@query
def q_xml_escape(spark, sf):
    return a.table(spark, sf, "pages").select(
        "page_id",
        tx.escape_text(F.col("html")).alias("content"),
        tx.escape_attribute(F.col("html")).alias("attribute"),
    )


# -------------------------------------------------------------------- manifest


@query
def q_recording_scan(spark, sf):
    found = a.recording_files(spark, sf)
    path = F.col("path")
    return found.select(
        "path",
        "stem",
        v.suffix(path).alias("suffix"),
        files.is_recording(path, recursive=False).alias("flat"),
        files.is_recording(path, recursive=True).alias("recursive"),
    ).filter("flat or recursive")


@query
def q_ordered_scan(spark, sf):
    """Turns with their place in the order of the clips' paths."""
    return ordering.numbered(a.clips(spark, sf).select("path", "recording"), [F.col("path"), F.col("recording")])


@query
def q_listing(spark, sf):
    """Files of a tree of folders: all recordings in it, and those of its top folder."""
    folder = _fresh(spark, "corpus")
    sinks.write_bytes(a.small_files(spark, sf), folder)
    start = F.lit(len(plain_path(folder)) + 2)
    deep = files.scan_recordings(spark, folder, recursive=True).withColumn("kind", F.lit("deep"))
    flat = files.scan_recordings(spark, folder).withColumn("kind", F.lit("flat"))
    texts = files.scan_annotations(spark, folder).withColumn("kind", F.lit("annotation"))
    listed = deep.union(flat).union(texts)
    return listed.select("kind", F.substr("path", start).alias("path"), "stem", "length")


@query
def q_checkpoint_listing(spark, sf):
    """Checkpoint folders of a run, and the one to resume from."""
    folder = _fresh(spark, "run")
    groups = a.table(spark, sf, "embeddings").selectExpr("vec_id div 25 as k").distinct()
    state = groups.selectExpr(
        "concat(case k % 3 when 0 then 'runs/' else 'checkpoint-' end, k * 50, '/state') as path",
        "cast(string(k) as binary) as body",
    )
    sinks.write_bytes(state, folder)
    latest = history.latest_checkpoint(files.list_checkpoints(spark, folder, "r")).first()
    names = files.list_checkpoints(spark, folder, "r").select("name")
    return names.withColumn("checkpoint", F.lit(latest.checkpoint if latest else None).cast("string"))


@query
def q_pair_join(spark, sf):
    paired = manifest.pair_annotations(a.recording_files(spark, sf), a.annotation_files(spark, sf))
    return paired.select("path", "annotation")


@query
def q_missing_annotation(spark, sf):
    return manifest.missing_annotations(
        a.recording_files(spark, sf), a.annotation_files(spark, sf)
    ).select("path")


@query
def q_annotation_spans(spark, sf):
    nodes = annotations.parse_annotations(a.annotation_documents(spark, sf))
    return annotations.spans(nodes).select(
        "recording", "pos", "sent_id", "text", F.col("start").alias("t_start"), F.col("end").alias("t_end")
    )


@query
def q_annotation_rejects(spark, sf):
    nodes = annotations.parse_annotations(a.annotation_documents(spark, sf))
    return (
        nodes.filter(F.col("reason").isNotNull())
        .groupBy("recording", "reason")
        .agg(F.count("*").alias("n"))
    )


@query
def q_empty_annotation(spark, sf):
    documents_ = a.annotation_documents(spark, sf)
    paired = documents_.select(
        F.col("recording").alias("stem"), F.concat("recording", F.lit(".xml")).alias("annotation")
    )
    return manifest.empty_annotations(paired, annotations.parse_annotations(documents_)).select(
        "stem"
    )


@query
def q_manifest(spark, sf):
    built = manifest.build_manifest(a.nodes(spark, sf), "nru")
    return built.select("path", "sentence", "duration", "recording")


@query
def q_rejects(spark, sf):
    return manifest.rejects(a.nodes(spark, sf), "nru")


@query
def q_reject_counts(spark, sf):
    rejected = manifest.rejects(a.nodes(spark, sf), "nru")
    return rejected.groupBy("reason").agg(
        F.count("*").alias("n"), F.countDistinct("recording").alias("n_recordings")
    )


@query
def q_duration_filter(spark, sf):
    timed = manifest.with_times(a.nodes(spark, sf))
    return timed.filter(manifest.duration_kept(F.col("duration_s"))).select(
        "recording", "sent_id", v.format_seconds(F.col("duration_s"), 3).alias("duration")
    )


@query
def q_total_minutes(spark, sf):
    return manifest.total_minutes(manifest.build_manifest(a.nodes(spark, sf)))


@query
def q_clip_window(spark, sf):
    built = manifest.build_manifest(a.nodes(spark, sf))
    return manifest.clip_windows(built).select("path", "start_sample", "end_sample")


@query
def q_clip_join(spark, sf):
    rows = a.clips(spark, sf)
    stored = a.nodes(spark, sf).filter("reason is null").select(
        manifest.clip_name(F.col("recording"), F.col("sent_id")).alias("path"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    found = manifest.join_clips(rows, stored).select("path", "n_chars")
    lost = manifest.missing_clips(rows, stored).select(
        "path", F.lit(-1).cast("bigint").alias("n_chars")
    )
    return found.unionByName(lost)


@query
def q_audio_contract(spark, sf):
    return manifest.contract_violations(a.wav_contracts(spark, sf)).select("path", "reason")


# ----------------------------------------------------------------------- split


@query
def q_recording_key(spark, sf):
    return a.clips(spark, sf).select(
        "path", split.recording_key(F.col("path")).alias("recording")
    )


@query
def q_group_split(spark, sf):
    assigned = split.assign_splits(a.clips(spark, sf))
    return assigned.select(F.col("split_recording").alias("recording"), "split").distinct()


@query
def q_split_rows(spark, sf):
    return split.assign_splits(a.clips(spark, sf)).select("path", "sentence", "split")


@query
def q_split_summary(spark, sf):
    return split.split_summary(split.assign_splits(a.clips(spark, sf)))


@query
def q_split_leakage(spark, sf):
    # splitting turn by turn would put one conversation into several splits
    by_turn = a.clips(spark, sf).withColumn(
        "path", F.concat("recording", F.lit("t"), F.col("turn"), F.lit("_S1.wav"))
    )
    return split.leaked_recordings(split.assign_splits(by_turn), "recording")


# ---------------------------------------------------------------------- encode


def _corpora(spark, sf):
    rows = a.clips(spark, sf).select(F.col("sentence"), (F.col("turn") % 2).alias("half"))
    return rows.filter("half = 0"), rows.filter("half = 1")


@query
def q_vocab(spark, sf):
    return vc.vocabulary(*_corpora(spark, sf)).select("char", F.col("id").cast("bigint").alias("id"))


@query
def q_vocab_json(spark, sf):
    return vc.vocabulary_json(vc.vocabulary(*_corpora(spark, sf)))


@query
def q_label_encode(spark, sf):
    # the marks appended to the texts hold characters that the turns lack
    alphabet = vc.Alphabet.load(vc.vocabulary(*_corpora(spark, sf)))
    labels = alphabet.encode(F.col("text"))
    return a.raw_texts(spark, sf).select(
        "doc_id", F.array_join(labels.cast("array<string>"), " ").alias("labels")
    )


@query
def q_label_decode(spark, sf):
    alphabet = vc.Alphabet.load(vc.vocabulary(*_corpora(spark, sf)))
    marked = F.concat("sentence", F.lit("漢 @"))  # characters that no turn has
    padded = F.concat(alphabet.encode(marked), F.array_repeat(F.lit(-100), 5))
    return a.clips(spark, sf).select("path", alphabet.decode(padded).alias("sentence"))


@query
def q_feature_scale(spark, sf):
    rows = a.table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(batches.scale_features(F.col("embedding"))).alias("pos", "x")
    )
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("x", 5).alias("x"))


@query
def q_length_batches(spark, sf):
    rows = a.encoded(spark, sf)
    made = batches.length_batches(rows, "utt", F.size("input_values"))
    return made.select(
        "utt", "shard", "batch_no", F.size("input_values").cast("bigint").alias("n_values")
    )


@query
def q_pad_batches(spark, sf):
    made = batches.length_batches(a.encoded(spark, sf), "utt", F.size("input_values"))
    padded = batches.pad_batches(made, ["shard", "batch_no"], inputs_multiple=16)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    return padded.select(
        "utt",
        F.size("input_values").cast("bigint").alias("n_values"),
        F.round(total("input_values"), 4).alias("sum_values"),
        F.size("attention_mask").cast("bigint").alias("n_mask"),
        total("attention_mask").cast("bigint").alias("sum_mask"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"),
    )


@query
def q_padding_options(spark, sf):
    made = batches.length_batches(a.encoded(spark, sf), "utt", F.size("input_values"))
    padded = batches.pad_batches(
        made, ["shard", "batch_no"], min_inputs=300, min_labels=40, labels_multiple=8
    )
    ignored = F.filter("labels", lambda i: i == vc.IGNORED_LABEL)
    mask = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return padded.select(
        "utt",
        F.size("input_values").cast("bigint").alias("n_values"),
        mask.cast("bigint").alias("sum_mask"),
        F.size("labels").cast("bigint").alias("n_labels"),
        F.size(ignored).cast("bigint").alias("n_ignored"),
    )


# ------------------------------------------------------------ decode and score


def _frame_chars():
    return F.array(*map(F.lit, a.FRAME_CHARS))


@query
def q_ctc_decode(spark, sf):
    blank = a.FRAME_CHARS.index("[PAD]")
    return a.frame_scores(spark, sf).select(
        "utt", ctc.decode(F.col("frames"), _frame_chars(), blank).alias("prediction")
    )


@query
def q_transcribe(spark, sf):
    def make_scorer():
        return lambda samples: samples.reshape(8, 8)

    chunks = a.blocks(spark, sf).selectExpr("recording", "block_no as chunk_no", "samples")
    blank = a.FRAME_CHARS.index("[PAD]")
    return infer.transcribe(chunks, make_scorer, _frame_chars(), blank).select(
        "recording", "chunk_no", "n_samples", "prediction"
    )


@query
def q_wer(spark, sf):
    return metrics.word_error_rate(a.pairs(spark, sf))


@query
def q_cer(spark, sf):
    return metrics.char_error_rate(a.pairs(spark, sf))


@query
def q_wer_by_recording(spark, sf):
    return metrics.word_error_rate(a.pairs(spark, sf), ["conv_id"])


@query
def q_cer_by_role(spark, sf):
    return metrics.char_error_rate(a.pairs(spark, sf), ["role"])


@query
def q_best_step(spark, sf):
    return history.best_step(a.history(spark, sf))


@query
def q_early_stop(spark, sf):
    # -1 for runs that never stop
    return history.early_stop(a.history(spark, sf)).fillna(-1, "stop_step")


@query
def q_latest_checkpoint(spark, sf):
    return history.latest_checkpoint(a.checkpoints(spark, sf))


# ---------------------------------------------------------------------- signal


@query
def q_downmix(spark, sf):
    stereo = a.table(spark, sf, "embeddings").selectExpr(
        "vec_id", "array(slice(embedding, 1, 32), slice(embedding, 33, 32)) as channels"
    )
    mixed = stereo.select(
        "vec_id",
        F.posexplode(
            F.arrays_zip(
                signal.downmix(F.col("channels")).alias("mean"),
                signal.downmix(F.col("channels"), "first").alias("first"),
            )
        ).alias("pos", "s"),
    )
    return mixed.select(
        "vec_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.round("s.mean", 6).alias("mean"),
        F.round(F.col("s.first").cast("double"), 6).alias("first"),
    )


@query
def q_pcm_decode(spark, sf):
    @F.arrow_udf("array<double>")
    def decode(data: pa.Array) -> pa.Array:
        return pa.array(
            [audio.pcm_to_floats(d.as_py(), 2, 1)[:, 0] for d in data], pa.list_(pa.float64())
        )

    decoded = a.pcm_bytes(spark, sf).select(
        "recording", "block_no", decode.asNondeterministic()(F.col("data")).alias("x")
    )
    rows = decoded.select("recording", "block_no", F.posexplode("x").alias("pos", "x"))
    return rows.select(
        "recording", (F.col("block_no") * a.BLOCK_SAMPLES + F.col("pos")).alias("pos"), "x"
    )


@query
def q_frame_energy(spark, sf):
    return signal.frame_energy(signal.energy_blocks(a.blocks(spark, sf)), a.BLOCK_MS)


@query
def q_dbfs(spark, sf):
    measured = signal.loudness(signal.energy_blocks(a.blocks(spark, sf)))
    return measured.select(
        "recording", "n_samples", "length_ms", "rms", F.round("dbfs", 6).alias("dbfs")
    )


@query
def q_silence_ranges(spark, sf):
    energy = signal.energy_blocks(a.blocks(spark, sf))
    found = silence.silence_ranges(
        energy, a.BLOCK_MS, MIN_SILENCE, OFFSET_DB, tile_ms=TILE_MS
    )
    return found.select("recording", "start_ms", "end_ms")


@query
def q_chunks(spark, sf):
    energy = signal.energy_blocks(a.blocks(spark, sf))
    made = silence.segment(energy, a.BLOCK_MS, MIN_SILENCE, OFFSET_DB, tile_ms=TILE_MS)
    return made.select(
        "recording", "chunk_no", tl.chunk_file(F.col("chunk_no")).alias("chunk"), "start_ms", "end_ms"
    )


@query
def q_truncate(spark, sf):
    # a scored part of 40 samples, so that every row is cut
    cut = signal.truncate(F.col("samples"), rate=8, seconds=5)
    return a.blocks(spark, sf).select(
        "recording",
        "block_no",
        F.size(cut).cast("bigint").alias("n"),
        F.aggregate(cut, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"),
    )


@query
def q_chunk_duration(spark, sf):
    lengths = tl.cap_length(a.chunk_lengths(spark, sf), "length_ms", 1000)
    return lengths.select("recording", "chunk_no", (F.col("length_ms") / 1000.0).alias("duration_s"))


@query
def q_clip_samples(spark, sf):
    cut = signal.cut_clips(
        a.block_spans(spark, sf), a.blocks(spark, sf), a.BLOCK_SAMPLES, tail=0.002
    )
    samples = F.col("samples")
    return cut.select(
        "path",
        F.size(samples).cast("bigint").alias("n"),
        F.aggregate(samples, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"),
        F.get(samples, F.lit(0)).cast("bigint").alias("first"),
        F.element_at(samples, -1).cast("bigint").alias("last"),
    )


@query
def q_training_rows(spark, sf):
    """Batches of labelled clips out of a table of tiles."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = tiles.write_tiles(
        a.blocks(spark, sf), parts, a.BLOCK_SAMPLES, tile_blocks=32, longest=10 * a.BLOCK_SAMPLES
    )
    clips = a.labelled_clips(spark, sf)
    alphabet = vc.Alphabet.load(vc.vocabulary(clips))
    made = tiles.training_rows(clips, kept, alphabet)
    own = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    value = lambda at: F.round(F.get("input_values", at).cast("double"), 4) + F.lit(0.0)
    squares = F.aggregate("input_values", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return made.select(
        "path",
        "shard",
        "batch_no",
        F.size("input_values").cast("bigint").alias("n_values"),
        own.cast("bigint").alias("n_own"),
        value(F.lit(0)).alias("first"),
        value(own - 1).alias("last"),
        F.round(squares / own, 3).alias("power"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"),
    )


def _fresh(spark, name):
    """A folder of this run in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def q_wav_round_trip(spark, sf):
    """Recordings written as wav files of two kinds and rates, and windows of them read."""
    number = F.substring("recording", 4, 9).cast("int")
    slow = number % 2 == 1
    blocks = a.blocks(spark, sf).select(
        F.concat("recording", F.lit(".wav")).alias("path"),
        "block_no",
        F.when(slow, 8_000).otherwise(16_000).alias("rate"),
        (number % 4 >= 2).alias("floating"),
        "samples",
    )
    folder = _fresh(spark, "recordings")
    sinks.write_recordings(blocks, folder)
    headers = audio.read_headers(files.scan_recordings(spark, folder))
    windows = manifest.clip_windows(a.block_spans(spark, sf), tail=0.002)
    read = [
        audio.read_windows(headers.filter(F.col("sr") == rate), windows, "path", rate=rate)
        for rate in (8_000, 16_000)
    ]
    samples = F.col("samples")
    return read[0].union(read[1]).select(
        "path",
        F.size(samples).cast("bigint").alias("n"),
        F.aggregate(samples, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"),
        F.get(samples, F.lit(0)).cast("bigint").alias("first"),
        F.element_at(samples, -1).cast("bigint").alias("last"),
    )


@query
def q_clip_files(spark, sf):
    """Clips written as files: their names, sizes and digests."""
    cut = signal.cut_clips(a.block_spans(spark, sf), a.blocks(spark, sf), a.BLOCK_SAMPLES, tail=0.002)
    folder = _fresh(spark, "clips")
    written = sinks.write_clips(cut.select("path", "samples"), folder, 16_000)
    return written.select(v.file_name(F.col("file")).alias("file"), "bytes", "md5")


@query
def q_resample(spark, sf):
    out = signal.resample(a.blocks(spark, sf), 8_000, 16_000, a.BLOCK_SAMPLES)
    rows = out.select("recording", "block_no", F.posexplode("samples").alias("pos", "x"))
    return rows.select(
        "recording",
        (F.col("block_no") * (2 * a.BLOCK_SAMPLES) + F.col("pos")).alias("pos"),
        F.round("x", 3).alias("x"),
    )


# -------------------------------------------------------- timeline and exports


def _timed(spark, sf):
    # timed in blocks of document parts, which the exports then share
    capped = tl.cap_length(a.chunk_lengths(spark, sf), "length_ms", 1000)
    return tl.timeline(capped, "length_ms", 1000, documents.PART)


def _annotated(spark, sf, words=True):
    """The annotations of chunks that are timed on the way."""
    capped = tl.cap_length(a.chunk_lengths(spark, sf), "length_ms", 1000)
    return documents.timed_annotations(capped, "length_ms", 1000, words)


def _recordings(spark, sf):
    return a.chunk_lengths(spark, sf).select("recording").distinct()


@query
def q_timeline(spark, sf):
    capped = tl.cap_length(a.chunk_lengths(spark, sf), "length_ms", 1000)
    timed = tl.timeline(capped, "length_ms", 1000)
    return timed.select("recording", "chunk_no", "start_s", "end_s", "duration_s")


@query
def q_source_times(spark, sf):
    energy = signal.energy_blocks(a.blocks(spark, sf))
    made = silence.segment(energy, a.BLOCK_MS, MIN_SILENCE, OFFSET_DB, tile_ms=TILE_MS)
    return tl.source_times(made).select("recording", "chunk_no", "start_s", "end_s", "duration_s")


@query
def q_prediction_table(spark, sf):
    return tl.prediction_table(_timed(spark, sf))


@query
def q_nonempty(spark, sf):
    return tl.non_empty(a.chunk_lengths(spark, sf)).select("recording", "chunk_no", "prediction")


@query
def q_plain_text(spark, sf):
    return documents.plain_text(a.chunk_lengths(spark, sf))


@query
def q_prediction_csv(spark, sf):
    return documents.prediction_csv(_timed(spark, sf), _recordings(spark, sf))


@query
def q_document_files(spark, sf):
    """What the document writer is given: the file of every part, and its bytes."""
    parts = documents.plain_text(a.chunk_lengths(spark, sf))
    path = F.concat(F.lit(f"{AUDIO_ROOT}/"), "recording", F.lit(".wav"))
    return parts.select(
        tl.result_path(path, AUDIO_ROOT, "txt").alias("file"),
        "part_no",
        F.octet_length("body").cast("bigint").alias("bytes"),
        F.md5(F.col("body").cast("binary")).alias("md5"),
    )


@query
def q_pangloss_rows(spark, sf):
    numbered = documents.sentences(_timed(spark, sf))
    return numbered.select(
        "recording",
        "chunk_no",
        "sentence_id",
        v.format_seconds(F.col("start_s"), 1).alias("t_start"),
        v.format_seconds(F.col("end_s"), 1).alias("t_end"),
        "prediction",
    )


@query
def q_pangloss_words(spark, sf):
    words = documents.sentence_words(documents.sentences(a.chunk_lengths(spark, sf)))
    return words.select("recording", "sentence_id", F.col("pos").cast("bigint").alias("pos"), "word")


@query
def q_pangloss_doc(spark, sf):
    return documents.annotation_xml(_timed(spark, sf), _recordings(spark, sf), LANGUAGE)


@query
def q_eaf_slots(spark, sf):
    return documents.time_slots(_annotated(spark, sf))


@query
def q_eaf_phono(spark, sf):
    return documents.sentence_annotations(_annotated(spark, sf))


@query
def q_eaf_words(spark, sf):
    return documents.word_annotations(_annotated(spark, sf))


def _media(spark, sf):
    path = F.concat(F.lit(f"{AUDIO_ROOT}/"), "recording", F.lit(".wav"))
    return _recordings(spark, sf).withColumn("media", path)


@query
def q_eaf_doc(spark, sf):
    return documents.tier_xml(
        a.chunk_lengths(spark, sf), _media(spark, sf), LANGUAGE, DATE, numbered=_annotated(spark, sf)
    )


@query
def q_eaf_doc_plain(spark, sf):
    return documents.tier_xml(
        a.chunk_lengths(spark, sf),
        _recordings(spark, sf),
        None,
        DATE,
        words=False,
        numbered=_annotated(spark, sf, words=False),
    )


@query
def q_result_path(spark, sf):
    path = F.col("path")
    return a.recording_files(spark, sf).select(
        "path",
        tl.result_path(path, AUDIO_ROOT, "tsv").alias("table_file"),
        tl.result_path(path, AUDIO_ROOT, "eaf").alias("tier_file"),
    )
