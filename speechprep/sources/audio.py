"""PCM wav files, read window by window.

Files are never loaded whole. One pass reads headers; after that, work on audio
is a table of windows (recording and sample bounds) spread evenly over the
cluster, and a task seeks to the bytes of its windows. An hour-long file is many
small reads, so one long recording does not hold a task, or a row, to itself, and
audio is not shuffled.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable
from contextlib import closing

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..operators import silence
from ..operators.lookup import lookup
from ..operators.manifest import SAMPLE_RATE as TARGET_RATE
from ..operators.ordering import packed
from ..operators.signal import (
    loudness_of,
    millisecond_energies,
    resample_piece,
    resampling_kernel,
)
from ..session import settle, spread
from .storage import resolve

# ---------------------------------------------------------------- fixed values
_PCM, _FLOAT, _EXTENSIBLE = 1, 3, 0xFFFE
_WIDTHS = {_PCM: (1, 2, 3, 4), _FLOAT: (4, 8)}  # bytes per sample
_SUBFORMAT_TAIL = bytes.fromhex("000000001000800000aa00389b71")  # after the format code
# -----------------------------------------------------------------------------

RANGE_SECONDS = 60  # audio per read
HEADERS_PER_TASK = 500
WINDOWS_PER_TASK = 60  # of a batch's clips
BYTES_PER_TASK = 64 << 20  # of audio files, about half an hour of 16-bit mono
OPENING_BYTES = 64 << 10  # what opening or seeking costs, as bytes read
SAMPLES_PER_BATCH = 4 << 20  # what Python holds back before sending results on


def _format(chunk: bytes) -> tuple[int, int, int, bool, int]:
    """Rate, channels, bytes per sample, whether they are floating point, and bytes
    per frame, from a format chunk that makes sense."""
    code, channels, rate, _, frame_bytes, bits = struct.unpack("<HHIIHH", chunk[:16])
    if code == _EXTENSIBLE:
        if len(chunk) < 40 or chunk[26:40] != _SUBFORMAT_TAIL:
            raise ValueError("unknown extensible format")
        code = struct.unpack("<H", chunk[24:26])[0]
    width = bits // 8
    if code not in _WIDTHS or bits % 8 or width not in _WIDTHS[code]:
        raise ValueError(f"not PCM or float: format {code}, {bits} bits")
    if not rate or not channels or frame_bytes != channels * width:
        raise ValueError(f"bad format: rate {rate}, {channels} channels, {frame_bytes} bytes a frame")
    return rate, channels, width, code == _FLOAT, frame_bytes


def _header(stream, size: int) -> tuple[int, int, int, bool, int, int]:
    """Rate, channels, sample width, floating, data offset and frames of a RIFF file."""
    riff = stream.read(12)
    if riff[:4] != b"RIFF" or riff[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    known = None
    while True:
        head = stream.read(8)
        if len(head) < 8:
            raise ValueError("no data chunk")
        name, length = head[:4], struct.unpack("<I", head[4:])[0]
        if name == b"fmt ":
            known = _format(stream.read(min(length, 64)))
            stream.seek(stream.tell() - min(length, 64) + length + (length & 1))
        elif name == b"data":
            if known is None:
                raise ValueError("data before format")
            *described, frame_bytes = known
            offset = stream.tell()
            return *described, offset, min(length, size - offset) // frame_bytes
        else:
            stream.seek(stream.tell() + length + (length & 1))


def read_headers(recordings: DataFrame) -> DataFrame:
    """Wav headers of ``path, stem`` rows. Unreadable files come out with an
    ``error`` instead of stopping the others."""

    def read(batches):
        for batch in batches:
            rows = []
            for path, stem in zip(batch["path"].to_pylist(), batch["stem"].to_pylist()):
                try:
                    files, name = resolve(path)
                    size = files.get_file_info(name).size
                    with files.open_input_file(name) as stream:
                        rows.append((path, stem, *_header(stream, size), None))
                except (OSError, ValueError, struct.error) as e:
                    rows.append((path, stem, *[None] * 6, str(e)))
            columns = [list(c) for c in zip(*rows)] or [[] for _ in schemas.WAV_HEADERS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _HEADER_TYPES)],
                schemas.WAV_HEADERS.names,
            )

    listed = spread(recordings.select("path", "stem"), "path", per_task=HEADERS_PER_TASK)
    return listed.mapInArrow(read, schemas.WAV_HEADERS)


_HEADER_TYPES = [
    pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(),
    pa.int64(), pa.int64(), pa.string(),
]


def pcm_to_floats(data: bytes, width: int, channels: int, floating: bool = False) -> np.ndarray:
    """Sample bytes to ``[frames, channels]`` in -1..1. Of floating point samples,
    those that are no number become 0."""
    if floating:
        values = np.nan_to_num(np.frombuffer(data, f"<f{width}").astype(np.float64))
    elif width == 1:  # the only unsigned width
        values = (np.frombuffer(data, np.uint8).astype(np.float64) - 128) / 128
    elif width == 3:
        raw = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
        values = raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16
        values = (values - ((values & 0x800000) << 1)) / float(1 << 23)
    else:
        values = np.frombuffer(data, f"<i{width}") / float(1 << (8 * width - 1))
    return values.reshape(-1, channels)


def floats_to_pcm16(values: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(values * 32_768), -32_768, 32_767).astype(np.int16)


class ByteRanges:
    """Reads ranges of bytes. The file read last stays open and its last bytes are kept,
    because windows come in order: those that overlap share what was read."""

    def __init__(self) -> None:
        self.path, self.stream, self.begin, self.data = None, None, 0, b""

    def read(self, path: str, low: int, high: int) -> bytes:
        if path != self.path:
            self.close()
            files, name = resolve(path)
            self.stream, self.path = files.open_input_file(name), path
        behind = low - self.begin
        kept = self.data[behind:] if 0 <= behind <= len(self.data) else b""
        if len(kept) < high - low:
            self.stream.seek(low + len(kept))
            kept += self.stream.read(high - low - len(kept))
        self.begin, self.data = low, kept
        return kept[: high - low]

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
        self.path, self.stream, self.data = None, None, b""


def _read(ranges: ByteRanges, row: dict, first: int, last: int, mode: str, rate: int) -> np.ndarray:
    """16-bit mono samples ``first .. last - 1`` of a recording at ``rate``. At
    another rate, a few more frames are read on either side and filtered."""
    sr, channels, width, frames = row["sr"], row["channels"], row["sample_width"], row["frames"]
    step, phases, halo = 1, 1, 0
    if sr != rate:
        kernel, half, step, phases = resampling_kernel(sr, rate)
        halo = half + step
    last = min(last, -(-phases * frames // step))
    if last <= first:
        return np.zeros(0, np.int16)
    group = first // phases
    begin, end = group * step, min(-(-last // phases) * step, frames)
    low, high = max(begin - halo, 0), min(end + halo, frames)
    frame, offset = channels * width, row["data_offset"]
    data = ranges.read(row["path"], offset + low * frame, offset + high * frame)
    values = pcm_to_floats(data, width, channels, row["floating"])
    mono = values[:, 0] if mode == "first" else values.mean(axis=1)
    own = mono[begin - low : end - low]
    if sr != rate:
        own = resample_piece(mono[: begin - low], own, mono[end - low :], sr, rate)
    return floats_to_pcm16(own[first - group * phases : last - group * phases])


_HEADER_FIELDS = ["path", "sr", "channels", "sample_width", "floating", "data_offset", "frames"]


def _readable(headers: DataFrame) -> DataFrame:
    good = headers.filter(F.col("error").isNull() & (F.col("frames") > 0))
    return good.select(F.col("stem").alias("recording"), *_HEADER_FIELDS)


def map_windows(
    windows: DataFrame,
    reduce: Callable[[np.ndarray, dict], Iterable[tuple]],
    schema: T.StructType,
    mode: str = "mean",
    rate: int = TARGET_RATE,
) -> DataFrame:
    """Read windows straight from the files and give ``reduce(samples, window)``
    rows. A window has ``recording, start_sample, end_sample`` and the header
    fields of its recording.

    Only bounds are shuffled, never audio. Windows are packed into tasks by the bytes
    they read, in the order in which these lie in the files: a long recording is read by
    many tasks, and a task opens a file once. Results leave Python in small batches.
    """
    to_arrow = to_arrow_schema(schema)

    def run(batches):
        with closing(ByteRanges()) as ranges:
            for batch in batches:
                rows, weight = [], 0
                for window in batch.to_pylist():
                    samples = _read(
                        ranges, window, window["start_sample"], window["end_sample"], mode, rate
                    )
                    rows += reduce(samples, window)
                    weight += len(samples)
                    if weight >= SAMPLES_PER_BATCH:
                        yield _batch(rows, to_arrow)
                        rows, weight = [], 0
                if rows:
                    yield _batch(rows, to_arrow)

    return packed_windows(windows, rate).mapInArrow(run, schema)


def window_bytes(rate: int) -> Column:
    """Bytes that the task of a window reads, with its share of opening the file."""
    seconds = F.greatest(F.col("end_sample") - F.col("start_sample"), F.lit(0)) / rate
    frames = F.least(F.ceil(seconds * F.col("sr")), F.col("frames"))
    return frames * F.col("channels") * F.col("sample_width") + OPENING_BYTES


def packed_windows(windows: DataFrame, rate: int, per_task: int = BYTES_PER_TASK) -> DataFrame:
    """Windows dealt to tasks by bytes, in the order of the files."""
    order = [F.col(c) for c in ("path", "start_sample", "end_sample")]
    return packed(windows, order, window_bytes(rate), per_task)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _ranges(headers: DataFrame, rate: int) -> DataFrame:
    """Windows of a fixed length that cover every recording."""
    samples = RANGE_SECONDS * rate
    seconds = F.ceil(F.col("frames") / F.col("sr"))
    starts = F.sequence(F.lit(0).cast("bigint"), seconds * rate - 1, F.lit(samples).cast("bigint"))
    return _readable(headers).select("*", F.explode(starts).alias("start_sample")).withColumn(
        "end_sample", F.col("start_sample") + samples
    )


def read_blocks(headers: DataFrame, mode: str = "mean", rate: int = TARGET_RATE) -> DataFrame:
    """One-second blocks of 16-bit mono samples at ``rate``. Channels are averaged,
    or the first is taken with ``mode="first"``."""

    def blocks(samples: np.ndarray, window: dict):
        first = window["start_sample"] // rate
        for i in range(0, len(samples), rate):
            yield window["recording"], first + i // rate, rate, samples[i : i + rate]

    return map_windows(_ranges(headers, rate), blocks, schemas.BLOCKS, mode, rate)


def read_windows(
    headers: DataFrame, windows: DataFrame, key: str, mode: str = "mean", rate: int = TARGET_RATE
) -> DataFrame:
    """Samples of windows (clips or chunks): ``recording, <key>, samples``. Windows
    past the end of a recording give no row."""
    field = windows.schema[key]
    renamed = "_key" if key == "path" else key

    def whole(samples: np.ndarray, window: dict):
        if len(samples):
            yield window["recording"], window[renamed], samples

    schema = T.StructType([_TEXT_RECORDING, field, _SAMPLES])
    bounds = windows.select(
        "recording", F.col(key).alias(renamed), "start_sample", "end_sample"
    )
    placed = lookup(bounds, _readable(headers), "recording", [renamed])
    return map_windows(placed, whole, schema, mode, rate)


def read_batches(
    headers: DataFrame,
    windows: DataFrame,
    batch: list[str],
    make: Callable[[list[dict], list[np.ndarray]], Iterable[tuple]],
    schema: T.StructType,
    mode: str = "mean",
    rate: int = TARGET_RATE,
) -> DataFrame:
    """``make(windows, samples)`` rows of every batch of windows (rows with equal
    ``batch`` columns, few enough for one task). Only the bounds are shuffled: the
    task that gets a batch reads its samples. Windows past the end of their recording
    are left out."""
    placed = lookup(windows, _readable(headers), "recording", ["start_sample"])
    tasks = spread(placed, *batch, per_task=WINDOWS_PER_TASK)
    to_arrow = to_arrow_schema(schema)

    def whole(rows: list[dict]) -> pa.RecordBatch:
        with closing(ByteRanges()) as ranges:
            samples = [_read(ranges, w, w["start_sample"], w["end_sample"], mode, rate) for w in rows]
        full = [i for i, s in enumerate(samples) if len(s)]
        return _batch(list(make([rows[i] for i in full], [samples[i] for i in full])), to_arrow)

    def run(batches):
        held: list[dict] = []
        for rows in batches:
            for window in rows.to_pylist():
                if held and any(window[k] != held[0][k] for k in batch):
                    yield whole(held)
                    held = []
                held.append(window)
        if held:
            yield whole(held)

    return tasks.sortWithinPartitions(*batch).mapInArrow(run, schema)


def energies(headers: DataFrame, mode: str = "mean", rate: int = TARGET_RATE) -> DataFrame:
    """Energy per millisecond in one-second blocks ``recording, block_no, energy``:
    all that loudness and silence need to know of the audio."""
    per_ms = rate // 1000

    def seconds(samples: np.ndarray, window: dict):
        first = window["start_sample"] // rate
        for i in range(0, len(samples), rate):
            energy = millisecond_energies(samples[i : i + rate], per_ms)
            yield window["recording"], first + i // rate, len(samples[i : i + rate]), energy

    return map_windows(_ranges(headers, rate), seconds, schemas.ENERGIES, mode, rate)


def segment(
    headers: DataFrame,
    min_silence: int = silence.MIN_SILENCE_MS,
    offset_db: float = silence.SILENCE_OFFSET_DB,
    mode: str = "mean",
    rate: int = TARGET_RATE,
    tile_ms: int = silence.TILE_MS,
) -> DataFrame:
    """Chunks of recordings, cut on silence: ``recording, chunk_no, start_ms,
    end_ms``. The files are read once, for their energies; the rest works on those."""
    stored = settle(energies(headers, mode, rate))
    return silence.segment(stored, 1000, min_silence, offset_db, rate, tile_ms)


_TEXT_RECORDING = T.StructField("recording", T.StringType())
_SAMPLES = T.StructField("samples", T.ArrayType(T.ShortType(), False))


def write_block_table(blocks: DataFrame, table: str, buckets: int) -> None:
    """Keep blocks bucketed by (recording, block_no): cutting clips or chunks out
    of such a table does not shuffle the audio again."""
    (
        blocks.write.mode("overwrite")
        .bucketBy(buckets, "recording", "block_no")
        .sortBy("recording", "block_no")
        .saveAsTable(table)
    )
