"""Files written from tasks: transcript documents and audio clips.

Documents are written under temporary names and then moved into place, so a task that
is retried, or runs twice, leaves the same single file. Clips and recordings are staged
and published together.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.lookup import lookup
from ..session import settle, shared_folder, spread
from ..sources.storage import resolve
from .publish import published, staged_batch, staged_name

COPY_BYTES = 4 << 20  # read at once when parts are put together


def _store(path: str, data: bytes) -> int:
    files, name = resolve(path)
    folder, _, base = name.rpartition("/")
    files.create_dir(folder, recursive=True)
    temporary = f"{folder}/_{uuid.uuid4().hex}.{base}"
    with files.open_output_stream(temporary) as stream:
        stream.write(data)
    files.move(temporary, name)
    return len(data)


def _written(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    paths, sizes = [r[0] for r in rows], [r[1] for r in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], schemas.WRITTEN.names
    )


def _put_together(parts: list[str], path: str) -> tuple[int, str]:
    """Stream part files, in order, into one file; its size and MD5."""
    files, name = resolve(path)
    folder, _, base = name.rpartition("/")
    files.create_dir(folder, recursive=True)
    temporary, size, md5 = f"{folder}/_{uuid.uuid4().hex}.{base}", 0, hashlib.md5()
    with files.open_output_stream(temporary) as out:
        for part in parts:
            store, source = resolve(part)
            with store.open_input_stream(source) as stream:
                while data := stream.read(COPY_BYTES):
                    out.write(data)
                    md5.update(data)
                    size += len(data)
    files.move(temporary, name)
    return size, md5.hexdigest()


def write_documents(parts: DataFrame, targets: DataFrame) -> DataFrame:
    """Write documents given as parts, each as one file; returns ``file, bytes``
    rows. The files are there once the result has been consumed.

    ``targets`` maps ``recording`` to ``file``. The parts are written in parallel to
    the shared folder, wherever they are; then one task per file, which gets their
    names only, streams them together. So text is never gathered in a row or a task,
    whatever the length of a document, and every document has the same layout.
    """
    folder = f"{shared_folder(parts.sparkSession)}/documents-{uuid.uuid4().hex}"
    placed = lookup(parts, targets.select("recording", "file"), "recording", ["section", "part_no"])

    def write(batches):
        for batch in batches:
            names = [f"{folder}/{uuid.uuid4().hex}" for _ in range(batch.num_rows)]
            for name, body in zip(names, batch["body"].to_pylist()):
                _store(name, body.encode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch["file"], batch["section"], batch["part_no"], pa.array(names, pa.string())],
                schemas.PART_FILES.names,
            )

    bodies = placed.select("file", "section", "part_no", "body")
    stored = settle(bodies.mapInArrow(write, schemas.PART_FILES))
    order = F.array_sort(F.collect_list(F.struct("section", "part_no", "part")))
    listed = stored.groupBy("file").agg(F.transform(order, lambda p: p["part"]).alias("parts"))

    def join(batches):
        for batch in batches:
            rows = zip(batch["file"].to_pylist(), batch["parts"].to_pylist())
            yield _written([(file, _put_together(names, file)[0]) for file, names in rows])

    return spread(listed, "file").mapInArrow(join, schemas.WRITTEN)


def wav_bytes(samples: np.ndarray, rate: int) -> bytes:
    """A mono 16-bit wav file."""
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as out:
        out.setnchannels(1)
        out.setsampwidth(2)
        out.setframerate(rate)
        out.writeframes(np.asarray(samples, "<i2").tobytes())
    return buffer.getvalue()


def write_clips(clips: DataFrame, directory: str, rate: int) -> DataFrame:
    """Write ``path, samples`` rows as wav files; returns ``file, bytes, md5`` rows. The
    files are there when this returns; if a task fails for good, none is."""
    root = directory.rstrip("/")
    named = clips.select(F.concat(F.lit(f"{root}/"), F.col("path")).alias("file"), "samples")

    def stage(folder: str) -> DataFrame:
        def write(batches):
            for batch in batches:
                rows = []
                for file, samples in zip(batch["file"].to_pylist(), batch["samples"]):
                    data = wav_bytes(samples.values.to_numpy(zero_copy_only=False), rate)
                    name = staged_name(folder)
                    rows.append((file, name, _store(name, data), hashlib.md5(data).hexdigest()))
                yield staged_batch(rows)

        return named.mapInArrow(write, schemas.STAGED)

    return published(stage, root)


def wav_header(frames: int, rate: int, floating: bool) -> bytes:
    """The header of a mono wav file of 16-bit or 32-bit floating point samples."""
    width, code = (4, 3) if floating else (2, 1)
    size = frames * width
    described = struct.pack("<HHIIHH", code, 1, rate, rate * width, width, 8 * width)
    return (
        b"RIFF" + struct.pack("<I", 36 + size) + b"WAVEfmt " + struct.pack("<I", 16) + described
        + b"data" + struct.pack("<I", size)
    )


def write_recordings(blocks: DataFrame, directory: str) -> DataFrame:
    """Write ``path, block_no, rate, floating, samples`` blocks of 16-bit samples as one
    wav file per path; returns ``file, bytes, md5`` rows. A file is streamed block by
    block by the task that gets its path, and published like a clip."""
    root = directory.rstrip("/")

    def stage(folder: str) -> DataFrame:
        def finished(path: str, body: str, frames: int, rate: int, floating: bool):
            head, whole = staged_name(folder), staged_name(folder)
            _store(head, wav_header(frames, rate, floating))
            size, md5 = _put_together([head, body], whole)
            return f"{root}/{path}", whole, size, md5

        def write(batches):
            out, now, frames = None, None, 0
            for batch in batches:
                columns = (batch[c].to_pylist() for c in ("path", "rate", "floating"))
                for path, rate, floating, samples in zip(*columns, batch["samples"]):
                    if out is None or path != now[0]:
                        if out is not None:
                            out.close()
                            yield staged_batch([finished(now[0], body, frames, *now[1:])])
                        now, frames, body = (path, rate, floating), 0, staged_name(folder)
                        store, name = resolve(body)
                        store.create_dir(name.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(name)
                    values = samples.values.to_numpy(zero_copy_only=False)
                    frames += len(values)
                    out.write((values / np.float32(32_768)).astype("<f4").tobytes() if floating else values.astype("<i2").tobytes())
            if out is not None:
                out.close()
                yield staged_batch([finished(now[0], body, frames, *now[1:])])

        rows = blocks.select("path", "block_no", "rate", "floating", "samples")
        streamed = rows.repartition("path").sortWithinPartitions("path", "block_no")
        return streamed.mapInArrow(write, schemas.STAGED)

    return published(stage, root)


def write_bytes(rows: DataFrame, directory: str) -> DataFrame:
    """Write ``path, body`` rows (binary) as files; returns ``file, bytes, md5``."""
    root = directory.rstrip("/")

    def stage(folder: str) -> DataFrame:
        def write(batches):
            for batch in batches:
                out = []
                for path, body in zip(batch["path"].to_pylist(), batch["body"].to_pylist()):
                    name = staged_name(folder)
                    out.append((f"{root}/{path}", name, _store(name, body), hashlib.md5(body).hexdigest()))
                yield staged_batch(out)

        return rows.select("path", "body").mapInArrow(write, schemas.STAGED)

    return published(stage, root)
