"""Files that appear only if the job that made them succeeded.

Tasks write under staged names of their own and report them. The reports are stored as
a table, whose rows are those of the attempts that Spark counted: the commit list. Only
then are the listed files moved to their names, in parallel; files of failed, repeated
or speculative attempts are not on the list and go with the staging folder. A job that
fails before the list is complete leaves nothing behind. Moving is idempotent, so a
repeated task finishes what another began.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..session import spread, stored
from ..sources.storage import resolve

#: Files that one task moves.
MOVES_PER_TASK = 500


def staged_name(folder: str) -> str:
    """A name in the staging folder that no other attempt uses."""
    return f"{folder}/{uuid.uuid4().hex}"


def staged_batch(rows: list[tuple[str, str, int, str]]) -> pa.RecordBatch:
    """Reports of staged files: ``(file, staged, bytes, md5)``."""
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], schemas.STAGED.names
    )


def _exists(path: str) -> bool:
    files, name = resolve(path)
    return files.get_file_info(name).type == fs.FileType.File


def _move(staged: str, file: str) -> None:
    files, name = resolve(file)
    _, source = resolve(staged)
    files.create_dir(name.rpartition("/")[0], recursive=True)
    try:
        files.move(source, name)
    except OSError:
        # another attempt was faster, or it is a real failure
        if _exists(staged) or not _exists(file):
            raise


def _remove(folder: str) -> None:
    files, name = resolve(folder)
    if files.get_file_info(name).type == fs.FileType.Directory:
        files.delete_dir(name)


def published(write: Callable[[str], DataFrame], directory: str) -> DataFrame:
    """Publish the files of ``write(folder)``, ``file, staged, bytes, md5`` rows of files
    staged in ``folder`` on the store of ``directory``. Returns ``file, bytes, md5``;
    the files are there when this returns. Two files of one name are an error, and then
    none is published."""
    folder = f"{directory.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        listed = stored(write(folder))
        twice = listed.groupBy("file").count().filter("count > 1").select("file").head(5)
        if twice:
            raise ValueError(f"more than one file of a name: {', '.join(r.file for r in twice)}")

        def move(batches):
            for batch in batches:
                for staged, file in zip(batch["staged"].to_pylist(), batch["file"].to_pylist()):
                    _move(staged, file)
                yield batch.select(schemas.PUBLISHED.names)

        spaced = spread(listed, "staged", per_task=MOVES_PER_TASK)
        return stored(spaced.mapInArrow(move, schemas.PUBLISHED))
    finally:
        _remove(folder)
