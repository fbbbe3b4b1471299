"""Folders as a Spark data source, level by level.

``load()`` lists the folders that a stored table names; its partitions are slices of
that table, known from the footers of its files, so neither the folders of a level nor
what is in them passes through the driver. Conditions on the name, and on whether an
entry is a folder, are pushed down: entries that fail them never become rows.

    register(spark)
    spark.read.format("folder_level").option("folders", table).load()

Load anew for every query: Spark keeps what was pushed down with the loaded relation and
uses it again for a later query on it that pushes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from .storage import list_directory, resolve

FOLDERS_PER_TASK = 100
ENTRIES_PER_BATCH = 10_000
#: What file systems and Spark put beside the part files of a table.
_NO_PARTS = ("_", ".")


class Slice(InputPartition):
    """Rows ``first`` to ``last - 1`` of one file of the table of folders."""

    def __init__(self, file: str, first: int, last: int) -> None:
        super().__init__(None)
        self.file, self.first, self.last = file, first, last


def _test(condition: Filter) -> Callable[[str, bool], bool] | None:
    """What an entry's name and kind must pass, or None where Spark has to decide."""
    if isinstance(condition, Not):
        inner = _test(condition.child)
        return inner and (lambda name, folder: not inner(name, folder))
    if not hasattr(condition, "attribute"):
        return None
    if isinstance(condition, IsNotNull):
        return lambda name, folder: True  # no column has nulls
    value = getattr(condition, "value", None)
    if condition.attribute == ("directory",) and isinstance(condition, EqualTo):
        return lambda name, folder: folder == value
    if condition.attribute != ("name",):
        return None
    if isinstance(condition, StringEndsWith):
        return lambda name, folder: name.endswith(value)
    if isinstance(condition, StringStartsWith):
        return lambda name, folder: name.startswith(value)
    if isinstance(condition, StringContains):
        return lambda name, folder: value in name
    if isinstance(condition, EqualTo):
        return lambda name, folder: name == value
    if isinstance(condition, In):
        names = set(value)
        return lambda name, folder: name in names
    return None


class FolderReader(DataSourceReader):
    def __init__(self, table: str, per_task: int, suffix: str) -> None:
        self.table, self.per_task, self.suffix = table, per_task, suffix
        self.pushed: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            if _test(condition) is None:
                yield condition
            else:
                self.pushed.append(condition)

    def partitions(self) -> list[Slice]:
        out = []
        for path, is_folder, _ in list_directory(self.table):
            if is_folder or path.rsplit("/", 1)[1].startswith(_NO_PARTS):
                continue
            files, name = resolve(path)
            with files.open_input_file(name) as stream:
                rows = pq.read_metadata(stream).num_rows
            out += [Slice(path, k, min(k + self.per_task, rows)) for k in range(0, rows, self.per_task)]
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a table without rows
            return
        tests = [_test(condition) for condition in self.pushed]
        files, name = resolve(partition.file)
        with files.open_input_file(name) as stream:
            folders = pq.read_table(stream, columns=["path"]).column(0)
        for folder in folders.slice(partition.first, partition.last - partition.first).to_pylist():
            entries = (
                (path, name, is_folder, size)
                for path, is_folder, size in list_directory(folder)
                for name in [path.rsplit("/", 1)[1]]
                if (is_folder or name.endswith(self.suffix)) and all(t(name, is_folder) for t in tests)
            )
            while rows := list(islice(entries, ENTRIES_PER_BATCH)):
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _LISTING)]
                yield pa.RecordBatch.from_arrays(columns, schema=_LISTING)


class FolderLevel(DataSource):
    """Options: ``folders``, a Parquet table with a column ``path``; ``per_task``, how
    many folders one task lists; ``suffix``, what names of files (not of folders) have to
    end in."""

    @classmethod
    def name(cls) -> str:
        return "folder_level"

    def schema(self):
        return schemas.ENTRIES

    def reader(self, schema) -> FolderReader:
        per_task = int(self.options.get("per_task", FOLDERS_PER_TASK))
        return FolderReader(self.options["folders"], per_task, self.options.get("suffix", ""))


_LISTING = to_arrow_schema(schemas.ENTRIES)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let it take conditions."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FolderLevel)
