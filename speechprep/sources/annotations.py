"""Annotation documents (XML) to rows."""

from __future__ import annotations

import xml.etree.ElementTree as ElementTree
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import spread
from .storage import read_bytes, resolve

ROWS_PER_BATCH = 10_000
DOCUMENTS_PER_TASK = 500
CHUNK = 64 << 10  # of a document, parsed at once


def _why_unusable(text: str | None, audio: dict | None) -> str | None:
    if text is None:
        return "no text"
    if audio is None:
        return "no audio"
    return None if {"start", "end"} <= audio.keys() else "no timecode"


class _SentenceTag:
    """Told of a document's elements: which ones are its sentences. Builds no tree."""

    def __init__(self) -> None:
        self.depth, self.tag = 0, "W"

    def start(self, tag: str, attributes: dict) -> None:
        if self.depth == 1 and tag == "S":
            self.tag = "S"
        self.depth += 1

    def end(self, tag: str) -> None:
        self.depth -= 1

    def close(self) -> str:
        return self.tag


def _sentences(read: Callable[[], Iterator[bytes | str]], tag: str) -> Iterator[ElementTree.Element]:
    """The children of the root with a tag, each dropped before the next one."""
    parser, root, depth = ElementTree.XMLPullParser(["start", "end"]), None, 0
    for chunk in read():
        parser.feed(chunk)
        for event, node in parser.read_events():
            if event == "start":
                root = node if root is None else root
                depth += 1
                continue
            depth -= 1
            if depth == 1:
                if node.tag == tag:
                    yield node
                root.clear()


def _nodes(read: Callable[[], Iterator[bytes | str]] | None) -> Iterator[tuple]:
    """``pos, sent_id, text, start, end, reason`` of every sentence node, as written.

    Sentences are the S children of the root, or its W children where it has no S, which
    is known at the end only. ``read`` gives the document's chunks and is called twice:
    to see that it is sound and what its sentences are, and to read them. What is held is
    a chunk and a sentence, whatever the length of the document.
    """
    if read is None:
        yield 0, None, None, None, None, "unreadable document"
        return
    try:
        kinds = ElementTree.XMLParser(target=_SentenceTag())
        for chunk in read():
            kinds.feed(chunk)
        tag = kinds.close()
    except ElementTree.ParseError:
        yield 0, None, None, None, None, "bad document"
        return
    for pos, node in enumerate(_sentences(read, tag)):
        form, audio = node.find("FORM"), node.find("AUDIO")
        text = None if form is None else form.text
        times = {} if audio is None else audio.attrib
        why = _why_unusable(text, None if audio is None else times)
        yield pos, node.get("id"), text, times.get("start"), times.get("end"), why


def _chunks_of(document: bytes | str | None) -> Callable[[], Iterator[bytes | str]] | None:
    if document is None:
        return None
    return lambda: (document[k : k + CHUNK] for k in range(0, len(document), CHUNK))


def _chunks_in(path: str) -> Callable[[], Iterator[bytes]]:
    def read() -> Iterator[bytes]:
        files, name = resolve(path)
        with files.open_input_stream(name) as stream:
            while chunk := stream.read(CHUNK):
                yield chunk

    return read


def _rows(documents: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of the nodes of ``(recording, read)`` documents."""
    rows = []
    for recording, read in documents:
        for row in _nodes(read):
            rows.append((recording, *row))
            if len(rows) >= ROWS_PER_BATCH:
                yield _to_batch(rows)
                rows = []
    if rows:
        yield _to_batch(rows)


def parse_annotations(documents: DataFrame) -> DataFrame:
    """``recording, xml`` rows to one row per sentence node. Rows with a ``reason``
    are unusable; the others are spans. Of usable nodes of one recording and id, the
    last one gives the values and the first one the position; the others are listed
    as replaced. A null document gives one row with a reason."""

    def parse(batches):
        for batch in batches:
            documents = zip(batch["recording"].to_pylist(), batch["xml"].to_pylist())
            yield from _rows((name, _chunks_of(document)) for name, document in documents)

    return _last_wins(documents.select("recording", "xml").mapInArrow(parse, schemas.NODES))


def parse_files(paired: DataFrame) -> DataFrame:
    """The same of the annotation documents of ``stem, annotation`` rows, read from their
    files piece by piece, so that the length of a document does not matter. A document
    that cannot be read gives one row with a reason."""

    def parse(batches):
        for batch in batches:
            for stem, path in zip(batch["stem"].to_pylist(), batch["annotation"].to_pylist()):
                try:
                    files, name = resolve(path)
                    files.open_input_stream(name).close()
                    read = _chunks_in(path)
                except OSError:
                    read = None
                yield from _rows([(stem, read)])

    wanted = paired.filter(F.col("annotation").isNotNull()).select("stem", "annotation")
    placed = spread(wanted, "annotation", per_task=DOCUMENTS_PER_TASK)
    return _last_wins(placed.mapInArrow(parse, schemas.NODES))


def _last_wins(nodes: DataFrame) -> DataFrame:
    usable = F.col("reason").isNull()
    # nodes of one document, which one task has parsed
    same = Window.partitionBy("recording", "sent_id", usable)
    pos = F.col("pos")
    placed = nodes.withColumns({"_first": F.min("pos").over(same), "_last": F.max("pos").over(same)})
    kept = usable & (pos == F.col("_last"))
    return placed.withColumns(
        {
            "reason": F.when(usable & ~kept, "replaced").otherwise(F.col("reason")),
            "pos": F.when(kept, F.col("_first")).otherwise(pos),
        }
    ).drop("_first", "_last")


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), *[pa.string()] * 5]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, schemas.NODES.names)


def spans(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("reason").isNull()).drop("reason")


def read_documents(paired: DataFrame) -> DataFrame:
    """``recording, xml`` of paired recordings (``stem, annotation``). Bytes, not
    text: the parser obeys the document's own encoding declaration. A document that
    cannot be read is null."""

    def read(batches):
        for batch in batches:
            for stem, path in zip(batch["stem"].to_pylist(), batch["annotation"].to_pylist()):
                try:
                    data = read_bytes(path)
                except OSError:
                    data = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([stem], pa.string()), pa.array([data], pa.binary())],
                    ["recording", "xml"],
                )

    wanted = paired.filter(F.col("annotation").isNotNull()).select("stem", "annotation")
    placed = spread(wanted, "annotation", per_task=DOCUMENTS_PER_TASK)
    return placed.mapInArrow(read, "recording string, xml binary")
