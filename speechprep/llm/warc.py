"""WARC archives: writing records with revisits, and a sequential reader.

An archive is a sequence of gzip members, one per record. The reader takes its bytes
in order, inflates them in small steps, frames each record by its Content-Length and
checks block and payload digests on the way; it never holds more than one step, apart
from payloads that are asked for.

Defined results: a null payload is an empty one; a null or empty url gives a record
without target; of records with equal payloads that with the largest id is the
response, a null id being the smallest; rows equal in id and payload are all
responses; a table without rows gives no archive, and no archive gives no rows; of
extra columns nothing is written. A record that cannot be read comes out as a row
with an ``error``, and the records behind it are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechprep.llm.common import fresh_folder, join_facts, settled
from speechprep.session import spread
from speechprep.sources.storage import resolve

#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Archives that one task reads.
ARCHIVES_PER_TASK = 8
#: Bytes of an archive read at once, and inflated at once.
STEP = 256 << 10
#: Bytes of rows sent on at once.
BATCH_BYTES = 4 << 20
#: A header block longer than this is taken for broken data.
LONGEST_HEADER = 1 << 20

# fixed values of the format
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:x-page:%s>"
MEMBER_BEGIN = b"\x1f\x8b\x08"
RECORD_END = b"\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_value(text: str) -> str:
    return re.sub(
        r"[\x00-\x20\x7f-\xa0]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text
    )


def record(
    number: str, url: str | None, payload: bytes, refers_to: str | None, date: str
) -> bytes:
    """One record: a response with its payload, or a revisit without it. Both have the
    HTTP header, with the payload's length."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {RECORD_ID % number}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        lines.insert(3, f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {RECORD_ID % refers_to}", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BadRecord(ValueError):
    """A record that cannot be framed; ``headers`` as far as they are known."""

    headers: dict[str, str] = {}


class BrokenData(BadRecord):
    """Data that cannot be inflated: where the member ends is not known."""


@dataclass
class Record:
    """What was read of one record. ``payload`` is None unless it was asked for."""

    headers: dict[str, str]
    payload_bytes: int = 0
    payload_digest: str = ""
    payload: bytes | None = None
    errors: list[str] = field(default_factory=list)


class Members:
    """The gzip members of a stream, each as its inflated bytes in steps. A member must
    be used up, or skipped, before the next one is asked for."""

    def __init__(self, stream) -> None:
        self.stream, self.raw = stream, b""

    def _more(self) -> bool:
        self.raw = self.raw or self.stream.read(STEP)
        return bool(self.raw)

    def __iter__(self) -> Iterator[Iterator[bytes]]:
        while self._more():
            yield self._steps()

    def _steps(self) -> Iterator[bytes]:
        inflate = zlib.decompressobj(wbits=31)
        while not inflate.eof:
            if not self._more():
                raise BadRecord("the archive ends within a record")
            begun = self.raw
            try:
                out = inflate.decompress(begun, STEP)
            except zlib.error as error:
                self.raw = begun[1:]
                raise BrokenData(str(error)) from error
            self.raw = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            if out:
                yield out

    def find_next(self) -> None:
        """Behind broken data: go on to what looks like the begin of a member."""
        while self._more():
            at = self.raw.find(MEMBER_BEGIN)
            if at >= 0:
                self.raw = self.raw[at:]
                return
            # the mark may be cut in two
            rest = self.raw[1 - len(MEMBER_BEGIN) :]
            more = self.stream.read(STEP)
            self.raw = rest + more if more else b""


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Body:
    """Takes a record's block in steps: digests, and the payload behind the HTTP
    header."""

    def __init__(self, keep: bool) -> None:
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.http: bytes | None = None
        self.begun, self.size = b"", 0
        self.kept: list[bytes] | None = [] if keep else None

    def take(self, data: bytes) -> None:
        self.block.update(data)
        if self.http is None:
            self.begun += data
            head, end, data = self.begun.partition(b"\r\n\r\n")
            if not end:
                if len(self.begun) > LONGEST_HEADER:
                    raise BadRecord("no end of the HTTP header")
                return
            self.http, self.begun = head, b""
        self.payload.update(data)
        self.size += len(data)
        if self.kept is not None:
            self.kept.append(data)


def _read_one(steps: Iterator[bytes], keep: bool) -> Record:
    head = b""
    while b"\r\n\r\n" not in head:
        part = next(steps, None)
        if part is None or len(head) > LONGEST_HEADER:
            raise BadRecord("no end of the header")
        head += part
    head, _, rest = head.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise BadRecord("no WARC record")
    found = Record(_headers(head))
    try:
        return _framed(found, rest, steps, keep)
    except BadRecord as error:
        error.headers = found.headers
        raise


def _framed(found: Record, rest: bytes, steps: Iterator[bytes], keep: bool) -> Record:
    length = found.headers.get("content-length", "")
    if not length.isdigit():
        raise BadRecord("no Content-Length")
    left, body = int(length), _Body(keep)
    while left:
        if not rest:
            rest = next(steps, None)
            if rest is None:
                raise BadRecord("shorter than its Content-Length")
        body.take(rest[:left])
        rest, left = rest[left:], max(left - len(rest), 0)
    while len(rest) <= len(RECORD_END) and (more := next(steps, None)) is not None:
        rest += more
    if rest != RECORD_END:
        raise BadRecord("longer than its Content-Length")

    def check(name: str, digest) -> str:
        own = base64.b32encode(digest.digest()).decode()
        stated = found.headers.get(name, "").partition(":")[2].upper()
        if stated and stated != own:
            found.errors.append(f"{name} differs")
        return own

    check("warc-block-digest", body.block)
    if found.headers.get("warc-type") == "revisit":
        http = _headers(body.http or b"")
        found.payload_bytes = int(http.get("content-length") or 0)
        found.payload_digest = found.headers.get("warc-payload-digest", "").partition(":")[2]
    else:
        found.payload_digest = check("warc-payload-digest", body.payload)
        found.payload_bytes = body.size
        found.payload = None if body.kept is None else b"".join(body.kept)
    return found


def read_records(stream, keep: bool = False) -> Iterator[Record]:
    """The records of one archive, in order. A record that cannot be read is one row with
    its error, and the next gzip member is read: it begins where the bad one ends, or,
    behind data that cannot be inflated, where the next one that holds a record begins."""
    members, lost = Members(stream), False
    for steps in members:
        try:
            found = _read_one(steps, keep)
            lost = False
        except BrokenData as error:
            members.find_next()
            if lost:
                continue  # still looking behind the same broken data
            lost, found = True, Record(error.headers, errors=[f"record not read: {error}"])
        except BadRecord as error:
            if lost and not error.headers:
                continue
            found = Record(error.headers, errors=[f"record not read: {error}"])
            try:
                for _ in steps:
                    pass
            except BrokenData:
                members.find_next()
                lost = True
            except BadRecord:
                pass  # the archive ends here
        yield found


def _number(header: str | None) -> str | None:
    before, _, after = RECORD_ID.partition("%s")
    if not header or not header.startswith(before) or not header.endswith(after):
        return None
    return header[len(before) : -len(after)] or None


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(_id, _url, _payload)`` with ``_refers``, the id of the response that a row's
    record revisits, or null. Shorter payloads are always responses."""
    keyed = pages.withColumn("_payload", F.coalesce("_payload", F.lit("").cast("binary")))
    keyed = keyed.withColumn(
        "_key", F.when(F.octet_length("_payload") >= least_bytes, F.sha1("_payload"))
    )
    groups = settled(
        keyed.filter("_key is not null")
        .groupBy("_key")
        .agg(F.max("_id").alias("_leader"), F.count("*").alias("_held"))
        .filter("_held > 1")
    )
    total = groups.agg(F.sum("_held")).first()[0] or 0
    joined = join_facts(keyed, groups, "_key", "_held", total)
    refers = F.when(~F.col("_id").eqNullSafe(F.col("_leader")), F.col("_leader"))
    return joined.select("_id", "_url", "_payload", refers.alias("_refers"))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of ``pages`` and return ``(path, records, bytes)`` of the
    archives. A task that runs twice writes other archives; only those of the run that
    counted are returned."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, name = resolve(folder)
        files.create_dir(name, recursive=True)
        out, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    base = f"{uuid.uuid4().hex}.warc.gz"
                    out, count, size = files.open_output_stream(f"{name}/{base}", compression=None), 0, 0
                raw = record(
                    row["_id"] or "", row["_url"], row["_payload"], row["_refers"], date
                )
                pack = zlib.compressobj(wbits=31)
                data = pack.compress(raw) + pack.flush()
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{folder}/{base}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{base}", count, size))
        columns = list(zip(*done, strict=True)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["path", "records", "bytes"],
        )

    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        F.col(payload_col).cast("binary").alias("_payload"),
    )
    marked = mark_revisits(rows, least_bytes)
    texts = marked.withColumn("_id", F.col("_id").cast("string")).withColumn(
        "_refers", F.coalesce(F.col("_refers").cast("string"))
    )
    return settled(texts.mapInArrow(write, "path string, records long, bytes long"))


def read_archives(archives: DataFrame, keep_payload: bool = False) -> DataFrame:
    """The records of the archives ``(path, ..)``: ``id, url, payload_bytes,
    payload_digest, record_type, refers_to, error`` and, if wanted, ``payload``.
    A task reads several archives, one after the other."""
    schema = (
        "id string, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to string, error string"
    ) + ", payload binary" * keep_payload
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [{"long": pa.int64(), "binary": pa.binary()}.get(p.split()[1], pa.string()) for p in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = resolve(path)
                with files.open_input_stream(name, compression=None) as stream:
                    for found in read_records(stream, keep_payload):
                        h = found.headers
                        row = (
                            _number(h.get("warc-record-id")),
                            h.get("warc-target-uri"),
                            found.payload_bytes,
                            found.payload_digest,
                            h.get("warc-type"),
                            _number(h.get("warc-refers-to")),
                            "; ".join([*found.errors, path]) if found.errors else None,
                        )
                        rows.append((*row, found.payload) if keep_payload else row)
                        size += 500 + len(found.payload or b"")
                        if size >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return spread(archives.select("path"), "path", per_task=ARCHIVES_PER_TASK).mapInArrow(read, schema)


def round_trip(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, ids in
    their own type. The archives stay there until the folder is cleared."""
    folder = fresh_folder(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, id_col, url_col, payload_col, least_bytes)
    kind = pages.schema[id_col].dataType
    return read_archives(archives).select(
        F.col("id").cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "error",
    )
