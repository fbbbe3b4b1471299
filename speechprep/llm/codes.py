"""Vector codes by product quantisation, trained on all vectors in flat blocks.

A vector becomes whole numbers and is cut into equal parts, each of which has a
codebook of its own. The tasks that read the vectors write them once as chunks. Within
a chunk each part's pieces are sorted along a Hilbert curve and cut into flat blocks,
which store their pieces, the smallest box around them and their sums. In every round a
block's box shortlists the entries that may be nearest to one of its pieces: with ``f``
the entry nearest to the block's mean, an entry is out if ``f`` is nearer everywhere in
the box. A block with one entry left gives its sums as they are; the others are
evaluated by exact whole-number kernels. Per round only sums by entry are shuffled, and
only the codebooks pass through the driver (parts x entries, whatever the number of
vectors). Vectors are never shuffled.

Distances are computed in floating point where every intermediate is a whole number
below 2**53, and in 64-bit integers otherwise; both are exact.

Defined results: a vector that is null, or holds a null or non-finite component, is
dropped, and so is one whose length is not a positive multiple of the parts or differs
from that of the kept vector with the smallest id (then the smallest components).
Components are limited to +-65536 before they are scaled, so that sums of squares fit
in 64 bits. Null ids come last among the first entries; equal vectors and ids count as often
as they occur. With fewer vectors than entries the codebooks are shorter. The table may
be empty; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechprep.llm.common import join_facts, settled

#: Vectors of one chunk (a row of the chunk table) and pieces of one block.
CHUNK_VECTORS, BLOCK_PIECES = 8192, 256
#: Largest size of a component before it is scaled.
LARGEST = 65536.0
#: Bits of a Hilbert key, and the most dimensions it spans.
KEY_BITS, KEY_DIMS = 64, 16
#: Below this, sums of squares of up to 64 differences are exact in floating point.
FLOAT_LIMIT = 1 << 22
FLOAT_DIMS = 64
_FIELDS = ("place", "piece", "low", "high", "total")


@dataclass(frozen=True)
class Layout:
    parts: int
    width: int  # components of a part

    def cut(self, values: np.ndarray, part: int) -> np.ndarray:
        return values[:, part * self.width : (part + 1) * self.width]


def hilbert_keys(values: np.ndarray) -> np.ndarray:
    """Places of rows along a Hilbert curve through the box around them, over the
    dimensions of the widest range (Skilling's transposition of the axes)."""
    n, width = values.shape
    if n == 0:
        return np.zeros(0, np.uint64)
    lows = values.min(axis=0)
    ranges = values.max(axis=0) - lows
    used = np.sort(np.argsort(-ranges, kind="stable")[: min(width, KEY_DIMS)])
    dims = len(used)
    bits = KEY_BITS // dims if dims > 1 else 32
    top = (1 << min(bits, 32)) - 1
    scaled = (values[:, used] - lows[used]) / np.maximum(ranges[used], 1) * top
    axes = [scaled[:, i].astype(np.uint64) for i in range(dims)]
    bits = min(bits, 32)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = np.uint64(1 << level)
        low = q - one
        for i in range(dims):
            flip = (axes[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(flip, low, swap)
            axes[i] ^= swap
    for i in range(1, dims):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(n, dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        q = np.uint64(1 << level)
        turn ^= np.where((axes[-1] & q) != 0, q - one, np.uint64(0))
    key = np.zeros(n, dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << one | ((axis ^ turn) >> np.uint64(level)) & one
    return key


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """``(_id, _label, _vec array<double>)`` of the vectors that take part."""
    vec = F.col(vector_col).cast("array<double>")
    plain = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), vec.alias("_vec"))
    most = F.lit(1.7976931348623157e308)
    good = F.forall("_vec", lambda x: x.isNotNull() & (F.abs(x) <= most))
    length = F.size("_vec")
    kept = plain.filter(F.col("_vec").isNotNull() & (length > 0) & (length % parts == 0) & good)
    first = kept.orderBy(F.col("_id").asc_nulls_last(), "_vec").select(length.alias("n")).first()
    return kept.filter(length == (first.n if first else 0))


def _numbers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    whole = np.floor(np.clip(flat, -LARGEST, LARGEST) * scale)
    return whole.astype(np.int64).reshape(-1, width)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in 2 or 4 or 8 bytes each, the width in front."""
    for code in ("<i2", "<i4", "<i8"):
        limits = np.iinfo(code)
        if values.size == 0 or (values.min() >= limits.min and values.max() <= limits.max):
            return code.encode() + values.astype(code).tobytes()
    raise OverflowError("beyond 64 bits")


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, data[:3].decode(), offset=3)


def _chunks(kept: DataFrame, layout: Layout, scale: int) -> DataFrame:
    """One row per chunk: the ids and labels, and for each part the pieces in Hilbert
    order, that order, and the blocks' boxes and sums."""
    width = layout.parts * layout.width

    def chunk(rows: pa.RecordBatch) -> list:
        values = _numbers(rows.column(2), width, scale)
        out = []
        for part in range(layout.parts):
            own = layout.cut(values, part)
            order = np.argsort(hilbert_keys(own), kind="stable")
            own = own[order]
            begins = np.arange(0, len(own), BLOCK_PIECES)
            out.append(
                {
                    "place": _packed(order),
                    "piece": _packed(own),
                    "low": _packed(np.minimum.reduceat(own, begins, axis=0)),
                    "high": _packed(np.maximum.reduceat(own, begins, axis=0)),
                    "total": _packed(np.add.reduceat(own, begins, axis=0)),
                }
            )
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: pa.RecordBatch) -> pa.RecordBatch:
            cut = chunk(rows)
            one = [pa.array([rows.column(k)], pa.list_(rows.schema.field(k).type)) for k in (0, 1)]
            stored = pa.array([cut], pa.list_(pa.struct([(f, pa.binary()) for f in _FIELDS])))
            return pa.RecordBatch.from_arrays([*one, stored], names=["ids", "labels", "parts"])

        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, CHUNK_VECTORS - count)
                batch = batch.slice(part.num_rows)
                held.append(part)
                count += part.num_rows
                if count == CHUNK_VECTORS:
                    yield made(pa.concat_batches(held))
                    held, count = [], 0
        if count:
            yield made(pa.concat_batches(held))

    fields = ", ".join(f"{f} binary" for f in _FIELDS)
    ids, labels = (kept.schema[c].dataType.simpleString() for c in ("_id", "_label"))
    schema = f"ids array<{ids}>, labels array<{labels}>, parts array<struct<{fields}>>"
    return kept.select("_id", "_label", "_vec").mapInArrow(run, schema)


class _Part:
    """One part of a chunk, against one codebook."""

    def __init__(self, stored: dict, layout: Layout, codebook: np.ndarray) -> None:
        self.pieces = _unpacked(stored["piece"]).reshape(-1, layout.width)
        shape = (-1, layout.width)
        self.low = _unpacked(stored["low"]).reshape(shape).astype(np.int64)
        self.high = _unpacked(stored["high"]).reshape(shape).astype(np.int64)
        self.total = _unpacked(stored["total"]).reshape(shape).astype(np.int64)
        self.counts = np.full(len(self.low), BLOCK_PIECES, dtype=np.int64)
        self.counts[-1] = len(self.pieces) - BLOCK_PIECES * (len(self.low) - 1)
        self.place = _unpacked(stored["place"])
        self.entries = codebook
        largest = max(np.abs(self.low).max(), np.abs(self.high).max(), np.abs(codebook).max())
        self.exact_floats = largest < FLOAT_LIMIT and layout.width <= FLOAT_DIMS
        self.kind = np.float64 if self.exact_floats else np.int64
        self.squares = (codebook.astype(self.kind) ** 2).sum(axis=1)

    def shortlists(self) -> np.ndarray:
        """Which entries may be nearest in which block."""
        entries = self.entries.astype(self.kind)
        mean = (self.total // self.counts[:, None]).astype(self.kind)
        near = np.argmin(self.squares - 2 * (mean @ entries.T), axis=1)
        out = np.empty((len(self.low), len(entries)), dtype=bool)
        for block, f in enumerate(near):
            # over the box the largest value of |x - f|^2 - |x - e|^2
            apart = entries - entries[f]
            corner = np.where(apart > 0, self.high[block], self.low[block])
            most = 2 * (apart * corner).sum(axis=1) + self.squares[f] - self.squares
            out[block] = most >= 0
        return out

    def assign(self) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every piece, ties to the lower one, and which blocks lie
        with a single entry as a whole."""
        nearest = np.empty(len(self.pieces), dtype=np.int64)
        listed = self.shortlists()
        single = listed.sum(axis=1) == 1
        for block in range(len(listed)):
            rows = slice(block * BLOCK_PIECES, block * BLOCK_PIECES + self.counts[block])
            among = np.flatnonzero(listed[block])
            if len(among) == 1:
                nearest[rows] = among[0]
                continue
            x = self.pieces[rows].astype(self.kind)
            # the piece's own square is the same for all entries
            scores = self.squares[among] - 2 * (x @ self.entries[among].astype(self.kind).T)
            nearest[rows] = among[np.argmin(scores, axis=1)]
        return nearest, single

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """How many pieces each entry has, and their sums."""
        nearest, single = self.assign()
        counts = np.bincount(nearest, minlength=len(self.entries))
        sums = np.zeros(self.entries.shape, dtype=np.int64)
        whole = np.flatnonzero(single)
        np.add.at(sums, nearest[whole * BLOCK_PIECES], self.total[whole])
        loose = np.flatnonzero(~np.repeat(single, self.counts))
        if len(loose):
            order = loose[np.argsort(nearest[loose], kind="stable")]
            ranked = nearest[order]
            begins = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
            sums[ranked[begins]] += np.add.reduceat(self.pieces[order].astype(np.int64), begins, axis=0)
        return counts, sums

    def coded(self) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every vector's piece, in the vectors' order."""
        nearest, _ = self.assign()
        apart = self.pieces.astype(np.int64) - self.entries[nearest]
        code, error = np.empty_like(nearest), np.empty(len(nearest), dtype=np.int64)
        code[self.place] = nearest
        error[self.place] = (apart * apart).sum(axis=1)
        return code, error


def _round(chunks: DataFrame, layout: Layout, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros(b.shape, dtype=np.int64) for b in books]
        for batch in batches:
            for cell in batch.column(0):
                for part, stored in enumerate(cell.as_py()):
                    more = _Part(stored, layout, books[part]).sums()
                    counts[part] += more[0]
                    sums[part] += more[1]
        for part, own in enumerate(counts):
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), part), pa.int32()),
                    pa.array(used, pa.int32()),
                    pa.array(own[used], pa.int64()),
                    pa.array(list(sums[part][used]), pa.list_(pa.int64())),
                ],
                names=["part", "entry", "n", "sums"],
            )

    found = chunks.select("parts").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    added = found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(layout.width))
    )
    out = [b.copy() for b in books]
    for row in added.collect():  # at most one row per entry
        out[row.part][row.entry] = [row[f"s{k}"] // row.n for k in range(layout.width)]
    return out


def _coded(chunks: DataFrame, layout: Layout, books: list[np.ndarray], kinds: list[str]) -> DataFrame:
    """``(_id, _label, code, error)`` of every vector."""
    digits = np.array([f"{k:02x}" for k in range(max((len(b) for b in books), default=0))], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                code, error = "", 0
                for part, stored in enumerate(batch.column(2)[row].as_py()):
                    nearest, apart = _Part(stored, layout, books[part]).coded()
                    code, error = code + digits[nearest], error + apart
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[row].values, batch.column(1)[row].values, pa.array(code, pa.string()), pa.array(error, pa.int64())],
                    names=["_id", "_label", "code", "error"],
                )

    return chunks.mapInArrow(run, f"_id {kinds[0]}, _label {kinds[1]}, code string, error long")


def books_digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(id_col, label_col, code, error)`` of the vectors that take part, stored, and
    the codebooks, one array of whole numbers per part. ``code`` has two hexadecimal
    digits per part, ``error`` is the squared distance to the entries it names."""
    kept = kept_vectors(vectors, id_col, vector_col, label_col, parts)
    kinds = [kept.schema[c].dataType.simpleString() for c in ("_id", "_label")]
    first = kept.orderBy(F.col("_id").asc_nulls_last(), "_vec").limit(entries).select("_vec").collect()
    width = len(first[0]._vec) // parts if first else 0
    layout = Layout(parts, width)
    start = _numbers(pa.array([r._vec for r in first], pa.list_(pa.float64())), parts * width or 1, scale)
    books = [layout.cut(start, part) for part in range(parts)]
    chunks = settled(_chunks(kept, layout, scale))
    for _ in range(rounds if first else 0):
        books = _round(chunks, layout, books)
    coded = settled(_coded(chunks, layout, books, kinds))
    return coded.withColumnRenamed("_id", id_col).withColumnRenamed("_label", label_col), books


def with_label_errors(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the errors of all vectors of the same label;
    nulls are one label."""
    text = F.concat(F.lit("="), F.col(label_col).cast("string"))
    keyed = coded.withColumn("_key", F.coalesce(text, F.lit("null")))
    sums = settled(
        keyed.groupBy("_key").agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows"))
    )
    total = sums.agg(F.sum("_rows")).first()[0] or 0
    return join_facts(keyed, sums, "_key", "_rows", total).drop("_key", "_rows")


def oracle(parts: int, width: int, entries: int, rounds: int, scale: int) -> str:
    """The codes of ``embeddings`` as SQL, every piece against every entry."""
    steps = [f"""pieces AS MATERIALIZED (
  SELECT vec_id, label, part, list_transform(embedding[part * {width} + 1:(part + 1) * {width}],
    lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS piece
  FROM embeddings, (SELECT unnest(range({parts})) AS part)
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), book_0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, piece AS center
  FROM pieces WHERE vec_id IN (SELECT DISTINCT vec_id FROM pieces ORDER BY vec_id LIMIT {entries})
)"""]
    for k in range(rounds + 1):
        steps.append(f"""near_{k} AS MATERIALIZED (
  SELECT vec_id, p.part, any_value(label) AS label, any_value(piece) AS piece, min({{'d': list_sum(list_transform(
    list_zip(piece, center), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': entry}}) AS best
  FROM pieces p JOIN book_{k} b ON b.part = p.part GROUP BY vec_id, p.part
)""")
        if k < rounds:
            steps.append(f"""sums_{k} AS MATERIALIZED (
  SELECT part, entry, list(mean ORDER BY pos) AS center FROM (
    SELECT part, best.e AS entry, pos, floor(sum(x) / count(*))::BIGINT AS mean
    FROM (SELECT part, best, unnest(piece) AS x, unnest(range({width})) AS pos FROM near_{k})
    GROUP BY part, best.e, pos) GROUP BY part, entry
), book_{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(s.center, b.center) AS center
  FROM book_{k} b LEFT JOIN sums_{k} s ON s.part = b.part AND s.entry = b.entry
)""")
    chain = ", ".join(steps)
    return f"""
WITH {chain}, digest AS (
  SELECT sha256(string_agg(array_to_string(center, ','), ',' ORDER BY part, entry)) AS sha FROM book_{rounds}
), coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code,
    sum(best.d)::BIGINT AS error
  FROM near_{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  sha AS codebooks_sha256
FROM coded, digest
"""
