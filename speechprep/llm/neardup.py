"""Near-duplicate groups from bottom-k sketches, exact at the end.

A text's set holds the 64-bit hashes of its distinct word shingles; one hash function
serves for all. The sketch of a set is its ``keep`` smallest hashes.

1. Texts with equal sets are one class, known by a digest of the set; from here on
   one text stands for its class.
2. Inverted lists of retained values generate overlaps. Two sets at the wanted
   similarity share at least ``least`` retained values (for large sets six standard
   deviations below the mean, for small ones exactly), hence ``SHARED_LISTED`` of the
   ``size - least + SHARED_LISTED`` that each one lists, whatever the order by which
   these are chosen. The order is rarity, as counted in a table of fixed size. A short
   list gives its pairs. Two sets that meet in fewer than three short lists share
   ``SHARED_LISTED - 2`` values of long ones, of which, as there are few colours of
   values, several pairs are of one colour; hence long lists are split by a second
   listed value of the same colour. Short lists of such pairs of values give pairs again,
   that have to meet as often as follows from that; long ones, of sets that share two
   values many others share too, join their members to the first one. Joined classes form
   a bundle. A large bundle is formed anew, of pairs and of members of a long list whose
   marks, bitmaps of the sketches, share as many bits as those of a link must: unrelated
   sets meet in some long list, and the larger the corpus, the more they hold together.
3. Within a bundle, in blocks of bounded size, overlaps of the sketches and the
   estimate from the union's sketch choose pairs, and their full sets decide.
   A large bundle is cut into blocks. Blocks are solved by themselves, then the
   best linked members of all blocks together; members that are not yet in the
   bundle's largest group are at last held against all blocks. No link that could
   join two groups is left out, and pairs within a group are never emitted.

Defined results: a null or empty text, or one without words, has no shingles, is
linked with nothing and is kept. Rows with equal ids and texts are one row twice and
get equal results. Rows with null ids take part; a group of only such rows has a null
``component_id``. Order and ties do not matter, since a group is named by its smallest
id. The table may be empty; of extra columns nothing is read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechprep.llm.common import components, join_facts, settled, temporary, without
from speechprep.llm.spans import Texts, grams, mix, pieces

#: Lists up to this length give their pairs.
SHORT_LIST = 12
#: Listed values that two sets of a link share, if they can share so many; meetings in
#: short lists that make a pair a candidate; colours of values, which have to be fewer
#: than the values that are left for long lists.
SHARED_LISTED, MEETINGS, COLOURS = 9, 3, 3
#: Places of the table in which retained values are counted to tell their rarity.
COUNTED, SLICE = 1 << 22, 1 << 16
#: A value with more than one of this many parts of all listed values, or this many
#: rows, goes to no list of its own.
HOT_PART, HOT_ROWS = 4096, 1 << 16
#: Classes and shingles of one block.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 400_000
#: Best linked members of a block that meet those of other blocks.
HUBS = 2
#: A bundle of more classes than this is formed anew by marks.
LARGE_BUNDLE = 1 << 13
#: Bits of a mark; pairs of marks that are compared at once; members of a list that one
#: task compares with each other.
MARK_BITS, AT_ONCE, LIST_PART = 256, 1 << 17, 1 << 15
#: Classes that are looked up by broadcast; and bits of the bitmap that finds more.
BROADCAST_IDS, BITMAP = 200_000, 1 << 27


@dataclass(frozen=True)
class Similarity:
    """Link sets with ``100 * shared >= percent * union``; shingles of ``words``
    words; sketches of ``keep`` values."""

    words: int = 5
    percent: int = 80
    keep: int = 64

    @property
    def spread(self) -> float:
        share = self.percent / 100
        return 6 * math.sqrt(share * (1 - share) / self.keep)

    @property
    def least(self) -> int:
        """Fewest shared retained values of two sets that may be cut off."""
        return max(1, math.floor(self.keep * (self.percent / 100 - self.spread)))

    def shared_at_least(self, size: np.ndarray) -> np.ndarray:
        """The same for sets of ``size``; below ``keep * percent / 100`` both sets
        of a link are whole."""
        whole = -(-self.percent * size // 100)
        return np.where(100 * size <= self.keep * self.percent, whole, self.least)


def shingle_sets(texts: Texts, words: int) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; a text of fewer words has
    one, of all its words."""
    lowered = texts.lower()
    starts, ends = lowered.words()
    owners = lowered.owners(starts)
    hashes = lowered.hashes(starts, ends)
    values, firsts = grams(hashes, owners, words)
    of = owners[firsts]
    counts = np.bincount(owners, minlength=len(texts))
    few = np.flatnonzero((counts > 0) & (counts < words))
    if len(few):
        begin = np.concatenate([[0], np.cumsum(counts)])
        extra = []
        for i in few:
            own = hashes[begin[i] : begin[i + 1]]
            extra.append(grams(own, np.zeros(len(own), np.int64), len(own))[0][0])
        values = np.concatenate([values, mix(np.array(extra, dtype=np.uint64) + counts[few].astype(np.uint64))])
        of = np.concatenate([of, few])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    values, of = values[new], of[new]
    return np.split(values, np.searchsorted(of, np.arange(1, len(texts))))


def _class_of(values: np.ndarray) -> int:
    raw = hashlib.blake2b(values.tobytes(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def _sketches(documents: DataFrame, how: Similarity) -> DataFrame:
    """``(_id, _hash, n, node, sketch)`` of ``(_id, _text, _hash)``; node null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "_text"):
            sets = shingle_sets(texts, how.words)
            nodes = [_class_of(s) if len(s) else None for s in sets]
            sketches = [s[: how.keep].view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["_id", "_hash", "n", "node", "sketch"],
            )

    kind = documents.schema["_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"_id {kind}, _hash long, n long, node long, sketch array<long>")


#: What a task knows of the class whose set it makes.
_PLACED = ("node", "n", "bundle", "blocks", "block")


def _members(texts: DataFrame, placed: DataFrame, how: Similarity) -> DataFrame:
    """``placed (first_id, node, n, bundle, blocks, block)`` with ``set``, the classes'
    full sets. One text of each class is read, that with ``first_id``.

    Up to ``BROADCAST_IDS`` classes are looked up by broadcast, and their sets carry
    where they belong. Beyond, a bitmap of ids, of a fixed size, leaves few other texts,
    and the sets meet their places by shuffle.
    """
    known = F.broadcast(placed.withColumnRenamed("first_id", "_wanted"))
    same = F.col("_id").eqNullSafe(F.col("_wanted"))
    if placed.count() <= BROADCAST_IDS:
        return _sets(texts.join(known, same).select("_text", *_PLACED), how, _PLACED)
    place = F.pmod(F.xxhash64("first_id"), F.lit(BITMAP)) + 1
    parts = (
        placed.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("at"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )
    held = np.zeros(BITMAP // 8, dtype=np.uint8)
    for row in parts.collect():  # as many bits as BITMAP, whatever the number of ids
        held[(row.part - 1) * len(row.bits) : row.part * len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column(1).to_numpy()
            yield batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    numbered = texts.select("_text", F.pmod(F.xxhash64("_id"), F.lit(BITMAP)).alias("_at"))
    few = numbered.mapInArrow(run, "_text string, _at long")
    return _sets(few.select("_text"), how, ()).join(placed.drop("first_id"), "node")


def _sets(texts: DataFrame, how: Similarity, placed: tuple[str, ...]) -> DataFrame:
    """``(node, .., set binary)`` of ``(_text, ..)``, with the columns ``placed``. A text
    that has the id but not the set of its class is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in pieces(batches, "_text"):
            sets = shingle_sets(own, how.words)
            nodes = [_class_of(s) if len(s) else None for s in sets]
            wanted = batch.column(1).to_pylist() if placed else nodes
            kept = [i for i, node in enumerate(nodes) if node is not None and node == wanted[i]]
            columns = batch.take(pa.array(kept, pa.int64())).columns[2:] if placed else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([nodes[i] for i in kept], pa.int64()),
                    *columns,
                    pa.array([sets[i].tobytes() for i in kept], pa.binary()),
                ],
                names=["node", *placed[1:], "set"],
            )

    more = "".join(f"{c} {texts.schema[c].dataType.simpleString()}, " for c in placed[1:])
    return texts.mapInArrow(run, f"node long, {more}set binary")


def _least_second() -> int:
    """In how many pairs of values of one colour two sets meet at least, if they meet in
    fewer than ``MEETINGS`` short lists: when the colours are spread most evenly."""
    left = SHARED_LISTED - MEETINGS + 1
    sizes = [left // COLOURS + (k < left % COLOURS) for k in range(COLOURS)]
    return sum(math.comb(size, 2) for size in sizes)


def _counts(sketched: DataFrame) -> np.ndarray:
    """How often retained values fall into each of ``COUNTED`` places. Only the order
    that it gives values counts, so it does not matter that values share places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTED, dtype=np.int32)
        for batch in batches:
            # equal texts are one set
            _, once = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
            values = batch.column(1).take(pa.array(once)).flatten().to_numpy()
            places, often = np.unique(values & (COUNTED - 1), return_counts=True)
            held[places] += often.astype(np.int32)
        packed = [_packed(held[k : k + SLICE]) for k in range(0, COUNTED, SLICE)]
        numbers = pa.array(range(len(packed)), pa.int32())
        yield pa.RecordBatch.from_arrays([numbers, pa.array(packed, pa.binary())], names=["slice", "held"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(_unpacked(x).astype(np.int64) for x in rows["held"])
        total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "held": [_packed(total)]})

    rows = sketched.filter("node is not null").select("node", "sketch")
    counted = rows.mapInArrow(run, "slice int, held binary")
    summed = counted.groupBy("slice").applyInPandas(add, "slice int, held binary").collect()
    out = np.zeros(COUNTED, dtype=np.int32)
    for row in summed:  # one per slice
        out[row.slice * SLICE : (row.slice + 1) * SLICE] = _unpacked(row.held)
    return out


def _packed(counts: np.ndarray) -> bytes:
    kind = next(k for k in ("<u1", "<u2", "<u4") if counts.max() <= np.iinfo(k).max)
    return kind.encode() + zstandard.ZstdCompressor(level=1).compress(counts.astype(kind).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[3:]), data[:3].decode())


def _listed(sketched: DataFrame, counts: np.ndarray, how: Similarity) -> DataFrame:
    """``sketched`` with the values each set lists: ``cold``, and ``hot`` ones, which
    are too frequent for a list of their own; and the ``mark`` of the sketch."""
    limit = max(HOT_ROWS, int(counts.sum(dtype=np.int64)) // HOT_PART)
    shared = sketched.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            n = batch.column(2).to_numpy()
            column = batch.column(4)
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            values = column.flatten().to_numpy()
            of = np.repeat(np.arange(len(sizes)), sizes)
            often = frequent[values & (COUNTED - 1)]
            order = np.lexsort((values, often, of))
            least = how.shared_at_least(n)
            take = sizes - least + np.minimum(SHARED_LISTED, least)
            rank = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = order[rank < np.repeat(take, sizes)]
            hot = often[order] > limit
            lists = []
            for chosen in (order[~hot], order[hot]):
                ends = np.searchsorted(of[chosen], np.arange(len(sizes) + 1)).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values[chosen])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *lists, _marks(values, of, len(sizes))],
                names=["_id", "_hash", "n", "node", "cold", "hot", "mark"],
            )

    kind = sketched.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _hash long, n long, node long, cold array<long>, hot array<long>, mark binary"
    return sketched.filter("node is not null").mapInArrow(run, schema)


def _marks(values: np.ndarray, of: np.ndarray, count: int) -> pa.Array:
    """Bitmaps of the ``values`` of each of ``count`` sketches."""
    bits = np.zeros((count, MARK_BITS), dtype=bool)
    bits[of, (values >> 24) & (MARK_BITS - 1)] = True
    size = MARK_BITS // 8
    ends = pa.array(np.arange(count + 1, dtype=np.int32) * size)
    return pa.Array.from_buffers(pa.binary(), count, [None, ends.buffers()[1], pa.py_buffer(np.packbits(bits, axis=1))])


class _Marked:
    """Classes that are compared by the marks of their sketches."""

    def __init__(self, n: np.ndarray, marks: list[bytes], how: Similarity) -> None:
        self.n, self.how = n, how
        self.marks = np.frombuffer(b"".join(marks), np.uint64).reshape(len(n), MARK_BITS // 64)
        self.least = how.shared_at_least(n)
        # bits that values of the sketch have in common, less than none
        self.spare = np.bitwise_count(self.marks).sum(axis=1, dtype=np.int64) - np.minimum(n, how.keep)

    def alike(self, i: np.ndarray, other: _Marked, j: np.ndarray) -> np.ndarray:
        """Whether the classes ``i`` may be linked with the ``j`` of the other ones. Sketches
        of a link share ``least`` values; the other values of each can make no more bits of
        its mark than there are of them, so that the rest of its bits is shared."""
        small, large = np.minimum(self.n[i], other.n[j]), np.maximum(self.n[i], other.n[j])
        least = np.maximum(self.least[i], other.least[j]) + np.maximum(self.spare[i], other.spare[j])
        shared = np.zeros(least.shape, dtype=np.int64)
        for k in range(self.marks.shape[1]):
            shared += np.bitwise_count(self.marks[i, k] & other.marks[j, k])
        return (shared >= least) & (100 * small >= self.how.percent * large)

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be linked and join all that such pairs join."""
        rest, froms, tos = np.arange(len(self.n)), [], []
        width = max(1, AT_ONCE // max(1, len(rest)))
        while len(rest):
            seeds = rest[:width]
            met = self.alike(seeds[:, None], self, rest[None, :])
            met[np.arange(len(seeds)), np.arange(len(seeds))] = False
            some = np.flatnonzero(met.any(axis=1))
            alone = np.ones(len(rest), dtype=bool)
            alone[: len(seeds)] = met.any(axis=1)
            if len(some) == 0:
                rest = rest[alone]
                continue
            queue = [seeds[some[:1]]]  # everything that this one is joined with, breadth first
            rest = rest[alone & (rest != seeds[some[0]])]
            while queue:
                wave = queue.pop()
                for low in range(0, len(wave), width):
                    part = wave[low : low + width]
                    near = self.alike(part[:, None], self, rest[None, :])
                    found = near.any(axis=0)
                    if found.any():
                        froms.append(part[near[:, found].argmax(axis=0)])
                        tos.append(rest[found])
                        queue.append(rest[found])
                        rest = rest[~found]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *froms]), np.concatenate([none, *tos])


def _alike_pairs(pairs: DataFrame, marks: DataFrame, how: Similarity) -> DataFrame:
    """The ``pairs (a, b)`` that may be linked by ``marks (node, n, mark)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                _Marked(batch.column(k).to_numpy(), batch.column(k + 1).to_pylist(), how) for k in (2, 4)
            )
            at = np.arange(batch.num_rows)
            yield batch.filter(pa.array(left.alike(at, right, at))).select(["a", "b"])

    both = pairs.select("a", "b").distinct()
    for end in ("a", "b"):
        both = both.join(marks.toDF(end, f"n_{end}", f"mark_{end}"), end)
    return both.select("a", "b", "n_a", "mark_a", "n_b", "mark_b").mapInArrow(run, "a long, b long")


def _alike_members(lists: DataFrame, marks: DataFrame, how: Similarity) -> DataFrame:
    """Pairs ``(a, b)`` that join the members of each of the ``lists (value, node)`` that
    may be linked, and those that such are linked with. Lists of more than ``LIST_PART``
    members, of which there are few, are cut into parts, and any two parts are compared."""
    sizes = lists.groupBy("value").agg(F.ceil(F.count("*") / LIST_PART).cast("int").alias("parts"))
    cut = F.broadcast(sizes.filter("parts > 1").withColumnRenamed("value", "_value"))
    rows = lists.join(cut, F.col("value") == F.col("_value"), "left").join(marks, "node")
    rows = rows.withColumn("part", F.coalesce(F.pmod(F.xxhash64("node"), "parts").cast("int"), F.lit(0)))
    others = F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)
    rows = rows.withColumn("other", F.explode(others)).filter("parts is null or other <> part")
    cell = F.xxhash64("value", F.least("part", "other"), F.greatest("part", "other"))

    def edges(rows: pa.Table) -> pa.RecordBatch:
        nodes = rows["node"].to_numpy()
        i, j = _Marked(rows["n"].to_numpy(), rows["mark"].to_pylist(), how).forest()
        return pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(nodes[j])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, held = None, []  # the list that may go on, and the pieces of it
        for batch in batches:
            cells = batch.column(0).to_numpy()
            begins = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))[: len(cells)]
            for low, high in zip(begins, np.append(begins[1:], len(cells)), strict=True):
                if cells[low] != open_ and held:
                    yield edges(pa.Table.from_batches(held))
                    held = []
                open_ = cells[low]
                held.append(batch.slice(low, high - low))
        if held:
            yield edges(pa.Table.from_batches(held))

    dealt = rows.select(cell.alias("cell"), "node", "n", "mark").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "a long, b long")


def _meetings(rows: DataFrame, how: Similarity, meetings: int) -> DataFrame:
    """What meets in the lists of ``rows (value, node, n)``: pairs ``(a, b, wanted)`` of
    short lists, and of long ones every member with the list's first, ``(a, b, n,
    value)``. A list is read in the order of its members and never held as a whole.
    ``wanted`` is ``meetings``, or 1 for sets that may share too few values for that."""

    def pairs(value: np.ndarray, node: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        least = how.shared_at_least(n)
        found = []
        for apart in range(1, SHORT_LIST):
            i = np.flatnonzero(value[apart:] == value[:-apart])
            j = i + apart
            i, j = i[node[i] != node[j]], j[node[i] != node[j]]
            similar = 100 * np.minimum(n[i], n[j]) >= how.percent * np.maximum(n[i], n[j])
            i, j = i[similar], j[similar]
            wanted = np.where(np.maximum(least[i], least[j]) >= SHARED_LISTED, meetings, 1)
            found.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), wanted]))
        return np.concatenate(found, axis=1)

    def out(pair: np.ndarray, long: list[np.ndarray]) -> pa.RecordBatch:
        rest, k = len(long[0]), pair.shape[1]
        of_pair = np.arange(k + rest) < k
        columns = [
            np.concatenate([pair[0], long[0]]),
            np.concatenate([pair[1], long[1]]),
            pa.array(np.concatenate([pair[2], np.zeros(rest, np.int64)]), mask=~of_pair),
            pa.array(np.concatenate([np.zeros(k, np.int64), long[2]]), mask=of_pair),
            pa.array(np.concatenate([np.zeros(k, np.int64), long[3]]), mask=of_pair),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "wanted", "n", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held, open_ = [none] * 3, None  # the last list so far, or of a long one its value and first
        for batch in _then_none(batches):
            more = [none] * 3 if batch is None else [c.to_numpy() for c in batch.columns]
            value, node, n = (np.concatenate(x) for x in zip(held, more, strict=True))
            if len(value) == 0:
                continue
            begins = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            sizes = np.diff(np.append(begins, len(value)))
            first, size = np.repeat(node[begins], sizes), np.repeat(sizes, sizes)
            is_long = size > SHORT_LIST
            if open_ is not None and open_[0] == value[0]:
                first[: sizes[0]], is_long[: sizes[0]] = open_[1], True
            last = np.arange(len(value)) >= begins[-1]
            held = [none] * 3
            if batch is not None:
                if is_long[-1]:
                    open_ = value[-1], first[-1]
                else:
                    held = [x[last] for x in (value, node, n)]
                    is_long = is_long | last  # not yet: neither long nor short
            is_short = ~is_long
            listed = is_long & ~(last & (len(held[0]) > 0))
            yield out(
                pairs(value[is_short], node[is_short], n[is_short]),
                [node[listed], first[listed], n[listed], value[listed]],
            )

    dealt = rows.select("value", "node", "n").repartition("value").sortWithinPartitions("value", "node")
    return dealt.mapInArrow(run, "a long, b long, wanted long, n long, value long")


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _second_values(rows: DataFrame, how: Similarity) -> DataFrame:
    """``(value, node, n, hot)`` of ``(node, n, cold, hot)``: the pairs of a set's values
    that have the same colour, or all pairs if it may share too few values for that.
    ``hot`` are those of which both values are hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            cold, hot = batch.column(2), batch.column(3)
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), cold, hot)
            for node, n, *lists in rows:
                own = [x.values.to_numpy() for x in lists]
                values = np.concatenate(own)
                is_hot = np.arange(len(values)) >= len(own[0])
                order = np.argsort(values)
                values, is_hot = values[order], is_hot[order]
                i, j = np.triu_indices(len(values), 1)
                if how.shared_at_least(np.array([n]))[0] >= SHARED_LISTED:
                    colour = (values >> 20) % COLOURS
                    same = colour[i] == colour[j]
                    i, j = i[same], j[same]
                key = mix(values[i].view(np.uint64) * np.uint64(3) + mix(values[j].view(np.uint64)))
                found.append((key.view(np.int64), np.full(len(i), node), np.full(len(i), n), is_hot[i] & is_hot[j]))
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["value", "node", "n", "hot"])

    return rows.select("node", "n", "cold", "hot").mapInArrow(
        run, "value long, node long, n long, hot boolean"
    )


def _ties(classes: DataFrame, how: Similarity) -> DataFrame:
    """``(a, b, value)`` of the classes that may have a link: step 2 above. Pairs that met
    often enough have no ``value``; those of a long list have that of the list, and every
    member, also its first one, comes with the first one as ``b``."""
    # two different sets share all but one value at most
    smallest = -(-how.percent // (100 - how.percent)) if how.percent < 100 else None
    if smallest is None:
        return classes.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"), F.col("n").alias("value"))
    rows = classes.filter(F.col("n") >= smallest).select("node", "n", "cold", "hot")

    def met(found: DataFrame) -> DataFrame:
        pairs = found.filter("wanted is not null").groupBy("a", "b")
        often = pairs.agg(F.count("*").alias("lists"), F.max("wanted").alias("wanted"))
        return often.filter("lists >= wanted").select("a", "b", F.lit(None).cast("long").alias("value"))

    single = settled(_meetings(rows.select(F.explode("cold").alias("value"), "node", "n"), how, MEETINGS))
    long = single.filter("value is not null").select(F.col("a").alias("node"), "n", "value", F.lit(False).alias("hot"))
    hot = rows.select("node", "n", F.explode("hot").alias("value"), F.lit(True).alias("hot"))
    by_node = (
        long.union(hot)
        .groupBy("node", "n")
        .agg(
            F.collect_list(F.when(~F.col("hot"), F.col("value"))).alias("cold"),
            F.collect_list(F.when(F.col("hot"), F.col("value"))).alias("hot"),
        )
        .filter(F.size("cold") + F.size("hot") > 1)
    )
    second = settled(_second_values(by_node, how))
    double = settled(_meetings(second.filter("not hot"), how, _least_second()))
    tied = double.filter("value is not null").select("a", "b", "value")
    keyed = second.filter("hot").select("value", "node")
    firsts = settled(keyed.groupBy("value").agg(F.min("node").alias("first"), F.count("*").alias("held")))
    total = firsts.agg(F.sum("held")).first()[0] or 0
    starred = join_facts(keyed, firsts, "value", "held", total).select(
        F.col("node").alias("a"), F.col("first").alias("b"), "value"
    )
    return met(single).union(met(double)).union(tied).union(starred)


def _bundles(classes: DataFrame, how: Similarity) -> DataFrame:
    """``(node, root)`` of the ``classes (node, n, cold, hot, mark)`` that may have a link.
    The ``mark`` is needed only if bundles become large."""
    ties = _ties(classes, how)
    bundles = components(ties.select("a", "b"))
    sizes = bundles.groupBy("root").agg(F.count("*").alias("held"))
    large = sizes.filter(F.col("held") > LARGE_BUNDLE)
    total = large.agg(F.sum("held")).first()[0]
    if total is None or "mark" not in classes.columns:
        return bundles
    known = join_facts(bundles, settled(large), "root", "held", total)
    known = settled(known.select("node", "root", F.col("held").isNotNull().alias("large")))
    marks = classes.select("node", "n", "mark").join(known.filter("large").select("node"), "node", "left_semi")
    inside = settled(ties.join(marks.select(F.col("node").alias("a")), "a", "left_semi"))
    marks = settled(marks)
    pairs = settled(_alike_pairs(inside.filter("value is null"), marks, how))
    lists = inside.filter("value is not null").select("value", F.col("a").alias("node"))
    members = settled(_alike_members(lists, marks, how).distinct())
    return known.filter("not large").select("node", "root").union(components(pairs.union(members)))


class _Block:
    """Classes whose sketches and sets are compared within one task."""

    def __init__(self, rows: pd.DataFrame) -> None:
        rows = rows.drop_duplicates("node").sort_values("node")
        self.nodes = rows["node"].to_numpy()
        self.sets = [np.frombuffer(s, np.uint64) for s in rows["set"]]
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        self.roots = rows["root"].to_numpy() if "root" in rows else self.nodes


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sorted sets share."""
    a, b = np.concatenate(left), np.concatenate(right)
    values, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    in_a = np.zeros(len(values), dtype=bool)
    in_b = np.zeros(len(values), dtype=bool)
    in_a[place[: len(a)]] = True
    in_b[place[len(a) :]] = True
    columns = np.full(len(values), -1)
    both = np.flatnonzero(in_a & in_b)
    columns[both] = np.arange(len(both))
    rows_a = np.repeat(np.arange(len(left)), [len(s) for s in left])
    rows_b = np.repeat(np.arange(len(right)), [len(s) for s in right])
    at_a, at_b = columns[place[: len(a)]], columns[place[len(a) :]]
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    width = 1 << 14
    for low in range(0, len(both), width):
        x = np.zeros((len(left), width), dtype=np.float32)
        y = np.zeros((len(right), width), dtype=np.float32)
        use = (at_a >= low) & (at_a < low + width)
        x[rows_a[use], at_a[use] - low] = 1
        use = (at_b >= low) & (at_b < low + width)
        y[rows_b[use], at_b[use] - low] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def _estimates(x: np.ndarray, y: np.ndarray, keep: int) -> np.ndarray:
    """Similarities estimated from the bottom-k sketch of the union. Rows of ``x`` and
    ``y`` are sketches, filled up with the largest number."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.empty(len(x))
    for low in range(0, len(x), 4096):
        merged = np.sort(np.concatenate([x[low : low + 4096], y[low : low + 4096]], axis=1), axis=1)
        twice = np.zeros(merged.shape, dtype=bool)
        twice[:, 1:] = (merged[:, 1:] == merged[:, :-1]) & (merged[:, 1:] != top)
        rank = np.cumsum(~twice & (merged != top), axis=1)
        retained = np.minimum(rank[:, -1], keep)
        out[low : low + 4096] = (twice & (rank <= keep)).sum(axis=1) / np.maximum(retained, 1)
    return out


def _padded(sets: list[np.ndarray], keep: int) -> np.ndarray:
    out = np.full((len(sets), keep), np.uint64(0xFFFFFFFFFFFFFFFF))
    for i, s in enumerate(sets):
        out[i, : min(len(s), keep)] = s[:keep]
    return out


def _linked(left: _Block, right: _Block, how: Similarity) -> np.ndarray:
    """Matrix of the links between two blocks: overlaps, estimates, then full sets."""
    keep = how.keep
    overlaps = _shared([s[:keep] for s in left.sets], [s[:keep] for s in right.sets])
    least_a = how.shared_at_least(left.sizes)[:, None]
    least_b = how.shared_at_least(right.sizes)[None, :]
    small = np.minimum(left.sizes[:, None], right.sizes[None, :])
    large = np.maximum(left.sizes[:, None], right.sizes[None, :])
    chosen = (overlaps >= np.maximum(least_a, least_b)) & (100 * small >= how.percent * large)
    chosen &= left.nodes[:, None] != right.nodes[None, :]
    i, j = np.nonzero(chosen)
    if len(i):
        guess = _estimates(_padded(left.sets, keep)[i], _padded(right.sets, keep)[j], keep)
        chosen[i, j] = guess >= how.percent / 100 - how.spread
    if chosen.any():
        shared = _shared(left.sets, right.sets)
        union = left.sizes[:, None] + right.sizes[None, :] - shared
        chosen &= 100 * shared >= how.percent * union
    return chosen


def _forest(a: np.ndarray, b: np.ndarray, known: dict[int, int]) -> list[tuple[int, int]]:
    """The links ``(a, b)`` that join two groups; ``known`` has the groups so far."""
    parent = dict(known)

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


_FOUND = "a long, b long, bundle long, hub long"


def _frame(links: list[tuple[int, int]], bundle: int, hubs: np.ndarray) -> pd.DataFrame:
    # nullable integers: floating point would round the hashes
    whole = {
        "a": [x for x, _ in links] + [None] * len(hubs),
        "b": [y for _, y in links] + [None] * len(hubs),
        "bundle": [int(bundle)] * (len(links) + len(hubs)),
        "hub": [None] * len(links) + hubs.tolist(),
    }
    return pd.DataFrame({name: pd.array(values, dtype="Int64") for name, values in whole.items()})


def _solve_blocks(members: DataFrame, how: Similarity) -> DataFrame:
    """Links within each (bundle, block), and each block's best linked members."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        block = _Block(rows)
        links = _linked(block, block, how)
        i, j = np.nonzero(np.triu(links))
        best = np.argsort(-links.sum(axis=1), kind="stable")[:HUBS]
        found = _forest(block.nodes[i], block.nodes[j], {})
        return _frame(found, rows["bundle"].iat[0], block.nodes[best])

    return members.groupBy("bundle", "block").applyInPandas(solve, _FOUND)


def _solve_rest(members: DataFrame, rest: DataFrame, how: Similarity) -> DataFrame:
    """Links of each bundle's ``rest`` (blocks ``part``) with all of its blocks."""

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _frame([], 0, np.zeros(0, np.int64))
        a, b = _Block(left), _Block(right)
        i, j = np.nonzero(_linked(a, b, how) & (a.roots[:, None] != b.roots[None, :]))
        known = dict(zip(a.nodes.tolist(), a.roots.tolist(), strict=True))
        known |= dict(zip(b.nodes.tolist(), b.roots.tolist(), strict=True))
        found = _forest(a.nodes[i], b.nodes[j], known)
        return _frame(found, left["bundle"].iat[0], np.zeros(0, np.int64))

    keys = ["bundle", "block", "part"]
    left = members.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = rest.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, _FOUND)


def _blocks(members: DataFrame) -> DataFrame:
    """``members (bundle, node, n, ..)`` with their bundle's ``blocks`` and their own."""
    sizes = members.groupBy("bundle").agg(
        F.ceil(
            F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_SHINGLES, F.lit(1.0))
        ).cast("int").alias("blocks"),
        F.count("*").alias("held"),
    )
    sizes = settled(sizes)
    total = sizes.agg(F.sum("held")).first()[0] or 0
    known = join_facts(members, sizes, "bundle", "held", total).drop("held")
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    return known.withColumn("block", F.coalesce(block, F.lit(0)))


def _links(members: DataFrame, how: Similarity) -> DataFrame:
    """Links ``(a, b)`` that join all groups of every bundle: step 3 above."""
    found = settled(_solve_blocks(members, how))
    links = [found.select("a", "b").filter("a is not null")]
    large = members.filter("blocks > 1")
    if large.isEmpty():
        return links[0]
    level, before = found, large.count()
    while True:
        hubs = level.filter("hub is not null").select("bundle", F.col("hub").alias("node"))
        chosen = large.drop("blocks", "block").join(hubs, ["bundle", "node"], "left_semi")
        chosen = settled(_blocks(chosen))
        level = settled(_solve_blocks(chosen, how))
        links.append(level.select("a", "b").filter("a is not null"))
        # blocks of a few very large sets may have no fewer best members
        now = chosen.count()
        if now >= before or chosen.filter("blocks > 1").isEmpty():
            break
        before = now
    groups = components(reduce(DataFrame.union, links))
    # from here on without the sets, which are joined to what is left to compare
    narrow = large.drop("set")
    rooted = settled(
        narrow.join(groups.withColumnRenamed("root", "_root"), "node", "left").select(
            *narrow.columns, F.coalesce("_root", "node").alias("root")
        )
    )
    counted = rooted.groupBy("bundle", "root").agg(F.count("*").alias("size"))
    main = counted.groupBy("bundle").agg(
        F.max_by("root", F.struct("size", "root")).alias("main"),
        (F.sum("size") - F.max("size")).alias("others"),
        F.sum("size").alias("held"),
    )
    main = settled(
        main.withColumn("parts", F.ceil(F.col("others") / BLOCK_CLASSES).cast("int"))
    )
    total = main.agg(F.sum("held")).first()[0]
    placed = join_facts(rooted, main.drop("others"), "bundle", "held", total)
    placed = settled(placed.filter("parts > 0").drop("held"))
    rest = placed.filter("root <> main").withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int")
    )
    sets = large.select("node", "set")
    unplaced = sets.join(rest.drop("block"), "node")
    unplaced = unplaced.toDF(*unplaced.columns)  # columns of their own, for the cogroup
    last = settled(_solve_rest(sets.join(placed, "node"), unplaced, how))
    return links[0].union(links[1]).union(
        reduce(DataFrame.union, [*links[2:], last.select("a", "b").filter("a is not null")])
    )


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    how: Similarity = Similarity(),
) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` of every row."""
    return _judged(documents, id_col, text_col, how).select(
        F.col("_id").alias(id_col), "n_shingles", "component_id", "kept"
    )


def _grouped(texts: DataFrame, how: Similarity) -> tuple[DataFrame, DataFrame, int]:
    """``(_id, _hash, n, node, sketch)`` of all rows, ``(node, component_id, held)`` of all
    classes, and the number of rows with a class."""
    sketched = settled(_sketches(texts, how), keep=True)
    with temporary(texts.sparkSession):
        listed = settled(
            _listed(sketched, _counts(sketched), how)
            .groupBy("node")
            .agg(
                F.min("_id").alias("first_id"),
                F.count("*").alias("held"),
                F.max("n").alias("n"),
                *(F.first(c).alias(c) for c in ("cold", "hot", "mark")),
            )
        )
        classes = settled(listed.select("node", "first_id", "held", "n"), keep=True)
        rows = classes.agg(F.sum("held")).first()[0] or 0
        bundles = settled(_bundles(listed, how), keep=True)
    # blocks are told apart before the sets are made, so that these move once
    placed = settled(_blocks(bundles.withColumnRenamed("root", "bundle").join(classes.drop("held"), "node")))
    members = settled(_members(texts.select("_id", "_text"), placed, how))
    groups = components(_links(members, how))

    joined = settled(
        classes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    )
    names = joined.groupBy("root").agg(
        F.min("first_id").alias("component_id"), F.count("*").alias("classes")
    )
    named = join_facts(
        joined.select("root", "node", "held"), names, "root", "classes", joined.count()
    )
    return sketched, settled(named.select("node", "component_id", "held"), keep=True), rows


def _judged(documents: DataFrame, id_col: str, text_col: str, how: Similarity) -> DataFrame:
    """The same with the id as ``_id`` and the text's hash as ``_hash``."""
    text = F.col(text_col)
    texts = documents.select(
        F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash")
    )
    with temporary(documents.sparkSession):
        sketched, named, rows = _grouped(texts, how)
    out = join_facts(
        sketched.select("_id", "_hash", "n", "node"),
        named,
        "node",
        "held",
        rows,
    )
    component = F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(
        "_id",
        "_hash",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Similarity = Similarity()
) -> DataFrame:
    """The rows of ``documents`` that are kept, with all their columns. Rows with equal
    ids and texts stay or go together."""
    gone = _judged(documents, id_col, text_col, how).filter("not kept")
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    return without(
        documents, key, gone.select(F.struct(F.col("_id").alias("id"), F.col("_hash").alias("hash")))
    )
