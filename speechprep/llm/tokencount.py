"""Token counts by merging ragged arrays of symbols, rank by rank.

The distinct pre-tokens of a batch of texts lie in one flat array of symbols with
the sequence of each. In every round each sequence finds its lowest-ranked adjacent
pair and merges all of that pair's occurrences, from the left, in all sequences at
the same time; sequences without a pair are done. What is left is counted. A sequence of
thousands of symbols would be swept once per round; its pairs wait in arrays by rank
instead, the lowest rank is merged at all its places, and only the neighbours of these
places are looked up again, so its time grows little faster than its length.

Defined results: a null text is an empty one and has no tokens; rows are counted one
by one, so ties and repeated rows get equal counts; a long run without white space
is one sequence of the arrays (a million letters take seconds); the table may be empty; of extra columns nothing is
read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechprep.llm.bpe import byte_letters
from speechprep.llm.spans import parts_of

#: Pieces between white space that are kept with their counts, per task (up to
#: twice as many, the older half of which goes first), and the longest one kept.
KEPT_PIECES, KEPT_LENGTH = 400_000, 64
#: Symbols from which on a word is merged by itself.
LONG_WORD = 2048
#: Bytes of text whose new pieces are merged at once.
BATCH_BYTES = 2 << 20

_SPACES = str.maketrans(dict.fromkeys("\t\n\v\f\r", " "))


class Counter:
    """Counts the tokens that one vocabulary file gives."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = {s["type"]: s for s in spec["normalizer"]["normalizers"]}
        splits = {s["type"]: s for s in spec["pre_tokenizer"]["pretokenizers"]}
        if set(steps) != {"NFC", "Replace", "Lowercase"} or set(splits) != {"Split", "ByteLevel"}:
            raise ValueError("only vocabularies of lower-cased words")
        pattern = splits["Split"]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pattern = regex.compile(pattern)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_pattern = regex.compile(
            "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        )
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.zeros(256, dtype=np.int64)
        self.final = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.inner[byte] = vocab[letter]
            self.final[byte] = vocab[letter + end]
        self.width = np.int64(1 << 20)
        first, second, made = [], [], []
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            first.append(vocab[left])
            second.append(vocab[right])
            made.append(vocab[left + right])
        keys = np.array(first, dtype=np.int64) * self.width + np.array(second, dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array(made, dtype=np.int64)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where they are no pair of the vocabulary."""
        pair = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], -1)

    def merged_long(self, word: bytes) -> int:
        """The number of symbols left of one long word."""
        data = np.frombuffer(word, np.uint8)
        symbols = self.inner[data]
        symbols[-1] = self.final[data[-1]]
        count = len(symbols)
        # neighbours of each symbol; a place behind the last one stands for none
        after, before = np.arange(1, count + 1), np.arange(-1, count)
        symbols = np.append(symbols, -1)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[(places >= 0) & (places < count)]
            places = places[after[places] < count]
            rank = self._ranks(symbols[places], symbols[after[places]])
            places, rank = places[rank >= 0], rank[rank >= 0]
            if len(rank) == 0:
                return
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            begins = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
            for low, high in zip(begins, np.append(begins[1:], len(rank)), strict=True):
                own = int(rank[low])
                if own not in waiting:
                    waiting[own] = []
                    heapq.heappush(ranks, own)
                waiting[own].append(places[low:high])

        wait(np.arange(count))
        left = count
        while ranks:
            rank = heapq.heappop(ranks)
            heads = np.unique(np.concatenate(waiting.pop(rank)))
            heads = heads[(symbols[heads] >= 0) & (after[heads] < count)]
            heads = heads[self._ranks(symbols[heads], symbols[after[heads]]) == rank]
            if len(heads) == 0:
                continue
            # of overlapping pairs, as in "aaa", every second one from the left
            joins = np.append(False, after[heads[:-1]] == heads[1:])
            places = np.arange(len(heads))
            heads = heads[(places - np.maximum.accumulate(np.where(joins, -1, places))) % 2 == 0]
            tails = after[heads]
            symbols[heads], symbols[tails] = self.made[rank], -1
            after[heads] = after[tails]
            before[after[heads]] = heads
            left -= len(heads)
            wait(np.concatenate([before[heads], heads]))
        return left

    def merged(self, words: list[bytes]) -> np.ndarray:
        """The number of symbols left of each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        long = np.flatnonzero(sizes > LONG_WORD)
        if len(long):
            short = np.flatnonzero(sizes <= LONG_WORD)
            out = np.zeros(len(words), dtype=np.int64)
            out[short] = self.merged([words[i] for i in short])
            out[long] = [self.merged_long(words[i]) for i in long]
            return out
        counts = sizes.copy()
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(sizes) - 1
        symbols[last[sizes > 0]] = self.final[data[last[sizes > 0]]]
        owner = np.repeat(np.arange(len(words)), sizes)
        none = np.int64(len(self.made))
        while len(symbols) > 1:
            pair = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            found = (self.keys[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.where(found, self.ranks[at], none)
            lowest = np.full(len(words), none)
            np.minimum.at(lowest, owner[:-1], rank)
            chosen = found & (rank == lowest[owner[:-1]])
            # of overlapping pairs, as in "aaa", every second one from the left
            begins = chosen.copy()
            begins[1:] &= ~chosen[:-1]
            places = np.arange(len(chosen))
            origin = np.maximum.accumulate(np.where(begins, places, -1))
            chosen &= (places - origin) % 2 == 0
            heads = np.flatnonzero(chosen)
            if len(heads) == 0:
                break
            symbols[heads] = self.made[rank[heads]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[heads + 1] = False
            counts -= np.bincount(owner[heads], minlength=len(words))
            # sequences without a pair are done and leave the arrays
            keep &= (lowest < none)[owner]
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def learn(self, pieces: list[str]) -> list[int]:
        """The counts of pieces, all merged together."""
        words: list[bytes] = []
        numbers: dict[bytes, int] = {}
        used: list[int] = []
        ends = np.zeros(len(pieces) + 1, dtype=np.int64)
        specials = np.zeros(len(pieces), dtype=np.int64)
        find = self.pattern.findall
        for i, piece in enumerate(pieces):
            parts = [piece]
            if "<|" in piece:
                parts = self.special_pattern.split(piece)
                specials[i] = len(parts) - 1
            for part in parts:
                if not part.isascii():
                    # letters one by one: the last sigma of a word is like any other
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                part = part.lower()
                for word in [part] if part.isalpha() else find(part):
                    raw = word.encode()
                    number = numbers.setdefault(raw, len(words))
                    if number == len(words):
                        words.append(raw)
                    used.append(number)
            ends[i + 1] = len(used)
        sums = np.zeros(len(used) + 1, dtype=np.int64)
        if words:
            np.cumsum(self.merged(words)[used], out=sums[1:])
        return (sums[ends[1:]] - sums[ends[:-1]] + specials).tolist()

    def counts(self, texts: list[str]) -> list[int]:
        split = []
        for text in texts:
            for space in "\t\n\v\f\r":
                if space in text:
                    text = text.replace(space, " ")
            split.append(text.split(" "))
        known, older = self.known, self.older
        fresh = {}
        for pieces in split:
            for piece in set(pieces).difference(known):
                fresh[piece] = older.get(piece, -1)
        new = [piece for piece, count in fresh.items() if count < 0]
        fresh.update(zip(new, self.learn(new), strict=True))
        known.update(fresh)
        out = [sum(map(known.__getitem__, pieces)) for pieces in split]
        for piece in fresh:
            if len(piece) > KEPT_LENGTH:
                del known[piece]
        if len(known) >= KEPT_PIECES:
            self.known, self.older = {}, known
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(
    documents: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        try:
            for batch in batches:
                for part in parts_of(batch, "_text", BATCH_BYTES):
                    yield counted(own, part)
        finally:
            own.known, own.older = {}, {}  # workers outlive their tasks

    def counted(own: Counter, part: pa.RecordBatch) -> pa.RecordBatch:
        column = pc.fill_null(part.column(1), "")
        tokens = pa.array(own.counts(column.to_pylist()), pa.int64())
        sizes = pc.cast(pc.binary_length(column), pa.int64())
        return pa.RecordBatch.from_arrays(
            [part.column(0), sizes, tokens, pc.greater(tokens, limit)],
            names=["_id", "n_bytes", "n_tokens", "over_limit"],
        )

    kind = documents.schema[id_col].dataType.simpleString()
    return (
        documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
        .withColumnRenamed("_id", id_col)
    )
