"""BPE encoding by backtracking over longest matches, and decoding by offsets.

The encoder walks a pre-token from left to right. At each place an Aho-Corasick
automaton over the vocabulary names the longest token that starts there; the token
is taken if it is compatible with the one before it, that is, if merging the two
tokens' bytes by rank would leave just these two. If not, the next shorter token
that is a prefix of it is tried, and if none is left, the token before it is given
up for its own next shorter one. Places from which no encoding can go on are
remembered, so that none is tried twice and the time is linear in the text. The
result is exactly that of merging by rank.

Texts are cut where the pattern of the vocabulary's pre-tokeniser always cuts, and
the ids of cut pieces are kept in a bounded table per task.

Defined results: a null text is an empty one and has no tokens; every row is encoded
by itself, so ties and repeated rows get equal ids; a very long text or a very long
run without a space is encoded in linear time; the table may be empty; of extra
columns nothing is read.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechprep.llm.spans import parts_of

#: The splitting pattern of byte-level vocabularies of this family (fixed value).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The characters of \p{White_Space} (fixed values), those in ASCII first.
WHITE_ASCII = "\t\n\v\f\r"
WHITE = (
    WHITE_ASCII
    + "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    + "\u2028\u2029\u202f\u205f\u3000"
)
#: Pieces kept while a task runs (in each of two tables, up to twice as many), the
#: longest piece kept, and compatible pairs kept.
KEPT_PIECES, KEPT_LENGTH, KEPT_PAIRS = 200_000, 64, 500_000
#: Characters of a pre-token that are matched in one go.
LOOK_AHEAD = 512
#: Bytes of text that one output batch is made of; ids that are decoded at once.
BATCH_BYTES, DECODED_IDS = 2 << 20, 1 << 18


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable bytes
    for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Kept(dict):
    """What was made of recent keys. When it is full, the older half goes."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key) if key else b""
            if len(key) > KEPT_LENGTH:
                return found
        if len(self) >= KEPT_PIECES:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


    def forget(self) -> None:
        self.clear()
        self.older = {}


class Encoder:
    """Encoder of one byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only vocabularies without normaliser and prefix space")
        letters = byte_letters()
        model = spec["model"]
        by_letters = model["vocab"]
        self.tokens: list[bytes] = [b""] * (1 + max(by_letters.values()))
        for letter_form, number in by_letters.items():
            self.tokens[number] = bytes(letters[c] for c in letter_form)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: list[tuple[int, int] | None] = [None] * len(self.tokens)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = by_letters[left], by_letters[right]
            whole = by_letters[left + right]
            self.rank[a, b] = (rank, whole)
            if self.parts[whole] is None:
                self.parts[whole] = (a, b)
        self.made = [-1] * len(self.tokens)
        for (a, b), (rank, whole) in self.rank.items():
            if self.parts[whole] == (a, b):
                self.made[whole] = rank
        # bytes as Latin-1 letters, which is what the automaton takes
        self.matches = ahocorasick.Automaton()
        numbers = {token.decode("latin-1"): i for i, token in enumerate(self.tokens) if token}
        for letter_form, number in numbers.items():
            self.matches.add_word(letter_form, number)
        self.matches.make_automaton()
        self.shorter = [-1] * len(self.tokens)
        for letter_form, number in numbers.items():
            for end in range(len(letter_form) - 1, 0, -1):
                if letter_form[:end] in numbers:
                    self.shorter[number] = numbers[letter_form[:end]]
                    break
        self.lengths = [len(t) for t in self.tokens]
        self.longest = max(self.lengths)
        self.pairs: dict[int, bool] = {}

        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = (
            regex.compile(
                "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
            )
            if self.special
            else None
        )
        self.pattern = regex.compile(PATTERN)
        # a single space between two characters that are not white space starts a
        # pre-token, whatever these are
        self.cut = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
        self.first = Kept(self.piece)
        self.spaced = Kept(lambda word: self.piece(" " + word))

    def forget(self) -> None:
        """Give back what was kept of the texts. Workers outlive their tasks."""
        self.first.forget()
        self.spaced.forget()
        self.pairs.clear()

    # encoding

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when their bytes are merged by rank.

        The merges of both tokens are undone from the boundary outward, last first:
        if a pair across the boundary would have been merged before the pair that
        was, the two do not stay apart.
        """
        key = left << 20 | right
        found = self.pairs.get(key)
        if found is None:
            found = self._apart(left, right)
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def _apart(self, left: int, right: int) -> bool:
        limit = 1 << 62
        while True:
            merge = self.rank.get((left, right))
            if merge is not None and merge[0] < limit:
                return False
            a, b = self.made[left], self.made[right]
            if a < 0 and b < 0:
                return True
            # undo the later of the two merges; of equal ones the right token's,
            # because equal pairs are merged from the left
            if a > b:
                limit = a
                left = self.parts[left][1]
                if merge_first := self.rank.get((left, right)):
                    if merge_first[0] < limit:
                        return False
            else:
                limit = b + 1
                right = self.parts[right][0]
                if merge_first := self.rank.get((left, right)):
                    if merge_first[0] < limit:
                        return False

    def merge(self, piece: str) -> list[int]:
        """The ids of one pre-token."""
        text = piece if piece.isascii() else piece.encode().decode("latin-1")
        apart, compatible = self.pairs.get, self.compatible
        # mostly the longest matches, one after the other, are compatible
        out: list[int] = []
        place, last, token = 0, -1, -1
        for end, token in self.matches.iter_long(text[:LOOK_AHEAD]):
            if last >= 0 and not (apart(last << 20 | token) or compatible(last, token)):
                break
            out.append(token)
            last, place = token, end + 1
        if place == len(text):
            return out
        if place >= LOOK_AHEAD - self.longest:
            # the last match may have been cut short
            token = out.pop()
            place -= self.lengths[token]
            token = self._longest(text, place)
        lengths, shorter = self.lengths, self.shorter
        dead = bytearray(len(text) + 1)  # places from which no encoding goes on
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                end = place + lengths[token]
                if not dead[end] and (
                    last < 0 or apart(last << 20 | token) or compatible(last, token)
                ):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                place = end
                if place == len(text):
                    return out
                token = self._longest(text, place)
            else:
                dead[place] = 1
                token = out.pop()
                place -= lengths[token]
                token = shorter[token]

    def _longest(self, text: str, place: int) -> int:
        return next(self.matches.iter_long(text[place : place + self.longest]))[1]

    def piece(self, text: str) -> bytes:
        """The ids of a stretch that starts and ends where pre-tokens do, as the
        bytes of 32-bit numbers."""
        word = text[1:] if text[0] == " " else text
        if word.isalpha():
            return array("i", self.merge(text)).tobytes()
        out: list[int] = []
        for part in self.pattern.findall(text):
            out += self.merge(part)
        return array("i", out).tobytes()

    def _plain(self, text: str) -> bytes:
        if self.regular(text):
            first, *rest = text.split(" ")
        else:
            first, *rest = self.cut.split(text)
        return self.first[first] + b"".join(map(self.spaced.__getitem__, rest))

    @staticmethod
    def regular(text: str) -> bool:
        """Whether every space stands between two characters that are no white space."""
        if text[0] == " " or text[-1] == " " or "  " in text:
            return False
        return not any(
            c in text and (c + " " in text or " " + c in text)
            for c in (WHITE_ASCII if text.isascii() else WHITE)
        )

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; the strings of special tokens in it are those tokens."""
        if not text:
            return np.zeros(0, np.int32)
        if not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), np.int32)
        out = []
        for part in self.special_pattern.split(text):
            if part in self.special:
                out.append(np.int32(self.special[part]).tobytes())
            elif part:
                out.append(self._plain(part))
        return np.frombuffer(b"".join(out), np.int32)


class Decoder:
    """All tokens' bytes one after the other, and the offset at which each begins."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        tokens = {n: bytes(map(letters.get, t)) for t, n in spec["model"]["vocab"].items()}
        tokens |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        # one more, without bytes, for ids outside the vocabulary
        parts = [tokens.get(i, b"") for i in range(max(tokens) + 2)]
        self.starts = np.zeros(len(parts) + 1, dtype=np.int64)
        np.cumsum([len(p) for p in parts], out=self.starts[1:])
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray, firsts: np.ndarray) -> list[str]:
        """Texts of many id sequences; sequence i is ``ids[firsts[i]:firsts[i + 1]]``.
        Ids outside the vocabulary give nothing; bytes that are no UTF-8 give U+FFFD."""
        none = len(self.starts) - 2
        raw, ends = [], np.zeros(len(ids) + 1, dtype=np.int64)
        for low in range(0, len(ids), DECODED_IDS):
            part = ids[low : low + DECODED_IDS]
            part = np.where((part >= 0) & (part < none), part, none)
            begins, sizes = self.starts[part], self.starts[part + 1] - self.starts[part]
            own = np.cumsum(sizes)
            places = np.arange(own[-1]) + np.repeat(begins - own + sizes, sizes)
            raw.append(self.data[places].tobytes())
            ends[low + 1 : low + 1 + len(part)] = ends[low] + own
        out, cuts = b"".join(raw), ends[firsts].tolist()
        return [
            out[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _lists(ids: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    ends = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in ids], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))), ends


def _encoded(documents: DataFrame, vocabulary: str, id_col: str, text_col: str, back: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        try:
            for batch in batches:
                for part in parts_of(batch, "_text", BATCH_BYTES):
                    yield made(own, part)
        finally:
            own.forget()

    def made(own: Encoder, part: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(part.column(1), "").to_pylist()
        ids, ends = _lists([own.encode(text) for text in texts])
        columns = [part.column(0), ids]
        if back:
            decoded = decoder(vocabulary).decode(ids.values.to_numpy(), ends)
            columns.append(pa.array(decoded, pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=["_id", "ids", "decoded"][: len(columns)])

    kind = documents.schema[id_col].dataType.simpleString()
    return (
        documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .mapInArrow(run, f"_id {kind}, ids array<int>" + ", decoded string" * back)
        .withColumnRenamed("_id", id_col)
    )


def encode(
    documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, ids array<int>)`` of every row. ``vocabulary`` is the path of a
    tokeniser file that every node has."""
    return _encoded(documents, vocabulary, id_col, text_col, False)


def round_trip(
    documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``encode`` and a column ``decoded``, the text decoded from the ids, in the same
    task: a second Python worker beside the first would hold the vocabulary again."""
    return _encoded(documents, vocabulary, id_col, text_col, True)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``, the text of its ids; null ids, or none,
    give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(vocabulary)
        for batch in batches:
            column = batch.column(at)
            firsts = np.zeros(len(column) + 1, dtype=np.int64)
            np.cumsum(
                pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False),
                out=firsts[1:],
            )
            ids = pc.fill_null(column.flatten(), -1).to_numpy(zero_copy_only=False)
            texts = own.decode(ids, firsts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "d"]
            )

    at = encoded.columns.index(ids_col)
    numbered = encoded.toDF(*(f"c{i}" for i in range(len(encoded.columns))))
    schema = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(encoded.dtypes))
    return numbered.mapInArrow(run, f"{schema}, d string").toDF(*encoded.columns, "decoded")
