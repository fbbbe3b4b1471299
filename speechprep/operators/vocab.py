"""Character vocabulary and text encoding."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

# ---------------------------------------------------------------- fixed values
SEPARATOR = "|"
UNKNOWN, PAD = "[UNK]", "[PAD]"
IGNORED_LABEL = -100
# -----------------------------------------------------------------------------

_CODE_POINTS = 0x110000
_SPACE = ord(" ")


def corpus_characters(sentences: DataFrame) -> DataFrame:
    """One row: the set of characters of one corpus (column ``sentence``).

    The separator stands for spaces and also joins sentences, so a second
    sentence is enough for it. One pass over the text, marking code points in a
    table per task; what leaves a task is bounded by the number of code points.
    """

    def characters(batches):
        seen, n = np.zeros(_CODE_POINTS, bool), 0
        for batch in batches:
            texts = batch[0].drop_null().to_pylist()
            seen[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)] = True
            n += len(texts)
        chars = [SEPARATOR if p == _SPACE else chr(p) for p in np.flatnonzero(seen)]
        # the number of sentences travels on a row of its own
        counts = [n] + [0] * len(chars)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *chars], pa.string()), pa.array(counts, pa.int64())], ["char", "n"]
        )

    found = (
        sentences.select("sentence")
        .mapInArrow(characters, "char string, n bigint")
        .agg(F.collect_set("char").alias("chars"), F.sum("n").alias("n"))
    )
    joined = F.when(F.col("n") >= 2, F.array(F.lit(SEPARATOR))).otherwise(
        F.array().cast("array<string>")
    )
    return found.select(F.array_union("chars", joined).alias("chars"))


def vocabulary(*corpora: DataFrame) -> DataFrame:
    """``char, id`` over all corpora in code point order, then the two specials."""
    sets = reduce(DataFrame.union, map(corpus_characters, corpora))
    chars = sets.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("chars")))).alias("c"))
    specials = F.array(F.lit(UNKNOWN), F.lit(PAD))
    return chars.select(F.posexplode(F.concat("c", specials)).alias("id", "char")).select(
        "char", "id"
    )


def vocabulary_json(vocab: DataFrame) -> DataFrame:
    """The vocabulary as one JSON object, in id order."""
    entries = F.array_sort(F.collect_list(F.struct("id", "char")))
    pairs = F.transform(entries, lambda e: F.struct(e["char"], e["id"]))
    return vocab.agg(F.to_json(F.map_from_entries(pairs)).alias("json"))


@dataclass(frozen=True)
class Alphabet:
    """A vocabulary brought to the driver, to encode and decode with. It holds at
    most one entry per code point, whatever the size of the corpus."""

    chars: tuple[str, ...]

    @classmethod
    def load(cls, vocab: DataFrame) -> Alphabet:
        """Run the vocabulary query (or read a stored vocabulary table)."""
        entries = F.array_sort(F.collect_list(F.struct("id", "char")))
        row = vocab.agg(F.transform(entries, lambda e: e["char"]).alias("chars")).first()
        return cls(tuple(row["chars"]))

    @property
    def unknown_id(self) -> int:
        return self.chars.index(UNKNOWN)

    @property
    def pad_id(self) -> int:
        return self.chars.index(PAD)

    def column(self) -> Column:
        """All entries in id order, as a literal array."""
        return F.lit(list(self.chars))

    def encode(self, text: Column) -> Column:
        """Ids of the characters of a text; spaces count as the separator and
        characters outside the vocabulary are unknown.

        Arrow UDF: a batch of texts is one table lookup. The native form, a
        transform over split characters, costs several times as much.
        """
        chars, unknown = self.chars, self.unknown_id

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def labels(texts: pa.Array) -> pa.Array:
            table = np.full(_CODE_POINTS, unknown, np.int32)
            for i, char in enumerate(chars):
                if len(char) == 1:
                    table[ord(char)] = i
            table[ord(" ")] = table[ord(SEPARATOR)]
            joined = "".join(t for t in texts.to_pylist() if t is not None)
            ids = table[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            return pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(ids), mask=texts.is_null()
            )

        return labels.asNondeterministic()(text)

    def decode(self, labels: Column) -> Column:
        """Reference text of label ids: padding is undone and dropped, repeated
        characters stay."""
        pad = self.pad_id
        real = F.filter(labels, lambda i: (i != IGNORED_LABEL) & (i != pad))
        return ids_to_text(real, self.column())


def ids_to_text(ids: Column, chars: Column) -> Column:
    """Text of ids; ``chars`` is the vocabulary in id order."""
    text = F.array_join(F.transform(ids, lambda i: F.get(chars, i)), "")
    spaced = F.replace(text, F.lit(SEPARATOR), F.lit(" "))
    return F.regexp_replace(spaced, f"^[{tx.WS}]+|[{tx.WS}]+$", "")
