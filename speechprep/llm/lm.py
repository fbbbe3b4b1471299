"""n-gram language model as a weighted backoff automaton, learnt and applied on blocks.

A state is a seen context of up to ``order - 1`` tokens. It has an arc, with a
log-probability, for every token seen behind it, and a failure arc, with a weight, to
the state of its context without the oldest token; the root has an arc for every token
and one for unknown ones. A text's score is that of a walk from left to right that starts
in the state of the text's begin, takes failure arcs until there is an arc for the next
token, goes on from the state that the arc leads to, and adds up the weights. All texts
of a block are walked at the same time, one token each per step. A long text is walked
in stretches side by side; a stretch begins ``order - 1`` tokens early at the root, which
leads to the state that the walk from the text's begin is in.

Probabilities are smoothed by the shorter context: with ``c`` the counts,
``p(w | h) = (c(h w) + mass * p(w | shorter h)) / (c(h) + mass)``, hence a failure arc
weighs ``mass / (c(h) + mass)``. At the root a known token has ``(c(w) - d) / N`` and
all unknown tokens together ``d * V / N``, with ``d = n1 / (n1 + 2 * n2)`` from the
numbers of tokens seen once and twice.

The model of a large corpus fits no machine, so it stays spread out. Texts are packed
into blocks of bounded size; each block names its own distinct n-grams, with their
counts in its training texts, to the parts of the model that hold them (by hash); a
part adds up and answers with the counts of all training texts; with these each block
builds the piece of the automaton that its own texts can reach. An n-gram is named
once per block, which bounds what a frequent one costs.

Defined results: a null text is an empty one and has the end token alone; a row with a
null id takes part as the caller's column says; without training texts every token is
unknown with probability 1; repeated rows are counted and scored each; the table may
be empty; of extra columns nothing is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechprep.llm.common import settled
from speechprep.llm.spans import Texts, grams, mix, pieces, texts_of

#: Bytes of text in a block; a longer text is a block by itself.
BLOCK_BYTES = 3 << 20
#: Bytes of text per part of the model, for each order of n-grams.
PART_BYTES = 8 << 20
#: Tokens of a stretch of a text that is walked beside the others.
STRETCH = 256
BEGIN, END = mix(np.array([1, 2], dtype=np.uint64))


@dataclass(frozen=True)
class Model:
    """``order`` of the n-grams and the weight of a shorter context in a longer one."""

    order: int = 2
    mass: float = 500.0


@dataclass(frozen=True)
class Totals:
    """Of all training tokens: their number, the distinct ones, and those seen once
    and twice."""

    tokens: int
    distinct: int
    once: int
    twice: int

    @property
    def discount(self) -> float:
        if not self.once or not self.twice:
            return 0.5
        return self.once / (self.once + 2 * self.twice)


class Grams:
    """The tokens of a block's texts, and its distinct n-grams by order.

    A text's tokens are its words and one end. ``kinds[n]`` are the sorted hashes of
    the distinct n-grams, ``of[n]`` the n-gram that ends at each token, or -1 where
    the text began less than ``n - 1`` tokens before; its begin counts as a token.
    """

    def __init__(self, texts: Texts, order: int) -> None:
        lowered = texts.lower()
        starts, ends = lowered.words()
        owners = lowered.owners(starts)
        words = lowered.hashes(starts, ends)
        count = len(texts)
        sizes = np.bincount(owners, minlength=count) + 1
        self.firsts = np.zeros(count + 1, dtype=np.int64)
        np.cumsum(sizes, out=self.firsts[1:])
        # with a begin before each text, for n-grams that reach back to it
        padded = np.empty(len(words) + 2 * count, dtype=np.uint64)
        owner = np.repeat(np.arange(count), sizes + 1)
        begins = self.firsts[:-1] + np.arange(count)
        padded[begins] = BEGIN
        padded[begins + sizes] = END
        inside = np.ones(len(padded), dtype=bool)
        inside[begins] = inside[begins + sizes] = False
        padded[inside] = words
        place = np.full(len(padded), -1)
        token = np.ones(len(padded), dtype=bool)
        token[begins] = False
        place[token] = np.arange(self.firsts[-1])
        self.kinds: dict[int, np.ndarray] = {}
        self.of: dict[int, np.ndarray] = {}
        for n in range(1, order + 1):
            if n == 1:
                hashes, last = padded[token], place[token]
            else:
                hashes, first = grams(padded, owner, n)
                last = place[first + n - 1]
            self.kinds[n], inverse = np.unique(hashes, return_inverse=True)
            self.of[n] = np.full(self.firsts[-1], -1)
            self.of[n][last] = inverse

    def counts(self, n: int, texts: np.ndarray) -> np.ndarray:
        """How often each n-gram ends in one of the chosen texts."""
        chosen = np.repeat(texts, np.diff(self.firsts)) & (self.of[n] >= 0)
        return np.bincount(self.of[n][chosen], minlength=len(self.kinds[n]))


class Automaton:
    """The part of the automaton that a block's texts can reach.

    State 0 is the root and state 1 the begin of a text. The others are the block's
    distinct n-grams of up to ``order - 1`` tokens, by order; those that training texts
    do not have are never entered.
    """

    ROOT, START = 0, 1

    def __init__(
        self, block: Grams, counts: dict[int, np.ndarray], totals: Totals, model: Model
    ) -> None:
        self.block, self.order = block, model.order
        self.tokens = block.of[1]
        self.width = np.int64(max(len(block.kinds[1]), 1))
        discount, size = totals.discount, totals.tokens
        seen = counts[1] > 0
        if size:
            known = (counts[1] - discount) / size
            self.root = np.where(seen, known, discount * totals.distinct / size)
        else:
            self.root = np.ones(len(seen))
        # states
        self.first = {n: 2 + sum(len(block.kinds[m]) for m in range(1, n)) for n in range(1, model.order)}
        end = np.searchsorted(block.kinds[1], END)
        texts = int(counts[1][end]) if len(seen) else 0
        held = [np.array([0, texts]), *(counts[n] for n in self.first)]
        self.held = np.concatenate(held)
        self.weights = model.mass / (self.held + model.mass)
        self.failure = np.zeros(len(self.held), dtype=np.int64)
        self.after_root = self._state(1, np.arange(len(seen)))
        # arcs, sorted by state and token, order by order
        self.keys, self.values = np.zeros(0, np.int64), np.zeros(0)
        self.targets = np.zeros(0, np.int64)
        for n in range(2, model.order + 1):
            at = np.flatnonzero(block.of[n] >= 0)
            # one token for each distinct n-gram stands for all of its tokens
            one = np.zeros(len(block.kinds[n]), dtype=np.int64)
            one[block.of[n][at]] = at
            one = one[counts[n] > 0]
            state, token = self._before(n, one), self.tokens[one]
            lower, _ = self.step(self.failure[state], token)
            value = (counts[n][counts[n] > 0] + model.mass * lower) / (self.held[state] + model.mass)
            own = block.of[n][one]
            if n < model.order:
                target = self.first[n] + own
                self.failure[target] = self._state(n - 1, block.of[n - 1][one])
            else:
                target = self._state(n - 1, block.of[n - 1][one])
            keys = np.concatenate([self.keys, state * self.width + token])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.values = np.concatenate([self.values, value])[order]
            self.targets = np.concatenate([self.targets, target])[order]

    def _state(self, n: int, kinds: np.ndarray) -> np.ndarray:
        """States of n-grams that were seen; the root for others and without contexts."""
        if n not in self.first:
            return np.zeros(len(kinds), dtype=np.int64)
        states = self.first[n] + kinds
        return np.where(self.held[states] > 0, states, self.ROOT)

    def _before(self, n: int, tokens: np.ndarray) -> np.ndarray:
        """States of the ``n - 1`` tokens before each of ``tokens``."""
        of = np.append(-1, self.block.of[n - 1])[tokens]
        begins = np.zeros(self.block.firsts[-1] + 1, dtype=bool)
        begins[self.block.firsts] = True
        # only bigrams reach back to a text's begin alone
        return np.where(begins[tokens], self.START, self.first[n - 1] + of)

    def step(self, states: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one token from each state: probabilities, and the states reached."""
        weight, target = np.ones(len(states)), np.empty(len(states), dtype=np.int64)
        open_, state, token = np.arange(len(states)), states, tokens
        while len(open_):
            key = state * self.width + token
            at = np.searchsorted(self.keys, key)
            arc = np.zeros(len(key), dtype=bool)
            inside = at < len(self.keys)
            arc[inside] = self.keys[at[inside]] == key[inside]
            weight[open_[arc]] *= self.values[at[arc]]
            target[open_[arc]] = self.targets[at[arc]]
            root = ~arc & (state == self.ROOT)
            weight[open_[root]] *= self.root[token[root]]
            target[open_[root]] = self.after_root[token[root]]
            fails = ~arc & ~root
            open_, state, token = open_[fails], state[fails], token[fails]
            weight[open_] *= self.weights[state]
            state = self.failure[state]
        return weight, target

    def walk(self) -> np.ndarray:
        """The log10 probability of every token."""
        firsts, sizes = self.block.firsts[:-1], np.diff(self.block.firsts)
        per_text = -(-sizes // STRETCH)
        text = np.repeat(np.arange(len(sizes)), per_text)
        part = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begin = firsts[text] + part * STRETCH
        stop = np.minimum(begin + STRETCH, firsts[text] + sizes[text])
        at = np.maximum(begin - (self.order - 1), firsts[text])
        start = self.START if self.order > 1 else self.ROOT
        state = np.where(at == firsts[text], start, self.ROOT)
        # the longest first, so that those still being walked are in front
        longest = np.argsort(at - stop, kind="stable")
        at, stop, begin, state = at[longest], stop[longest], begin[longest], state[longest]
        out = np.empty(self.block.firsts[-1])
        while len(at):
            weight, state = self.step(state, self.tokens[at])
            counted = at >= begin
            out[at[counted]] = weight[counted]
            more = np.searchsorted(at + 1 - stop, 0)
            at, stop, begin, state = at[:more] + 1, stop[:more], begin[:more], state[:more]
        return np.log10(out)


def scores(block: Grams, counts: dict[int, np.ndarray], totals: Totals, model: Model) -> dict:
    """Per text of a block: tokens, known ones, the base score and the model's."""
    of = counts[1][block.of[1]]
    base = np.log10((of + 1) / (totals.tokens + totals.distinct + 1))
    walk = Automaton(block, counts, totals, model).walk()
    first = block.firsts[:-1]

    def by_text(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, first) if len(first) else values

    return {
        "n_tokens": np.diff(block.firsts),
        "n_known": by_text((of > 0).astype(np.int64)),
        "base_score": by_text(base),
        "score": by_text(walk),
    }


# the corpus in blocks


def _pack_numbers(values: np.ndarray) -> bytes:
    top = int(values.max(initial=0))
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    raw = values.astype(kind).tobytes()
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor().compress(raw)


def _unpack_numbers(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data[1:])
    return np.frombuffer(raw, f"<u{data[0]}").astype(np.int64)


def _pack_blocks(texts: DataFrame) -> DataFrame:
    """``(block, bytes, packed)`` of ``(_id, _text, _trains)``: compressed Arrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                writer.write_table(table)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                names=["block", "bytes", "packed"],
            )

        for batch, own in pieces(batches, "_text", BLOCK_BYTES):
            if held and size + len(own.data) > BLOCK_BYTES:
                yield block()
                held, size, number = [], 0, number + 1
            held.append(batch)
            size += len(own.data)
        if held:
            yield block()

    return texts.mapInArrow(run, "block long, bytes long, packed binary")


def _unpacked(packed: bytes, order: int) -> tuple[pa.Table, Grams]:
    table = pa.ipc.open_stream(packed).read_all().combine_chunks()
    column = table.column("_text").combine_chunks().fill_null("")
    return table, Grams(texts_of(column), order)


def _requests(blocks: DataFrame, model: Model, bits: int) -> DataFrame:
    """``(part, block, kinds, counts)``: a block's distinct n-grams, in the part's
    range of hashes, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                table, found = _unpacked(packed, model.order)
                trains = table.column("_trains").to_numpy()
                for n in range(1, model.order + 1):
                    kinds, counts = found.kinds[n], found.counts(n, trains)
                    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
                    cuts = [0, *np.searchsorted(kinds, edges).tolist(), len(kinds)]
                    rows = [
                        (n << bits | k, kinds[a:b].tobytes(), _pack_numbers(counts[a:b]))
                        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                        if a < b
                    ]
                    columns = zip(*rows, strict=True)
                    kinds_of = (pa.int32(), pa.binary(), pa.binary())
                    part, data, numbers = (
                        pa.array(c, kind) for c, kind in zip(columns, kinds_of, strict=True)
                    )
                    yield pa.RecordBatch.from_arrays(
                        [part, pa.array([block] * len(part), pa.int64()), data, numbers],
                        names=["part", "block", "kinds", "counts"],
                    )

    return blocks.select("block", "packed").mapInArrow(
        run, "part int, block long, kinds binary, counts binary"
    )


_ANSWERS = "part int, block long, counts binary, tokens long, distinct long, once long, twice long"


def _answers(requests: DataFrame, bits: int) -> DataFrame:
    """For each request the counts of all training texts, in its order; and a row
    without block for each part of the single tokens, with what it adds to the totals."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(k, np.uint64) for k in rows["kinds"]]
        counts = np.concatenate([_unpack_numbers(c) for c in rows["counts"]])
        kinds, at = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(at, counts, minlength=len(kinds)).astype(np.int64)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        answers = [_pack_numbers(totals[own]) for own in np.split(at, cuts)]
        part = int(rows["part"].iat[0])
        out = pd.DataFrame({"part": part, "block": rows["block"].to_numpy(), "counts": answers})
        adds = np.zeros(4, dtype=np.int64)
        if part >> bits == 1:
            adds[:] = totals.sum(), (totals > 0).sum(), (totals == 1).sum(), (totals == 2).sum()
        last = pd.DataFrame({"part": [part], "block": [-1], "counts": [None]})
        out = pd.concat([out, last], ignore_index=True)
        for name, value in zip(("tokens", "distinct", "once", "twice"), adds, strict=True):
            out[name] = np.where(out["block"] == -1, value, 0)
        return out

    return requests.groupBy("part").applyInPandas(answer, _ANSWERS)


def score_texts(
    documents: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: Model = Model(),
) -> DataFrame:
    """``(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of
    every row. The model learns from the rows for which ``held_out`` is false."""
    texts = documents.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), (~held_out).alias("_trains")
    )
    blocks = settled(_pack_blocks(texts))
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    bits = max((size // PART_BYTES).bit_length(), 1)
    answers = settled(_answers(_requests(blocks, model, bits), bits))
    sums = answers.filter("block = -1").agg(
        *(F.sum(c) for c in ("tokens", "distinct", "once", "twice"))
    )
    totals = Totals(*(int(x or 0) for x in sums.first()))
    kind = documents.schema[id_col].dataType.simpleString()
    schema = (
        f"_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def score(block: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return pd.DataFrame({name: [] for name in names})
        table, found = _unpacked(block["packed"].iat[0], model.order)
        answered = answered.sort_values("part")
        counts = {}
        for n in range(1, model.order + 1):
            own = answered["counts"][answered["part"].to_numpy() >> bits == n]
            known = [_unpack_numbers(c) for c in own]
            counts[n] = np.concatenate(known) if known else np.zeros(0, np.int64)
        out = scores(found, counts, totals, model)
        ids = table.column("_id").to_pandas(integer_object_nulls=True)
        return pd.DataFrame(
            {
                "_id": ids,
                "held_out": ~table.column("_trains").to_numpy(),
                "train_tokens": totals.tokens,
                **out,
            }
        )[names]

    asked = answers.filter("block <> -1").select("block", "part", "counts")
    return (
        blocks.select("block", "packed")
        .groupBy("block")
        .cogroup(asked.groupBy("block"))
        .applyInPandas(score, schema)
        .withColumnRenamed("_id", id_col)
    )


def crc_fold(number: Column, folds: int, fold: int) -> Column:
    """Whether a row is in ``fold``, by the CRC-32 of its id as text; a null id is an
    empty text."""
    text = F.coalesce(number.cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(text), F.lit(folds)) == fold
