"""Conversations formatted by a compiled template, and read back.

The template marks turns with control strings. Where such a string occurs in a role
or a text, a backslash is put behind its first character, and one more where there
are some already; taking one away gives the text back. A formatted text therefore
holds control strings only where the template wrote them.

The turns of a conversation come in the order of ``turn``, then role, then text, nulls
first. A conversation is one row of output and is put together in one task, where its
turns arrive sorted and in batches; the largest conversation bounds the memory.

Defined results: a null role or text is an empty one; rows with a null conversation id
form one conversation; repeated rows are repeated turns; a table without rows gives no
rows; of extra columns nothing is read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechprep.llm.template import compile_template

#: Control strings of common chat formats (fixed values). None begins inside another.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
#: One turn after the other; what the assistant says is to be learnt.
TEMPLATE = (
    "{%- for message in messages -%}"
    "{{ '<|im_start|>' ~ message.role | field ~ '\n' }}"
    "{%- if message.role == 'assistant' -%}"
    "{%- generation -%}{{ message.text | guard }}{%- endgeneration -%}"
    "{%- else -%}{{ message.text | guard }}{%- endif -%}"
    "{{ '<|im_end|>\n' }}"
    "{%- endfor -%}"
)
#: Characters of formatted text that are sent on at once.
BATCH_CHARS = 4 << 20

_ANY = "|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL)
_ESCAPED = "|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL)
_GUARD, _UNGUARD = re.compile(_ANY), re.compile(_ESCAPED)
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def guard(text: str) -> str:
    return _GUARD.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unguard(text: str) -> str:
    return _UNGUARD.sub(lambda m: m[0][0] + m[0][2:], text)


def field(text: str) -> str:
    """``text`` on one line and guarded."""
    return guard(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unfield(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguard(text))


@lru_cache(maxsize=8)
def renderer(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    return compile_template(template, {"guard": guard, "field": field})


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_conversations(
    conversations: DataFrame,
    template: str = TEMPLATE,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, formatted, loss array<struct<start, end>>)`` of every conversation;
    ``loss`` are the spans of code points under the template's generation markers."""

    def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        ids, texts, spans = zip(*rows, strict=True)
        loss = [[{"start": a, "end": b} for a, b in s] for s in spans]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array(texts, pa.string()), pa.array(loss, _SPANS)],
            names=["_id", "formatted", "loss"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = renderer(template)
        rows, size, current, messages, kind = [], 0, None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for number, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if messages is not None and number != current:
                    rows.append((current, *render({"messages": messages})))
                    size += len(rows[-1][1])
                    messages = None
                    if size >= BATCH_CHARS:
                        yield batch_of(rows, kind)
                        rows, size = [], 0
                if messages is None:
                    current, messages = number, []
                messages.append({"role": role or "", "text": text or ""})
        if messages is not None:
            rows.append((current, *render({"messages": messages})))
        if rows:
            yield batch_of(rows, kind)

    kind = conversations.schema[id_col].dataType.simpleString()
    return (
        conversations.select(
            F.col(id_col).alias("_id"),
            F.col(turn_col).alias("_turn"),
            F.col(role_col).alias("_role"),
            F.col(text_col).alias("_text"),
        )
        .repartition("_id")
        .sortWithinPartitions("_id", "_turn", "_role", "_text")
        .select("_id", "_role", "_text")
        .mapInArrow(run, f"_id {kind}, formatted string, loss array<struct<start:long,end:long>>")
        .withColumnRenamed("_id", id_col)
    )


def parse_formatted(text: str) -> list[tuple[str, str]]:
    """The turns ``(role, text)`` of a formatted conversation."""
    out, place = [], 0
    while place < len(text):
        found = _TURN.match(text, place)
        if not found:
            raise ValueError("not a formatted conversation")
        out.append((unfield(found[1]), unguard(found[2])))
        place = found.end()
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with its ``turns array<struct<role, text>>`` and ``learnt
    array<string>``, the unescaped text of each span of ``loss``."""
    turns_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    at_text, at_loss = (formatted.columns.index(c) for c in ("formatted", "loss"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at_text).to_pylist()
            spans = batch.column(at_loss).to_pylist()
            turns = [[{"role": r, "text": t} for r, t in parse_formatted(text)] for text in texts]
            learnt = [
                [unguard(text[s["start"] : s["end"]]) for s in own]
                for text, own in zip(texts, spans, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(turns, turns_type), pa.array(learnt, pa.list_(pa.string()))],
                names=[*batch.schema.names, "t", "l"],
            )

    numbered = formatted.toDF(*(f"c{i}" for i in range(len(formatted.columns))))
    schema = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(formatted.dtypes))
    schema += ", t array<struct<role:string,text:string>>, l array<string>"
    return numbered.mapInArrow(run, schema).toDF(*formatted.columns, "turns", "learnt")
