"""A small, sandboxed template language for conversations, compiled to closures.

``{{ expression }}``, ``{% for x in xs %}``, ``{% if %} {% elif %} {% else %}``,
``{% set x = expression %}``, ``{% generation %} .. {% endgeneration %}`` around what a
model is to learn, and ``{# comments #}``; a ``-`` inside a delimiter trims white space
on its side. Expressions have strings, integers, ``true``, ``false``, ``none``, names,
``a.b`` and ``a['b']`` on mappings, ``~ + == != < <= > >= in not and or``, parentheses
and filters. There are no calls and no attributes of Python objects.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

TAGS = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
TOKENS = re.compile(
    r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)"
    r"|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-~+<>|.\[\]()=]))",
    re.S,
)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


# syntax tree: expressions


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    sign: str
    of: Any


@dataclass(frozen=True)
class Binary:
    sign: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Filter:
    name: str
    of: Any


# syntax tree: statements


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Block:
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    then: Block
    other: Block


@dataclass(frozen=True)
class For:
    name: str
    of: Any
    body: Block


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: Block


class _Expression:
    """Recursive descent over the tokens of one expression."""

    levels = (
        ("or",),
        ("and",),
        ("==", "!=", "<", "<=", ">", ">=", "in", "not in"),
        ("+", "~"),
    )

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        place = 0
        while place < len(source.rstrip()):
            found = TOKENS.match(source, place)
            if not found:
                raise TemplateError(f"cannot read {source[place:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            place = found.end()
        self.at = 0

    def peek(self, ahead: int = 0) -> str | None:
        at = self.at + ahead
        if at < len(self.tokens) and self.tokens[at][0] != "string":
            return self.tokens[at][1]
        return None

    def take(self, wanted: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or (wanted and self.peek() != wanted):
            raise TemplateError(f"expected {wanted or 'more'} in an expression")
        self.at += 1
        return self.tokens[self.at - 1]

    def name(self) -> str:
        kind, value = self.take()
        if kind != "name":
            raise TemplateError(f"{value!r} is no name")
        return value

    def whole(self) -> Any:
        out = self.level(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def level(self, depth: int) -> Any:
        if depth == len(self.levels):
            return self.unary()
        if depth == 2 and self.peek() == "not":
            self.take()
            return Unary("not", self.level(2))
        left = self.level(depth + 1)
        while True:
            sign = self.peek()
            if sign == "not" and self.peek(1) == "in":
                sign = "not in"
            if sign not in self.levels[depth]:
                return left
            self.at += 2 if sign == "not in" else 1
            left = Binary(sign, left, self.level(depth + 1))

    def unary(self) -> Any:
        out = self.primary()
        while (sign := self.peek()) in (".", "[", "|"):
            self.take()
            if sign == ".":
                out = Item(out, Const(self.name()))
            elif sign == "[":
                out = Item(out, self.level(0))
                self.take("]")
            else:
                out = Filter(self.name(), out)
        return out

    def primary(self) -> Any:
        kind, value = self.take()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if kind == "name":
            known = {"true": True, "false": False, "none": None}
            if value in known:
                return Const(known[value])
            return Name(value)
        if value == "(":
            out = self.level(0)
            self.take(")")
            return out
        raise TemplateError(f"unexpected {value!r}")


class _Parser:
    def __init__(self, source: str) -> None:
        self.parts: list[tuple[str, str]] = []
        trim = False
        pieces = TAGS.split(source)
        for k, piece in enumerate(pieces):
            if k % 2 == 0:
                if trim:
                    piece = piece.lstrip()
                if k + 1 < len(pieces) and pieces[k + 1][2:3] == "-":
                    piece = piece.rstrip()
                if piece:
                    self.parts.append(("text", piece))
                continue
            trim = piece[-3:-2] == "-"
            if piece[1] != "#":
                kind = "output" if piece[1] == "{" else "tag"
                self.parts.append((kind, piece[2:-2].strip("-").strip()))
        self.at = 0

    def block(self, *ends: str) -> tuple[Block, str]:
        """Statements up to one of the tags ``ends``, and that tag."""
        body = []
        while self.at < len(self.parts):
            kind, source = self.parts[self.at]
            self.at += 1
            if kind == "text":
                body.append(Output(Const(source)))
            elif kind == "output":
                body.append(Output(_Expression(source).whole()))
            else:
                word, _, rest = source.partition(" ")
                if word in ends:
                    return Block(tuple(body)), source
                body.append(self.statement(word, rest))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return Block(tuple(body)), ""

    def statement(self, word: str, rest: str) -> Any:
        if word == "if":
            return self.condition(rest)
        if word == "for":
            source = _Expression(rest)
            name = source.name()
            source.take("in")
            of = source.whole()
            return For(name, of, self.block("endfor")[0])
        if word == "set":
            source = _Expression(rest)
            name = source.name()
            source.take("=")
            return Set(name, source.whole())
        if word == "generation":
            return Generation(self.block("endgeneration")[0])
        raise TemplateError(f"unknown tag {word!r}")

    def condition(self, test: str) -> If:
        then, end = self.block("elif", "else", "endif")
        other = Block(())
        if end.startswith("elif"):
            other = Block((self.condition(end.partition(" ")[2]),))
        elif end == "else":
            other, _ = self.block("endif")
        return If(_Expression(test).whole(), then, other)


def parse(source: str) -> Block:
    return _Parser(source).block()[0]


# constant folding


def _text(value: Any) -> str:
    if value is None or value is False or value is True:
        return {None: "", False: "false", True: "true"}[value]
    if not isinstance(value, (str, int)):
        raise TemplateError("only text and numbers can be written")
    return str(value)


def _item(of: Any, key: Any) -> Any:
    if isinstance(of, Mapping) and isinstance(key, str):
        return of.get(key)
    if isinstance(of, (list, tuple, str)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError(f"no item {key!r}")


BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "+": operator.add,
    "~": lambda a, b: _text(a) + _text(b),
    "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b,
}
FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": len,
}


def fold(node: Any, filters: Mapping[str, Callable]) -> Any:
    """The tree with constant expressions evaluated, decided branches taken and
    neighbouring texts joined."""
    if isinstance(node, Block):
        body: list = []
        for part in node.body:
            part = fold(part, filters)
            inner = part.body if isinstance(part, Block) else (part,)
            for one in inner:
                if isinstance(one, Output) and isinstance(one.value, Const):
                    one = Output(Const(_text(one.value.value)))
                    if not one.value.value:
                        continue
                    if body and isinstance(body[-1], Output) and isinstance(body[-1].value, Const):
                        one = Output(Const(body.pop().value.value + one.value.value))
                body.append(one)
        return Block(tuple(body))
    if isinstance(node, Output):
        return Output(fold(node.value, filters))
    if isinstance(node, If):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other, filters)
        return If(test, fold(node.then, filters), fold(node.other, filters))
    if isinstance(node, For):
        return For(node.name, fold(node.of, filters), fold(node.body, filters))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, Item):
        node = Item(fold(node.of, filters), fold(node.key, filters))
        constant = isinstance(node.of, Const) and isinstance(node.key, Const)
    elif isinstance(node, Filter):
        node = Filter(node.name, fold(node.of, filters))
        constant = isinstance(node.of, Const)
    elif isinstance(node, Unary):
        node = Unary(node.sign, fold(node.of, filters))
        constant = isinstance(node.of, Const)
    elif isinstance(node, Binary):
        node = Binary(node.sign, fold(node.left, filters), fold(node.right, filters))
        if node.sign in ("and", "or") and isinstance(node.left, Const):
            return node.right if bool(node.left.value) == (node.sign == "and") else node.left
        constant = isinstance(node.left, Const) and isinstance(node.right, Const)
    else:
        return node
    return Const(_value(node, filters)({})) if constant else node


# closures


class Writer:
    """Collects text, its length in code points, and the spans of generation blocks."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    """A closure that evaluates an expression in a scope."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Item):
        of, key = _value(node.of, filters), _value(node.key, filters)
        return lambda scope: _item(of(scope), key(scope))
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"no filter {node.name!r}")
        run, of = filters[node.name], _value(node.of, filters)
        return lambda scope: run(of(scope))
    if isinstance(node, Unary):
        of = _value(node.of, filters)
        return lambda scope: not of(scope)
    left, right = _value(node.left, filters), _value(node.right, filters)
    if node.sign == "and":
        return lambda scope: left(scope) and right(scope)
    if node.sign == "or":
        return lambda scope: left(scope) or right(scope)
    apply = BINARY[node.sign]

    def binary(scope: dict) -> Any:
        try:
            return apply(left(scope), right(scope))
        except TypeError as error:
            raise TemplateError(str(error)) from None

    return binary


def _run(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict, Writer], None]:
    """A closure that runs a statement."""
    if isinstance(node, Block):
        steps = [_run(part, filters) for part in node.body]
        if len(steps) == 1:
            return steps[0]

        def block(scope: dict, out: Writer) -> None:
            for step in steps:
                step(scope, out)

        return block
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            text = _text(node.value.value)
            return lambda scope, out: out.write(text)
        value = _value(node.value, filters)
        return lambda scope, out: out.write(_text(value(scope)))
    if isinstance(node, If):
        test, then, other = (
            _value(node.test, filters), _run(node.then, filters), _run(node.other, filters)
        )
        return lambda scope, out: (then if test(scope) else other)(scope, out)
    if isinstance(node, Set):
        name, value = node.name, _value(node.value, filters)

        def assign(scope: dict, out: Writer) -> None:
            scope[name] = value(scope)

        return assign
    if isinstance(node, Generation):
        body = _run(node.body, filters)

        def generation(scope: dict, out: Writer) -> None:
            start = out.length
            body(scope, out)
            out.spans.append((start, out.length))

        return generation
    name, of, body = node.name, _value(node.of, filters), _run(node.body, filters)

    def loop(scope: dict, out: Writer) -> None:
        values = of(scope) or ()
        last = len(values) - 1
        inner = dict(scope)
        for k, value in enumerate(values):
            inner[name] = value
            inner["loop"] = {
                "index": k + 1, "index0": k, "first": k == 0, "last": k == last, "length": last + 1
            }
            body(inner, out)

    return loop


def compile_template(
    source: str, filters: Mapping[str, Callable] | None = None
) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from a scope to the text and the spans of its generation blocks."""
    known = FILTERS | dict(filters or {})
    run = _run(fold(parse(source), known), known)

    def render(scope: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Writer()
        run(dict(scope), out)
        return "".join(out.parts), out.spans

    return render
