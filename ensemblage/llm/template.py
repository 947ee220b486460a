"""A small template language for conversations, compiled to Python closures.

``{{ value | filter }}`` writes a value; ``{% for m in messages %}``, ``{% if %} {% elif %} {% else %}``,
``{% set name = value %}`` and ``{% generation %} ... {% endgeneration %}`` are the statements. Values are
strings, integers, ``true``, ``false``, ``none``, names, ``m.role``, ``loop.index0``, ``loop.first``,
``loop.last``, ``~`` (joins), ``==``, ``!=``, ``in``, ``and``, ``or``, ``not`` and round brackets.

Sandbox: there are no calls, no subscripts and no imports; a name is looked up in the given variables only, and
an attribute only in a dict. Filters come from a fixed table. Anything else is a TemplateError when compiling.

Compiling takes three steps: text to tokens, tokens to a tree, tree to a tree with constants folded and dead
branches removed, and that tree to closures that write pieces one after another, so that ``messages`` may be an
iterator that is longer than memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    """The template isn't well-formed or asks for what the sandbox doesn't offer."""


def escape(text: str) -> str:
    """Make control strings harmless: afterwards no ``<|`` stands in the text; ``unescape`` restores it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    """As ``escape``, and without line feeds."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower,
}


# -- the tree ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Attribute:
    of: Any
    name: str


@dataclass(frozen=True)
class Filtered:
    of: Any
    name: str


@dataclass(frozen=True)
class Operation:
    kind: str
    left: Any
    right: Any = None


@dataclass(frozen=True)
class Write:
    value: Any


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Choice:
    branches: tuple[tuple[Any, tuple], ...]


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# -- reading ----------------------------------------------------------------------------------------------

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<word>[A-Za-z_]\w*)|(?P<mark>==|!=|[|.~()=]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


@dataclass
class _Reader:
    """The tokens of one tag."""

    source: str
    tokens: list[tuple[str, str]] = field(default_factory=list)
    at: int = 0

    def __post_init__(self) -> None:
        at = 0
        while self.source[at:].strip():
            found = _TOKEN.match(self.source, at)
            if not found:
                raise TemplateError(f"can't read {self.source[at:]!r}")
            self.tokens.append((found.lastgroup or "", found[found.lastgroup or 0]))
            at = found.end()

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else ""

    def next(self) -> tuple[str, str]:
        if self.at >= len(self.tokens):
            raise TemplateError(f"{self.source!r} ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def take(self, text: str) -> bool:
        if self.peek() == text and self.tokens[self.at][0] in ("word", "mark"):
            self.at += 1
            return True
        return False

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing in {self.source!r}")

    def name(self) -> str:
        kind, word = self.next()
        if kind != "word" or word.startswith("_"):
            raise TemplateError(f"{word!r} isn't a name")
        return word

    def value(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Operation("or", left, self.both())
        return left

    def both(self) -> Any:
        left = self.inverse()
        while self.take("and"):
            left = Operation("and", left, self.inverse())
        return left

    def inverse(self) -> Any:
        return Operation("not", self.inverse()) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.joined()
        for mark in ("==", "!=", "in"):
            if self.take(mark):
                return Operation(mark, left, self.joined())
        return left

    def joined(self) -> Any:
        left = self.filtered()
        while self.take("~"):
            left = Operation("~", left, self.filtered())
        return left

    def filtered(self) -> Any:
        value = self.single()
        while True:
            if self.take("."):
                value = Attribute(value, self.name())
            elif self.take("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"there is no filter {name!r}")
                value = Filtered(value, name)
            else:
                return value

    def single(self) -> Any:
        if self.take("("):
            value = self.value()
            self.need(")")
            return value
        kind, word = self.next()
        if kind == "text":
            return Constant(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == "number":
            return Constant(int(word))
        if kind == "word" and word in ("true", "false", "none"):
            return Constant({"true": True, "false": False, "none": None}[word])
        if kind == "word" and not word.startswith("_"):
            return Name(word)
        raise TemplateError(f"{word!r} isn't a value")

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.peek()!r} is too much in {self.source!r}")


def parse(source: str) -> tuple:
    """The tree of a template."""
    tags: list[tuple[str, str]] = []
    at = 0
    for found in _PARTS.finditer(source):
        if found.start() > at:
            tags.append(("text", source[at : found.start()]))
        at = found.end()
        if found[1] is not None:
            tags.append(("write", found[1]))
        elif found[2] is not None:
            tags.append(("do", found[2].strip()))
    if at < len(source):
        tags.append(("text", source[at:]))
    tags.reverse()
    body, stop = _body(tags, ())
    if stop:
        raise TemplateError(f"{stop!r} closes nothing")
    return body


def _body(tags: list[tuple[str, str]], stops: tuple[str, ...]) -> tuple[tuple, str]:
    nodes: list[Any] = []
    while tags:
        kind, text = tags.pop()
        if kind == "text":
            nodes.append(Write(Constant(text)))
            continue
        reader = _Reader(text)
        if kind == "write":
            nodes.append(Write(reader.value()))
        elif reader.peek() in ("elif", "else", "endif", "endfor", "endgeneration"):
            if reader.peek() not in stops:
                raise TemplateError(f"{text!r} closes nothing")
            return tuple(nodes), text
        else:
            nodes.append(_statement(reader, tags))
        reader.end()
    if stops:
        raise TemplateError(f"{stops[-1]!r} is missing")
    return tuple(nodes), ""


def _statement(reader: _Reader, tags: list[tuple[str, str]]) -> Any:
    if reader.take("for"):
        name = reader.name()
        reader.need("in")
        over = reader.value()
        return Loop(name, over, _body(tags, ("endfor",))[0])
    if reader.take("set"):
        name = reader.name()
        reader.need("=")
        return Assign(name, reader.value())
    if reader.take("generation"):
        return Generation(_body(tags, ("endgeneration",))[0])
    if reader.take("if"):
        branches = []
        condition: Any = reader.value()
        while True:
            body, stop = _body(tags, ("elif", "else", "endif") if condition != Constant(True) or not branches else ("endif",))
            branches.append((condition, body))
            closing = _Reader(stop)
            if closing.take("elif"):
                condition = closing.value()
            elif closing.take("else"):
                condition = Constant(True)
            else:
                return Choice(tuple(branches))
    raise TemplateError(f"{reader.source!r} isn't a statement")


# -- folding ----------------------------------------------------------------------------------------------

_RULES: dict[str, Callable[[Any, Any], Any]] = {
    "~": lambda a, b: _shown(a) + _shown(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "in": lambda a, b: _shown(a) in _shown(b), "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a, _: not a,
}


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def fold(node: Any) -> Any:
    """The same tree with constant values computed, neighbouring texts joined and dead branches removed."""
    if isinstance(node, tuple):
        nodes: list[Any] = []
        for child in map(fold, node):
            for part in child if isinstance(child, tuple) else (child,):
                if isinstance(part, Write) and isinstance(part.value, Constant):
                    text = _shown(part.value.value)
                    if nodes and isinstance(nodes[-1], Write) and isinstance(nodes[-1].value, Constant):
                        text = nodes.pop().value.value + text
                    if not text:
                        continue
                    part = Write(Constant(text))
                nodes.append(part)
        return tuple(nodes)
    if isinstance(node, Write):
        return Write(fold(node.value))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value))
    if isinstance(node, Attribute):
        return Attribute(fold(node.of), node.name)
    if isinstance(node, Filtered):
        inner = fold(node.of)
        return Constant(FILTERS[node.name](_shown(inner.value))) if isinstance(inner, Constant) else Filtered(inner, node.name)
    if isinstance(node, Operation):
        left, right = fold(node.left), fold(node.right)
        if isinstance(left, Constant) and (right is None or isinstance(right, Constant)):
            return Constant(_RULES[node.kind](left.value, right.value if right else None))
        return Operation(node.kind, left, right)
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Choice):
        branches = []
        for condition, body in node.branches:
            condition = fold(condition)
            if isinstance(condition, Constant) and not condition.value:
                continue
            branches.append((condition, fold(body)))
            if isinstance(condition, Constant):
                break
        if not branches:
            return ()
        return branches[0][1] if isinstance(branches[0][0], Constant) else Choice(tuple(branches))
    return node


# -- closures ---------------------------------------------------------------------------------------------

Scope = dict[str, Any]
#: A piece of output and whether it stands between generation markers.
Piece = tuple[str, bool]


def _value(node: Any) -> Callable[[Scope], Any]:
    if isinstance(node, Constant):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Attribute):
        of, name = _value(node.of), node.name

        def attribute(scope: Scope) -> Any:
            found = of(scope)
            return found.get(name) if isinstance(found, dict) else None

        return attribute
    if isinstance(node, Filtered):
        of, change = _value(node.of), FILTERS[node.name]
        return lambda scope: change(_shown(of(scope)))
    left, kind = _value(node.left), node.kind
    if kind == "not":
        return lambda scope: not left(scope)
    right, rule = _value(node.right), _RULES[kind]
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    return lambda scope: rule(left(scope), right(scope))


def _writer(node: Any, marked: bool) -> Callable[[Scope], Iterator[Piece]]:
    if isinstance(node, tuple):
        writers = [_writer(child, marked) for child in node]

        def all_of(scope: Scope) -> Iterator[Piece]:
            for write in writers:
                yield from write(scope)

        return all_of
    if isinstance(node, Write):
        value = _value(node.value)

        def one(scope: Scope) -> Iterator[Piece]:
            yield _shown(value(scope)), marked

        return one
    if isinstance(node, Assign):
        name, value = node.name, _value(node.value)

        def assign(scope: Scope) -> Iterator[Piece]:
            scope[name] = value(scope)
            return iter(())

        return assign
    if isinstance(node, Generation):
        return _writer(node.body, True)
    if isinstance(node, Choice):
        branches = [(_value(condition), _writer(body, marked)) for condition, body in node.branches]

        def choose(scope: Scope) -> Iterator[Piece]:
            for condition, write in branches:
                if condition(scope):
                    yield from write(scope)
                    return

        return choose
    name, over, body = node.name, _value(node.over), _writer(node.body, marked)

    def loop(scope: Scope) -> Iterator[Piece]:
        rest = iter(over(scope) or ())
        index, here = 0, next(rest, None)
        while here is not None:
            following = next(rest, None)
            inner = {**scope, name: here, "loop": {"index0": index, "index": index + 1, "first": index == 0, "last": following is None}}
            yield from body(inner)
            index, here = index + 1, following

    return loop


def compile_template(source: str) -> Callable[[Scope], Iterator[Piece]]:
    """A function from variables to the pieces of output, in order."""
    return _writer(fold(parse(source)), False)
