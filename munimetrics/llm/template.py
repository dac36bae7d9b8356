"""A small sandboxed template language: parsed into a syntax tree, constants folded, compiled to Python closures.

Text stands for itself. ``{{ expression }}`` prints, ``{# remark #}`` is dropped, ``{% ... %}`` holds ``for name in
expression`` / ``endfor``, ``if`` / ``elif`` / ``else`` / ``endif``, ``set name = expression`` and ``generation`` /
``endgeneration``, which marks what the model has to learn. A ``-`` inside a tag's brackets drops the white space beside it.

Expressions have strings, whole numbers, ``true``, ``false``, ``none``, names, ``a.key`` and ``a['key']`` (mapping keys and
list places only), ``or and not``, comparisons, ``in``, ``+ - * // %`` (on numbers; ``+`` also joins strings), ``~`` (joins
as text), ``x if c else y``, ``is [not] defined`` / ``none`` and filters ``x | name(arguments)`` out of a given table. There
are no calls, no Python attributes and no way to more names than those handed in. An unknown name prints as nothing.

A compiled template is a generator of pieces, so that the list of a loop may be read as it is written.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

Env = dict[str, Any]
Value = Callable[[Env], Any]

#: Pieces that are no text.
START, END, CUT = object(), object(), object()


class TemplateError(ValueError):
    """The template is not well formed, or an expression has no value."""


class _Undefined:
    def __bool__(self) -> bool:
        return False


UNDEFINED = _Undefined()


@dataclass
class Node:
    """An expression (``literal name key not binary choice test filter``) or a statement (``text print for if set generation``)."""

    kind: str
    value: Any = None
    parts: list[Any] = field(default_factory=list)


_TAGS = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
_WORDS = re.compile(
    r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|//|[-+*%~<>|().,\[\]=]))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORD_SIGNS = {"or", "and", "not", "in", "is", "if", "else"}
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_LEVELS = [["or"], ["and"], ["==", "!=", "<", "<=", ">", ">=", "in", "not in"], ["~"], ["+", "-"], ["*", "//", "%"]]
_DEPTH = 60


def _numbers(a: Any, b: Any) -> bool:
    return all(isinstance(x, int) and not isinstance(x, bool) for x in (a, b))


def _plus(a: Any, b: Any) -> Any:
    if _numbers(a, b) or isinstance(a, str) and isinstance(b, str):
        return a + b
    raise TemplateError("+ takes two numbers or two strings")


def _arithmetic(name: str, run: Callable[[int, int], int]) -> Callable[[Any, Any], int]:
    def apply(a: Any, b: Any) -> int:
        if not _numbers(a, b) or name in ("//", "%") and b == 0:
            raise TemplateError(f"{name} takes two numbers, and divides by none of zero")
        return run(a, b)

    return apply


def _order(name: str, run: Callable[[Any, Any], bool]) -> Callable[[Any, Any], bool]:
    def apply(a: Any, b: Any) -> bool:
        if not (_numbers(a, b) or isinstance(a, str) and isinstance(b, str)):
            raise TemplateError(f"{name} takes two numbers or two strings")
        return run(a, b)

    return apply


def _within(a: Any, b: Any) -> bool:
    if isinstance(b, str):
        return isinstance(a, str) and a in b
    return isinstance(b, list | tuple | dict) and a in b


def shown(value: Any) -> str:
    """What an expression prints."""
    if value is UNDEFINED or value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else str(value) if isinstance(value, int) else json.dumps(value, ensure_ascii=False)


BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: type(a) is type(b) and a == b,
    "!=": lambda a, b: not (type(a) is type(b) and a == b),
    "<": _order("<", lambda a, b: a < b),
    "<=": _order("<=", lambda a, b: a <= b),
    ">": _order(">", lambda a, b: a > b),
    ">=": _order(">=", lambda a, b: a >= b),
    "in": _within,
    "not in": lambda a, b: not _within(a, b),
    "~": lambda a, b: shown(a) + shown(b),
    "+": _plus,
    "-": _arithmetic("-", lambda a, b: a - b),
    "*": _arithmetic("*", lambda a, b: a * b),
    "//": _arithmetic("//", lambda a, b: a // b),
    "%": _arithmetic("%", lambda a, b: a % b),
}

FILTERS: dict[str, Callable[..., Any]] = {
    "trim": lambda x: shown(x).strip(),
    "upper": lambda x: shown(x).upper(),
    "lower": lambda x: shown(x).lower(),
    "length": lambda x: len(x) if isinstance(x, str | list | dict) else 0,
    "default": lambda x, other="": other if x is UNDEFINED or x is None else x,
    "tojson": lambda x: json.dumps(None if x is UNDEFINED else x, ensure_ascii=False),
}


def _lookup(value: Any, key: Any) -> Any:
    if isinstance(value, dict):
        return value.get(key, UNDEFINED)
    if isinstance(value, list | tuple) and _numbers(key, 0) and -len(value) <= key < len(value):
        return value[key]
    return UNDEFINED


class _Expression:
    """Recursive descent over the words of one tag."""

    def __init__(self, source: str):
        self.words: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            match = _WORDS.match(source, at)
            if match is None:
                raise TemplateError(f"not understood: {source[at : at + 20]!r}")
            self.words.append((match.lastgroup or "", match.group(match.lastgroup)))
            at = match.end()
        self.at = self.depth = 0

    def peek(self, *wanted: str) -> str | None:
        if self.at < len(self.words):
            kind, word = self.words[self.at]
            if kind != "string" and word in wanted:
                return word
        return None

    def take(self, *wanted: str) -> str | None:
        found = self.peek(*wanted)
        self.at += found is not None
        return found

    def need(self, wanted: str) -> None:
        if self.take(wanted) is None:
            raise TemplateError(f"{wanted!r} expected")

    def name(self) -> str:
        if self.at < len(self.words) and self.words[self.at][0] == "name" and self.words[self.at][1] not in _WORD_SIGNS:
            self.at += 1
            return self.words[self.at - 1][1]
        raise TemplateError("a name expected")

    def end(self) -> None:
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")

    def whole(self) -> Node:
        node = self.choice()
        self.end()
        return node

    def choice(self) -> Node:
        self.depth += 1
        if self.depth > _DEPTH:
            raise TemplateError("nested too deeply")
        node = self.binary(0)
        if self.take("if"):
            condition = self.binary(0)
            other = self.choice() if self.take("else") else Node("literal", "")
            node = Node("choice", None, [condition, node, other])
        self.depth -= 1
        return node

    def binary(self, level: int) -> Node:
        if level == len(_LEVELS):
            return self.unary()
        if level == 2 and self.take("not"):
            return Node("not", None, [self.binary(level)])
        node = self.binary(level + 1)
        while True:
            if level == 2 and self.take("is"):
                other, name = self.take("not"), self.name()
                if name not in ("defined", "none"):
                    raise TemplateError(f"no test {name!r}")
                node = Node("test", name, [node])
                node = Node("not", None, [node]) if other else node
                continue
            sign = self.take(*_LEVELS[level])
            if sign is None and level == 2 and self.peek("not"):
                self.take("not")
                self.need("in")
                sign = "not in"
            if sign is None:
                return node
            node = Node("binary", sign, [node, self.binary(level + 1)])

    def unary(self) -> Node:
        if self.take("-"):
            return Node("binary", "-", [Node("literal", 0), self.unary()])
        node = self.primary()
        while True:
            if self.take("."):
                node = Node("key", None, [node, Node("literal", self.name())])
            elif self.take("["):
                node = Node("key", None, [node, self.choice()])
                self.need("]")
            elif self.take("|"):
                name, arguments = self.name(), []
                if self.take("("):
                    while not self.take(")"):
                        arguments.append(self.choice())
                        if not self.peek(")"):
                            self.need(",")
                node = Node("filter", name, [node, *arguments])
            else:
                return node

    def primary(self) -> Node:
        if self.at >= len(self.words):
            raise TemplateError("an expression expected")
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        kind, word = self.words[self.at]
        if kind == "string":
            self.at += 1
            return Node("literal", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == "number":
            self.at += 1
            return Node("literal", int(word))
        name = self.name()
        return Node("literal", _CONSTANTS[name]) if name in _CONSTANTS else Node("name", name)


def parse(source: str) -> list[Node]:
    """The syntax tree of a template."""
    pieces: list[tuple[str, str]] = []
    at, strip = 0, False
    for match in _TAGS.finditer(source):
        text = source[at : match.start()]
        left, right = match[1] or match[4], match[3] or match[6]
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if left else text))
        if match[2] is not None:
            pieces.append(("print", match[2]))
        elif match[5] is not None:
            pieces.append(("tag", match[5]))
        at, strip = match.end(), bool(right)
    pieces.append(("text", source[at:].lstrip() if strip else source[at:]))
    body, at = _block(pieces, 0, (), 0)
    return body


def _block(pieces: list[tuple[str, str]], at: int, closers: tuple[str, ...], depth: int) -> tuple[list[Node], int]:
    """Statements up to one of ``closers``, whose place is returned."""
    if depth > _DEPTH:
        raise TemplateError("nested too deeply")
    out: list[Node] = []
    while at < len(pieces):
        kind, content = pieces[at]
        if kind == "text":
            if content:
                out.append(Node("text", content))
            at += 1
            continue
        words = _Expression(content)
        if kind == "print":
            out.append(Node("print", None, [words.whole()]))
            at += 1
            continue
        word = words.name() if not words.peek("if", "else") else words.take("if", "else")
        if word in closers:
            return out, at
        if word == "for":
            name = words.name()
            words.need("in")
            items = words.whole()
            body, at = _block(pieces, at + 1, ("endfor",), depth + 1)
            out.append(Node("for", name, [items, body]))
        elif word == "if":
            branches, condition = [], words.whole()
            while True:
                body, at = _block(pieces, at + 1, ("elif", "else", "endif"), depth + 1)
                branches.append((condition, body))
                words = _Expression(pieces[at][1])
                word = words.take("else") or words.name()
                if word == "endif":
                    break
                condition = words.whole() if word == "elif" else Node("literal", True)
            out.append(Node("if", None, branches))
        elif word == "set":
            name = words.name()
            words.need("=")
            out.append(Node("set", name, [words.whole()]))
        elif word == "generation":
            words.end()
            body, at = _block(pieces, at + 1, ("endgeneration",), depth + 1)
            out.append(Node("generation", None, [body]))
        else:
            raise TemplateError(f"unexpected {word!r}")
        at += 1
    if closers:
        raise TemplateError(f"{closers[-1]!r} is missing")
    return out, at


class Compiler:
    """Folds what ``constants`` and literals decide, then builds closures."""

    def __init__(self, constants: Env | None = None, filters: dict[str, Callable[..., Any]] | None = None):
        self.constants = dict(constants or {})
        self.filters = FILTERS | (filters or {})

    def fold(self, node: Node) -> Node:
        if node.kind == "literal":
            return node
        if node.kind == "name":
            return Node("literal", self.constants[node.value]) if node.value in self.constants else node
        parts = [self.fold(p) for p in node.parts]
        if node.kind == "filter" and node.value not in self.filters:
            raise TemplateError(f"no filter {node.value!r}")
        out = Node(node.kind, node.value, parts)
        if node.kind == "choice" and parts[0].kind == "literal":
            return parts[1] if parts[0].value else parts[2]
        if node.kind == "binary" and node.value in ("and", "or") and parts[0].kind == "literal":
            return parts[1] if bool(parts[0].value) == (node.value == "and") else parts[0]
        if all(p.kind == "literal" for p in parts):
            try:
                return Node("literal", self.value(out)({}))
            except TemplateError:
                return out  # fails where it is reached, not before
        return out

    def fold_block(self, body: list[Node], shadowed: frozenset[str] = frozenset()) -> list[Node]:
        """Folded statements with neighbouring text joined and undecided branches only."""
        # A name that the template sets anywhere in the block is no constant there.
        hidden = {n.value for n in _walk(body) if n.kind == "set"} | shadowed
        held = {k: self.constants.pop(k) for k in hidden & self.constants.keys()}
        out: list[Node] = []

        def add(node: Node) -> None:
            if node.kind == "text" and out and out[-1].kind == "text":
                out[-1] = Node("text", out[-1].value + node.value)
            elif node.kind != "text" or node.value:
                out.append(node)

        for node in body:
            if node.kind == "print":
                value = self.fold(node.parts[0])
                add(Node("text", shown(value.value)) if value.kind == "literal" else Node("print", None, [value]))
            elif node.kind == "set":
                add(Node("set", node.value, [self.fold(node.parts[0])]))
            elif node.kind == "for":
                add(Node("for", node.value, [self.fold(node.parts[0]), self.fold_block(node.parts[1], shadowed | {node.value, "loop"})]))
            elif node.kind == "generation":
                add(Node("generation", None, [self.fold_block(node.parts[0], shadowed)]))
            elif node.kind == "if":
                left = []
                for condition, inner in node.parts:
                    condition = self.fold(condition)
                    if condition.kind == "literal" and not condition.value:
                        continue
                    left.append((condition, self.fold_block(inner, shadowed)))
                    if condition.kind == "literal":
                        break
                if left and left[0][0].kind == "literal":
                    for inner in left[0][1]:
                        add(inner)
                elif left:
                    add(Node("if", None, left))
            else:
                add(node)
        self.constants |= held
        return out

    def value(self, node: Node) -> Value:
        parts = [self.value(p) for p in node.parts]
        if node.kind == "literal":
            constant = node.value
            return lambda env: constant
        if node.kind == "name":
            name = node.value
            return lambda env: env.get(name, UNDEFINED)
        if node.kind == "not":
            (inner,) = parts
            return lambda env: not inner(env)
        if node.kind == "test":
            (inner,) = parts
            if node.value == "defined":
                return lambda env: inner(env) is not UNDEFINED
            return lambda env: inner(env) is None
        if node.kind == "choice":
            condition, yes, no = parts
            return lambda env: yes(env) if condition(env) else no(env)
        if node.kind == "filter":
            run, (first, *others) = self.filters[node.value], parts
            if not others:
                return lambda env: run(first(env))
            return lambda env: run(first(env), *(o(env) for o in others))
        a, b = parts
        if node.kind == "key":
            return lambda env: _lookup(a(env), b(env))
        if node.value == "and":
            return lambda env: a(env) and b(env)
        if node.value == "or":
            return lambda env: a(env) or b(env)
        apply = BINARY[node.value]
        return lambda env: apply(a(env), b(env))

    def block(self, body: list[Node], inner: bool = False) -> Callable[[Env], Iterator[Any]]:
        steps = [self._statement(n, inner) for n in body]

        def run(env: Env) -> Iterator[Any]:
            for step in steps:
                yield from step(env)

        return run

    def _statement(self, node: Node, inner: bool) -> Callable[[Env], Iterable[Any]]:
        if node.kind == "text":
            text = (node.value,)
            return lambda env: text
        if node.kind == "print":
            value = self.value(node.parts[0])
            return lambda env: (shown(value(env)),)
        if node.kind == "set":
            name, value = node.value, self.value(node.parts[0])

            def assign(env: Env) -> tuple[()]:
                env[name] = value(env)
                return ()

            return assign
        if node.kind == "generation":
            body = self.block(node.parts[0], True)

            def marked(env: Env) -> Iterator[Any]:
                yield START
                yield from body(env)
                yield END

            return marked
        if node.kind == "if":
            branches = [(self.value(c), self.block(b, inner)) for c, b in node.parts]

            def decide(env: Env) -> Iterable[Any]:
                for condition, chosen in branches:
                    if condition(env):
                        return chosen(env)
                return ()

            return decide
        name, items, body = node.value, self.value(node.parts[0]), self.block(node.parts[1], True)

        def loop(env: Env) -> Iterator[Any]:
            values = items(env)
            if values is UNDEFINED or isinstance(values, str | int) or values is None:
                raise TemplateError("for needs a list")
            for number, (value, last) in enumerate(_with_last(values)):
                own = dict(env)
                own[name] = value
                own["loop"] = {"index0": number, "index": number + 1, "first": number == 0, "last": last}
                yield from body(own)
                if not inner:
                    yield CUT

        return loop


def _walk(body: list[Node]) -> Iterator[Node]:
    for node in body:
        yield node
        for inner in [node.parts[-1]] if node.kind in ("for", "generation") else [b for _, b in node.parts] if node.kind == "if" else []:
            yield from _walk(inner)


def _with_last(values: Iterable[Any]) -> Iterator[tuple[Any, bool]]:
    """Each value and whether it is the last one; one value is read ahead."""
    flow = iter(values)
    for held in flow:
        for value in flow:
            yield held, False
            held = value
        yield held, True


class Template:
    """``pieces(env)`` gives texts and the marks ``START``, ``END`` (of what is learnt) and ``CUT`` (after a round of an outer loop)."""

    def __init__(self, source: str, constants: Env | None = None, filters: dict[str, Callable[..., Any]] | None = None):
        compiler = Compiler(constants, filters)
        self.tree = compiler.fold_block(parse(source))
        self.run = compiler.block(self.tree)
        self.constants = compiler.constants

    def pieces(self, env: Env) -> Iterator[Any]:
        return self.run(self.constants | env)

    def render(self, env: Env) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and the learnt spans in code points."""
        out, spans, at, start = [], [], 0, 0
        for piece in self.pieces(env):
            if piece is START:
                start = at
            elif piece is END:
                spans.append((start, at))
            elif piece is not CUT:
                out.append(piece)
                at += len(piece)
        return "".join(out), spans
