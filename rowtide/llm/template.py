"""A small template language: parser, constant folding, and compilation to Python closures.

Syntax: ``{{ expression }}``, ``{% for m in messages %}..{% endfor %}``, ``{% if c %}..{% elif c %}..
{% else %}..{% endif %}``, ``{% generation %}..{% endgeneration %}``, ``{# comment #}``. Expressions have
strings, integers, ``true``, ``false``, ``none``, names, ``m.field`` and ``m['field']``, ``~`` and ``+``,
``== != < > <= >=``, ``in``, ``not``, ``and``, ``or``, parentheses and filters (``| trim``).

Sandboxed: a name is a key of the context, a field is a key of a dict; no attribute, call or import
can be reached, loops run over given lists only, and anything else is a ``TemplateError`` when parsed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass


class TemplateError(ValueError):
    """The template is not in the language."""


# ---------------------------------------------------------------- syntax tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    owner: object
    key: object


@dataclass(frozen=True)
class Apply:
    """An operator or filter over its operands."""

    name: str
    operands: tuple


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class Loop:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Branch:
    test: object
    then: tuple
    otherwise: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def text_of(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


OPERATORS: dict[str, Callable] = {
    "~": lambda a, b: text_of(a) + text_of(b),
    "+": lambda a, b: a + b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: text_of(x).strip(),
    "upper": lambda x: text_of(x).upper(),
    "lower": lambda x: text_of(x).lower(),
    "length": len,
}

PIECE = re.compile(r"\{#.*?#\}|\{\{.*?\}\}|\{%.*?%\}", re.S)
TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[~+<>()|.\[\]]))""")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def tokens(source: str) -> list[tuple[str, object]]:
    found, at = [], 0
    source = source.strip()
    while at < len(source):
        match = TOKEN.match(source, at)
        if not match:
            raise TemplateError(f"cannot read {source[at:at + 20]!r}")
        string, number, word, sign = match.groups()
        if string is not None:
            found.append(("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), string[1:-1], flags=re.S)))
        elif number is not None:
            found.append(("const", int(number)))
        else:
            found.append(("word", word) if word is not None else ("sign", sign))
        at = match.end()
    return found


class Expression:
    """Recursive descent over the tokens of one expression."""

    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("~", "+"))

    def __init__(self, source: str):
        self.tokens, self.at = tokens(source), 0

    def whole(self):
        tree = self.level(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind != "const" and value in values:
                self.at += 1
                return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def level(self, n: int):
        if n == len(self.LEVELS):
            return self.filtered()
        if n == 2 and self.take("not"):
            return Apply("not", (self.level(2),))
        tree = self.level(n + 1)
        while sign := self.take(*self.LEVELS[n]):
            tree = Apply(sign, (tree, self.level(n + 1)))
        return tree

    def filtered(self):
        tree = self.atom()
        while True:
            if self.take("|"):
                name = self.word()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                tree = Apply(name, (tree,))
            elif self.take("."):
                tree = Field(tree, Const(self.word()))
            elif self.take("["):
                tree = Field(tree, self.level(0))
                self.need("]")
            else:
                return tree

    def word(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "word":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("name expected")

    def atom(self):
        if self.take("("):
            tree = self.level(0)
            self.need(")")
            return tree
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            self.at += 1
            return Const(self.tokens[self.at - 1][1])
        name = self.word()
        return {"true": Const(True), "false": Const(False), "none": Const(None)}.get(name) or Name(name)


def pieces(source: str) -> Iterator[tuple[str, str]]:
    at = 0
    for match in PIECE.finditer(source):
        if match.start() > at:
            yield "text", source[at:match.start()]
        body = match[0]
        if body.startswith("{{"):
            yield "value", body[2:-2]
        elif body.startswith("{%"):
            yield "tag", body[2:-2].strip()
        at = match.end()
    if at < len(source):
        yield "text", source[at:]


def parse(source: str) -> tuple:
    """The template as a tuple of nodes."""
    stream = list(pieces(source))
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes = []
        while at < len(stream):
            kind, body = stream[at]
            at += 1
            if kind == "text":
                nodes.append(Emit(Const(body)))
                continue
            if kind == "value":
                nodes.append(Emit(Expression(body).whole()))
                continue
            word, _, rest = body.partition(" ")
            if word in ends:
                return tuple(nodes), body
            if word == "for":
                match = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not match:
                    raise TemplateError(f"cannot read {body!r}")
                nodes.append(Loop(match[1], Expression(match[2]).whole(), block("endfor")[0]))
            elif word == "if":
                nodes.append(branch(rest))
            elif word == "generation":
                nodes.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"no tag {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} expected")
        return tuple(nodes), ""

    def branch(test: str) -> Branch:
        then, end = block("elif", "else", "endif")
        otherwise: tuple = ()
        if end.startswith("elif"):
            otherwise = (branch(end.partition(" ")[2]),)
        elif end == "else":
            otherwise = block("endif")[0]
        return Branch(Expression(test).whole(), then, otherwise)

    return block()[0]


# ---------------------------------------------------------------- constant folding


def fold(node):
    """The same tree with constant expressions evaluated, dead branches cut and texts joined."""
    if isinstance(node, tuple):
        flat = []
        for child in map(fold, node):
            for part in child if isinstance(child, tuple) else (child,):
                both = flat and isinstance(part, Emit) and isinstance(flat[-1], Emit)
                if both and isinstance(part.value, Const) and isinstance(flat[-1].value, Const):
                    part = Emit(Const(text_of(flat.pop().value.value) + text_of(part.value.value)))
                flat.append(part)
        return tuple(flat)
    if isinstance(node, Emit):
        return Emit(fold(node.value))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Field):
        return Field(fold(node.owner), fold(node.key))
    if isinstance(node, Branch):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.otherwise)
        return Branch(test, fold(node.then), fold(node.otherwise))
    if isinstance(node, Apply):
        operands = tuple(map(fold, node.operands))
        if node.name in ("and", "or"):
            if isinstance(operands[0], Const):
                return operands[1] if bool(operands[0].value) == (node.name == "and") else operands[0]
        elif all(isinstance(x, Const) for x in operands):
            return Const((OPERATORS.get(node.name) or FILTERS[node.name])(*(x.value for x in operands)))
        return Apply(node.name, operands)
    return node


# ---------------------------------------------------------------- closures


def value_of(node) -> Callable[[dict], object]:
    """A closure that computes an expression from a context."""
    if isinstance(node, Const):
        constant = node.value
        return lambda c: constant
    if isinstance(node, Name):
        name = node.name
        return lambda c: c.get(name)
    if isinstance(node, Field):
        owner, key = value_of(node.owner), value_of(node.key)

        def field(c):
            held = owner(c)
            return held.get(key(c)) if isinstance(held, dict) else None

        return field
    first, *rest = map(value_of, node.operands)
    if node.name == "and":
        return lambda c: first(c) and rest[0](c)
    if node.name == "or":
        return lambda c: first(c) or rest[0](c)
    apply = OPERATORS.get(node.name) or FILTERS[node.name]
    if rest:
        return lambda c: apply(first(c), rest[0](c))
    return lambda c: apply(first(c))


def writer(node) -> Callable[[dict, bool], Iterator[tuple[str, bool]]]:
    """A closure that yields ``(text, generated)`` pieces."""
    if isinstance(node, tuple):
        parts = [writer(x) for x in node]

        def sequence(c, on):
            for part in parts:
                yield from part(c, on)

        return sequence
    if isinstance(node, Emit):
        value = value_of(node.value)

        def emit(c, on):
            yield text_of(value(c)), on

        return emit
    if isinstance(node, Generation):
        body = writer(node.body)
        return lambda c, on: body(c, True)
    if isinstance(node, Branch):
        test, then, otherwise = value_of(node.test), writer(node.then), writer(node.otherwise)
        return lambda c, on: (then if test(c) else otherwise)(c, on)
    name, over, body = node.name, value_of(node.over), writer(node.body)

    def loop(c, on):
        for item in over(c) or ():
            yield from body(c | {name: item}, on)

    return loop


def compiled(source: str) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    """The template as a function from a context to ``(text, generated)`` pieces.

    ``generated`` marks what stands between ``{% generation %}`` and ``{% endgeneration %}``. A loop
    takes items from any iterable as it goes, so a conversation need not be held whole.
    """
    write = writer(fold(parse(source)))
    return lambda context: write(context, False)
