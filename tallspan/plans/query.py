"""The query language: select columns from schema [where conditions]; text to a tree.

AND and OR have no precedence over each other: without brackets a chain nests to the right, so
`a AND b OR c` is `a AND (b OR c)`. Doubled quotes inside a quoted value stand for one. Nothing may follow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from ..errors import QueryError

_TOKEN = re.compile(
    r"""\s*(?:(?P<str>"(?:[^"\r\n]|"")*"|'(?:[^'\r\n]|'')*')
    |(?P<ref>(?:[\w-]+\.)?(?:[\w-]*<[\w-]+>[\w-]*)|(?:[\w*-]+\.)?[\w-]*\*[\w*-]*|[\w-]+(?:[.\#][\w-]+)*)
    |(?P<op><>|!=|<=|>=|=|<|>)|(?P<sign>[(),]))""",
    re.X,
)
OPERATORS = ("=", "!=", "<", ">", "<=", ">=", "regexp", "not regexp")


@dataclass(frozen=True)
class Ref:
    """A column as written: family, name with its placeholder, or a JSON path."""

    family: str | None
    name: str

    @property
    def json(self) -> bool:
        return "#" in self.name

    @property
    def affixes(self) -> tuple[str, str, str] | None:
        m = re.fullmatch(r"([\w-]*)<([\w-]+)>([\w-]*)", self.name)
        return (m[1], m[2], m[3]) if m else None


@dataclass(frozen=True)
class Condition:
    ref: Ref
    op: str
    value: str

    @property
    def is_null_test(self) -> bool:
        return self.value.lower() == "null"


@dataclass(frozen=True)
class Tree:
    op: str  # and, or
    left: Tree | Condition
    right: Tree | Condition


@dataclass(frozen=True)
class Query:
    select: tuple[Ref, ...]
    source: str
    where: Tree | Condition | None = None


def conditions(tree: Tree | Condition | None) -> list[Condition]:
    if tree is None:
        return []
    return [tree] if isinstance(tree, Condition) else conditions(tree.left) + conditions(tree.right)


def conjuncts(tree: Tree | Condition | None) -> list[Condition]:
    """Conditions that must all hold for the tree to hold."""
    if isinstance(tree, Condition):
        return [tree]
    return conjuncts(tree.left) + conjuncts(tree.right) if tree is not None and tree.op == "and" else []


class _Parser:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise QueryError(f"not understood: {text[at:].strip()[:40]}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, kind: str | None = None, word: str | None = None) -> str:
        k, v = self.peek()
        if kind and k != kind or word and v.lower() != word:
            raise QueryError(f"expected {word or kind}, found {v or 'the end'}")
        self.at += 1
        return v

    def is_word(self, *words: str) -> bool:
        k, v = self.peek()
        return k == "ref" and v.lower() in words

    def ref(self) -> Ref:
        family, dot, name = self.take("ref").rpartition(".")
        if "." in family:
            raise QueryError(f"too many dots in {family}.{name}")
        return Ref(family if dot else None, name)

    def condition(self) -> Condition:
        ref = self.ref()
        if self.is_word("not"):
            self.take()
            self.take("ref", "regexp")
            op = "not regexp"
        elif self.is_word("regexp"):
            op = self.take().lower()
        else:
            op = self.take("op").replace("<>", "!=")
        kind, value = self.peek()
        self.at += 1
        if kind == "str":
            return Condition(ref, op, value[1:-1].replace(value[0] * 2, value[0]))
        if kind == "ref" and value.isdigit():
            return Condition(ref, op, value)
        raise QueryError(f"expected a quoted value or a number, found {value or 'the end'}")

    def operand(self) -> Tree | Condition:
        if self.peek() == ("sign", "("):
            self.take()
            inner = self.tree()
            self.take("sign", ")")
            return inner
        return self.condition()

    def tree(self) -> Tree | Condition:
        left = self.operand()
        if self.is_word("and", "or"):
            op = self.take().lower()
            return Tree(op, left, self.tree())
        return left

    def query(self) -> Query:
        self.take("ref", "select")
        select = [self.ref()]
        while self.peek() == ("sign", ","):
            self.take()
            select.append(self.ref())
        self.take("ref", "from")
        source = self.take("ref")
        where = None
        if self.is_word("where"):
            self.take()
            where = self.tree()
        if self.peek()[0] != "end":
            raise QueryError(f"nothing may follow the query: {self.peek()[1]}")
        return Query(tuple(select), source, where)


def parse(text: str) -> Query:
    return _Parser(text).query()
