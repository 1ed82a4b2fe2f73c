"""Declared schemas: wide sources, file targets and table targets, and the texts they are written in.

source   schema:table -> RK=|:hash(a)[0:7]|b|c="lit" -> F.col:type:"default":codec,F.pre<X>suf::: -> X=|:p|q;
file     schema=col:type:"default",PARENT=a#b>COLUMNS=JSON.c::;
table    schema=database -> col:type:"default",PARTITION=p:string:,STORAGE=parquet;
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from .errors import SchemaError

STORAGES = ("textfile", "sequencefile", "orc", "parquet", "avro", "rcfile")
#: Declared type names and the engine's types.
TYPES = {"": "string", "string": "string", "char": "string", "varchar": "string", "json": "json", "integer": "int", "int": "int", "tinyint": "int", "smallint": "int", "long": "long", "bigint": "long", "biginteger": "biginteger", "float": "float", "double": "double", "decimal": "decimal", "bigdecimal": "decimal", "date": "date", "boolean": "boolean"}


@dataclass(frozen=True)
class KeyField:
    name: str
    literal: str | None = None
    bits: tuple[int, int] | None = None

    @property
    def plain(self) -> bool:
        return self.literal is None and self.bits is None


@dataclass(frozen=True)
class Column:
    """A fixed column, or one whose qualifier is prefix + part + suffix."""

    family: str
    name: str
    type: str = "string"
    date_format: str = "dd-MM-yyyy"
    default: str | None = None
    codec: str | None = None
    prefix: str | None = None
    suffix: str | None = None
    placeholder: str | None = None
    path: tuple[str, ...] = ()

    @property
    def dynamic(self) -> bool:
        return self.placeholder is not None

    @property
    def label(self) -> str:
        """Name in results: the fixed affix of a dynamic column, the whole path of a JSON leaf."""
        return "#".join((*self.path, self.name)) if self.path else self.name


@dataclass(frozen=True)
class SourceSpec:
    schema: str
    table: str
    key: tuple[KeyField, ...]
    columns: tuple[Column, ...]
    key_separator: str = "|"
    parts: tuple[str, ...] = ()
    part_separator: str = "|"
    placeholder: str = "X"
    text: str = ""

    def __post_init__(self) -> None:
        plain = [f.name for f in self.key if f.bits is None]
        if clash := set(plain) & {c.name for c in self.columns if not c.path}:
            raise SchemaError(f"{self.schema}: {sorted(clash)} both in the row key and a column")
        if len(set(plain)) < len(plain):
            raise SchemaError(f"{self.schema}: a row-key field occurs twice")
        for f in self.key:
            if f.bits and not 0 <= f.bits[0] < f.bits[1]:
                raise SchemaError(f"{self.schema}: bits of {f.name} must rise")
        for c in self.columns:
            if c.dynamic and c.placeholder != self.placeholder and self.parts:
                raise SchemaError(f"{self.schema}: placeholder <{c.placeholder}> is not declared")

    @property
    def wide(self) -> bool:
        return any(c.dynamic for c in self.columns)

    @property
    def salt_bytes(self) -> int:
        return sum((f.bits[1] - f.bits[0]) // 8 + 1 for f in self.key if f.bits)

    @property
    def key_names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.key if f.plain)

    @property
    def part_names(self) -> tuple[str, ...]:
        return tuple(p for p in self.parts if p != "SKIP")

    def column(self, family: str | None, name: str) -> Column:
        found = [c for c in self.columns if c.name == name and family in (None, c.family)]
        if not found:
            raise SchemaError(f"{self.schema} has no column {family or '*'}.{name}")
        return found[0]


@dataclass(frozen=True)
class TargetSpec:
    """Flat target; kind is file, table or cells."""

    schema: str
    columns: tuple[Column, ...]
    kind: str = "file"
    database: str | None = None
    partitions: tuple[Column, ...] = ()
    storage: str = "parquet"
    text: str = ""

    def __post_init__(self) -> None:
        labels = [c.label for c in self.all_columns]
        if twice := sorted({x for x in labels if labels.count(x) > 1}):
            raise SchemaError(f"{self.schema}: columns {twice} occur twice")
        if self.storage not in STORAGES:
            raise SchemaError(f"{self.schema}: storage {self.storage} is not one of {', '.join(STORAGES)}")

    @property
    def all_columns(self) -> tuple[Column, ...]:
        return (*self.columns, *self.partitions)

    @property
    def json_columns(self) -> tuple[Column, ...]:
        return tuple(c for c in self.all_columns if c.path or c.family == "JSON")


class Catalog:
    """Specs by schema name. Names are unique over all kinds."""

    def __init__(self) -> None:
        self.specs: dict[str, SourceSpec | TargetSpec] = {}

    def add(self, *specs: SourceSpec | TargetSpec) -> Catalog:
        for s in specs:
            if s.schema in self.specs:
                raise SchemaError(f"schema {s.schema} is declared twice")
            self.specs[s.schema] = s
        return self

    def source(self, name: str) -> SourceSpec:
        return self._get(name, SourceSpec, "source")

    def target(self, name: str) -> TargetSpec:
        return self._get(name, TargetSpec, "target")

    def _get(self, name: str, kind: type, what: str):
        if not isinstance(s := self.specs.get(name), kind):
            raise SchemaError(f"{what} schema {name} is not declared")
        return s

    def list(self) -> list[str]:
        return sorted(self.specs)

    def show(self, name: str) -> str:
        if name not in self.specs:
            raise SchemaError(f"schema {name} is not declared")
        return self.specs[name].text or repr(self.specs[name])


# Reading schema texts

_NAME = r"[A-Za-z0-9_-]+"


def _statements(text: str) -> list[str]:
    """Statements up to their semicolons; quoted ones don't count, and nothing may follow the last."""
    parts = re.findall(r'(?:"[^"]*"|[^";])*;|(?:"[^"]*"|[^";])+$', text.strip())
    out = [p.strip() for p in parts if p.strip()]
    if out and not out[-1].endswith(";"):
        raise SchemaError(f"statement without a semicolon: {out[-1][:60]}")
    return [p[:-1].strip() for p in out if p != ";"]


def _type(text: str, where: str) -> tuple[str, str]:
    m = re.fullmatch(r"(\w*)(?:\(([^)]*)\))?", text)
    if not m:
        raise SchemaError(f"{where}: type {text} is not understood")
    name = TYPES.get(m[1].lower(), "string")
    if m[2] is not None and name != "date":
        raise SchemaError(f"{where}: only dates take a format")
    return name, m[2] or "dd-MM-yyyy"


def _split(text: str, sep: str) -> list[str]:
    """Cuts at sep outside quotes."""
    return re.findall(rf'(?:"[^"]*"|[^"{re.escape(sep)}])+|(?<={re.escape(sep)})(?={re.escape(sep)}|$)|^(?={re.escape(sep)})', text)


def _columns(text: str, with_family: bool) -> tuple[Column, ...]:
    out: list[Column] = []
    path: tuple[str, ...] = ()
    for item in _split(text, ","):
        item = item.strip()
        if m := re.match(r"PARENT=([^>]*)>COLUMNS=", item):
            path, item = tuple(m[1].split("#")), item[m.end() :]
        m = re.fullmatch(r'(?:([\w-]+)\.)?(.+?):([^:"]*):("[^"]*")?(?::([\w-]*))?', item)
        if not m:
            raise SchemaError(f"column {item} is not understood")
        family, name, kind, default, codec = m[1], m[2], m[3], m[4], m[5] or None
        if with_family and not family:
            raise SchemaError(f"column {item} needs a family")
        type_, fmt = _type(kind, item)
        json = family == "JSON" or name.startswith("JSON.")
        if name.startswith("JSON."):
            name = name[5:]
        if path and not json:
            raise SchemaError(f"{item}: only JSON leaves have a parent path")
        d = re.fullmatch(rf"({_NAME})?<({_NAME})>({_NAME})?", name)
        affix = {} if not d else {"prefix": d[1] or "", "suffix": d[3] or "", "placeholder": d[2]}
        if codec not in (None, "snappy"):
            raise SchemaError(f"{item}: compression {codec} is not known")
        out.append(Column(family or "", (d[1] or d[3] or d[2]) if d else name, type_, fmt, default[1:-1] if default else None, codec, path=path if json else (), **affix))
    return tuple(out)


def _key_fields(text: str) -> tuple[str, tuple[KeyField, ...]]:
    m = re.match(r"RK=(?:([^A-Za-z0-9\s]):)?", text)
    if not m:
        raise SchemaError(f"row key {text} is not understood")
    sep, rest = m[1] or "\0", text[m.end() :]
    fields = []
    for item in _split(rest, sep):
        if h := re.fullmatch(rf"hash\(({_NAME})\)\[(\d+):(\d+)\]", item):
            fields.append(KeyField(h[1], bits=(int(h[2]), int(h[3]))))
        elif lit := re.fullmatch(rf'({_NAME})="([^"]*)"', item):
            fields.append(KeyField(lit[1], literal=lit[2]))
        elif re.fullmatch(_NAME, item):
            fields.append(KeyField(item))
        else:
            raise SchemaError(f"row-key field {item} is not understood")
    return sep, tuple(fields)


def parse_sources(text: str) -> list[SourceSpec]:
    out = []
    for s in _statements(text):
        parts = [p.strip() for p in s.split("->")]
        head = re.fullmatch(rf"({_NAME})\s*:\s*({_NAME})", parts[0])
        if not head or len(parts) not in (3, 4):
            raise SchemaError(f"source {s[:60]} is not understood")
        sep, key = _key_fields(parts[1])
        extra: dict = {}
        if len(parts) == 4:
            m = re.fullmatch(rf"({_NAME})=(?:([^A-Za-z0-9\s]):)?(.+)", parts[3])
            if not m:
                raise SchemaError(f"dynamic parts {parts[3]} are not understood")
            names = tuple(m[3].split(m[2])) if m[2] else (m[3],)
            extra = {"placeholder": m[1], "part_separator": m[2] or "\0", "parts": names}
        out.append(SourceSpec(head[1], head[2], key, _columns(parts[2], True), sep, text=s + ";", **extra))
    return out


def parse_files(text: str) -> list[TargetSpec]:
    out = []
    for s in _statements(text):
        name, eq, rest = s.partition("=")
        if not eq or not re.fullmatch(_NAME, name.strip()):
            raise SchemaError(f"file schema {s[:60]} is not understood")
        out.append(TargetSpec(name.strip(), _columns(rest, False), text=s + ";"))
    return out


def parse_tables(text: str) -> list[TargetSpec]:
    out = []
    for s in _statements(text):
        m = re.fullmatch(rf"({_NAME})\s*=\s*({_NAME})\s*->\s*(.+)", s, re.S)
        if not m:
            raise SchemaError(f"table schema {s[:60]} is not understood")
        body, storage = m[3], "parquet"
        if st := re.search(r",STORAGE=(\w+)\s*$", body):
            body, storage = body[: st.start()], st[1].lower()
        body, _, parts = body.partition(",PARTITION=")
        out.append(TargetSpec(m[1], _columns(body, False), "table", m[2], _columns(parts, False) if parts else (), storage, text=s + ";"))
    return out
