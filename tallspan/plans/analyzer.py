"""Queries against schemas: which columns they read, and what a source, query and target must agree on."""

from __future__ import annotations

import re
from dataclasses import dataclass

from ..catalog import Column, SourceSpec, TargetSpec
from ..errors import AnalysisError
from .query import Condition, Query, Ref, conditions, conjuncts

_RANGE = ("<", ">", "<=", ">=")


@dataclass(frozen=True)
class Resolved:
    """A condition with what its reference stands for: key, part, static, dynamic or json, a label and a type."""

    condition: Condition
    kind: str
    label: str
    type: str


@dataclass(frozen=True)
class Plan:
    spec: SourceSpec
    query: Query
    select: tuple[Column, ...]
    key_only: bool
    resolved: dict[Condition, Resolved]
    where_only: tuple[Column, ...]

    @property
    def dynamic(self) -> bool:
        return any(c.dynamic for c in self.select)

    @property
    def required(self) -> tuple[Column, ...]:
        return tuple(dict.fromkeys((*self.select, *self.where_only)))

    def instantiated(self, column: Column) -> str | None:
        """The exact qualifier of a dynamic column whose part a condition that must hold fixes (one part name)."""
        if not column.dynamic or len(self.spec.parts) > 1:
            return None
        names = self.spec.parts or (self.spec.placeholder,)
        fixed = {c.value for c in conjuncts(self.query.where) if c.op == "=" and not c.is_null_test and self.resolved[c].kind == "part" and c.ref.name == names[0]}
        return f"{column.prefix}{fixed.pop()}{column.suffix}" if len(fixed) == 1 else None


def pattern_of(text: str | None) -> re.Pattern:
    """Select items are regular expressions over names; an empty one or a star means all."""
    return re.compile(".*" if text in (None, "", "*") else text.replace("*", ".*"))


def select_columns(spec: SourceSpec, ref: Ref) -> list[Column]:
    if affix := ref.affixes:
        return [c for c in spec.columns if c.dynamic and (c.prefix, c.suffix) == (affix[0], affix[2]) and ref.family in (None, c.family)]
    if ref.name in spec.key_names:
        return []
    family, name = pattern_of(ref.family), pattern_of(ref.name)
    return [c for c in spec.columns if family.fullmatch(c.family) and name.fullmatch(c.name)]


def resolve(spec: SourceSpec, c: Condition, target: TargetSpec | None) -> Resolved:
    ref = c.ref
    leaves = {x.label: x for x in (target.json_columns if target else ())}
    if ref.affixes:
        found = [x for x in select_columns(spec, ref)]
        kind, label, type_ = ("dynamic", found[0].name, found[0].type) if found else (None, "", "")
    elif ref.family is None and ref.name in spec.key_names:
        kind, label, type_ = "key", ref.name, "string"
    elif ref.family is None and ref.name in spec.part_names:
        kind, label, type_ = "part", ref.name, "string"
    elif ref.family is None and ref.name in leaves:
        kind, label, type_ = "json", ref.name, leaves[ref.name].type
    else:
        found = [x for x in spec.columns if not x.dynamic and x.name == ref.name and ref.family in (None, x.family)]
        kind, label, type_ = ("static", found[0].label, "string" if found[0].codec else found[0].type) if found else (None, "", "")
    if kind is None:
        raise AnalysisError(f"condition on {ref.name}: no such column, key field, dynamic part or JSON leaf")
    if c.op in _RANGE and not c.is_null_test and type_ in ("string", "json", "boolean"):
        raise AnalysisError(f"{c.op} can't be used on {ref.name}, which is a {type_}")
    return Resolved(c, kind, label, type_)


def analyze(spec: SourceSpec, query: Query, target: TargetSpec | None = None) -> Plan:
    if query.source != spec.schema:
        raise AnalysisError(f"query reads {query.source}, not {spec.schema}")
    select: list[Column] = []
    for ref in query.select:
        found = select_columns(spec, ref)
        if not found and ref.name not in spec.key_names:
            raise AnalysisError(f"no column matches {ref.family or '*'}.{ref.name}")
        select += found
    resolved = {c: resolve(spec, c, target) for c in conditions(query.where)}
    chosen = tuple(dict.fromkeys(select))
    by_name = {(c.name, c.dynamic): c for c in spec.columns}
    extra = [by_name[r.label, r.kind == "dynamic"] for r in resolved.values() if r.kind in ("static", "dynamic")]
    return Plan(spec, query, chosen, not chosen, resolved, tuple(x for x in dict.fromkeys(extra) if x not in chosen))


def validate(plan: Plan, target: TargetSpec) -> None:
    """The rules that a load must keep, each with its own message."""
    spec, labels = plan.spec, [c.label for c in target.all_columns]
    json_source = any(c.type == "json" for c in spec.columns)
    fields = {*spec.key_names, *(f.name for f in spec.key if f.literal is not None), *spec.part_names, *(c.label for c in spec.columns)}
    json_labels = {c.label for c in target.json_columns}
    if unknown := [x for x in labels if x not in fields and not (x in json_labels and json_source)]:
        raise AnalysisError(f"target columns {unknown} are not in the source")
    if len({c.dynamic for c in plan.select}) > 1:
        raise AnalysisError("select either fixed columns or dynamic columns")
    one_json = len(plan.select) == 1 and plan.select[0].type == "json"
    if bool(json_labels) != one_json:
        raise AnalysisError("JSON leaves in the target go with a select of exactly one JSON column")
    if missing := [c.label for c in plan.select if c.type != "json" and c.label not in labels]:
        raise AnalysisError(f"selected columns {missing} are not in the target")
    offered = {*spec.key_names, *spec.part_names, *(f.name for f in spec.key if f.literal is not None), *(c.label for c in plan.required), *json_labels}
    if extra := [x for x in labels if x not in offered]:
        raise AnalysisError(f"target columns {extra} are neither selected, nor key fields, dynamic parts or condition columns")
    needed = [*spec.key_names, *(spec.part_names if plan.dynamic else ())]
    if absent := [x for x in needed if x not in labels]:
        raise AnalysisError(f"target lacks the key columns {absent}")
