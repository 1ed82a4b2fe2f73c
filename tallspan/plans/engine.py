"""A query over cells as one lazy DataFrame: scan, newest cells, unpivot, decode, filter, flatten, project."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import SourceSpec, TargetSpec
from ..operators.cdc import Changes, applied, changes, image_cells
from ..operators.jsonflat import flatten_json
from ..operators.predicate import filtered
from ..operators.project import key_columns, to_target, with_selected
from ..operators.reshape import unpivot, with_parts, with_values
from ..operators.rowkey import with_key_fields
from ..sources.cells import in_time, live, prune_columns, prune_keys
from .analyzer import Plan, analyze, validate
from .query import parse


def plan_of(spec: SourceSpec, text: str, target: TargetSpec | None = None) -> Plan:
    plan = analyze(spec, parse(text), target)
    if target is not None:
        validate(plan, target)
    return plan


def tall_rows(newest: DataFrame, plan: Plan, target: TargetSpec | None = None) -> DataFrame:
    """Newest cells to rows that answer the query: key fields, parts, selected and condition columns."""
    spec = plan.spec
    rows = with_parts(unpivot(newest, spec, plan.required), spec)
    rows = with_values(with_key_fields(rows, spec), plan.required)
    json = next((c for c in plan.select if c.type == "json"), None)
    rows = with_selected(rows, plan)
    if json is not None and target is not None and target.json_columns:
        rows = filtered(rows, plan, ("key", "part", "static", "dynamic"))
        rows = flatten_json(rows, json.name, [c.label for c in target.json_columns])
    return filtered(rows, plan).drop("row_key")


def run(cells: DataFrame, spec: SourceSpec, text: str, target: TargetSpec | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """Full load (no bounds) or a load of the cells in [low, high), whose markers count too; a target shapes the result and is validated."""
    plan = plan_of(spec, text, target)
    if plan.key_only:  # a select of key fields only writes nothing
        empty = with_key_fields(cells.select("row_key").limit(0), spec).drop("row_key")
        return to_target(empty, target) if target else empty
    scanned = prune_columns(prune_keys(in_time(cells, low, high), plan), plan)
    rows = tall_rows(live(scanned), plan, target)
    return to_target(rows, target) if target else rows


def run_incremental(cells: DataFrame, current: DataFrame | None, spec: SourceSpec, text: str, target: TargetSpec, bookmark: int | None, high: int) -> DataFrame:
    """The target after an incremental load; without a bookmark it is a full load up to high."""
    if bookmark is None or current is None:
        return run(cells, spec, text, target, None, high)
    plan = plan_of(spec, text, target)
    deletes, inserts = incremental(cells, plan, target, bookmark, high)
    parts = [p for p in spec.part_names] if plan.dynamic else []
    return applied(current, *delete_rows(deletes, plan), inserts, list(spec.key_names), parts)


def incremental(cells: DataFrame, plan: Plan, target: TargetSpec, bookmark: int, high: int) -> tuple[Changes, DataFrame]:
    found = changes(prune_keys(cells, plan), plan, bookmark, high)
    rows = tall_rows(live(image_cells(cells, found, plan, high)), plan, target)
    return found, to_target(rows, target)


def delete_rows(found: Changes, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """Deletes with key fields and parts as named columns."""
    names = key_columns(plan.spec)
    all_ = with_key_fields(found.delete_all, plan.spec).select(*names)
    one = with_key_fields(found.delete_one.withColumnRenamed("part", "__part"), plan.spec)
    one = with_parts(one.filter(F.col("__part").isNotNull()), plan.spec)
    return all_, one.select(*key_columns(plan.spec, plan.dynamic and bool(plan.spec.part_names)))
