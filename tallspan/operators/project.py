"""Rows as a target wants them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import SourceSpec, TargetSpec
from ..functions.codecs import delimited, iso_date
from ..plans.analyzer import Plan
from .rowkey import build_key

#: What a null default prints as in file and table targets (fixed values of the formats).
FILE_NULL, TABLE_NULL = "NULL", "\\N"


def with_selected(rows: DataFrame, plan: Plan) -> DataFrame:
    """Rows that have at least one selected column; none if only key fields are selected."""
    names = [c.name for c in plan.select]
    return rows.dropna("all", subset=names) if names else rows.limit(0)


def to_target(rows: DataFrame, target: TargetSpec) -> DataFrame:
    """The target's columns in declared order; where a value is absent, the declared default.

    JSON date leaves are rewritten from dd-MM-yyyy to ISO form.
    """
    out, have = [], set(rows.columns)
    for c in target.all_columns:
        value = F.col(f"`{c.label}`") if c.label in have else F.lit(None).cast("string")
        if c.type == "date" and (c.path or c.family == "JSON"):
            value = iso_date(value, "dd-MM-yyyy")
        if c.default is not None:
            value = F.coalesce(value, F.lit(c.default).cast(dict(rows.dtypes).get(c.label, "string")))
        out.append(value.alias(c.label))
    return rows.select(*out)


def to_records(rows: DataFrame, null: str = FILE_NULL) -> DataFrame:
    """One column, record: all columns joined by the unit separator, unquoted."""
    return rows.select(delimited([F.col(f"`{c}`") for c in rows.columns], "\u0001", null).alias("record"))


def rekeyed(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """Tall key-value form: row_key of the target's fields, then every data column, defaults filled in."""
    if spec.wide:
        raise ValueError("a cell target has fixed columns only")
    have = set(rows.columns)
    value = lambda c: F.coalesce(F.col(c.name).cast("string") if c.name in have else F.lit(None).cast("string"), F.lit(c.default).cast("string"))
    return rows.select(build_key(spec).alias("row_key"), *(value(c).alias(c.name) for c in spec.columns))


def delete_keys(rows: DataFrame, key_names: list[str], part_names: list[str] = ()) -> DataFrame:
    """Distinct keys to delete by: of whole rows, or of single parts. Rows are later matched by name, never place."""
    return rows.select(*key_names, *part_names).distinct()


def key_columns(spec: SourceSpec, parts: bool = False) -> list[str]:
    return [*spec.key_names, *(spec.part_names if parts else ())]

