"""Reconciliation of what a load wrote: its rows, and sums and counts of columns, in the same pass."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..catalog import TargetSpec
from ..errors import AnalysisError

_SUMMABLE = ("int", "long", "float", "double", "decimal", "biginteger")


def validate_recon(target: TargetSpec, ops: dict[str, list[str]]) -> None:
    types = {c.label: c.type for c in target.all_columns}
    for name, kinds in ops.items():
        if name not in types:
            raise AnalysisError(f"reconciliation of {name}, which is not in the target")
        for k in kinds:
            if k.lower() not in ("sum", "count"):
                raise AnalysisError(f"reconciliation by {k}: only sum and count")
            if k.lower() == "sum" and types[name] not in _SUMMABLE:
                raise AnalysisError(f"sum of {name}, which is a {types[name]}")


def recon_columns(ops: dict[str, list[str]], scale: int = 10) -> list[C]:
    """rows, and <op>_<column> for each; nulls and the texts null and \\N don't count, an empty sum is 0."""
    out = [F.count(F.lit(1)).alias("rows")]
    for name, kinds in ops.items():
        col = F.col(f"`{name}`")
        there = F.when(~F.coalesce(col.cast("string"), F.lit("null")).isin("null", "\\N"), col)
        for k in kinds:
            if k.lower() == "sum":
                out.append(F.coalesce(F.sum(there.cast(f"decimal(28,{scale})")), F.lit(0).cast(f"decimal(38,{scale})")).alias(f"sum_{name}"))
            else:
                out.append(F.count(there).alias(f"count_{name}"))
    return out


def recon(rows: DataFrame, ops: dict[str, list[str]], scale: int = 10) -> DataFrame:
    """One row; sums are partial on every task, then final."""
    return rows.agg(*recon_columns(ops, scale))


def observed(rows: DataFrame, ops: dict[str, list[str]], name: str = "recon") -> tuple[DataFrame, Observation]:
    """rows that fill the observation while they are written, with no second pass."""
    seen = Observation(name)
    return rows.observe(seen, *recon_columns(ops)), seen
