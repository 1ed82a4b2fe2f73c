"""Reads of a cell table: row_key binary, family, qualifier string, ts long, cell_type string, value binary.

cell_type is put, delete_version (that very cell), delete_column (that column up to ts) or delete_family.
"""

from __future__ import annotations

import re

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..catalog import Column, SourceSpec
from ..functions.codecs import salt_byte
from ..plans.analyzer import Plan
from ..plans.query import conjuncts

SCHEMA = "row_key binary, family string, qualifier string, ts long, cell_type string, value binary"
#: How long before the bookmark delete markers are looked for: 90 days in milliseconds (fixed value).
LOOK_BACK_MS = 7_776_000_000


def scan(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    cells = spark.read.parquet(path)
    return cells.repartition(partitions) if partitions else cells


def point(cells: DataFrame, key: bytes) -> DataFrame:
    return cells.filter(F.col("row_key") == F.lit(key))


def after_prefix(prefix: bytes) -> bytes | None:
    """The least key above all that begin with prefix."""
    head = prefix.rstrip(b"\xff")
    return head[:-1] + bytes([head[-1] + 1]) if head else None


def with_prefix(cells: DataFrame, prefix: bytes) -> DataFrame:
    """Keys that begin with prefix, as a range, which Parquet statistics can prune."""
    if not prefix:
        return cells
    out, end = cells.filter(F.col("row_key") >= F.lit(prefix)), after_prefix(prefix)
    return out.filter(F.col("row_key") < F.lit(end)) if end else out


def key_bytes(spec: SourceSpec, bound: dict[str, str]) -> tuple[bytes, bool]:
    """The key's bytes as far as literals and bound fields reach, and whether that is the whole key."""
    head, parts = b"", []
    for f in spec.key:
        if f.bits:
            if f.name not in bound:
                return b"", False
            head += bytes([salt_byte(bound[f.name], f.bits[1] - f.bits[0] + 1 if f.bits[1] - f.bits[0] < 8 else 8)])
    plain = [f for f in spec.key if not f.bits]
    for i, f in enumerate(plain):
        value = f.literal if f.literal is not None else bound.get(f.name)
        if value is None:
            return head + "".join(p + spec.key_separator for p in parts).encode(), False
        parts.append(value)
        if i == len(plain) - 1:
            return head + spec.key_separator.join(parts).encode(), True
    return head, False


def prune_keys(cells: DataFrame, plan: Plan) -> DataFrame:
    """A point or prefix read from key fields that conditions fix in every result row."""
    bound = {c.ref.name: c.value for c in conjuncts(plan.query.where) if c.op == "=" and not c.is_null_test and plan.resolved[c].kind == "key"}
    key, whole = key_bytes(plan.spec, bound)
    return point(cells, key) if whole else with_prefix(cells, key)


def qualifier_test(column: Column, exact: str | None = None) -> C:
    same = F.col("family") == column.family
    if not column.dynamic:
        return same & (F.col("qualifier") == column.name)
    if exact is not None:
        return same & (F.col("qualifier") == exact)
    test = same
    if column.prefix:
        test = test & F.col("qualifier").startswith(column.prefix)
    if column.suffix:
        test = test & F.col("qualifier").endswith(column.suffix)
    return test


def prune_columns(cells: DataFrame, plan: Plan) -> DataFrame:
    """Cells of the columns that the query selects or tests; family-wide delete markers stay."""
    test = F.lit(False)
    for c in plan.required:
        test = test | qualifier_test(c, plan.instantiated(c))
    families = sorted({c.family for c in plan.required})
    return cells.filter(test | ((F.col("cell_type") == "delete_family") & F.col("family").isin(families)))


def keys_only(cells: DataFrame) -> DataFrame:
    return cells.select("row_key").distinct()


def in_time(cells: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """low <= ts < high; either may be open."""
    out = cells if low is None else cells.filter(F.col("ts") >= low)
    return out if high is None else out.filter(F.col("ts") < high)


def raw_since(cells: DataFrame, bookmark: int | None, high: int) -> DataFrame:
    """Cells of an incremental read: everything below high, or with a bookmark from 90 days before it, markers too."""
    return in_time(cells, None if bookmark is None else max(0, bookmark - LOOK_BACK_MS), high)


def latest(cells: DataFrame) -> DataFrame:
    """The newest put of each cell, whatever its age; markers are ignored."""
    puts = cells.filter(F.col("cell_type") == "put")
    newest = F.max_by(F.struct("value"), "ts").alias("last")
    return puts.groupBy("row_key", "family", "qualifier").agg(F.max("ts").alias("ts"), newest).select("row_key", "family", "qualifier", "ts", F.lit("put").alias("cell_type"), F.col("last.value").alias("value"))


def live(cells: DataFrame) -> DataFrame:
    """The newest put of each cell that no marker hides: of its family or column up to its ts, or of that version.

    All is decided inside one row, so one exchange by row key serves the windows and sums.
    """
    family = Window.partitionBy("row_key", "family")
    column = Window.partitionBy("row_key", "family", "qualifier")
    version = Window.partitionBy("row_key", "family", "qualifier", "ts")
    marker = lambda kind: F.max(F.when(F.col("cell_type") == kind, F.col("ts")))
    seen = cells.repartition("row_key").withColumn("f", marker("delete_family").over(family)).withColumn("c", marker("delete_column").over(column)).withColumn("v", marker("delete_version").over(version))
    shown = seen.filter((F.col("cell_type") == "put") & (F.col("ts") > F.coalesce("f", F.lit(-1))) & (F.col("ts") > F.coalesce("c", F.lit(-1))) & F.col("v").isNull())
    return latest(shown.drop("f", "c", "v"))


def compiled(names: list[str]) -> str:
    """One regular expression for any of the names, taken literally."""
    return "^(?:" + "|".join(map(re.escape, names)) + ")$"


def holding(cells: DataFrame, mark: str) -> DataFrame:
    """Cells of rows whose key has mark between separators; for looking into stored data."""
    return cells.filter(F.instr(F.decode("row_key", "UTF-8"), f"|{mark}|") > 0)
