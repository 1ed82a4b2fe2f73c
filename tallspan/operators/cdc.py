"""Incremental loads: of the cells since a bookmark, what to delete from the target and what to insert.

For every key, or key and part, touched in [bookmark, high): its rows in the target go, and its image at high comes
in if it still answers the query. All of it is set algebra over cells; nothing is looked up row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.analyzer import Plan
from ..sources.cells import in_time, prune_columns, raw_since
from .reshape import matched


@dataclass(frozen=True)
class Changes:
    """delete_all: row keys whose rows all go; delete_one: row keys and parts; both of the source, undecoded."""

    delete_all: DataFrame
    delete_one: DataFrame


def family_marks(raw: DataFrame, plan: Plan, bookmark: int) -> DataFrame:
    """row_key, family, mark: the newest family marker since the bookmark, of families that the query reads."""
    families = sorted({c.family for c in plan.required})
    return raw.filter((F.col("cell_type") == "delete_family") & (F.col("ts") >= bookmark) & F.col("family").isin(families)).groupBy("row_key", "family").agg(F.max("ts").alias("mark"))


def changed_cells(raw: DataFrame, plan: Plan, bookmark: int) -> DataFrame:
    """Newest raw cell of each column, newer than its family's marker, since the bookmark or a version's marker."""
    cells = prune_columns(raw, plan).filter("cell_type <> 'delete_family'")
    newest = cells.groupBy("row_key", "family", "qualifier").agg(F.max_by(F.struct("ts", "cell_type"), F.struct("ts", F.col("cell_type") != "put")).alias("c"))  # of one time the marker counts
    live = newest.join(family_marks(raw, plan, bookmark), ["row_key", "family"], "left").filter(F.col("mark").isNull() | (F.col("c.ts") > F.col("mark")))
    return live.filter((F.col("c.ts") >= bookmark) | (F.col("c.cell_type") == "delete_version")).withColumn("m", matched(plan.spec.columns)).filter("m is not null").select("row_key", "family", "qualifier", F.col("m.part").alias("part"))


def changes(cells: DataFrame, plan: Plan, bookmark: int, high: int) -> Changes:
    raw = raw_since(cells, bookmark, high)
    touched, marked = changed_cells(raw, plan, bookmark), family_marks(raw, plan, bookmark).select("row_key").distinct()
    fixed = touched.filter("part is null").select("row_key").distinct()
    parts = touched.filter("part is not null").select("row_key", "part").distinct()
    if not plan.dynamic:  # a fixed select has no parts in its target: a change of any kind is one of the row
        return Changes(marked.unionByName(touched.select("row_key")).distinct(), parts.limit(0))
    reread = marked
    if any(not c.dynamic for c in plan.where_only):  # a fixed column decides over all parts
        reread = reread.unionByName(fixed).distinct()
    only_fixed = fixed.join(parts.select("row_key").distinct(), "row_key", "left_anti")
    every = reread.unionByName(only_fixed).distinct()
    return Changes(every, parts.join(every, "row_key", "left_anti"))


def image_cells(cells: DataFrame, found: Changes, plan: Plan, high: int) -> DataFrame:
    """All cells below high that the new image of a touched row or part needs: one semi join, no look-ups."""
    below = prune_columns(in_time(cells, None, high), plan)
    whole = below.join(found.delete_all, "row_key", "left_semi")
    part = below.withColumn("m", matched(plan.spec.columns)).join(found.delete_one.select("row_key").distinct(), "row_key", "left_semi")
    some = found.delete_one.select(F.col("row_key").alias("k"), F.col("part").alias("p"))
    fixed = part.filter("m.part is null")
    own = part.join(some, (F.col("row_key") == F.col("k")) & (F.col("m.part") == F.col("p")), "left_semi")
    return whole.unionByName(fixed.drop("m")).unionByName(own.drop("m"))


def without(target: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """target without the rows whose named columns are among keys: the anti join, matched by name."""
    keys = keys.select(*(F.col(n).alias(f"__{n}") for n in names)).distinct()
    test = F.lit(True)
    for n in names:
        test = test & target[n].eqNullSafe(keys[f"__{n}"])
    return target.join(keys, test, "left_anti")


def applied(target: DataFrame, all_keys: DataFrame, one_keys: DataFrame, inserts: DataFrame, key_names: list[str], part_names: list[str]) -> DataFrame:
    """Deletes of whole rows, then of single parts, then inserts."""
    left = without(target, all_keys, key_names)
    if part_names:
        left = without(left, one_keys, [*key_names, *part_names])
    return left.unionByName(inserts)
