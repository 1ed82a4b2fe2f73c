"""Condition trees as Spark columns, so that Catalyst places and pushes them."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import typed
from ..plans.analyzer import Plan, Resolved
from ..plans.query import Condition, Tree


def condition_column(r: Resolved, column: C) -> C:
    """One condition. A column that is absent is null, and then only `= null` holds.

    The value null, in any case, is a test: `=` for absent, null or the text null; any other operator for the rest.
    Regular expressions must match the whole text. Dates compare as ISO text.
    """
    c, text = r.condition, column.cast("string")
    if c.is_null_test:
        empty = column.isNull() | (text == "null")
        return empty if c.op == "=" else ~empty
    if c.op.endswith("regexp"):
        found = text.rlike(f"^(?:{c.value})$")
        return found if c.op == "regexp" else ~found
    left, right = typed(column, r.type), typed(F.lit(c.value), r.type)
    return {"=": left == right, "!=": left != right, "<": left < right, ">": left > right, "<=": left <= right, ">=": left >= right}[c.op]


def tree_column(plan: Plan, tree: Tree | Condition, columns: dict[str, C] | None = None) -> C:
    """The whole tree. Null and false filter alike, as no operator negates a sub-tree."""
    if isinstance(tree, Condition):
        r = plan.resolved[tree]
        return condition_column(r, (columns or {}).get(r.label, F.col(f"`{r.label}`")))
    left, right = tree_column(plan, tree.left, columns), tree_column(plan, tree.right, columns)
    return left & right if tree.op == "and" else left | right


def weaker(plan: Plan, tree: Tree | Condition, kinds: tuple[str, ...]) -> C | None:
    """What the tree implies of conditions of these kinds only; None if nothing.

    Rows it rejects can go before the columns of other kinds exist: it is the first phases of an evaluation that
    looks at keys, then fixed columns, then dynamic ones, then JSON.
    """
    if isinstance(tree, Condition):
        return tree_column(plan, tree) if plan.resolved[tree].kind in kinds else None
    left, right = weaker(plan, tree.left, kinds), weaker(plan, tree.right, kinds)
    if tree.op == "and":
        return left & right if left is not None and right is not None else left if left is not None else right
    return left | right if left is not None and right is not None else None


def filtered(rows: DataFrame, plan: Plan, kinds: tuple[str, ...] = ("key", "part", "static", "dynamic", "json")) -> DataFrame:
    if plan.query.where is None:
        return rows
    test = weaker(plan, plan.query.where, kinds)
    return rows if test is None else rows.filter(test)
