"""JSON text to flat rows, along the paths that a target asks for and no others.

Objects become columns named by their whole path; arrays become rows; arrays side by side multiply. Elements that
hold none of the wanted leaves vanish; an array without any leaves its row as it is. Leaves keep the text they have
in the JSON. The shape is the target's, not the data's: a path is read as an object or as an array of them,
whichever a document has.
"""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Leaves = dict[str, "Leaves | None"]


def path_tree(paths: list[str]) -> Leaves:
    root: Leaves = {}
    for p in paths:
        node = root
        *parents, leaf = p.split("#")
        for name in parents:
            nxt = node.setdefault(name, {})
            if nxt is None:
                nxt = node[name] = {}
            node = nxt
        node.setdefault(leaf, None)
    return root


def _texts(text: C, ddl: str) -> C:
    return F.from_json(text, ddl)


def _elements(text: C) -> C:
    """A JSON text as an array of JSON texts: an array's elements, or the value alone; null stays null."""
    many = F.coalesce(_texts(text, "array<string>"), F.array(text))  # text that only looks like an array is itself
    return F.when(text.rlike(r"^\s*\["), many).otherwise(F.array(text))


def _fields(tree: Leaves) -> str:
    return "struct<" + ",".join(f"`{k}`:string" for k in tree) + ">"


def _parsed(text: C, tree: Leaves) -> C:
    """The elements of a JSON text as structs of the wanted fields, each a JSON text again; parsed once."""
    return F.transform(_elements(text), lambda e: _texts(e, _fields(tree)))


def _holds(struct: C, tree: Leaves) -> C:
    """Whether a struct has any wanted leaf, at any depth; JSON null is none."""
    inner = lambda sub: lambda s: _holds(s, sub)
    out = F.lit(False)
    for k, sub in tree.items():
        out = out | (struct[k].isNotNull() if sub is None else F.coalesce(F.exists(_parsed(struct[k], sub), inner(sub)), F.lit(False)))
    return F.coalesce(out, F.lit(False))


def flatten_json(rows: DataFrame, column: str, paths: list[str], check_root: bool = False) -> DataFrame:
    """rows without column, with a text column for each path; check_root: a root that is no object or array fails."""
    tree = path_tree(paths)
    text = F.col(f"`{column}`")
    if check_root:
        bad = text.isNotNull() & ~F.ltrim(text).rlike(r"^[\[{]")
        text = F.when(bad, F.raise_error(F.lit("the JSON root is neither an object nor an array")).cast("string")).otherwise(text)
    out = _level(rows.withColumn("__j", text), "__j", tree, ())
    return out.drop("__j", *([] if column in paths else [column]))


def _level(rows: DataFrame, at: str, tree: Leaves, path: tuple[str, ...]) -> DataFrame:
    """Rows of the elements of the JSON text in column at; its scalars, then the levels below."""
    rows = rows.withColumn(f"{at}_s", F.explode_outer(F.filter(_parsed(F.col(at), tree), lambda s: _holds(s, tree))))
    name = lambda k: "#".join((*path, k))
    for k, sub in tree.items():
        if sub is None:  # a scalar, or an array of them: a row for each
            rows = rows.withColumn(name(k), F.explode_outer(_elements(F.col(f"{at}_s")[k])))
    for i, (k, sub) in enumerate(tree.items()):
        if sub is not None:
            inner = f"{at}{i}"
            rows = _level(rows.withColumn(inner, F.col(f"{at}_s")[k]), inner, sub, (*path, k)).drop(inner)
    return rows.drop(f"{at}_s")
