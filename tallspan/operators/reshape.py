"""Wide rows to tall ones: one output row for each dynamic part of a row, with the row's fixed columns beside it."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import Column, SourceSpec
from ..functions.codecs import decoded


def matched(columns: tuple[Column, ...]) -> C:
    """struct(label, part) of the column a qualifier belongs to.

    Of dynamic columns the longest prefix wins, and a suffix only if it is strictly longer; fixed names come first.
    """
    out = F.lit(None).cast("struct<label:string,part:string>")
    pair = lambda label, part: F.struct(F.lit(label).alias("label"), part.alias("part"))
    q = F.col("qualifier")
    order = sorted((c for c in columns if c.dynamic), key=lambda c: (max(len(c.prefix), len(c.suffix)), len(c.prefix) >= len(c.suffix)))
    for c in order:  # later ones stand in front
        test = (F.col("family") == c.family) & q.startswith(c.prefix) & q.endswith(c.suffix) & (F.length(q) >= len(c.prefix) + len(c.suffix))
        out = F.when(test, pair(c.name, q.substr(F.lit(len(c.prefix) + 1), F.length(q) - len(c.prefix) - len(c.suffix)))).otherwise(out)
    for c in (c for c in columns if not c.dynamic):
        out = F.when((F.col("family") == c.family) & (q == c.name), pair(c.name, F.lit(None).cast("string"))).otherwise(out)
    return out


def unpivot(cells: DataFrame, spec: SourceSpec, columns: tuple[Column, ...]) -> DataFrame:
    """row_key, __part, a binary column for each of columns; cells are the newest ones.

    One exchange, by row key: parts are gathered by (row key, part), fixed columns spread over a row's parts.
    A row without dynamic cells gives one row with fixed columns only; one whose parts are all malformed gives none.
    """
    fixed, dynamic = [c for c in columns if not c.dynamic], [c for c in columns if c.dynamic]
    known = cells.withColumn("__m", matched(spec.columns)).filter(F.col("__m").isNotNull())
    pick = lambda c: F.max_by(F.when((F.col("__m.label") == c.name) & (F.col("family") == c.family), F.struct("value")), F.when((F.col("__m.label") == c.name) & (F.col("family") == c.family), F.col("ts")))
    grouped = known.repartition("row_key").groupBy("row_key", F.col("__m.part").alias("__part")).agg(*(pick(c).alias(c.name) for c in columns), F.count(F.lit(1)).alias("__n"))
    row = Window.partitionBy("row_key")
    out = grouped.withColumn("__dynamic", F.max(F.col("__part").isNotNull()).over(row))
    for c in fixed:
        out = out.withColumn(c.name, F.first(F.when(F.col("__part").isNull(), F.col(c.name)), ignorenulls=True).over(row))
    out = out.filter(F.col("__part").isNotNull() | ~F.col("__dynamic"))
    return out.select("row_key", "__part", *(F.col(f"{c.name}.value").alias(c.name) for c in (*fixed, *dynamic)))


def with_parts(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """Named dynamic parts as columns; a part of another number of fields is left out, SKIP fields are not named."""
    names = spec.parts or (spec.placeholder,)
    if len(names) == 1:
        return rows.drop("__part") if names[0] == "SKIP" else rows.withColumnRenamed("__part", names[0])
    rows = rows.withColumn("__split", F.split("__part", "\\Q" + spec.part_separator + "\\E"))
    rows = rows.filter(F.col("__part").isNull() | (F.size("__split") == len(names)))
    for i, name in enumerate(names):
        if name != "SKIP":
            rows = rows.withColumn(name, F.get("__split", F.lit(i)))
    return rows.drop("__split", "__part")


def with_values(rows: DataFrame, columns: tuple[Column, ...]) -> DataFrame:
    """Binary columns as values of their declared types."""
    return rows.withColumns({c.name: decoded(F.col(c.name), c.type, c.date_format, c.codec) for c in columns})


def to_cells(rows: DataFrame, family_of: dict[str, str], key: C, ts: C) -> DataFrame:
    """Tall rows as cells of a key-value table, a cell for each value that is not null."""
    names = list(family_of)
    pairs = F.array(*(F.struct(F.lit(family_of[n]).alias("family"), F.lit(n).alias("qualifier"), F.encode(F.col(n).cast("string"), "UTF-8").alias("value")) for n in names))
    out = rows.select(key.alias("row_key"), ts.cast("long").alias("ts"), F.explode(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("c"))
    return out.select("row_key", "c.family", "c.qualifier", "ts", F.lit("put").alias("cell_type"), "c.value")
