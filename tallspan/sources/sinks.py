"""Where results go: delimited files, managed tables, cell tables, or a sink of one's own."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.errors.exceptions.captured import AnalysisException as CapturedAnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import SourceSpec, TargetSpec
from ..errors import AnalysisError
from ..operators.project import rekeyed, to_records
from ..operators.reshape import to_cells

#: Table types of declared types (fixed values of the table format): decimals are (20,5), dates are timestamps.
TABLE_TYPES = {"string": "string", "json": "string", "int": "int", "long": "bigint", "float": "float", "double": "double", "decimal": "decimal(20,5)", "biginteger": "decimal(38,0)", "date": "timestamp", "boolean": "boolean"}
#: Spark's names of storage formats.
FORMATS = {"textfile": "csv", "sequencefile": "parquet", "rcfile": "orc", "orc": "orc", "parquet": "parquet", "avro": "avro"}
LOAD_STAMP = "LOAD_TIMESTAMP"


class Sink(ABC):
    """A target of one's own: write() gets the rows, delete() the keys of an incremental load."""

    @abstractmethod
    def write(self, rows: DataFrame) -> None: ...

    def delete(self, all_keys: DataFrame, one_keys: DataFrame) -> None:
        raise NotImplementedError(f"{type(self).__name__} takes no deletes")


class DelimitedFiles(Sink):
    """Text records joined by the unit separator, under base/schema/application/job; key files for deletes."""

    def __init__(self, base: str, schema: str, application: str, job: str):
        self.path = f"{base.rstrip('/')}/{schema}/{application}/{job}"

    def write(self, rows: DataFrame) -> None:
        to_records(rows).write.mode("append").text(f"{self.path}/insert")

    def delete(self, all_keys: DataFrame, one_keys: DataFrame) -> None:
        to_records(all_keys).write.mode("append").text(f"{self.path}/delete_all")
        to_records(one_keys).write.mode("append").text(f"{self.path}/delete_single")

    @staticmethod
    def read(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
        parts = F.split("value", "\u0001")
        return spark.read.text(path).select(*(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)))


def as_table(rows: DataFrame, target: TargetSpec) -> DataFrame:
    """Columns of the table's types, then the load stamp, then partitions, as the table has them."""
    typed = lambda c: F.col(f"`{c.label}`").cast(TABLE_TYPES[c.type]).alias(c.label)
    return rows.select(*(typed(c) for c in target.columns), F.current_timestamp().alias(LOAD_STAMP), *(typed(c) for c in target.partitions))


def create_table(target: TargetSpec) -> str:
    """The statement that makes the table."""
    one = lambda c: f"`{c.label}` {TABLE_TYPES[c.type].upper()}"
    columns = ", ".join([*map(one, target.columns), f"`{LOAD_STAMP}` TIMESTAMP", *map(one, target.partitions)])
    parts = f" PARTITIONED BY ({', '.join(f'`{c.label}`' for c in target.partitions)})" if target.partitions else ""
    return f"CREATE TABLE IF NOT EXISTS `{target.database}`.`{target.schema}` ({columns}) USING {FORMATS[target.storage].upper()}{parts}"


def load_script(target: TargetSpec, source_view: str, key_view: str | None = None, keys: list[str] = ()) -> str:
    """SQL that a session can run by itself: database, table, deletes by anti join, insert by dynamic partition."""
    out = [f"CREATE DATABASE IF NOT EXISTS `{target.database}`", create_table(target)]
    columns = ", ".join(f"CAST(`{c.label}` AS {TABLE_TYPES[c.type].upper()}) AS `{c.label}`" for c in target.columns)
    parts = "".join(f", CAST(`{c.label}` AS {TABLE_TYPES[c.type].upper()}) AS `{c.label}`" for c in target.partitions)
    if key_view:
        test = " AND ".join(f"t.`{k}` <=> d.`{k}`" for k in keys)
        aside = f"`{target.database}`.`{target.schema}_new`"
        out.append(f"CREATE TABLE {aside} USING {FORMATS[target.storage].upper()} AS SELECT t.* FROM `{target.database}`.`{target.schema}` t LEFT ANTI JOIN `{key_view}` d ON {test}")
        out += [f"INSERT OVERWRITE `{target.database}`.`{target.schema}` SELECT * FROM {aside}", f"DROP TABLE {aside}"]
    out.append(f"INSERT INTO `{target.database}`.`{target.schema}` SELECT {columns}, current_timestamp() AS `{LOAD_STAMP}`{parts} FROM `{source_view}`")
    return ";\n".join(out) + ";\n"


class ManagedTable(Sink):
    def __init__(self, target: TargetSpec, keys: list[str] = (), parts: list[str] = ()):
        self.target, self.keys, self.parts = target, list(keys), list(parts)

    @property
    def name(self) -> str:
        return f"`{self.target.database}`.`{self.target.schema}`"

    def make(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.target.database}`")
        spark.sql(create_table(self.target))

    def write(self, rows: DataFrame) -> None:
        self.make(rows.sparkSession)
        as_table(rows, self.target).write.mode("append").insertInto(self.name)

    def delete(self, all_keys: DataFrame, one_keys: DataFrame) -> None:
        """The table without these keys is written aside, then over it; a failure between leaves one of the two whole."""
        from ..operators.cdc import without

        spark = all_keys.sparkSession
        self.make(spark)
        old = spark.table(self.name)
        left = without(old, all_keys, self.keys)
        if self.parts:
            left = without(left, one_keys, [*self.keys, *self.parts])
        aside = f"`{self.target.database}`.`{self.target.schema}_new`"
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        writer = left.write.format(FORMATS[self.target.storage])
        (writer.partitionBy(*(c.label for c in self.target.partitions)) if self.target.partitions else writer).saveAsTable(aside.replace("`", ""))
        spark.table(aside).write.option("partitionOverwriteMode", "static").mode("overwrite").insertInto(self.name)
        spark.sql(f"DROP TABLE {aside}")


class CellTable(Sink):
    """Parquet cells under the target's own row keys; deletes are family markers.

    Each write and each delete has a time of its own, later than all that is stored, so a marker hides the rows of
    the batches before it and none of those after it. ts is the first time to be used.
    """

    def __init__(self, path: str, spec: SourceSpec, ts: int):
        self.path, self.spec, self.ts, self._begun = path, spec, ts, False

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.path)
        except CapturedAnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _now(self, spark: SparkSession) -> int:
        if not self._begun and (stored := self._stored(spark)) is not None:
            last = stored.agg(F.max("ts")).first()[0]
            self.ts = self.ts if last is None else max(self.ts, last + 1)
        self._begun, now = True, self.ts
        self.ts += 1
        return now

    def cells(self, rows: DataFrame, ts: int) -> DataFrame:
        families = {c.name: c.family for c in self.spec.columns}
        return to_cells(rekeyed(rows, self.spec), families, F.col("row_key"), F.lit(ts))

    def write(self, rows: DataFrame) -> None:
        self.cells(rows, self._now(rows.sparkSession)).write.mode("append").parquet(self.path)

    def delete(self, all_keys: DataFrame, one_keys: DataFrame) -> None:
        """Markers for every stored row whose known key fields are among the keys; others may be anything."""
        from ..operators.rowkey import with_key_fields

        spark = all_keys.sparkSession
        for keys in (all_keys, one_keys):
            if not set(keys.columns) & set(self.spec.key_names):
                raise AnalysisError(f"deletes by {', '.join(keys.columns)} name no key field of {self.spec.schema}: {', '.join(self.spec.key_names)}")
        if (cells := self._stored(spark)) is None:
            return
        ts = self._now(spark)
        stored = with_key_fields(cells.select("row_key").distinct(), self.spec)
        for keys in (all_keys, one_keys):
            names = [n for n in self.spec.key_names if n in keys.columns]
            gone = stored.join(keys.select(*names).distinct(), names, "left_semi")
            families = F.array(*(F.lit(f) for f in sorted({c.family for c in self.spec.columns})))
            marks = gone.select("row_key", F.explode(families).alias("family"), F.lit("").alias("qualifier"), F.lit(ts).cast("long").alias("ts"), F.lit("delete_family").alias("cell_type"), F.lit(None).cast("binary").alias("value"))
            marks.write.mode("append").parquet(self.path)
