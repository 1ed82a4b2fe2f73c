"""How far loads have read: a small table of marks for each source and target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "source string, target string, ts long"


class Bookmarks:
    """Marks are appended and the newest counts, so a lost write never leaves a half-written table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _of(self, source: str, target: str) -> str:
        """A folder for each pair, so that jobs that end together don't meet."""
        return f"{self.path.rstrip('/')}/{source}/{target}"

    def read(self, source: str, target: str) -> int | None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self._of(source, target))
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return None
        marks = self.spark.read.schema(SCHEMA).parquet(self._of(source, target))
        return marks.agg(F.max("ts")).first()[0]

    def write(self, source: str, target: str, ts: int) -> None:
        self.spark.createDataFrame([(source, target, ts)], SCHEMA).coalesce(1).write.mode("append").parquet(self._of(source, target))


def high_water(marks: DataFrame, data_source: str = "DR") -> DataFrame:
    """ts: the newest mark of another cluster with a count of 0 or more; 0 if there is none."""
    good = marks.filter((F.col("data_source") == data_source) & (F.col("count") >= 0))
    return good.agg(F.coalesce(F.max("ts"), F.lit(0)).alias("ts"))
