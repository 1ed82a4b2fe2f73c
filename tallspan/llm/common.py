"""What the operators share: input columns, shared folder, shipping of code, Arrow batches, word codes."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch: texts can be long, so a batch is bounded by bytes as well.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
#: Entries of a per-worker memo before it is emptied; bounds the memory of a Python worker.
MEMO = 400_000

_shipped: set[str] = set()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches and ships this package to the executors, once for each application."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[2]
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for p in sorted((root / "tallspan").rglob("*.py")):
                z.write(p, p.relative_to(root))
        target = Path(tempfile.mkdtemp()) / "tallspan_code.zip"
        target.write_bytes(packed.getvalue())
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """The checkpoint folder is the one the cluster names; where none is named, a temporary one, on one machine only."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "tallspan-checkpoints"))
    return spark


#: Partitions that one file of a checkpoint may hold, and files for each core that are fine however few the partitions.
MOST_IN_FILE, FILES_OF_CORE = 16, 2


def files_of(spark: SparkSession) -> int:
    """Files that a checkpoint has at most: enough to keep all cores busy, more with more shuffle partitions."""
    return max(FILES_OF_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // MOST_IN_FILE, 1)


def cut_off(df: DataFrame) -> DataFrame:
    """df in the checkpoint folder, in files_of files at most.

    Where Hadoop's native library is missing, each file on a local or mounted disk starts two processes (chmod, of the
    file and of its checksums), and each of these shows all memory of its JVM as its own until it runs. Spark puts small
    partitions together itself, but not where that is turned off.
    """
    return df.coalesce(files_of(df.sparkSession)).checkpoint()


def freed(spark: SparkSession) -> None:
    """Has the driver collect its garbage: shuffles, broadcasts and checkpoints that no frame refers to any more go now.

    Spark drops them only when the driver happens to collect; until then they take disk, and memory of the driver.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, whatever else the table holds; a null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_rows(df: DataFrame, work: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Each Arrow batch, as columns of Python lists, through a function that work() makes once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each, out = work(), None
        for b in batches:
            if b.num_rows:
                out = each({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns, strict=True)})
                yield pa.RecordBatch.from_pydict(out, schema=target)

    target = arrow_schema(schema)
    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


class Memo(dict):
    """Results of a function by its argument, long ones apart; two generations, so what is used again outlives the clearing."""

    def __init__(self, compute: Callable, most: int = MEMO):
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        if (out := self.old.get(key)) is None:
            out = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = out
        return out


class WordCodes(dict):
    """Word (bytes) to a small number, exact within a worker; hashes holds a 64-bit hash that is the same everywhere."""

    def __init__(self, most: int = MEMO * 2):
        self.most, self.hashes, self._filled = most, np.zeros(1024, np.uint64), 0

    def __missing__(self, word: bytes) -> int:
        n = self._filled
        if n == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(n, np.uint64)])
        self.hashes[n] = word_hash(word)
        self[word], self._filled = n, n + 1
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        """Codes of a text's words; the memo is emptied between texts only, so codes of one text agree."""
        if self._filled > self.most:
            self.clear()
            self._filled = 0
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes_of(self, words: list[bytes]) -> np.ndarray:
        codes = self.of(words)  # first: it may enlarge the hashes
        return self.hashes[codes]


def word_hash(word: bytes) -> int:
    """64 bits from two differently salted checksums, finished by a mixer."""
    x = (zlib.crc32(word) << 32) | zlib.crc32(word, 0x9747B28C ^ len(word))
    x = ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 29)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k-word shingles of word hashes h; a text of 1 to k-1 words is one shingle of all of them."""
    if len(h) == 0:
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n, np.uint64(0x2545F4914F6CDD1D + k), np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * np.uint64(0x9DDFEA08EB382D69)
        out ^= out >> np.uint64(32)
    return mix(out)


def fraction(df: DataFrame, key: str, share: float) -> DataFrame:
    """A share of the rows, chosen by a hash of the key, alike on every run."""
    return df if share >= 1 else df.filter(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20)) < int(share * (1 << 20)))


#: Rows of a side of ids up to which it is broadcast (8 MB as numbers, see among); larger sides are shuffled.
BROADCAST_ROWS = 1_000_000


def among(numbers: DataFrame) -> Callable[[Column], Column]:
    """Whether a long is one of numbers (one column, at most BROADCAST_ROWS rows by the caller's count).

    They travel as one sorted array. A table that Spark broadcasts takes over 100 bytes of the driver for each row,
    several times over while it is made: 100 MB and more for 1,000,000 rows.
    """
    known = numbers.sparkSession.sparkContext.broadcast(np.sort(numbers.toArrow().column(0).to_numpy()))

    @F.arrow_udf("boolean")
    def test(x: pa.Array) -> pa.Array:
        ids = x.to_numpy(zero_copy_only=False)
        if not len(known.value):
            return pa.array(np.zeros(len(ids), bool))
        return pa.array(known.value[np.minimum(np.searchsorted(known.value, ids), len(known.value) - 1)] == ids)

    return test


def row_key(id_col: str, text_col: str) -> Column:
    """16 bytes that name a row by its id and text; repeated rows have the same."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("|"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary")))


#: Rows of one key from which spread_join deals them out, and the share of all rows that may be exceeded besides.
HOT_ROWS, HOT_SHARE = 1024, 1 / 10_000


def spread_join(rows: DataFrame, values: DataFrame, key: str, salt: Column, counts: DataFrame | None = None, counted: DataFrame | None = None) -> DataFrame:
    """rows joined with values (some rows for each key) on key; rows of a hot key are dealt to several tasks.

    A key is hot if it has over HOT_ROWS rows and over HOT_SHARE of all, so at most 10,000 keys are, whatever the
    input, and their names may be broadcast. salt is a number that differs between rows of a key and is the same when
    a row is made again. counts (key, n_rows) spares the counting; counted is a narrower table with the same keys.
    """
    if counts is None:
        counts = (rows if counted is None else counted).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    seen = counts.agg(F.sum("n_rows").alias("total"), F.max("n_rows").alias("most")).first()
    each = max(HOT_ROWS, (seen["total"] or 0) * HOT_SHARE)
    if (seen["most"] or 0) <= each:
        return rows.join(values, key)
    hot = counts.filter(F.col("n_rows") > each).select(F.col(key).alias("__hot"), F.ceil(F.col("n_rows") / each).cast("int").alias("__copies")).coalesce(1).checkpoint()
    hot = F.broadcast(hot)
    copies = F.coalesce("__copies", F.lit(1))
    dealt = rows.join(hot, rows[key] == F.col("__hot"), "left").withColumn("__salt", F.pmod(salt, copies).cast("int")).drop("__hot", "__copies")
    copied = values.join(hot, values[key] == F.col("__hot"), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__hot", "__copies")
    return dealt.join(copied, [key, "__salt"]).drop("__salt")


def flagged(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """docs with a boolean: whether doc_id is in ids (one column doc_id). ids is broadcast only after a count."""
    ids = ids.filter(F.col("doc_id").isNotNull()).distinct().withColumn(name, F.lit(True))
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def flagged_values(docs: DataFrame, few: DataFrame, bound: int) -> DataFrame:
    """docs with a row in few, joined on doc_id. few has at most bound rows by its own limit, so it may be broadcast."""
    return docs.join(F.broadcast(few.limit(bound)), "doc_id")
