"""Sharding by histogram sort: exact byte counts below probe keys, refined until splitters are close, one exchange.

Rows are ordered by a 63-bit key: a hash of the text, then of the id, then of the row itself, so equal texts are
neighbours but a hot text, and a row that is repeated very often, still fall apart into many keys. Each round counts bytes and rows between the
probes over all partitions; intervals that hold a splitter and are wider than the tolerance, and intervals with
too many rows for one task, get new probes, and probes that are not needed any more go, so there is always room.
When all are fine enough, each interval is one piece of the exchange:
its shard is where its bytes fall, its first slot is the rows of its shard before it.

Law `bytes`: shard sizes differ by no more than the tolerance and one row. Null texts have no bytes besides the
fixed 16. With fewer rows than shards some shards are empty. Repeated rows are separate rows, also those with a null
id: each gets a slot of its own, which of them gets which is left open. Other columns are carried along; columns
named as the results are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, read, with_checkpoints

FIXED_BYTES = 16
#: Probes that an interval is cut by, and the bound of all probes: what the driver holds, whatever the input.
FIRST_PROBES, MORE_PROBES, MOST_PROBES = 4096, 64, 60_000
#: Share of a shard by which a splitter may be off, and share of all rows that one piece may hold.
TOLERANCE, PIECE = 0.0005, 1 / 1500


#: Bits of the key that come from the id and from the row; the text has the 31 above.
ID_BITS, ROW_BITS = 14, 18


def order_key(text: Column, id_: Column) -> Column:
    """Hashes of the text, the id and the row's place in the input; to be written once, as places may change when read anew."""
    high = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 33)
    low = F.shiftrightunsigned(F.xxhash64(id_.cast("string"), F.lit("shard")), 64 - ID_BITS)
    row = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id(), F.lit("row")), 64 - ROW_BITS)
    return F.shiftleft(F.shiftleft(high, ID_BITS).bitwiseOR(low), ROW_BITS).bitwiseOR(row)


def between(rows: DataFrame, probes: np.ndarray) -> DataFrame:
    """rows with `piece`: how many probes are at most the row's key."""
    shared = rows.sparkSession.sparkContext.broadcast(probes)  # at most MOST_PROBES numbers

    @F.pandas_udf("int")
    def piece(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, key.to_numpy(), "right").astype(np.int32))

    return rows.withColumn("piece", piece("key"))


def histogram(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of each interval between probes; sums are made before the shuffle."""
    at = between(rows, probes).groupBy("piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).toPandas()
    bytes_, n = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    bytes_[at["piece"]], n[at["piece"]] = at["bytes"], at["n"]
    return bytes_, n


def thinned(probes: np.ndarray, n: np.ndarray, needed: np.ndarray, most: float) -> np.ndarray:
    """The needed probes, and of the others those without which an interval would have more than most rows."""
    kept, held = needed.copy(), n[0]
    for i in range(len(probes)):
        kept[i] |= held + n[i + 1] > most
        held = n[i + 1] if kept[i] else held + n[i + 1]
    return probes[kept]


def refine(rows: DataFrame, shards: int, tolerance: float = TOLERANCE, piece: float = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probes with the bytes and rows between them, fine enough to place every splitter.

    Probes that settled intervals don't need are dropped in each round. At most 1 / piece intervals have too many
    rows and each splitter lies in one, so there is room to cut each of them: only intervals of one key stay wide.
    """
    probes = (np.arange(1, FIRST_PROBES, dtype=np.int64) << 51)
    bound = max(MOST_PROBES, int(8 * (1 / piece + shards)))
    while True:
        bytes_, n = histogram(rows, probes)
        total, ends = bytes_.sum(), np.cumsum(bytes_)
        goals = total * np.arange(1, shards) / shards
        low, high = np.concatenate([[0], probes]), np.concatenate([probes, [np.iinfo(np.int64).max]])
        slack = max(tolerance * total / shards, 1)
        split = np.zeros(len(n), bool)
        # a splitter's interval is too wide if neither of its borders is near the goal
        at = np.minimum(np.searchsorted(ends, goals), len(n) - 1)
        near = np.minimum(ends[at] - goals, goals - (ends[at] - bytes_[at]))
        split[at[near > slack]] = True
        most = max(piece * n.sum(), 64)
        split |= n > most
        split &= (n > 1) & (high - low > 1)
        if not split.any():
            return probes, bytes_, n
        needed = split.copy()
        needed[at] = True  # both borders of these intervals stay
        probes = thinned(probes, n, needed[:-1] | needed[1:], most)
        parts = min(MORE_PROBES, (bound - len(probes)) // int(split.sum()) + 1)
        new = [np.unique(low[i] + ((high[i] - low[i]) // parts + 1) * np.arange(1, parts)) for i in np.flatnonzero(split)]
        inside = [x[(x > low[i]) & (x < high[i])] for x, i in zip(new, np.flatnonzero(split), strict=True)]
        probes = np.unique(np.concatenate([probes, *inside]))


def place(bytes_: np.ndarray, n: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard and the first slot of each interval: a border goes where its bytes are nearest to the goal."""
    ends = np.concatenate([[0], np.cumsum(bytes_)])
    goals = ends[-1] * np.arange(1, shards) / shards
    right = np.clip(np.searchsorted(ends, goals), 1, len(ends) - 1)
    borders = np.where(goals - ends[right - 1] <= ends[right] - goals, right - 1, right)
    shard = np.searchsorted(borders, np.arange(len(n)), "right").astype(np.int32)
    before = np.concatenate([[0], np.cumsum(n)])[:-1]
    first = np.full(shards, np.iinfo(np.int64).max)
    np.minimum.at(first, shard, before)
    return shard, before - first[shard]


def assign_shards(rows: DataFrame, shards: int, size: str = "size", key: str = "key", tie: str = "doc_id") -> DataFrame:
    """rows with `shard` and `slot`; the one exchange of whole rows is by interval."""
    rows = rows.drop("shard", "slot", "piece")
    plain = rows.select(F.col(key).alias("key"), F.col(size).alias("size"))
    probes, bytes_, n = refine(plain, shards)
    shard, first = place(bytes_, n, shards)
    shared = rows.sparkSession.sparkContext.broadcast((shard, first))

    @F.pandas_udf("shard int, first long")
    def placed(piece: pd.Series) -> pd.DataFrame:
        shard, first = shared.value
        return pd.DataFrame({"shard": shard[piece], "first": first[piece]})

    w = Window.partitionBy("piece").orderBy(key, F.col(tie).asc_nulls_first())
    numbered = between(rows, probes).withColumn("rank", F.row_number().over(w))
    return numbered.withColumn("at", placed("piece")).withColumn("shard", F.col("at.shard")).withColumn("slot", F.col("at.first") + F.col("rank") - 1).drop("at", "rank", "piece")


def op6(spark, sf_dir: str) -> DataFrame:
    prepare(with_checkpoints(spark))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + FIXED_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        order_key(text, F.col("doc_id")).alias("key"),
    )
    rows = rows.checkpoint()  # texts are read once; the rounds count over the narrow rows
    placed = assign_shards(rows, 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
