"""All pairs of a bucket that are in different groups, compared in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import files_of
from .components import settled

#: Rows of a bucket that one chunk holds, on average, and units of n (words, characters); a block is one chunk against another.
CHUNK, CHUNK_N = 2048, 4_000_000


def still_open(members: DataFrame, groups: DataFrame) -> DataFrame:
    """members (bucket, node, n) of the buckets that hold more than one group, with component and the bucket's chunks."""
    known = members.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK, F.sum("n") / CHUNK_N)).cast("int").alias("chunks")
    several = known.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"), chunks).filter("least <> most").select("bucket", "chunks")
    return settled(known.join(several, "bucket"))


def links_in_blocks(rows: DataFrame, texts: DataFrame, allowed: Callable, verifier: Callable) -> DataFrame:
    """a, b: nodes of one bucket that join its groups, as far as links do.

    rows has bucket, node, n, component and chunks; texts has node, digest (bytes) and text. A bucket is dealt into
    chunks, and every two of them meet in one block, whatever the bucket's size: a row is sent once for each chunk.
    allowed(digest, digests, n, ns) is a mask of pairs worth a look; verifier() gives a function of two texts. What
    is linked within a block is one group from then on. A pair that meets in several buckets is looked at in one of
    them only, nearest to a number of its own, so that the work is spread: each row knows its node's buckets.
    """
    rows = rows.join(rows.groupBy("node").agg(F.collect_set("bucket").alias("all")), "node").join(texts, "node")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    names = ("bucket", "low", "high", "own", "node", "n", "component", "digest", "all", "text")
    keyed = dealt.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), *names[3:])
    blocks = keyed.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    target = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def links_of(block: list[tuple], linked: Callable) -> Iterator[tuple]:
        bucket, low, high = block[0][:3]
        groups = {c: i for i, c in enumerate({r[6] for r in block})}
        if len(groups) < 2:
            return
        own, n = np.array([r[3] for r in block]), np.array([r[5] for r in block])
        group, digests = np.array([groups[r[6]] for r in block]), np.stack([np.frombuffer(r[7], np.uint8) for r in block])
        all_, number = [set(r[8]) for r in block], [int.from_bytes(r[4][:8], "little", signed=True) for r in block]
        for i in np.flatnonzero(own == low):
            later = np.flatnonzero(own == high) if low != high else np.arange(i + 1, len(block))
            later = later[group[later] != group[i]]
            for j in later[allowed(digests[i], digests[later], n[i], n[later])]:
                if group[i] != group[j] and bucket == min(all_[i] & all_[j], key=(number[i] ^ number[j]).__xor__) and linked(block[i][9], block[j][9]):
                    group[group == group[j]] = group[i]
                    yield tuple(sorted((block[i][4], block[j][4])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked = verifier()
        every = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in names), strict=True))
        for _, block in groupby(every, key=lambda r: r[:3]):
            if out := list(links_of(list(block), linked)):
                yield pa.RecordBatch.from_pydict({"a": [a for a, _ in out], "b": [b for _, b in out]}, schema=target)

    # Blocks are many and uneven, links few: they are brought together by a shuffle, so that each block keeps its task.
    return blocks.mapInArrow(run, "a binary, b binary").repartition(files_of(rows.sparkSession))
