"""Benchmark decontamination: size-partitioned MinHash search for short items inside long documents.

Items are partitioned by their number of five-word shingles (a power of two caps each size). For each size that
occurs, documents are read as overlapping windows of twice that size, so item and window differ by a bounded
factor however long the document: an item that lies in a document lies whole in one window, at a Jaccard
similarity of 0.19 or more, and one of HASHES minima agrees but once in 20,000 times. Agreeing windows name
candidates; each candidate is verified by the exact share of the item's shingles (as words) in the whole document.

Items are the stated queries. They are sent to the executors in blocks of bounded size; documents are never
shuffled. Words are split at ASCII white space and compared in lower case. An item of one to FEW shingles
is a candidate wherever one of them is. An item of fewer than five words is one shingle of all its words, looked up
as such. Items or documents that are null or without words match nothing.
Repeated items and documents give a row each. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCodes, arrow_schema, prepare, read, shingle_hashes, texts

SHINGLE, SIMILARITY, HASHES = 5, 0.8, 48
#: Shingles up to which an item is looked up by each of them: too few for the minima of a window.
FEW = 4
#: Items in a block, and UTF-8 bytes of their texts: what one broadcast holds.
MOST_ITEMS, MOST_ITEM_BYTES = 20_000, 32 << 20

_A = (np.random.default_rng(21).integers(1, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = np.random.default_rng(22).integers(1, 1 << 63, HASHES, dtype=np.uint64)


def words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def shingles(w: list[bytes], k: int = SHINGLE) -> set[bytes]:
    k = min(k, len(w))
    return {b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()


def minima(h: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash function's least value of each block of shingle hashes."""
    return np.minimum.reduceat((h ^ _B[k]) * _A[k], starts)


class ItemIndex:
    """Items by size, with their minima in order for each hash function."""

    def __init__(self, ids: list[int], item_texts: list[str]):
        codes = WordCodes()
        self.ids, self.sets = ids, [shingles(words(t)) for t in item_texts]
        self.short: dict[bytes, list[int]] = {}
        self.few: dict[int, list[int]] = {}
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, t in enumerate(item_texts):
            if len(w := words(t)) >= SHINGLE:
                h = shingle_hashes(codes.hashes_of(w), SHINGLE)
                if len(h) <= FEW:
                    for x in set(h.tolist()):
                        self.few.setdefault(x, []).append(i)
                    continue
                by_size.setdefault(max(8, 1 << int(len(h) - 1).bit_length()), []).append((i, h))
            elif w:
                self.short.setdefault(b" ".join(w), []).append(i)
        self.lengths = sorted({x.count(b" ") + 1 for x in self.short})
        self.few_hashes = np.array(sorted(self.few), np.uint64)
        self.sizes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, items in by_size.items():
            starts = np.cumsum([0] + [len(h) for _, h in items])[:-1]
            every = np.concatenate([h for _, h in items])
            which = np.array([i for i, _ in items])
            self.sizes[size] = [(m[o], which[o]) for k in range(HASHES) for m in [minima(every, starts, k)] for o in [np.argsort(m, kind="stable")]]

    def candidates(self, hashes: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) pairs of which a window's minimum agrees, or any shingle of an item of few."""
        found: set[tuple[int, int]] = set()
        filled = [i for i, h in enumerate(hashes) if len(h)]
        if not filled:
            return found
        every = np.concatenate([hashes[i] for i in filled])
        length = np.array([len(hashes[i]) for i in filled])
        offset = np.cumsum(length) - length
        if len(self.few_hashes):
            near = np.minimum(np.searchsorted(self.few_hashes, every), len(self.few_hashes) - 1)
            for at in np.flatnonzero(self.few_hashes[near] == every):
                d = filled[int(np.searchsorted(offset, at, "right")) - 1]
                found.update((d, i) for i in self.few[int(every[at])])
        layout = {}
        for size in self.sizes:
            n = -(-length // size)
            doc = np.repeat(np.arange(len(filled)), n)
            block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            layout[size] = (doc, offset[doc] + block * size, np.append(doc[:-1] == doc[1:], False))
        for k in range(HASHES):
            mixed = (every ^ _B[k]) * _A[k]
            for size, (doc, starts, more) in layout.items():
                low = np.minimum.reduceat(mixed, starts)
                low = np.where(more, np.minimum(low, np.append(low[1:], np.uint64(0))), low)
                values, which = self.sizes[size][k]
                left, right = np.searchsorted(values, low, "left"), np.searchsorted(values, low, "right")
                for j in np.flatnonzero(right > left):
                    found.update((filled[doc[j]], int(i)) for i in which[left[j] : right[j]])
        return found

    def matches(self, docs: list[list[bytes]], hashes: list[np.ndarray], least: float) -> Iterator[tuple[int, int, int]]:
        """(document, item, shared shingles) of verified pairs."""
        pairs: dict[int, list[int]] = {}
        for d, i in sorted(self.candidates(hashes)):
            pairs.setdefault(d, []).append(i)
        for d, items in pairs.items():
            has = shingles(docs[d])
            for i in items:
                if (n := len(self.sets[i] & has)) >= least * len(self.sets[i]):
                    yield d, i, n
        for n in self.lengths:
            for d, w in enumerate(docs):
                for x in {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} & self.short.keys():
                    yield from ((d, i, 1) for i in self.short[x])


def hashes_of(split: list[list[bytes]], codes: WordCodes) -> list[np.ndarray]:
    return [shingle_hashes(codes.hashes_of(w), SHINGLE) if len(w) >= SHINGLE else np.zeros(0, np.uint64) for w in split]


def blocks_of(items: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """The items, in blocks that are bounded in number and bytes."""
    ids, held, size = [], [], 0
    for row in items.toLocalIterator():
        own = len(row["text"].encode())
        if ids and (len(ids) >= MOST_ITEMS or size + own > MOST_ITEM_BYTES):
            yield ids, held
            ids, held, size = [], [], 0
        ids.append(row["doc_id"])
        held.append(row["text"])
        size += own
    if ids:
        yield ids, held


def find_items(docs: DataFrame, items: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of each document and item that it holds."""
    spark = prepare(docs.sparkSession)
    docs = texts(docs, id_col, text_col)
    schema = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    target = arrow_schema(schema)
    out = spark.createDataFrame([], schema)
    for ids, held in blocks_of(texts(items, item_col, "text")):
        shared = spark.sparkContext.broadcast((ids, held))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, codes = ItemIndex(*shared.value), WordCodes()
            for b in batches:
                names = b.column("doc_id").to_pylist()
                split = [words(t) for t in b.column("text").to_pylist()]
                rows = [(names[d], index.ids[i], n, len(index.sets[i]), n / len(index.sets[i])) for d, i, n in index.matches(split, hashes_of(split, codes), least)]
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(target.names, map(list, zip(*rows, strict=True)), strict=True)), schema=target)

        out = out.unionByName(docs.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, least: float = SIMILARITY, text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item, each judged by its own text; one narrow pass for each block of items."""
    spark, schema = prepare(docs.sparkSession), docs.schema
    for ids, held in blocks_of(texts(items, "item_id", "text")):
        shared = spark.sparkContext.broadcast((ids, held))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, codes = ItemIndex(*shared.value), WordCodes()
            for b in batches:
                split = [words(t or "") for t in b.column(text_col).to_pylist()]
                bad = {d for d, _, _ in index.matches(split, hashes_of(split, codes), least)}
                yield b.filter(pa.array([d not in bad for d in range(len(split))], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs


def op3(spark, sf_dir: str) -> DataFrame:
    return find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[ \t-\r]+'), lambda x: x <> '') AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s, least(5, len(w)) AS k
       FROM b, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS r(i) WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
ks AS (SELECT DISTINCT k FROM bs),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
       FROM d, ks, unnest(range(1, greatest(len(w) - k + 2, 1))) AS r(i)),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item::DOUBLE AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item
"""
