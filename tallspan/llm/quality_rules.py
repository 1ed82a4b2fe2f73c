"""Word statistics with fixed rules, and a hashed n-gram likelihood ratio with a fixed threshold.

Two multinomials over word unigrams and bigrams, each known by a hash whose bits grow with the corpus, are counted: one over all documents,
one over the trusted ones. A document's score is the mean, over its n-grams, of the log of their ratio, both counted
in the other documents only, so neither length nor its own words matter; a document is kept if no base rule rejects
it and its score reaches the threshold. Every document is scored whole.

The counts grow with the corpus and are nowhere whole. Documents are packed into blocks; a block sends each range of
hashes its distinct n-grams with their counts, packed, and the range answers with the sums over all blocks. An n-gram
that is everywhere comes once from each block, so ranges are even however often a word occurs.

Words are found, hashed and compared in numpy, all texts of an Arrow batch at once; a block's n-grams are sorted once,
each in one number with its document, and scored in that order.

Null and empty texts have no words: they fail the base rules and score 0. Without trusted documents all scores
are 0. Repeated rows are counted as often as they occur. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, arrow_schema, flagged, mix, prepare, read, texts, with_checkpoints

#: Bytes of text after which a block ends; there are as many ranges of hashes as this goes into all texts.
BLOCK_BYTES = 32 << 20
#: Bits of a hash beyond those that number all n-grams, so that fewer than one in 256 shares its hash; and the least bits.
SPARE_BITS, LEAST_BITS = 8, 36
#: Occurrences in all documents, and their trusted share, that are added to the counts of each n-gram.
SMOOTHING = 5.0
#: Mean log ratio below which a document goes. Trusted documents of sf0.01 and sf0.1 score at least -0.34 and -0.18 by the
#: others, those labelled otherwise -1.6 and -2.4 in the median.
THRESHOLD = -0.4

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
#: Words up to this many bytes are hashed and compared eight bytes at a time, all words at once; longer ones one by one.
_LONG = 256
#: What is kept of eight bytes of which so many belong to a word.
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Numbers that are worked out at a time, so that what is used on the way stays small however long a text is.
_SLICE = 1 << 16
#: Odd numbers that hashes are multiplied by.
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def repeated_words(codes: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more; codes number the words."""
    n = len(codes) - 2
    if n < 2:
        return 0
    pair = np.unique(codes[:-1] * (codes.max() + 1) + codes[1:], return_inverse=True)[1]
    key = pair[:-1] * (codes.max() + 1) + codes[2:]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(n + 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return int((twice | np.roll(twice, 1) | np.roll(twice, 2)).sum())


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += bool(line.split())
        else:
            seen.add(line)
    return dup


def sliced(work: Callable[[slice], np.ndarray], n: int) -> np.ndarray:
    """n numbers, of which work gives those of a slice."""
    out = np.empty(n, np.uint64)
    for a in range(0, n, _SLICE):
        out[a : a + _SLICE] = work(slice(a, min(a + _SLICE, n)))
    return out


class Words:
    """The words of many texts, as bytes.split() finds them in each: start and length in data, the text a word is of.

    borders has where each text begins in data, and the end; first has the number of its first word, and that of all words.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        _, borders, data = texts.buffers()
        borders = np.frombuffer(borders, np.int64, len(texts) + 1, 8 * texts.offset)
        size = int(borders[-1] - borders[0])
        self.borders, self.data = borders - borders[0], np.zeros(size + 8, np.uint8)
        if size:
            self.data[:size] = np.frombuffer(data, np.uint8, size, int(borders[0]))
        data = self.data[:size]
        inside = np.zeros(size + 2, bool)
        inside[1:-1] = (data != 32) & (data - np.uint8(9) > 4)
        here, full = inside[1:-1], self.borders[:-1] < self.borders[1:]
        begins, ends = here & ~inside[:-2], here & ~inside[2:]
        for mask, at in ((begins, self.borders[:-1][full]), (ends, self.borders[1:][full] - 1)):
            mask[at] = here[at]  # a word does not go on into the next text
        self.start = np.flatnonzero(begins)
        self.length = np.flatnonzero(ends) + 1 - self.start
        self.first = np.searchsorted(self.start, self.borders)
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.first))
        self.hashes = sliced(self._hashes, len(self.start))

    def _eight(self, words: np.ndarray, k: int) -> np.ndarray:
        """The k-th eight bytes of words that have them, as numbers; zeros beyond a word's end."""
        rows = np.lib.stride_tricks.sliding_window_view(self.data, 8)[self.start[words] + 8 * k]
        return rows.view("<u8").ravel() & _KEPT[np.minimum(self.length[words] - 8 * k, 8)]

    def _bytes(self, word: int) -> bytes:
        return self.data[self.start[word] : self.start[word] + self.length[word]].tobytes()

    def _hashes(self, part: slice) -> np.ndarray:
        """64 bits of each word of a part that are the same everywhere."""
        first, length = part.start, self.length[part]
        out, words = length.astype(np.uint64) * _ODD[0], np.arange(len(length))
        for k in range(_LONG // 8):
            words = words[length[words] > 8 * k]
            if not len(words):
                return out
            out[words] = mix(out[words] ^ self._eight(words + first, k))
        for word in words[length[words] > _LONG].tolist():
            out[word] = int.from_bytes(blake2b(self._bytes(word + first), digest_size=8).digest(), "little")
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether each word of a is the one of b at the same place."""
        if (self.length[a] != self.length[b]).any():
            return False
        for k in range(_LONG // 8):
            more = self.length[a] > 8 * k
            a, b = a[more], b[more]
            if (self._eight(a, k) != self._eight(b, k)).any():
                return False
        return all(self._bytes(x) == self._bytes(y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if self.length[x] > _LONG)

    def grams(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The unigrams and bigrams of all texts, in so many bits, and which text each is of."""
        h, second = self.hashes, np.flatnonzero(self.text[:-1] == self.text[1:]) + 1
        one = sliced(lambda s: mix(h[s]) >> np.uint64(64 - bits), len(h))
        two = sliced(lambda s: mix(h[second[s] - 1] * np.uint64(3) ^ h[second[s]] * _ODD[0]) >> np.uint64(64 - bits), len(second))
        return np.concatenate([one, two]), np.concatenate([self.text, self.text[second]])

    def repeated(self) -> np.ndarray:
        """Of each text, the words inside 3-word windows that occur twice or more in it.

        Windows of equal hash are compared by their words; should any differ, the words are numbered instead.
        """
        h, twice = self.hashes, np.zeros(len(self.start), bool)
        at = np.flatnonzero(self.text[:-2] == self.text[2:])

        def windows(s: slice) -> np.ndarray:
            i = at[s]
            return mix((h[i] * np.uint64(3) ^ h[i + 1] * _ODD[0]) + h[i + 2] * _ODD[1] ^ self.text[i].astype(np.uint64) * _ODD[2])

        key = sliced(windows, len(at))
        order = np.argsort(key)
        key = key[order]
        same = key[1:] == key[:-1]
        a, b = at[order[:-1][same]], at[order[1:][same]]
        if (self.text[a] != self.text[b]).any() or not all(self.equal(a + k, b + k) for k in range(3)):
            return np.array([repeated_words(self._numbered(i)) for i in range(len(self.borders) - 1)], np.int64)
        twice[a] = twice[b] = True
        inside = twice.copy()
        inside[1:] |= twice[:-1]
        inside[2:] |= twice[:-2]
        return np.diff(np.concatenate([[0], np.cumsum(inside)])[self.first])

    def _numbered(self, text: int) -> np.ndarray:
        numbers: dict[bytes, int] = {}
        return np.array([numbers.setdefault(self._bytes(w), len(numbers)) for w in range(self.first[text], self.first[text + 1])], np.int64)

    def statistics(self) -> tuple[np.ndarray, ...]:
        """Of each text n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
        data = self.data[: self.borders[-1]]
        more, symbols, ends = (np.diff(np.searchsorted(np.flatnonzero(x), self.borders)) for x in (data & 0xC0 == 0x80, _SYMBOL[data], data == 10))
        dup = np.zeros(len(symbols), np.int64)
        for i in np.flatnonzero(ends).tolist():
            dup[i] = dup_lines(data[self.borders[i] : self.borders[i + 1]].tobytes())
        n_bytes = np.diff(np.concatenate([[0], np.cumsum(self.length)])[self.first])
        return np.diff(self.first), n_bytes - more, symbols, dup, self.repeated()


def zstd(level: int = 3) -> pa.Codec:
    return pa.Codec("zstd", level)


def packed(x: np.ndarray) -> bytes:
    """Numbers as planes of bytes, compressed: the upper planes of small numbers are zeros."""
    return len(x).to_bytes(8, "little") + zstd().compress(x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def unpacked(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(zstd().decompress(b[8:], 8 * n, asbytes=True), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def totals(docs: DataFrame) -> tuple[int, int, int]:
    """Bytes, n-grams, and n-grams of trusted documents, of docs (text, trusted)."""
    target = arrow_schema("n_bytes long, n_raw long, n_trusted long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = raw = good = 0
        for b in batches:
            for text, trusted in zip(b.column("text").to_pylist(), b.column("trusted").to_pylist(), strict=True):
                data = text.encode()
                n = max(2 * len(data.split()) - 1, 0)
                size, raw, good = size + len(data), raw + n, good + n * trusted
        yield pa.RecordBatch.from_pydict({"n_bytes": [size], "n_raw": [raw], "n_trusted": [good]}, schema=target)

    sums = docs.select("text", "trusted").mapInArrow(run, "n_bytes long, n_raw long, n_trusted long").agg(*(F.sum(c) for c in target.names)).first()
    return tuple(v or 0 for v in sums)


def in_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Arrow batches of docs as one compressed value each, with the block they belong to: a stretch of one task's rows."""
    target = pa.schema([("block", pa.int64()), ("rows", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first = 0, TaskContext.get().partitionId() << 32
        for b in batches:
            if b.num_rows:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression=zstd(6))) as out:
                    out.write_batch(b)
                yield pa.RecordBatch.from_pydict({"block": [first + size // block_bytes], "rows": [sink.getvalue().to_pybytes()]}, schema=target)
                size += b.nbytes

    return docs.mapInArrow(run, "block long, rows binary")


def documents_of(t: pa.Table) -> pa.Table:
    """The documents of a block, always in the same order."""
    return pa.concat_tables(pa.ipc.open_stream(rows).read_all() for rows in sorted(t.column("rows").to_pylist()))


_COUNTS = pa.schema([("block", pa.int64()), ("range", pa.int32()), ("grams", pa.binary()), ("n_raw", pa.binary()), ("n_trusted", pa.binary())])
_COUNTS_DDL = "block long, range int, grams binary, n_raw binary, n_trusted binary"


def counted(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each occurs."""
    every = np.concatenate([np.zeros(0, np.uint64), *found])
    every.sort()
    first = np.flatnonzero(np.diff(every, prepend=every[:1] + np.uint64(1)))
    return every[first], np.diff(first, append=len(every))


def block_counts(blocks: DataFrame, ranges: int, bits: int) -> DataFrame:
    """A row for each block and range: the block's distinct n-grams there, as steps from one to the next, and their counts."""
    borders = np.array([-(-r * (1 << bits) // ranges) for r in range(ranges + 1)], np.uint64)

    def count(t: pa.Table) -> pa.Table:
        found = ([], [])
        for batch in documents_of(t).to_batches():
            keys, text = Words(batch.column("text")).grams(bits)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)[text]
            found[False].append(keys[~trusted])
            found[True].append(keys[trusted])
            del keys, text, trusted
        good_keys, n_good = counted(found[True])
        keys, raw = counted(found[False] + found[True])
        good = np.zeros(len(keys), np.uint64)
        good[np.searchsorted(keys, good_keys)] = n_good
        cut, out, block = np.searchsorted(keys, borders), [], t.column("block")[0].as_py()
        for r in range(ranges):
            a, b = cut[r], cut[r + 1]
            if a < b:
                out.append((block, r, packed(np.diff(keys[a:b], prepend=np.uint64(0))), packed(raw[a:b]), packed(good[a:b])))
        return pa.Table.from_pylist([dict(zip(_COUNTS.names, row, strict=True)) for row in out], schema=_COUNTS)

    return blocks.groupBy("block").applyInArrow(count, _COUNTS_DDL)


def answers(counts: DataFrame) -> DataFrame:
    """The rows of block_counts, with the sums over all blocks for the block's n-grams; the n-grams themselves aren't sent back."""

    def add(t: pa.Table) -> pa.Table:
        c = {n: t.column(n).to_pylist() for n in _COUNTS.names}
        keys = [np.cumsum(unpacked(g), dtype=np.uint64) for g in c["grams"]]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        cut = np.cumsum([len(k) for k in keys])[:-1]
        for n in ("n_raw", "n_trusted"):
            sums = np.bincount(at, np.concatenate([unpacked(x) for x in c[n]]), len(distinct)).astype(np.uint64)
            c[n] = [packed(sums[part]) for part in np.split(at, cut)]
        return pa.Table.from_pydict(c | {"grams": [b""] * len(keys)}, schema=_COUNTS)

    return counts.groupBy("range").applyInArrow(add, _COUNTS_DDL)


#: Distinct n-grams of a block that are scored at a time.
_SCORED = 1 << 18


def scores(keys: list[np.ndarray], of: list[np.ndarray], bits: int, trusted: np.ndarray, sums: list[tuple[bytes, bytes]], share: float) -> np.ndarray:
    """Mean log ratio of each document of a block; keys are all its n-grams, of the documents they are in. keys is emptied.

    N-gram and document are sorted as one number. sums has the packed counts n_raw and n_trusted of the block's distinct
    n-grams, range by range.
    """
    n_docs, each = len(trusted), np.concatenate([np.zeros(0, np.uint64), *keys])
    keys.clear()
    shift, filled = np.uint64(n_docs.bit_length()), 0
    if bits + shift > 64:  # the n-grams are numbered in order instead
        each = np.unique(each, return_inverse=True)[1].astype(np.uint64)
    each <<= shift
    for docs in of:
        each[filled : filled + len(docs)] |= docs
        filled += len(docs)
    each.sort()
    step = each[1:] ^ each[:-1]
    step >>= shift
    starts = np.concatenate([[0], np.flatnonzero(step) + 1, [len(each)]]) if len(each) else np.zeros(1, np.int64)
    del step
    raw, good = (np.concatenate([np.zeros(0, np.uint64), *map(unpacked, c)]) for c in zip(*sums, strict=True)) if sums else np.zeros((2, 0))
    if len(raw) != len(starts) - 1:
        raise ValueError("a block's n-grams changed between two readings of its documents")
    out, n_grams = np.zeros(n_docs), np.zeros(n_docs, np.int64)
    for a in range(0, len(raw), _SCORED):
        b = min(a + _SCORED, len(raw))
        part = each[starts[a] : starts[b]]
        first = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
        own, part = np.diff(first, append=len(part)), part[first]
        doc, key = (part & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64), part >> shift
        key = np.cumsum(np.diff(key, prepend=key[:1]) != 0) + a
        n_grams += np.bincount(doc, own, n_docs).astype(np.int64)
        if share:
            others = raw[key].astype(np.float64) - own
            ratio = np.log((good[key].astype(np.float64) - own * trusted[doc] + SMOOTHING * share) / (share * (others + SMOOTHING)))
            out += np.bincount(doc, ratio * own, n_docs)
    return out / np.maximum(n_grams, 1)


_JUDGED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, base statistics, base_failed, score, kept for every document; trusted: a column doc_id."""
    prepare(docs.sparkSession)
    docs = flagged(texts(docs, id_col, text_col), trusted, "trusted")
    size, n_raw, n_trusted = totals(docs)
    share, target = n_trusted / max(n_raw, 1), arrow_schema(_JUDGED)
    bits = min(64, max(LEAST_BITS, n_raw.bit_length() + SPARE_BITS))
    blocks = in_blocks(docs, block_bytes)
    if trusted.count() > BROADCAST_ROWS:  # flagged() has shuffled, and blocks must be the same at both readings
        with_checkpoints(docs.sparkSession)
        blocks = blocks.checkpoint()

    def of_block(t: pa.Table, sums: pa.Table) -> pa.Table:
        docs, rows, keys, of, n_docs = documents_of(t), [], [], [], 0
        for batch in docs.to_batches():
            words = Words(batch.column("text"))
            rows.append(words.statistics())
            found, text = words.grams(bits)
            keys.append(found)
            of.append((text + n_docs).astype(np.uint32))
            n_docs += batch.num_rows
            del words, found, text  # before the next ones take as much again
        out = dict(zip(target.names[1:6], map(np.concatenate, zip(*rows, strict=True)), strict=True))
        out["base_failed"] = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
        order = np.argsort(sums.column("range").to_numpy()).tolist()
        packs = [(sums.column("n_raw")[i].as_py(), sums.column("n_trusted")[i].as_py()) for i in order]
        out["score"] = scores(keys, of, bits, docs.column("trusted").to_numpy(), packs, share)
        out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
        return pa.Table.from_pydict({"doc_id": docs.column("doc_id").to_pylist()} | out, schema=target)

    sums = answers(block_counts(blocks, -(-size // block_bytes) or 1, bits))
    return blocks.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(of_block, _JUDGED)


def op7(spark, sf_dir: str) -> DataFrame:
    trusted = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return judge(read(spark, sf_dir, "documents"), trusted)
