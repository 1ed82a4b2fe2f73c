"""Line dedup: equal lines and lines within a few edits of an earlier one go, over the whole corpus.

A pair may have k = EDITS edits, one more if the shorter line has MORE_EDITS_FROM characters, and one more for each
doubling. Lines are cut into k + 1 segments by their length; two lines within k edits share a segment, near its
place, so each line is indexed by its segments and looks up those substrings of itself that may be the segment of
a line as long or shorter by up to k (the multi-match-aware selection: an edit before a segment moves it, and
edits are few on either side). Keys are hashes of substrings, made for many lines at once and moved as packed
numbers; keys of one line only are dropped. Keys that very many lines share (crowded ones) are told by number only
at first, and their lines are looked up in a second pass. Candidates are compared in rounds, as copies of a line
share all keys: with the key's least line, then all pairs of a key that are still in different groups, in blocks,
where counts of characters allow them. A pair is a link if its banded bit-parallel edit distance is at most k.
Classes are connected components of links.

Of each class the first line stays, by (doc_id, position); all later ones go, in every document. Lines are split
at \\n. Equal lines are found at every length, if they hold more than white space; near ones only from MIN_CHARS
characters on, as segments of shorter ones say little. Empty and blank lines stay. Null texts stay null. Rows that
repeat a doc_id and text are one document. Distances count code points. Columns besides doc_id and text pass through untouched, but for
those named as the counts, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import links_in_blocks, still_open
from .common import BROADCAST_ROWS, cut_off, files_of, freed, mix, prepare, read, row_key, spread_join, with_checkpoints
from .components import components, joined, settled

EDITS, MIN_CHARS = 1, 32
#: Lines of this many characters have one edit more, and again at each doubling.
MORE_EDITS_FROM = 128
#: Keys that are sorted at once, and lines of one bucket among them from which it is crowded.
KEYS_AT_ONCE, CROWD = 1 << 20, 64
#: Characters of lines for each part of the key space (their keys are some 16 MB), and the most parts and partitions.
CHARS_OF_PART, MOST_PARTS, MOST_PARTITIONS = 12_000_000, 200_000, 20_000


def edits_of(length: int, edits: int | None = None) -> int:
    """Edits that a pair may have whose shorter line has this length; edits, if given, holds for all lengths."""
    return edits if edits is not None else EDITS + (length // MORE_EDITS_FROM).bit_length()


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """Start and length of the edits + 1 segments of a line; the last ones take what is left over."""
    k = edits + 1
    size, more = divmod(length, k)
    sizes = [size + (i >= k - more) for i in range(k)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(k)]


def selections(length: int, edits: int | None = None) -> list[tuple[int, int, int, int, bool]]:
    """(indexed length, segment, start, size, own) of all substrings that a line of this length is keyed by.

    own: the line's own segment, which is indexed and looked up at once.
    """
    out = []
    for short in range(max(length - edits_of(length, edits), 1), length + 1):
        shift, k = length - short, edits_of(short, edits)
        if shift > k or short <= k:
            continue
        for i, (start, size) in enumerate(segments(short, k)):
            first = max(start - i, start + shift - (k - i), 0)
            last = min(start + i, start + shift + (k - i), length - size)
            out += [(short, i, at, size, short == length and at == start) for at in range(first, last + 1)]
    return out


def banded_distance(a: str, b: str, edits: int) -> int:
    """Edit distance if it is at most edits, else a larger number.

    The band of 2 * edits + 1 rows slides down the diagonal, one row for each column; bits of up and down are the
    rows where the column steps up or down. Rows above the band and below the line are as far as they can be.
    """
    if abs(len(a) - len(b)) > edits:
        return edits + 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << 2 * edits
    down = (1 << (edits + 1)) - 1  # rows up to 0 at the start
    up, far = full ^ down, edits
    for j, c in enumerate(b, 1):
        up, down = up >> 1 | top, down >> 1
        at = j - edits - 1
        m = places.get(c, 0)
        same = (m >> at if at >= 0 else m << -at) & full
        zero = ((((same & up) + up) ^ up) | same | down) & full
        plus, minus = (down | ~(zero | up)) & full, up & zero
        far += not zero & top
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        up, down = (minus | ~(zero | plus)) & full, plus & zero
    for bit in range(len(a) - len(b) + edits + 1, width):
        far += (down >> bit & 1) - (up >> bit & 1)
    return far


def within(a: str, b: str, edits: int | None = None) -> bool:
    head, least = 0, min(len(a), len(b))
    edits = edits_of(least, edits)
    while head < least and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < least - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return banded_distance(a[head : len(a) - tail], b[head : len(b) - tail], edits) <= edits


def line_id(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def short_id(full: bytes) -> int:
    """63 bits that name a line among candidates; what is dropped is decided by the whole id and the text."""
    return int.from_bytes(full[:8], "little", signed=True) & -2


def character_counts(line: str) -> bytes:
    """Counts of characters by 32 classes, up to 255 each: an edit changes two of them by one."""
    u = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(np.bincount(u & 31, minlength=32), 255).astype(np.uint8).tobytes()


def allowed(one: np.ndarray, many: np.ndarray, n: int, ns: np.ndarray, edits: int | None = None) -> np.ndarray:
    short = np.minimum(ns, n)
    most = EDITS + np.frexp(short // MORE_EDITS_FROM)[1] if edits is None else edits  # the exponent is the bit length
    return (np.abs(ns - n) <= most) & (np.abs(many.astype(np.int16) - one).sum(1) <= 2 * most)


def occurrences(docs: DataFrame) -> DataFrame:
    """line, key, doc_id, at, n (characters) of each line that has a word; docs has key, doc_id, text."""
    target = pa.schema([("line", pa.binary()), ("key", pa.binary()), ("doc_id", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                (line_id(line), key, doc, at, len(line))
                for key, doc, text in zip(*(b.column(c).to_pylist() for c in ("key", "doc_id", "text")), strict=True)
                for at, line in enumerate(text.split("\n"))
                if line and not line.isspace()
            ]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(target.names, map(list, zip(*rows, strict=True)), strict=True)), schema=target)

    return docs.mapInArrow(run, "line binary, key binary, doc_id long, at int, n int")


class KeyMaker:
    """Keys of many lines at once: sums of characters times powers give the hash of any substring by two look-ups."""

    def __init__(self, edits: int | None):
        self.edits, self.first, self.count = edits, {}, {}
        self.table = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _know(self, lengths: set[int]) -> None:
        made, at = [], len(self.table[0])
        for n in sorted(lengths - self.first.keys()):
            chosen = selections(n, self.edits)
            self.first[n], self.count[n] = at, len(chosen)
            at += len(chosen)
            made += [(a, a + size, short * 64 + k, own) for short, k, a, size, own in chosen]
        if made:
            self.table = [np.concatenate([t, np.array(x, t.dtype)]) for t, x in zip(self.table, zip(*made, strict=True), strict=True)]

    def keys(self, lines: list[str], nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets, and the node of each with its lowest bit set if the key is the line's own segment."""
        n = np.fromiter(map(len, lines), np.int64, len(lines))
        self._know(set(n.tolist()))
        u = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(self.powers) <= len(u):
            step = np.full(len(u) + 1, _BASE, np.uint64)
            back = np.full(len(u) + 1, _UNBASE, np.uint64)
            step[0] = back[0] = 1
            self.powers, self.inverse = np.cumprod(step), np.cumprod(back)
        sums = np.zeros(len(u) + 1, np.uint64)
        np.cumsum(mix(u.astype(np.uint64) + np.uint64(0x51ED270B)) * self.powers[: len(u)], out=sums[1:])
        times = np.fromiter(map(self.count.__getitem__, n.tolist()), np.int64, len(n))
        first = np.fromiter(map(self.first.__getitem__, n.tolist()), np.int64, len(n))
        row = np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)
        offset = np.repeat(np.cumsum(n) - n, times)
        a, z = self.table[0][row] + offset, self.table[1][row] + offset
        bucket = mix(((sums[z] - sums[a]) * self.inverse[a]) ^ mix(self.table[2][row]))
        return bucket, np.repeat(nodes, times) | self.table[3][row]


_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def line_keys(batches: Iterator[pa.RecordBatch], edits: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and nodes of some KEYS_AT_ONCE keys at a time. A task gives a line once while it remembers it."""
    maker, seen, lines, nodes, size = KeyMaker(edits), set(), [], [], 0
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_held = 0

    def add() -> None:
        nonlocal lines, nodes, size, n_held
        if lines:
            held.append(maker.keys(lines, np.array(nodes, np.int64).view(np.uint64)))
            n_held += len(held[-1][0])
        lines, nodes, size = [], [], 0

    for b in batches:
        for text in b.column("text").to_pylist():
            for line in text.split("\n"):
                if (n := len(line)) < MIN_CHARS or (i := short_id(line_id(line))) in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(i)
                lines.append(line)
                nodes.append(i)
                size += n
                if size >= 1 << 19:
                    add()
                    if n_held >= KEYS_AT_ONCE:
                        yield tuple(map(np.concatenate, zip(*held, strict=True)))
                        held, n_held = [], 0
    add()
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def in_runs(bucket: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries that are alone in their bucket, and the others by bucket and node, each node once (as its own key, if it has that)."""
    order = np.argsort(bucket)
    bucket, node = bucket[order], node[order]
    same = np.append(bucket[1:] == bucket[:-1], False)
    several = same | np.append(False, same[:-1])
    alone = bucket[~several], node[~several]
    bucket, node = bucket[several], node[several]
    order = np.lexsort((node, bucket))
    bucket, node = bucket[order], node[order]
    last = np.append((bucket[1:] != bucket[:-1]) | (node[1:] >> np.uint64(1) != node[:-1] >> np.uint64(1)), True)[: len(bucket)]
    return *alone, bucket[last], node[last]


def bounds(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the runs of equal values, and their lengths."""
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    return first, np.diff(np.append(first, len(bucket)))


def first_own(node: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least node of each run that is there as its own key; all bits set if there is none."""
    return np.minimum.reduceat(np.where(node & np.uint64(1), node, ~np.uint64(0)), first) if len(first) else node[:0]


def packed_entries(docs: DataFrame, edits: int | None, parts: int) -> DataFrame:
    """part, bucket, node, crowded: keys as packed numbers, by the part of the key space that they lie in.

    A bucket that has more than CROWD lines among the keys at hand sends its least, its greatest and its least own
    one only, and is named as crowded: so no bucket costs a part more than CROWD entries from each KEYS_AT_ONCE keys.
    """
    target = pa.schema([("part", pa.int32()), ("bucket", pa.binary()), ("node", pa.binary()), ("crowded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, node in line_keys(batches, edits):
            b1, n1, b2, n2 = in_runs(bucket, node)
            first, size = bounds(b2)
            big = size > CROWD
            crowded, keep = b2[first[big]], np.repeat(~big, size)
            own = first_own(n2, first)
            bucket = np.concatenate([b1, b2[keep], crowded, crowded, crowded])
            node = np.concatenate([n1, n2[keep], n2[first[big]], n2[(first + size - 1)[big]], np.where(own == ~np.uint64(0), n2[first], own)[big]])
            columns = []
            for values in (bucket, crowded):
                part = (values >> np.uint64(32)).astype(np.int64) * parts >> 32
                order = np.argsort(part, kind="stable")
                columns.append((order, np.searchsorted(part[order], np.arange(parts + 1))))
            (order, cut), (order_c, cut_c) = columns
            bucket, node, crowded = bucket[order], node[order], crowded[order_c]
            some = np.flatnonzero(np.diff(cut))
            for at in range(0, len(some), 256):
                here = some[at : at + 256]
                yield pa.RecordBatch.from_pydict({"part": here, "bucket": [bucket[cut[p] : cut[p + 1]].tobytes() for p in here], "node": [node[cut[p] : cut[p + 1]].tobytes() for p in here], "crowded": [crowded[cut_c[p] : cut_c[p + 1]].tobytes() for p in here]}, schema=target)

    return docs.mapInArrow(run, "part int, bucket binary, node binary, crowded binary")


def shared_buckets(entries: DataFrame, parts: int) -> DataFrame:
    """bucket, node, lead, crowded of buckets of two or more lines, one of them (lead: the least) by its own segment.

    A crowded bucket is named by one row only. Parts come one after the other, sorted outside of this process.
    """
    target = pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("lead", pa.int64()), ("crowded", pa.bool_())])
    dealt = entries.repartition(min(parts, MOST_PARTITIONS), "part").sortWithinPartitions("part")

    def shared(rows: list[tuple]) -> pa.RecordBatch:
        bucket, node, crowded = (np.frombuffer(b"".join(x), np.uint64) for x in zip(*rows, strict=True))
        _, _, bucket, node = in_runs(bucket, node)
        first, size = bounds(bucket)
        own = first_own(node, first)
        full = np.isin(bucket[first], crowded)
        good = (own != ~np.uint64(0)) & (size > 1)
        take = np.repeat(good & ~full, size)
        number = lambda x: (x & ~np.uint64(1)).view(np.int64)
        named = good & full
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([bucket[take], bucket[first[named]]]).view(np.int64)),
            pa.array(np.concatenate([number(node[take]), number(own[named])])),
            pa.array(np.concatenate([number(np.repeat(own, size)[take]), number(own[named])])),
            pa.array(np.repeat([False, True], [take.sum(), named.sum()])),
        ], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("part", "bucket", "node", "crowded")), strict=True))
        for _, part in groupby(rows, key=lambda r: r[0]):
            yield shared([r[1:] for r in part])

    return dealt.mapInArrow(run, "bucket long, node long, lead long, crowded boolean")


def crowded_members(docs: DataFrame, crowded: DataFrame, edits: int | None) -> DataFrame:
    """bucket, node, lead of all lines in the crowded buckets (bucket, lead), whose keys are made once more."""
    spark, target = docs.sparkSession, pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("lead", pa.int64())])
    wanted = None
    if crowded.count() <= BROADCAST_ROWS:
        at = crowded.toArrow()
        bucket, lead = at.column("bucket").to_numpy(), at.column("lead").to_numpy()
        order = np.argsort(bucket.view(np.uint64))
        wanted = spark.sparkContext.broadcast((bucket.view(np.uint64)[order], lead[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, node in line_keys(batches, edits):
            lead = np.zeros(len(bucket), np.int64)
            if wanted is not None:
                at = np.minimum(np.searchsorted(wanted.value[0], bucket), len(wanted.value[0]) - 1)
                ok = wanted.value[0][at] == bucket
                bucket, node, lead = bucket[ok], node[ok], wanted.value[1][at[ok]]
            for i in range(0, len(bucket), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[part].view(np.int64)), pa.array((node[part] & ~np.uint64(1)).view(np.int64)), pa.array(lead[part])], schema=target)

    keys = docs.mapInArrow(run, "bucket long, node long, lead long").distinct()
    return keys if wanted is not None else keys.drop("lead").join(crowded, "bucket")


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, line, text of the wanted lines (node). Their ids are broadcast only if few; else lines are joined to them."""
    spark, target = docs.sparkSession, pa.schema([("node", pa.int64()), ("line", pa.binary()), ("text", pa.string())])
    wanted = settled(wanted.distinct())
    few = spark.sparkContext.broadcast(np.sort(wanted.toArrow().column("node").to_numpy())) if wanted.count() <= BROADCAST_ROWS else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            out: dict[bytes, tuple[int, str]] = {}
            for text in b.column("text").to_pylist():
                for line in text.split("\n"):
                    if len(line) >= MIN_CHARS and (full := line_id(line)) not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(full)
                        out[full] = short_id(full), line
            if few is not None and out:
                ids = np.fromiter((i for i, _ in out.values()), np.int64, len(out))
                at = np.minimum(np.searchsorted(few.value, ids), max(len(few.value) - 1, 0))
                ok = few.value[at] == ids if len(few.value) else np.zeros(len(ids), bool)
                out = {k: v for (k, v), good in zip(out.items(), ok.tolist(), strict=True) if good}
            if out:
                node, text = zip(*out.values(), strict=True)
                yield pa.RecordBatch.from_pydict({"node": node, "line": list(out), "text": text}, schema=target)

    lines = docs.mapInArrow(run, "node long, line binary, text string")
    if few is None:
        lines = lines.join(wanted, "node", "left_semi")
    return lines.groupBy("line").agg(F.first("node").alias("node"), F.first("text").alias("text"))


def verified(pairs: DataFrame, lines: DataFrame, edits: int | None) -> DataFrame:
    """Links a, b (whole ids) of those of the pairs of nodes whose texts are within the edits."""
    side = lambda k: lines.select(F.col("node").alias(k), F.col("line").alias(f"line_{k}"), F.col("text").alias(f"text_{k}"))
    both = spread_join(spread_join(pairs, side("a"), "a", F.xxhash64("b")), side("b"), "b", F.xxhash64("a"), counted=pairs)
    target = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [(min(a, b), max(a, b)) for a, b, s, t in zip(*(batch.column(n).to_pylist() for n in ("line_a", "line_b", "text_a", "text_b")), strict=True) if a != b and within(s, t, edits)]
            yield pa.RecordBatch.from_pydict({"a": [a for a, _ in good], "b": [b for _, b in good]}, schema=target)

    return both.mapInArrow(run, "a binary, b binary").repartition(files_of(pairs.sparkSession))  # few links, uneven tasks


def near_lines(docs: DataFrame, chars: int, edits: int | None = None) -> DataFrame:
    """node (whole id), component of the lines that have another within edits; docs has text, with about chars in lines."""
    parts = int(min(max(8, chars // CHARS_OF_PART), MOST_PARTS))
    shared = settled(shared_buckets(packed_entries(docs, edits, parts), parts))
    members = shared.filter("not crowded").select("bucket", "node", "lead")
    crowded = shared.filter("crowded").select("bucket", "lead")
    if not crowded.isEmpty():
        members = settled(members.unionByName(crowded_members(docs, crowded, edits).select("bucket", "node", "lead")))
    freed(docs.sparkSession)  # the packed keys, which are most of what is shuffled
    lines = settled(line_texts(docs, members.select("node")))
    # The lead has the indexed length, which its key is made from, so all members are near it in length.
    pairs = settled(members.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())
    groups = components(settled(verified(pairs, lines, edits)))
    # Where a lead and a line are still in different groups, all lines of their buckets are looked at; all others are done.
    of = lines.select("node", "line").join(groups.withColumnRenamed("node", "line"), "line", "left").select("node", F.coalesce("component", "line").alias("of"))
    side = lambda k: of.select(F.col("node").alias(k), F.col("of").alias(f"of_{k}"))
    apart = pairs.join(side("a"), "a").join(side("b"), "b").filter("of_a <> of_b").select(F.col("a").alias("lead"), F.col("b").alias("node"))
    buckets = members.join(apart, ["lead", "node"], "left_semi").select("bucket").distinct()
    left = settled(members.join(buckets, "bucket", "left_semi").select("bucket", "node"))
    counts = F.udf(character_counts, "binary", useArrow=True)
    open_ = still_open(left.join(lines.select("node", "line", F.length("text").alias("n")), "node").select("bucket", F.col("line").alias("node"), "n"), groups)
    wanted = lines.join(open_.select(F.col("node").alias("line")).distinct(), "line", "left_semi")
    texts = settled(wanted.select(F.col("line").alias("node"), counts("text").alias("digest"), "text"))
    return joined(groups, settled(links_in_blocks(open_, texts, lambda *x: allowed(*x, edits), lambda: lambda a, b: within(a, b, edits))))


def dropped_lines(docs: DataFrame, edits: int | None = None) -> DataFrame:
    """key, at, equal of each line that goes: equal where the same line comes earlier, else one near it."""
    found = cut_off(occurrences(docs))  # narrow rows, read twice
    where = F.struct("doc_id", "key", "at")
    chars = found.agg(F.sum(F.when(F.col("n") >= MIN_CHARS, F.col("n")))).first()[0] or 0
    lines = found.groupBy("line").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n_rows"))
    groups = near_lines(docs.select("text"), chars, edits)
    lines = settled(lines.join(groups.withColumnRenamed("node", "line"), "line", "left").filter("n_rows > 1 or component is not null"))
    freed(docs.sparkSession)
    classes = lines.filter("component is not null").groupBy("component").agg(F.min("first").alias("class_first"))
    near = spread_join(lines.filter("component is not null"), classes, "component", F.xxhash64("line")).filter("n_rows > 1 or class_first <> first")
    alone = lines.filter("component is null").select("line", "first", F.col("first").alias("stays"))
    heads = alone.unionByName(near.select("line", "first", F.col("class_first").alias("stays")))
    return spread_join(found, heads, "line", F.monotonically_increasing_id(), counts=lines.select("line", "n_rows")).filter(where != F.col("stays")).select("key", "at", (where != F.col("first")).alias("equal"))


def dedup_lines(docs: DataFrame, edits: int | None = None) -> DataFrame:
    """docs with its text cut, and n_lines, n_equal, n_near: lines of the text, and those gone for either reason."""
    prepare(with_checkpoints(docs.sparkSession))
    docs = docs.drop("n_lines", "n_equal", "n_near")
    key = row_key("doc_id", "text").alias("__key")
    plain = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    gone = dropped_lines(plain, edits).groupBy(F.col("key").alias("__key")).agg(F.collect_set("at").alias("__gone"), F.countDistinct(F.when(F.col("equal"), F.col("at"))).alias("n_equal"))
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.coalesce(F.array_contains("__gone", i), F.lit(False)))
    out = docs.withColumn("__key", key).join(gone, "__key", "left")
    n_gone = F.coalesce(F.size("__gone"), F.lit(0))
    n_equal = F.coalesce("n_equal", F.lit(0))
    out = out.withColumn("n_lines", F.size(F.split("text", "\n")).cast("long")).withColumn("n_near", (F.when(F.col("__gone").isNull(), 0).otherwise(n_gone) - n_equal).cast("long")).withColumn("n_equal", n_equal.cast("long"))
    return out.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).drop("__key", "__gone")


def op4(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_equal", "n_near", "text")
