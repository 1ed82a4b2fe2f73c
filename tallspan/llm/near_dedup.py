"""Near-duplicate groups by Order MinHash, verified by banded alignment.

The k-mers of a text are its five-word shingles (lower-case words between ASCII white space), each labelled by its
occurrence number. A sketch takes the LENGTH k-mers of least hash and keeps them in the order of the text; two texts
share one of SKETCHES with a probability of 1 - (1 - s ** LENGTH) ** SKETCHES or so, where s is the share of all their
k-mers that both have. A text of up to SHORT k-mers has too few for that: it is keyed by so many of its least ones
that any two texts with enough in common share one. Texts of one value form a bucket.

Candidates are compared in rounds. First each text is compared with the least text of all its buckets, so copies of a text
cost one comparison each; then, where a bucket still holds several groups, with a text of the bucket, chosen anew
for each bucket; last, all pairs of a bucket that are still in different groups are compared.
A digest (the least k-mer of each of BINS bins, and counts of words) rules out pairs that are several standard
deviations below the overlap, or hold too few equal words, before their texts are looked at. The last pairs are
compared in blocks of a bucket that are bounded in rows and bytes, links are followed within the block, and pairs
inside a group are never made; no bucket is cut short.

A pair is a link if the texts are near by edits of words: an alignment of the two word sequences matches m words and
m / (n1 + n2 - m) >= 0.8, found by bit-parallel LCS inside the band that this bound leaves, and two fifths of the
longer text's k-mers are in the other one too. (One word in nine may be replaced, which breaks five of nine k-mers.)
Groups are the connected components of links.

Equal texts are one text from the start (null counts as empty) and always one group. A text of one to four words
is one k-mer; texts without words group with equal texts only. class_id is the least doc_id of the group, null if all
its ids are; each row of the input, repeated or without an id, gets a row. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import links_in_blocks, still_open
from .common import BROADCAST_ROWS, WordCodes, among, cut_off, files_of, freed, mix, prepare, read, row_key, shingle_hashes, spread_join, with_checkpoints
from .components import components, joined, settled

SHINGLE, SIMILARITY, LENGTH, SKETCHES = 5, 0.8, 3, 40
#: Share of the longer text's k-mers that the other has; then both have a quarter of all, or more.
OVERLAP, LEAST_JACCARD = 0.4, 0.25
#: K-mers up to which a text is looked for by its least ones instead of sketches.
SHORT = 32
#: Bins of the digest that rules out pairs far below the overlap before their texts are fetched.
BINS, WORD_BINS = 256, 256
#: Words of texts that a task remembers while it compares them.
MOST_WORDS = 2_000_000

_A = (np.random.default_rng(31).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = np.random.default_rng(32).integers(1, 1 << 63, SKETCHES, dtype=np.uint64)


def words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def occurrences(h: np.ndarray) -> np.ndarray:
    """How often each value came before."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.append(True, s[1:] != s[:-1])
    out = np.empty(len(h), np.int64)
    out[order] = np.arange(len(h)) - np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
    return out


def labelled_shingles(h: np.ndarray) -> np.ndarray:
    return mix(h + occurrences(h).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def digest(labelled: np.ndarray, words_: np.ndarray) -> np.ndarray:
    """A byte for each bin of the hash space: 0 if no k-mer is in it, else taken from the least one; then counts of words by hash."""
    low = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    at = (labelled >> np.uint64(56)).astype(np.int64)
    np.minimum.at(low, at, labelled)
    out = (low >> np.uint64(30)) % np.uint64(255) + np.uint64(1)
    out[np.bincount(at, minlength=BINS) == 0] = 0
    bag = np.minimum(np.bincount((words_ >> np.uint64(56)).astype(np.int64), minlength=WORD_BINS), 255)
    return np.concatenate([out.astype(np.uint8), bag.astype(np.uint8)])


def maybe_similar(one: np.ndarray, many: np.ndarray, total: np.ndarray, deviations: float = 3.5) -> np.ndarray:
    """Whether digests agree as often as those of texts with enough in common do, less some standard deviations.

    total: k-mers of both texts; with few (a short text's pairs) the test is exact. Bins that are filled are a
    sample, without repetition, of the union. Counts of words give a bound of the words that can be matched, which
    is exact too; a count of 255 may be any larger one.
    """
    bag, bags, one, many = one[..., BINS:], many[..., BINS:], one[..., :BINS], many[..., :BINS]
    filled = np.maximum(((many | one) > 0).sum(1), 1)
    same = ((many == one) & (one > 0)).sum(1)
    left = np.clip(1 - filled * (1 + LEAST_JACCARD) / total, 0.02, 1)
    # K-mers that only one text has are at most 1 - OVERLAP of all; no other makes a bin differ.
    few = (filled - same) <= (1 - OVERLAP) * total
    enough = same >= filled * (LEAST_JACCARD - deviations * np.sqrt(LEAST_JACCARD * (1 - LEAST_JACCARD) / filled * left))
    ok = np.where(total <= SHORT * 9 // 4, few, enough)
    bag, bags = np.broadcast_to(bag, bags.shape)[ok], bags[ok]
    matched, every = np.minimum(bag, bags).sum(1, dtype=np.int64), bag.sum(1, dtype=np.int64) + bags.sum(1, dtype=np.int64)
    ok[ok] = (matched * (1 + SIMILARITY) >= SIMILARITY * every - 1e-9) | (np.maximum(bag, bags).max(1, initial=0) == 255)
    return ok


def allowed(one: np.ndarray, many: np.ndarray, n: int, ns: np.ndarray) -> np.ndarray:
    ok = np.minimum(ns, n) + 1 >= SIMILARITY * np.maximum(ns, n)  # a text has four words more than k-mers
    ok[ok] = maybe_similar(one, many[ok], ns[ok] + n)
    return ok


def order_minhash(labelled: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A value for each sketch of the labelled shingle hashes."""
    v = (labelled[None, :] ^ _B[:, None]) * _A[:, None]
    if len(labelled) > length:
        at = np.argpartition(v, length - 1, axis=1)[:, :length]
        at.sort(axis=1)
    else:
        at = np.broadcast_to(np.arange(len(labelled)), (SKETCHES, len(labelled)))
    out = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))
    for j in range(at.shape[1]):
        out = mix(out * np.uint64(31) + labelled[at[:, j]])
    return out


def needed(n: int) -> int:
    """K-mers of n that the other text must have, if it has no more."""
    return -int(-n * OVERLAP // 1)


def prefix_keys(labelled: np.ndarray) -> np.ndarray:
    """The least of the labelled k-mers, marked: so many that a text that lacks them all has too little in common."""
    n = len(labelled)
    return mix(np.sort(labelled)[: n - needed(n) + 1] ^ np.uint64(0xA0761D6478BD642F))


def buckets_of(labelled: np.ndarray) -> np.ndarray:
    """Keys of a short text, sketches of a long one, and both where either may be similar to it."""
    n = len(labelled)
    if n <= SHORT:
        return prefix_keys(labelled)
    if n * 4 <= SHORT * 5 + 5:
        return np.concatenate([order_minhash(labelled), prefix_keys(labelled)])
    return order_minhash(labelled)


def banded_lcs(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence along paths within band of the diagonal.

    Bits of v are rows of a column of the table: 0 where the length steps up. The rows of the band slide along:
    those left behind are counted, new ones come in as ones.
    """
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    low, high, v, done, n, full = 0, 0, 0, 0, len(a), 0
    for j, x in enumerate(b):
        if (new := j - band) > low:
            if new >= n:
                break
            gone = new - low
            done += gone - (v & ((1 << gone) - 1)).bit_count()
            v >>= gone
            full >>= gone
            low = new
        if (new := min(n, j + band + 1)) > high:
            v |= ((1 << (new - high)) - 1) << (high - low)
            high = new
            full = (1 << (high - low)) - 1
        if (m := where.get(x)) and (u := v & m >> low):
            v = ((v + u) | (v - u)) & full
    return done + (high - low) - v.bit_count()


def aligned(a: list[int], b: list[int], least: float = SIMILARITY) -> bool:
    """Whether an alignment matches m elements with m / (len(a) + len(b) - m) >= least."""
    total = len(a) + len(b)
    if not total or min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    band = int(total * (1 - least) / (1 + least)) + 2
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    m = head + tail + banded_lcs(a[head : len(a) - tail], b[head : len(b) - tail], band)
    return m >= least * (total - m) - 1e-9


class Sequence:
    """A text's words as numbers, and its labelled k-mers in order of their hashes."""

    def __init__(self, hashes: np.ndarray):
        self.words = hashes
        self.kmers = np.sort(labelled_shingles(shingle_hashes(hashes, SHINGLE)))


class Sequences(dict):
    """Sequences of texts; forgotten together once they hold MOST_WORDS words, which bounds the memory of a task."""

    def __init__(self):
        self.codes, self.held = WordCodes(), 0

    def __missing__(self, text: str) -> Sequence:
        if self.held > MOST_WORDS:
            self.clear()
            self.held = 0
        out = self[text] = Sequence(self.codes.hashes_of(words(text)))
        self.held += len(out.words)
        return out


def similar(a: Sequence, b: Sequence) -> bool:
    n, most = len(np.intersect1d(a.kmers, b.kmers, assume_unique=True)), max(len(a.kmers), len(b.kmers))
    return most > 0 and n >= needed(most) and aligned(a.words.tolist(), b.words.tolist())


def sketches(docs: DataFrame) -> DataFrame:
    """node, n, digest, buckets of each text (node, text); n is its number of shingles."""
    target = pa.schema([("node", pa.binary()), ("n", pa.int32()), ("digest", pa.binary()), ("buckets", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for b in batches:
            out: dict[bytes, tuple[int, bytes, np.ndarray]] = {}
            for key, text in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), strict=True):
                if key not in out and len(w := codes.hashes_of(words(text))):
                    x = labelled_shingles(shingle_hashes(w, SHINGLE))
                    out[key] = (len(x), digest(x, w).tobytes(), buckets_of(x).view(np.int64))
            n, d, buckets = zip(*out.values(), strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_pydict({"node": list(out), "n": n, "digest": d, "buckets": buckets}, schema=target)

    return docs.mapInArrow(run, "node binary, n int, digest binary, buckets array<long>").dropDuplicates(["node"])


def nodes_of(pairs: DataFrame) -> tuple[DataFrame, bool]:
    """The nodes of pairs, and whether they are so few that they may be broadcast."""
    nodes = settled(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    return nodes, nodes.count() <= BROADCAST_ROWS


def of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """rows whose node is one of the few nodes, or shares 64 bits of hash with one: the caller joins by the whole node."""
    return rows.filter(among(nodes.select(F.xxhash64("node")))(F.xxhash64("node")))


def plausible(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """pairs without those whose digests are 4.5 standard deviations below the overlap."""
    nodes, few = nodes_of(pairs)
    some = sketched.select("node", "n", "digest")
    some = settled(of_nodes(some, nodes)) if few else some.join(nodes, "node", "left_semi")
    side = lambda k: some.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("digest").alias(f"digest_{k}"))
    target = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.stack([np.frombuffer(x, np.uint8) for x in batch.column(f"digest_{k}").to_pylist()]) for k in "ab")
                ok = maybe_similar(one, two, batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy(), 4.5)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=target).filter(pa.array(ok))

    both = spread_join(spread_join(pairs, side("a"), "a", F.xxhash64("b")), side("b"), "b", F.xxhash64("a"), counted=pairs)
    return both.mapInArrow(run, "a binary, b binary")


def texts_of(nodes: DataFrame, few: bool, docs: DataFrame) -> DataFrame:
    """node, text: of equal texts one is moved, whatever their number."""
    one = lambda rows: rows.groupBy("node").agg(F.first("text").alias("text"))
    return one(of_nodes(docs, nodes)) if few else one(docs).join(nodes, "node", "left_semi")


def verifier() -> Callable[[str, str], bool]:
    of = Sequences()
    return lambda a, b: similar(of[a], of[b])


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of pairs (a, b) whose texts align."""
    text = settled(texts_of(*nodes_of(pairs), docs))
    side = lambda k: text.select(F.col("node").alias(k), F.col("text").alias(f"text_{k}"))
    both = spread_join(spread_join(pairs, side("a"), "a", F.xxhash64("b")), side("b"), "b", F.xxhash64("a"), counted=pairs)
    target = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked = verifier()
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in ("a", "b", "text_a", "text_b")}
            good = [(a, b) for a, b, s, t in zip(*c.values(), strict=True) if linked(s, t)]
            yield pa.RecordBatch.from_pydict({"a": [a for a, _ in good], "b": [b for _, b in good]}, schema=target)

    return both.mapInArrow(run, "a binary, b binary").repartition(files_of(pairs.sparkSession))  # few links, uneven tasks


def linked_groups(docs: DataFrame) -> DataFrame:
    """node, component of the texts (node, text) that are linked with another."""
    sketched = cut_off(sketches(docs))
    rows = sketched.select(F.explode("buckets").alias("bucket"), "node", "n")
    first = rows.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("lead"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut_off(rows.join(first, "bucket"))  # of buckets of two or more
    freed(docs.sparkSession)
    apart = (F.col("node") != F.col("lead.node")) & (F.least("n", "lead.n") + 1 >= SIMILARITY * F.greatest("n", "lead.n"))
    couple = (F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))

    # Each text with the least of its buckets' leads; most others are in one group with that by then.
    pairs = settled(members.filter(apart).groupBy("node").agg(F.min("lead").alias("lead")).select(*couple).distinct())
    groups = settled(components(settled(verified(settled(plausible(pairs, sketched)), docs))))
    # Where buckets still hold several groups: another lead for each bucket, then every pair that is left.
    members = members.drop("lead", "size")
    freed(docs.sparkSession)
    known = still_open(members, groups)
    lead = known.groupBy("bucket").agg(F.min_by(F.struct("node", "n", "component"), F.xxhash64("node", "bucket")).alias("lead"))
    more = known.join(lead, "bucket").filter(apart & (F.col("component") != F.col("lead.component"))).select(*couple).distinct().join(pairs, ["a", "b"], "left_anti")
    groups = joined(groups, settled(verified(settled(plausible(settled(more), sketched)), docs)))
    open_ = still_open(members, groups)
    nodes = settled(open_.select("node").distinct())
    text = settled(texts_of(nodes, nodes.count() <= BROADCAST_ROWS, docs).join(sketched.select("node", "digest"), "node"))
    freed(docs.sparkSession)
    return joined(groups, settled(links_in_blocks(open_, text, allowed, verifier)))


def text_node(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (least doc_id of the group), n_rows (of the group) for every row of docs."""
    prepare(with_checkpoints(docs.sparkSession))
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), text_node(text_col).alias("node"))
    groups = linked_groups(docs.select("node", "text"))
    rows = cut_off(docs.select("doc_id", "node"))
    of_text = rows.groupBy("node").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_rows"))
    of_text = cut_off(of_text.join(groups, "node", "left"))
    linked = of_text.filter("component is not null").select("node", "component")
    classes = of_text.filter("component is not null").groupBy("component").agg(F.min("class_id").alias("class_id"), F.sum("n_rows").alias("n_rows"))
    named = of_text.filter("component is null").select("node", "class_id", "n_rows").unionByName(spread_join(linked, classes, "component", F.xxhash64("node")).select("node", "class_id", "n_rows"))
    return spread_join(rows, named, "node", F.monotonically_increasing_id(), counts=of_text.select("node", "n_rows")).select("doc_id", "class_id", "n_rows")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, of each group only that of the least id (null ids come last), once if it is repeated."""
    prepare(with_checkpoints(docs.sparkSession))
    named = docs.withColumn("__row", row_key(id_col, text_col))
    groups = linked_groups(docs.select(text_node(text_col).alias("node"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    rows = named.select("__row", F.col(id_col).alias("doc_id"), text_node(text_col).alias("node"))
    rows = rows.groupBy("__row").agg(F.first("doc_id").alias("doc_id"), F.first("node").alias("node"), F.count(F.lit(1)).alias("n_rows"))
    rows = cut_off(rows.join(groups, "node", "left"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    stay = settled(rows.groupBy(F.coalesce("component", "node").alias("class")).agg(F.min_by(F.struct("__row", "n_rows"), order).alias("stay")).select("stay.*"))
    counts = stay.select("__row", "n_rows")
    kept = spread_join(named, stay.filter("n_rows = 1").select("__row"), "__row", F.monotonically_increasing_id(), counts=counts)
    again = stay.filter("n_rows > 1").select("__row")
    if not again.isEmpty():
        kept = kept.unionByName(spread_join(named, again, "__row", F.monotonically_increasing_id(), counts=counts).dropDuplicates(["__row"]))
    return kept.select(*docs.columns)


def op1(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
