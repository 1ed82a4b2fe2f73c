"""Operators that compare texts with each other, against brute force, and the pipeline as a whole."""

import random
import time
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallspan.llm import blocks, decontamination, line_dedup, near_dedup, sharding
from tallspan.llm.common import files_of, spread_join, with_checkpoints, word_hash
from tallspan.llm.components import components, joined, settled

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def groups_of(label):
    out = defaultdict(set)
    for k, v in label.items():
        out[v].add(k)
    return sorted(map(sorted, out.values()))


def closed(n, links):
    parent = list(range(n))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return [top(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(200), 100 + rng.randrange(200)) for _ in range(120)]
    df = spark.createDataFrame(links, "a long, b long")
    want = closed(301, links)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: want[n] for n in {x for a, b in links if a != b for x in (a, b)}}
    half = components(df.filter("a % 2 = 0"))
    again = {r.node: r.component for r in joined(half, df).collect()}
    assert {n: again[n] for n in got} == got
    assert components(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["long", "binary"])
def test_few_edges_take_one_task_and_get_the_labels_of_many(spark, monkeypatch, kind):
    rng = random.Random(12)
    links = [(-i, -i - 1) for i in range(9)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(30)] + [(900, 900 + i) for i in range(9)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    if kind == "binary":
        df = df.select(*(F.unhex(F.md5(F.col(c).cast("string").cast("binary"))).alias(c) for c in "ab"))
    once = components(df)
    assert once.rdd.getNumPartitions() == 1
    monkeypatch.setattr("tallspan.llm.components.MOST_EDGES", 0)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, components(df).collect()))


def shuffles_left(spark):
    """Shuffles that are known once what no frame refers to has had time to go."""
    for _ in range(100):
        if not (n := spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()):
            break
        time.sleep(0.1)
    return n


def test_line_dedup_drops_the_packed_keys_before_it_goes_on(spark, monkeypatch):
    """Their shuffle is the largest; it went only when the driver happened to collect its garbage."""
    docs, left, plain = spark.createDataFrame([(i, f"a line of some length, the same but for a number {i % 10}") for i in range(40)], "doc_id long, text string"), [], line_dedup.line_texts
    monkeypatch.setattr(line_dedup, "line_texts", lambda *x: left.append(shuffles_left(spark)) or plain(*x))
    before = shuffles_left(spark)  # of frames that other tests hold
    assert sum(r.n_equal + r.n_near for r in line_dedup.dedup_lines(docs).collect()) == 39
    assert len(left) == 1 and left[0] <= before + 2  # one is of the narrow occurrences at most


def broadcasts_of_ids(spark, work):
    """Tables of over 20 rows that Spark broadcast while work ran."""
    seen, plain = [], F.broadcast

    def told(df):
        seen.append(df.count())
        return plain(df)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(F, "broadcast", told)
        work()
    return [n for n in seen if n > 20]


def test_near_dedup_sends_ids_as_numbers(spark):
    """A table of ids that Spark broadcasts takes 100 MB of the driver at its bound, and several are made at once."""
    rows = [(2 * i + j, " ".join(f"w{i}x{k}" for k in range(24)) + f" end{j}") for i in range(60) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = []
    assert broadcasts_of_ids(spark, lambda: out.extend(near_dedup.near_duplicates(docs).collect())) == []
    assert {r.doc_id: r.class_id for r in out} == {2 * i + j: 2 * i for i in range(60) for j in range(2)}


def test_among(spark):
    from tallspan.llm.common import among

    df = spark.createDataFrame([(x,) for x in (-(1 << 63), -5, 0, 7, 8, (1 << 63) - 1)], "x long")
    kept = lambda numbers: sorted(r.x for r in df.filter(among(spark.createDataFrame([(n,) for n in numbers], "n long"))(F.col("x"))).collect())
    assert kept([8, -5, 8, 3, (1 << 63) - 1]) == [-5, 8, (1 << 63) - 1]
    assert kept([]) == []


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutated(rng, s, alphabet, most):
    s = list(s)
    for _ in range(rng.randint(0, most)):
        k, kind = rng.randint(0, len(s)), rng.random()
        if kind < 0.4 and k < len(s):
            s[k] = rng.choice(alphabet)
        elif kind < 0.7 and k < len(s):
            del s[k]
        else:
            s.insert(k, rng.choice(alphabet))
    return s


def test_alignment():
    rng = random.Random(3)
    for _ in range(2000):
        alphabet = range(rng.choice([3, 30]))
        a = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
        b = mutated(rng, a, alphabet, 8)
        m, total = lcs(a, b), len(a) + len(b)
        assert near_dedup.banded_lcs(a, b, 100) == m == near_dedup.banded_lcs(a, b, total - 2 * m + 2)
        assert near_dedup.aligned(a, b) == (total > 0 and m >= 0.8 * (total - m) - 1e-9)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_edit_join_parts(most):
    rng = random.Random(most)
    for _ in range(2000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = "".join(mutated(rng, a, "abcd", 4))
        d = edits(a, b)
        assert line_dedup.within(a, b, most) == (d <= most)
        got = line_dedup.banded_distance(a, b, most)
        assert got == d if d <= most else got > most
        short, long = sorted((a, b), key=len)
        if d <= most < len(short):  # a pair that is near always shares a key
            index = {(len(short), k, short[p : p + w]) for k, (p, w) in enumerate(line_dedup.segments(len(short), most))}
            assert index & {(s, k, long[p : p + w]) for s, k, p, w, _ in line_dedup.selections(len(long), most)}


def shingled(text):
    w = text.lower().encode().split()
    k = min(5, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if w else []


def brute_near(texts):
    """Words aligned, and two fifths of the k-mers (as often as they occur) in common."""
    split, runs = [t.lower().encode().split() for t in texts], [Counter(shingled(t)) for t in texts]
    links, where, first = [], defaultdict(list), {}
    for i, t in enumerate(texts):
        if first.setdefault(t, i) != i:
            links.append((first[t], i))
            continue
        for s in runs[i]:
            where[s].append(i)
    for i, j in {(i, j) for at in where.values() for i in at for j in at if i < j}:
        a, b, common = split[i], split[j], (runs[i] & runs[j]).total()
        if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and common >= 0.4 * max(runs[i].total(), runs[j].total()) - 1e-9:
            m = lcs(a, b)
            if m >= 0.8 * (len(a) + len(b) - m) - 1e-9:
                links.append((i, j))
    return closed(len(texts), links)


def near_cases(rng, n=60):
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 160))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    return texts + ["", "", "one two", "one two", "One  two", "same " * 300, "same " * 300 + "end"]


def test_near_dedup(spark):
    texts = near_cases(random.Random(8))
    rows = [(i, t, "x", i) for i, t in enumerate(texts)] + [(5000, None, "x", 0), (None, "null id text of its own", None, 1), (3, texts[3], "again", 2)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, class_id string, n long")).collect()
    want = brute_near(texts)
    assert len(got) == len(rows)
    label = {r.doc_id: r.class_id for r in got}
    assert [label[i] for i in range(len(texts))] == want
    assert label[5000] == label[texts.index("")] and label[None] is None
    sizes = defaultdict(int)
    for i, *_ in rows:
        sizes[label[i]] += 1
    assert all(r.n_rows == sizes[r.class_id] for r in got)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_table(spark, real):
    rows = real.orderBy("doc_id").collect()
    want = brute_near([r.text for r in rows])
    got = {r.doc_id: r.class_id for r in near_dedup.op1(spark, SF).collect()}
    assert [got[r.doc_id] for r in rows] == [rows[i].doc_id for i in want]


def test_near_dedup_recall(spark):
    """Pairs with one word in 20 to one in 11 changed, left out or put in; nothing else is alike."""
    rng, texts, n_pairs = random.Random(29), [], 0
    for part, n in [(p, n) for p in (20, 14, 11) for n in (12, 25, 40, 80, 160, 400) for _ in range(20)]:
        base = [f"u{rng.randrange(100_000)}" for _ in range(n)]
        copy = list(base)
        for at in rng.sample(range(n), n // part):
            copy[at] = rng.choice(["new", "new", None, f"{copy[at]} more"])
        texts += [" ".join(base), " ".join(w for w in copy if w)]
        n_pairs += 1
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = brute_near(texts)
    linked = [i for i in range(0, len(texts), 2) if want[i + 1] == i]
    assert all(got[i] in (i, i - i % 2) for i in got) and len(linked) > 0.6 * n_pairs
    found = sum(got[i + 1] == i for i in linked)
    assert found >= 0.95 * len(linked), (found, len(linked), n_pairs)


def test_near_dedup_larger_table(spark):
    """Near copies of the test data: at least 98 of 100 documents are in their group."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    want = [rows[i].doc_id for i in brute_near([r.text for r in rows])]
    got = {r.doc_id: r.class_id for r in near_dedup.op1(spark, "/root/testdata/sf0.01").collect()}
    wrong = sum(got[r.doc_id] != w for r, w in zip(rows, want, strict=True))
    assert all(got[r.doc_id] >= w for r, w in zip(rows, want, strict=True)) and wrong <= 0.02 * sum(r.doc_id != w for r, w in zip(rows, want, strict=True))


def test_one_of_each_goes_by_rows(spark):
    """Repeated rows, rows without an id, and an id of several texts: one row of each group, whatever the ids say."""
    base = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    near = [t.replace("30 ", "thirty ") for t in base]
    rows = [(1, base[0], "x"), (1, base[0], "x"), (2, near[0], "x"), (None, base[1], "x"), (None, near[1], "x"), (7, base[2], "x"), (7, base[3], "x"), (8, near[3], "x"), (9, None, "x"), (9, None, "y"), (None, "", None)]
    out = near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, other string"))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert out.columns == ["doc_id", "text", "other"] and len(got) == 5
    assert {(1, base[0]), (7, base[2]), (7, base[3]), (9, None)} < set(got) and [t in (base[1], near[1]) for i, t in got if i is None] == [True]
    assert near_dedup.one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(None, f"so {item} it is"), (None, "clean"), (3, item), (3, "clean too"), (4, None)], "doc_id long, text string")
    assert sorted((r.text or "" for r in decontamination.clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect())) == ["", "clean", "clean too"]


def test_near_dedup_short_texts(spark):
    """Pairs of few shingles, a word more or less at either end, and around the longest short text."""
    rng, texts = random.Random(17), []
    for n in [4, 5, 5, 6, 7, 8, 9, 10, 15, 26, 31, 32, 33, 36, 40]:  # shingles of the longer text
        for _ in range(4):
            base = [f"u{rng.randrange(100_000)}" for _ in range(n + 4)]
            cut = rng.randint(0, n // 5)
            texts += [" ".join(base), " ".join(base[cut:] if rng.random() < 0.5 else base[: len(base) - cut])]
    texts += ["a b c d e f g h i", "a b c d e f g h", "p q r s t u v w x y", "p q r s t u v w x"]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == brute_near(texts)
    assert got[len(texts) - 3] == len(texts) - 4 and got[len(texts) - 1] == len(texts) - 2


def test_blocks_miss_no_link(spark, monkeypatch):
    """Groups that links join within a bucket are joined, however many chunks it is dealt into."""
    monkeypatch.setattr(blocks, "CHUNK", 7)
    key = lambda n: bytes([n])
    members = spark.createDataFrame([(b, key(n), 1) for b in (1, 2) for n in range(60)] + [(3, key(1), 1)], "bucket long, node binary, n int")
    groups = spark.createDataFrame([(key(n), key(n % 12)) for n in range(60)], "node binary, component binary")
    texts = spark.createDataFrame([(key(n), key(n), str(n)) for n in range(60)], "node binary, digest binary, text string")
    open_ = blocks.still_open(members, groups)
    assert {r.bucket for r in open_.collect()} == {1, 2} and {r.chunks for r in open_.collect()} == {9}
    near = lambda i, j: (i + j) % 31 == 0
    found = blocks.links_in_blocks(open_, texts, lambda one, many, n, ns: (many[:, 0].astype(int) + one[0]) % 31 == 0, lambda: lambda a, b: near(int(a), int(b)) and int(a) % 2 != int(b) % 2)
    got = [(bytes(r.a)[0], bytes(r.b)[0]) for r in found.collect()]
    links = [(i, j) for i in range(60) for j in range(i) if i % 12 == j % 12 or near(i, j) and i % 2 != j % 2]
    assert all(near(i, j) and i % 2 != j % 2 and i % 12 != j % 12 for i, j in got)
    assert closed(60, got + [(i, j) for i in range(60) for j in range(i) if i % 12 == j % 12]) == closed(60, links)


def test_digest_lets_links_through():
    rng = random.Random(41)
    for n in (5, 9, 20, 36, 60, 300, 3000):
        for _ in range(15):
            a = [rng.choice(["the", "of"] + [f"w{rng.randrange(500)}"] * 4) for _ in range(n)]
            b = mutated(rng, a, ["new", "of"], max(1, n // 9))
            one, two = (near_dedup.Sequence(np.array([word_hash(w.encode()) for w in x], np.uint64)) for x in (a, b))
            if near_dedup.similar(one, two):
                d = [near_dedup.digest(x.kmers, x.words) for x in (one, two)]
                assert near_dedup.allowed(d[0], d[1][None], len(one.kmers), np.array([len(two.kmers)])).all()


def plain_lines(rows, least=line_dedup.MIN_CHARS):
    """rows: (doc_id, text), by doc_id."""
    every = list(dict.fromkeys(x for _, t in rows for x in t.split("\n") if x.strip()))
    unique = [x for x in every if len(x) >= least] + [x for x in every if len(x) < least]
    by_length, index, links = defaultdict(list), {x: i for i, x in enumerate(unique)}, []
    counts = [np.frombuffer(line_dedup.character_counts(x), np.uint8).astype(int) for x in unique]
    for i, x in enumerate(unique):
        if len(x) >= least:
            by_length[len(x)].append(i)
    for i, x in enumerate(unique):
        for n in range(max(least, len(x) - 20), len(x) + 1):
            if len(x) < least or len(x) - n > (most := line_dedup.edits_of(n)):
                continue
            links += [(i, j) for j in by_length[n] if i != j and np.abs(counts[i] - counts[j]).sum() <= 2 * most and edits(x, unique[j]) <= most]
    top, seen, out = closed(len(unique), links), set(), {}
    for i, t in rows:
        kept = []
        for x in t.split("\n"):
            if x.strip():
                if top[index[x]] in seen:
                    continue
                seen.add(top[index[x]])
            kept.append(x)
        out[i] = "\n".join(kept)
    return out


def test_line_dedup(spark):
    rng = random.Random(1)
    pool = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 70))) for _ in range(40)]
    pool += ["".join(mutated(rng, x, "abcz", 2)) for x in pool] + ["", "short", "é" * 40, "é" * 39 + "e"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(70)]
    table = [(i, t, "x", "y") for i, t in rows] + [(300, None, "x", "y")]
    got = line_dedup.dedup_lines(spark.createDataFrame(table, "doc_id long, text string, n_lines string, source string")).collect()
    assert {r.doc_id: r.text for r in got} == plain_lines(rows) | {300: None}
    for r in got:
        text = dict(rows).get(r.doc_id)
        if text is not None:
            assert r.n_lines == len(text.split("\n")) and (r.n_equal + r.n_near == 0) == (r.text == text) and r.source == "y"
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_dedup_repeats_and_nulls(spark):
    line = "a line of more than thirty-two characters"
    rows = [(None, line), (1, f"{line}\n{line}\nx"), (1, f"{line}\n{line}\nx"), (2, line + "!")]
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(None, line), (1, "x"), (1, "x"), (2, "")], key=repr)  # a null id comes first


def test_line_dedup_table(spark, real):
    rows = sorted((r.doc_id, r.text) for r in real.collect())
    assert {r.doc_id: r.text for r in line_dedup.op4(spark, SF).collect()} == plain_lines(rows)


def test_line_keys_are_substrings():
    """Two keys are equal if and only if their substrings and their places among the segments are."""
    rng, maker = random.Random(3), line_dedup.KeyMaker(None)
    lines = ["".join(rng.choice("ab") for _ in range(rng.choice([32, 33, 34, 140, 141]))) for _ in range(60)] + ["é" * 40, "𝄞" * 33]
    bucket, node = maker.keys(lines, np.arange(0, 2 * len(lines), 2, dtype=np.uint64))
    want = [(2 * i + own, (short, k, x[at : at + size])) for i, x in enumerate(lines) for short, k, at, size, own in line_dedup.selections(len(x))]
    assert node.tolist() == [i for i, _ in want]
    assert len(set(bucket.tolist())) == len({key for _, key in want}) == len(set(zip(bucket.tolist(), (key for _, key in want), strict=True)))


def test_line_dedup_crowded_keys(spark):
    """Hundreds of lines that begin alike share a key with each other; two of them are near, and so are two short lines."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    pool = ["a common beginning of a line " + word(29) for _ in range(400)] + ["yes", "no thanks", "  "]
    pool += [pool[7][:40] + "Z" + pool[7][41:], pool[300] + "Z"]
    rows = [(i, "\n".join(rng.sample(pool, 3) + [pool[i % len(pool)]])) for i in range(500)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert {r.doc_id: r.text for r in got} == plain_lines(rows)
    entries = line_dedup.packed_entries(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).select("text"), None, 8)
    assert line_dedup.shared_buckets(entries, 8).filter("crowded").count() > 0


def test_spread_join(spark):
    rows = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(12_000)] + [(None, 1)], "k long, v long")
    values = spark.createDataFrame([(i, w) for i in range(6) for w in ("a", "b")], "k long, w string")
    got = spread_join(rows, values, "k", F.col("v"))
    assert sorted(map(tuple, got.select("k", "v", "w").collect())) == sorted(map(tuple, rows.join(values, "k").select("k", "v", "w").collect()))
    assert got.columns == ["k", "v", "w"]


@pytest.fixture
def many_small_partitions(spark):
    """Partitions as on a cluster that doesn't put small ones together; gives a count of the files of new checkpoints."""
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    with_checkpoints(spark)
    folder = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    before = set(folder.rglob("part-*"))
    yield lambda: Counter(p.parent for p in set(folder.rglob("part-*")) - before)
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_checkpoints_are_in_few_files(spark, many_small_partitions):
    df = settled(spark.range(1000).repartition("id").select((F.col("id") * 3).alias("x")))
    assert sorted(r.x for r in df.collect()) == list(range(0, 3000, 3))
    assert [*many_small_partitions().values()] == [files_of(spark)] and files_of(spark) < 60


@pytest.mark.parametrize("of", [lambda docs: line_dedup.dedup_lines(docs).select("doc_id", "text"), near_dedup.near_duplicates, near_dedup.one_of_each], ids=["lines", "near", "one"])
def test_few_files_of_dedup(spark, real, many_small_partitions, of):
    docs = real.select("doc_id", "text").limit(150)
    cut = {r.doc_id: tuple(r)[1:] for r in of(docs).collect()}
    files = many_small_partitions()
    assert files and max(files.values()) <= files_of(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert cut == {r.doc_id: tuple(r)[1:] for r in of(docs).collect()}


def test_line_dedup_long_lines(spark):
    """Longer lines may have more edits: each pair here goes up to that number and stays beyond it."""
    rng, rows, want = random.Random(4), [], {}
    for length, most in ((100, 1), (140, 2), (300, 3), (700, 4), (1100, 5)):
        assert line_dedup.edits_of(length) == most
        for n in range(1, most + 2):
            line, i = "".join(rng.choice("abcdefgh ") for _ in range(length)), len(rows)
            copy = list(line)
            for at in range(n):
                copy[(2 * at + 1) * length // (2 * n + 2)] = "Z"
            rows += [(i, line), (i + 1, "".join(copy))]
            want |= {i: line, i + 1: "" if n <= most else "".join(copy)}
    rows += [(900, "q" * 127 + "x"), (901, "q" * 127)]  # a pair across a border is judged by its shorter line
    want |= {900: "q" * 127 + "x", 901: ""}
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == want
    one, ns = np.zeros((1, 32), np.uint8), np.array([127, 128, 255, 256, 1024])
    many = np.repeat(np.eye(1, 32, dtype=np.uint8) * 4, 5, 0)
    assert line_dedup.allowed(one[0], many, 2000, ns).tolist() == [False] * 5
    assert [bool(line_dedup.allowed(one[0], many[:1], int(n), ns[i : i + 1])[0]) for i, n in enumerate(ns)] == [False, True, True, True, True]


def test_decontamination(spark, real):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = sorted(con.execute(decontamination.OP3_SQL).fetchall())
    out = decontamination.op3(spark, SF)
    assert sorted(tuple(r) for r in out.select("doc_id", "item_id", "n_shared", "n_item", "containment").collect()) == want and want
    clean = decontamination.clean(real, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert clean.columns == real.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in real.collect()} - {w[0] for w in want}


def test_decontamination_cases(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_ITEMS", 3)
    rng = random.Random(6)
    text = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([5, 8, 9, 16, 17, 33, 60, 64, 65, 140, 300])] + [(20, "Three short Words"), (21, None), (22, " "), (9, text(30)), (1, text(12))]
    docs = [(i, f"{text(rng.randint(0, 2500))} {t.upper() if i % 2 else t} {text(rng.randint(0, 2500))}") for i, t in items if t and t.strip()]
    most = items[6][1].split()
    docs += [(100, " ".join(most[:52] + ["x"] + most[53:])), (101, " ".join(most[:30])), (102, None), (103, ""), (104, "three short"), (105, items[0][1])]
    got = sorted(tuple(r)[:2] for r in decontamination.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect())
    sets = [(i, decontamination.shingles(decontamination.words(t or "")), len(decontamination.words(t or ""))) for i, t in items]
    want = []
    for d, t in docs:
        w = decontamination.words(t or "")
        for i, s, n in sets:
            has = {b" ".join(w[j : j + min(5, n)]) for j in range(len(w) - min(5, n) + 1)} if n else set()
            if s and len(s & has) >= 0.8 * len(s):
                want.append((d, i))
    assert got == sorted(want)
    assert decontamination.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_decontamination_items_of_few_shingles():
    """Each item of 5 to 9 words is found in a long document: the minima of a window missed some."""
    rng = random.Random(23)
    text = lambda n: [f"v{rng.randrange(90_000)}" for _ in range(n)]
    items = [text(5 + i % 5) for i in range(1500)]
    docs = [[w.encode() for w in text(40) + x + text(40)] for x in items] + [[], [b"one"]]
    index, codes = decontamination.ItemIndex(list(range(1500)), [" ".join(x) for x in items]), decontamination.WordCodes()
    hashes = [decontamination.shingle_hashes(codes.hashes_of(d), 5) if len(d) >= 5 else np.zeros(0, np.uint64) for d in docs]
    assert {(d, i) for d, i, _ in index.matches(docs, hashes, 0.8)} == {(i, i) for i in range(1500)}


def check_shards(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert all(0 <= s < shards for s in by)
    for at in by.values():
        assert sorted(r.slot for r in at) == list(range(len(at)))
    return {s: sum(r.size for r in at) for s, at in by.items()}


def test_sharding(spark, real):
    rows = sharding.op6(spark, SF).collect()
    sizes, total, most = check_shards(rows, 40), sum(r.size for r in rows), max(r.size for r in rows)
    assert len(rows) == real.count() and max(sizes.values()) <= total / 40 + most
    import zlib

    text = {r.doc_id: r.text for r in real.collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 16 and r.law == "bytes" and r.grown_shard is None for r in rows)


def test_sharding_hot_text(spark):
    """A text with most of the rows falls apart; nulls, ties and repeated rows are all placed."""
    rows = [(i, "hot text") for i in range(6000)] + [(i, f"t{i}") for i in range(6000, 8000)] + [(None, None), (None, None), (7, "hot text"), (7, "hot text")]
    text = F.coalesce(F.col("text"), F.lit(""))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), sharding.order_key(text, F.col("doc_id")).alias("key"), F.lit("x").alias("shard"))
    placed = sharding.assign_shards(df, 7).collect()
    sizes = check_shards(placed, 7)
    assert len(placed) == len(rows) and len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 7 + 200
    assert sharding.assign_shards(df.limit(0), 7).count() == 0


def test_sharding_repeated_rows(spark):
    """Rows without an id and of one text are dealt out like any others."""
    rows = [(None, "x" * 14) for _ in range(3000)] + [(i, f"{i:014}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("doc_id", "text", (F.octet_length("text") + 16).cast("long").alias("size"), sharding.order_key(F.col("text"), F.col("doc_id")).alias("key")).checkpoint()
    placed = sharding.assign_shards(df, 8).collect()
    sizes = check_shards(placed, 8)
    assert sorted((r.doc_id or -1, r.text) for r in placed) == sorted((i or -1, t) for i, t in rows)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 2 * 30


@pytest.mark.parametrize("copied", [50, 200, 1400])
def test_sharding_many_hot_texts(monkeypatch, copied):
    """Many texts with more rows than a piece may hold: all of them are cut, within the bound of probes."""
    rng = np.random.default_rng(copied)
    n, shards = 300_000, 40
    text = np.concatenate([np.zeros(n // 3, np.int64), 1 + rng.integers(0, copied, n if copied > 1000 else n // 5), np.arange(2 * copied, 2 * copied + n // 2)])
    high = rng.integers(0, 1 << 39, text.max() + 1)
    keys = np.sort((high[text] << 24) | rng.integers(0, 1 << 24, len(text)))
    most = []

    def histogram(rows, probes):
        most.append(len(probes))
        counts = np.diff(np.concatenate([[0], np.searchsorted(keys, probes), [len(keys)]]))
        return counts * 100, counts

    monkeypatch.setattr(sharding, "histogram", histogram)
    _, bytes_, rows = sharding.refine(None, shards)
    sizes = np.bincount(sharding.place(bytes_, rows, shards)[0], bytes_, shards)
    assert rows.max() <= max(sharding.PIECE * len(keys), 64) and max(most) <= sharding.MOST_PROBES and len(most) < 30
    assert np.abs(sizes - sizes.mean()).max() <= 2 * sharding.TOLERANCE * sizes.mean() + 200


def test_pipeline(spark, real):
    """Each stage against a plain version of it on its own input."""
    docs, names = real, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "near dedup", "decontamination", "byte BPE"]
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        steps.append((docs, out))
        docs = out
    assert all(out.columns == real.columns for _, out in steps[:-1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[0][1].collect()}
    assert all(i in kept for i, q in labels.items() if q == 1) and sum(i in kept for i, q in labels.items() if q == 0) <= 0.2 * sum(q == 0 for q in labels.values()) + 1
    before, after = ({r.doc_id: r for r in d.collect()} for d in steps[1])
    want = plain_lines(sorted((i, r.text) for i, r in before.items()))
    assert {i: r.text for i, r in after.items()} == want and all(r.n_chars == len(r.text) for r in after.values())
    before, after = (sorted(d.collect(), key=lambda r: r.doc_id) for d in steps[2])
    top = brute_near([r.text for r in before])
    assert [r.doc_id for r in after] == [r.doc_id for i, r in enumerate(before) if top[i] == i]
    leaks = {r.doc_id for r in decontamination.find_items(steps[3][0], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in steps[3][1].collect()} == {r.doc_id for r in steps[3][0].collect()} - leaks
    assert sorted(map(tuple, steps[4][1].collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))


def test_pipeline_odd_input(spark, tmp_path, real):
    """An empty table, and one with nulls, goes through all stages."""
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    odd = real.limit(3).unionByName(spark.createDataFrame([(None, None, None, None, None), (900, None, "en", None, 3), (901, "", "en", None, 0)], real.schema))
    for docs, n in ((real.limit(0), 0), (odd, 5)):
        docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path)).count() <= n
