"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all else, labelled or not, is unlabelled and holds toxic documents
at a known rate, the class prior. A linear classifier in numpy minimises the prior-corrected risk
prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]); where the second part falls below zero its
gradient is turned round, so the classifier can't fit unlabelled positives as negatives.

Features are a document's distinct words and the 4- and 5-character pieces of them, hashed. Of a bounded sample
(MOST_POSITIVE and MOST_UNLABELLED documents, whole texts) the features are chosen that stand out among positives.
All documents are scored whole, in one narrow pass.

Null and empty texts get the score of no evidence. Without positives all scores are 0. Repeated rows get a row
each; a null doc_id has no label and is not held out. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MEMO, arrow_schema, fraction, map_rows, prepare, read, texts, with_checkpoints

BUCKETS = 1 << 22
#: Bounds of the training sample, in documents, and of the features kept.
MOST_POSITIVE, MOST_UNLABELLED, MOST_FEATURES = 3000, 9000, 2000
#: A feature needs this share of the positives, and this estimated share of toxic documents among those that have it.
LEAST_SUPPORT, LEAST_PURITY = 0.02, 0.7


def pieces(word: str) -> set[int]:
    """Hashed features of a word, with its borders marked."""
    w = f" {word} "
    out = {zlib.crc32(w.encode())}
    for n in (4, 5):
        out.update(zlib.crc32(w[i : i + n].encode(), n) for i in range(len(w) - n + 1))
    return {x & (BUCKETS - 1) for x in out}


class PieceMemo(dict):
    def __missing__(self, word: str) -> set[int]:
        if len(self) > MEMO // 4:
            self.clear()
        out = self[word] = pieces(word)
        return out


def words(text: str) -> set[str]:
    return {w.strip(".,;:!?()[]\"'|*#$%&<>") for w in text.lower().split()} - {""}


def feature_counts(sample: DataFrame) -> DataFrame:
    """bucket, n_positive, n_unlabelled: documents of the sample (text, positive) with each feature."""
    target = arrow_schema("bucket int, n_positive long, n_unlabelled long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, n = PieceMemo(), np.zeros((2, BUCKETS), np.int32)
        for b in batches:
            for text, positive in zip(b.column("text").to_pylist(), b.column("positive").to_pylist(), strict=True):
                has = set().union(*map(memo.__getitem__, words(text)))
                n[0 if positive else 1][np.fromiter(has, np.int64, len(has))] += 1
        at = np.flatnonzero(n.any(0))
        for i in range(0, len(at), 1 << 15):
            k = at[i : i + (1 << 15)]
            yield pa.RecordBatch.from_pydict({"bucket": k.astype(np.int32), "n_positive": n[0][k].astype(np.int64), "n_unlabelled": n[1][k].astype(np.int64)}, schema=target)

    return sample.mapInArrow(run, "bucket int, n_positive long, n_unlabelled long").groupBy("bucket").agg(F.sum("n_positive").alias("n_positive"), F.sum("n_unlabelled").alias("n_unlabelled"))


def fit(x: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float, rounds: int = 300, step: float = 0.03, decay: float = 1e-4) -> np.ndarray:
    """Weights and, last, the bias. x: the features of each document, counted once for each of its words.

    The loss is the sigmoid one: it is bounded, so a prior that is slightly off can't outweigh the evidence.
    """
    full = np.zeros((len(x), n_features + 1), np.float32)
    full[:, -1] = 1
    for i, r in enumerate(x):
        np.add.at(full[i], r, 1)
    np.log1p(full[:, :-1], out=full[:, :-1])
    p, u = full[positive], full[~positive]
    w = np.full(n_features + 1, 0.1, np.float32)
    w[-1] = -1
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(z @ w, -30, 30))) for z in (p, u))
        up, down = p.T @ (sp * (1 - sp)) / len(p), u.T @ (su * (1 - su)) / len(u)
        negative = down - prior * up  # of the risk on negatives, which can't be below zero
        grad = -prior * up + negative if su.mean() >= prior * sp.mean() else -negative
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w = w - step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        w[:-1] = np.maximum(w[:-1], 0)  # features were chosen as signs of toxicity
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, float], float]:
    """Weights by feature and the bias, from labels (doc_id, toxic) and all documents of docs (doc_id, text)."""
    spark = with_checkpoints(docs.sparkSession)
    seen = labels.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("p")).first()
    if not seen["p"]:
        return {}, -np.inf
    prior = float(min(max(seen["p"] / seen["n"], 0.001), 0.9))
    confirmed = fraction(labels.filter("toxic = 1").select("doc_id").distinct(), "doc_id", MOST_POSITIVE / seen["p"]).limit(2 * MOST_POSITIVE)
    known = F.broadcast(confirmed.withColumn("positive", F.lit(True)))  # at most 2 * MOST_POSITIVE ids
    share = min(1.0, MOST_UNLABELLED / max(1, docs.count()))
    # The unlabelled are drawn from all documents, confirmed ones included, as the prior is theirs.
    drawn = F.array(F.lit(True), F.lit(False)) if share >= 1 else F.when(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    sample = docs.join(known, "doc_id", "left").withColumn("as", F.explode(drawn)).filter(F.col("positive") | ~F.col("as")).select("text", F.col("as").alias("positive")).checkpoint()
    counts = feature_counts(sample)
    n = sample.groupBy("positive").count().toPandas().set_index("positive")["count"].to_dict()
    n_pos, n_unl = n.get(True, 0), n.get(False, 0)
    if not n_pos or not n_unl:
        return {}, -np.inf
    # The share of toxic documents among those with a feature is prior * P(feature | toxic) / P(feature).
    purity = F.lit(prior) * (F.col("n_positive") / n_pos) / ((F.col("n_unlabelled") + 1) / n_unl)
    enough = max(3, int(LEAST_SUPPORT * n_pos))
    chosen = counts.filter((F.col("n_positive") >= enough) & (purity >= LEAST_PURITY)).orderBy(F.col("n_positive").desc(), "bucket").limit(MOST_FEATURES).select("bucket").toPandas()["bucket"]
    index = {int(b): i for i, b in enumerate(chosen)}
    if not index:
        return {}, -np.inf

    def work():
        memo = PieceMemo()

        def each(c: dict) -> dict:
            return {"positive": c["positive"], "x": [[index[f] for w in words(t) for f in memo[w] if f in index] for t in c["text"]]}

        return each

    rows = map_rows(sample.select("text", "positive"), work, "positive boolean, x array<int>").toPandas()
    w = fit([np.asarray(r, np.int64) for r in rows["x"]], rows["positive"].to_numpy(bool), len(index), prior)
    return {b: float(w[i]) for b, i in index.items()}, float(w[-1])


class Evidence(dict):
    """The weights, by number, of a word's chosen features."""

    def __init__(self, index: dict[int, int]):
        self.index = index

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > MEMO:
            self.clear()
        out = self[word] = tuple(self.index[f] for f in pieces(word) if f in self.index)
        return out


def score(docs: DataFrame, weights: dict[int, float], bias: float, cut: float = 0.5) -> DataFrame:
    """doc_id, score, predicted of every document (doc_id, text)."""
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))  # at most MOST_FEATURES weights

    def work():
        weights, bias = model.value
        memo, w = Evidence({f: i for i, f in enumerate(weights)}), np.fromiter(weights.values(), np.float64, len(weights))

        def logit(text: str) -> float:
            found = [i for x in words(text) for i in memo[x]]
            return bias + float(np.log1p(np.bincount(found, minlength=len(w))) @ w) if found else bias

        def each(c: dict) -> dict:
            z = np.array([logit(t) for t in c["text"]])
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            s[np.isneginf(z)] = 0
            return {"doc_id": c["doc_id"], "score": s, "predicted": (s >= cut).astype(np.int32)}

        return each

    return map_rows(docs, work, "doc_id long, score double, predicted int")


def op10(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    docs = texts(read(spark, sf_dir, "documents"))
    labels = read(spark, sf_dir, "labels").filter("toxic is not null").filter(~held).select("doc_id", "toxic")
    weights, bias = train(docs.filter(~F.coalesce(held, F.lit(True))), labels)
    return score(docs, weights, bias).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
