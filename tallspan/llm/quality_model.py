"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Statistics are Spark column expressions. On a bounded sample of labelled rows, small boosted trees propose
splits; every path of a tree, from the root to any node, is a rule (a conjunction of thresholds). A lasso
logistic regression, fitted by proximal gradients, keeps few rules, and those are compiled into one Spark column
that scores every document inside the JVM.

Null and empty texts have statistics of zero and are scored like any other. With no labels, or labels of one
class, every score is the (smoothed) share of good labels. Extra columns are not read by the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flagged_values, fraction, read

#: Labelled rows that the model is fitted on, at most about so many; chosen by a hash of doc_id.
MOST_LABELLED = 20_000
CUT = 0.7


NAMES = ("words", "word_chars", "distinct_words", "richness", "repeats", "words_per_line", "distinct_lines", "symbols", "bars", "marks", "stops", "digits", "upper")


def with_statistics(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """docs with an array of the statistics NAMES; words and lines are split once for each text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.withColumn("__words", F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")).withColumn("__lines", F.split(text, "\n"))
    words, lines = F.col("__words"), F.col("__lines")
    counted = split.withColumn("__distinct", F.size(F.array_distinct(words)))
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n_words, n_lines = F.greatest(F.size(words), F.lit(1)).cast("double"), F.size(lines).cast("double")
    without = lambda signs: F.length(text) - F.length(F.translate(text, signs, ""))
    shifted = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    values = {
        "words": F.size(words),
        "word_chars": F.length(F.translate(text, " \n\t", "")) / n_words,
        "distinct_words": F.col("__distinct") / n_words,
        "richness": F.col("__distinct") / F.sqrt(n_words),
        "repeats": F.size(F.filter(F.zip_with(words, shifted, lambda a, b: a == b), lambda same: same)) / n_words,
        "words_per_line": n_words / n_lines,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "symbols": without("#*$%&<>=_~^@{}[]") / chars,
        "bars": without("|") / chars,
        "marks": without("!?") / chars,
        "stops": without(".,;:") / chars,
        "digits": without("0123456789") / chars,
        "upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")) / chars,
    }
    return counted.withColumn(name, F.array(*(values[k].cast("double") for k in NAMES))).drop("__words", "__lines", "__distinct")


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, threshold), all of which hold


@dataclass(frozen=True)
class RuleModel:
    names: tuple[str, ...]
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def column(self, stats: Column) -> Column:
        """The score of an array of statistics: 1 / (1 + exp(-(bias + weights of the rules that hold))).

        The rules are one constant, so the expression stays small however many there are.
        """
        if not self.rules:
            return F.lit(float(1 / (1 + np.exp(-self.bias))))
        part = lambda i, above, t: F.struct(F.lit(i).alias("i"), F.lit(above).alias("above"), F.lit(float(t)).alias("t"))
        rules = F.array(*(F.struct(F.array(*(part(*c) for c in r)).alias("all"), F.lit(float(w)).alias("w")) for r, w in zip(self.rules, self.weights, strict=True)))
        holds = lambda s, r: F.forall(r["all"], lambda c: (F.get(s, c["i"]) > c["t"]) == c["above"])
        total = lambda s: F.aggregate(rules, F.lit(float(self.bias)), lambda z, r: z + F.when(holds(s, r), r["w"]).otherwise(F.lit(0.0)))
        z = F.get(F.transform(F.array(stats), total), F.lit(0))  # bound as a lambda's argument, so it is computed once a row
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self.bias + sum((w * holds(r, x) for r, w in zip(self.rules, self.weights, strict=True)), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for i, above, t in rule:
        out &= x[:, i] > t if above else x[:, i] <= t
    return out


def grow(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], depth: int, least: int, rng: np.random.Generator, path: Rule = ()) -> tuple[list[tuple[Rule, float]], list[Rule]]:
    """A regression tree: its leaves with their means, and all paths. Of equal splits the first wins."""
    best = None
    if depth and len(target) >= 2 * least:
        total, n = target.sum(), len(target)
        for i in np.sort(rng.permutation(len(cuts))[: (len(cuts) + 1) // 2]):  # half of the statistics, so that rules differ
            at = cuts[i]
            left = np.searchsorted(at, x[:, i], "left")  # x <= at[k] exactly where left <= k
            count = np.cumsum(np.bincount(left, minlength=len(at) + 1))[:-1]
            part = np.cumsum(np.bincount(left, target, minlength=len(at) + 1))[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = part**2 / count + (total - part) ** 2 / (n - count) - total**2 / n
            gain[(count < least) | (n - count < least)] = -1
            if len(gain) and (k := int(gain.argmax())) >= 0 and gain[k] > 1e-9 and (best is None or gain[k] > best[0] + 1e-12):
                best = (gain[k], int(i), float(at[k]))
    if best is None:
        return [(path, float(target.mean()) if len(target) else 0.0)], [path] if path else []
    _, i, t = best
    low = x[:, i] <= t
    leaves, paths = [], [path] if path else []
    for above, rows in ((False, low), (True, ~low)):
        a, b = grow(x[rows], target[rows], cuts, depth - 1, least, rng, (*path, (i, above, t)))
        leaves += a
        paths += b
    return leaves, paths


def fit(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], trees: int = 40, depth: int = 3, rate: float = 0.2, penalty: float = 0.0005, rounds: int = 600) -> RuleModel:
    base = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
    if len(np.unique(y)) < 2:
        return RuleModel(names, (), (), float(np.log(base / (1 - base))))
    rng, cuts = np.random.default_rng(11), []
    for i in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, i], np.linspace(0, 1, 66)[1:-1]))
        cuts.append((q[:-1] + q[1:]) / 2 if len(q) > 1 else q)
    z, rules, least = np.full(len(y), np.log(base / (1 - base))), {}, max(3, len(y) // 500)
    for _ in range(trees):
        part = rng.random(len(y)) < 0.6
        leaves, paths = grow(x[part], (y - 1 / (1 + np.exp(-z)))[part], cuts, depth, least, rng)
        rules.update(dict.fromkeys(paths))
        for rule, mean in leaves:
            z += rate * 4 * mean * holds(rule, x)
    rules = list(rules)
    r = np.stack([holds(k, x) for k in rules], 1).astype(float)
    r = np.column_stack([r, np.ones(len(y))])
    w = np.zeros(r.shape[1])
    w[-1] = np.log(base / (1 - base))
    ahead, speed, pace = w.copy(), 4 * len(y) / max(np.linalg.norm(r, 2) ** 2, 1e-9), 1.0
    for _ in range(rounds):  # accelerated proximal gradient; the bias goes free
        new = ahead - speed * (r.T @ (1 / (1 + np.exp(-(r @ ahead))) - y)) / len(y)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - speed * penalty, 0)
        later = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = new + (pace - 1) / later * (new - w), new, later
    kept = np.flatnonzero(np.abs(w[:-1]) > 1e-4)
    return RuleModel(names, tuple(rules[k] for k in kept), tuple(float(w[k]) for k in kept), float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> RuleModel:
    """From docs (doc_id, text) and labels (doc_id, quality); the sample is bounded by MOST_LABELLED."""
    labels = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = labels.count()
    known = fraction(labels, "doc_id", MOST_LABELLED / max(n, 1)).limit(2 * MOST_LABELLED)
    rows = with_statistics(flagged_values(docs.select("doc_id", text_col), known, 2 * MOST_LABELLED), "x", text_col).select("quality", "x").toPandas()
    x = np.stack(rows["x"]).astype(float) if len(rows) else np.zeros((0, len(NAMES)))
    return fit(x, rows["quality"].to_numpy(float), NAMES)


def score(docs: DataFrame, model: RuleModel, name: str = "score", text_col: str = "text") -> DataFrame:
    """docs with the score in a new column (in place of one of that name, if any)."""
    return with_statistics(docs.drop(name), "__stats", text_col).withColumn(name, model.column(F.col("__stats"))).drop("__stats")


def held_out(share: int, at: int) -> Column:
    """Whether labels of this doc_id are held out; false for a null id, which has no label."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(share)) == at, F.lit(False))


def op2(spark, sf_dir: str) -> DataFrame:
    docs, held = read(spark, sf_dir, "documents").select("doc_id", "text"), held_out(4, 2)
    model = train(docs, read(spark, sf_dir, "labels").filter(~held).select("doc_id", "quality"))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
