"""Quality classifier: a sparse rule ensemble.

Shallow trees over text statistics are grown on resampled labelled rows; each
path from a root is a conjunctive rule (an interval per statistic).  A
logistic regression with a lasso penalty, fitted in numpy, keeps few of them.
The kept rules become Spark column expressions over the statistics columns.

The classifier is fitted on a bounded hash sample of labelled rows (``max_rows``
expected); every text is scored whole.

Cases: a null text has the statistics of an empty one, which are all 0; of
several labels of one id the lowest counts; null labels are not learned from;
without labelled rows, or with one class only, the score is that class's
share (0.5 without rows); repeated rows get equal scores; rows with a null id
are scored, neither learned from nor held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, id_bucket, spark_struct, structs, table, text_bytes, unit_hash
from .quality_rules import base_counts

MAX_ROWS = 8000
TREES = 40
DEPTH = 3
MIN_LEAF = 15
BINS = 48
MAX_RULES = 60
CUT = 0.3
STATISTICS = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
              "bang_share", "comma_share", "distinct_share", "words_per_line", "stop_lines", "packed_ratio",
              "one_letter_share")
FIELDS = pa.struct([(s, pa.float64()) for s in STATISTICS])
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))


def statistics(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, ...]:
    n_words, chars, symbols, dup_lines, repeats = base_counts(text)
    if not n_words:
        return (0.0,) * len(STATISTICS)
    size = len(text)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    without = lambda chars: size - len(text.translate(None, chars))
    return (float(n_words), chars / n_words, symbols / chars, dup_lines / len(lines), repeats / n_words,
            without(UPPER) / max(1, without(LETTERS)), without(DIGITS) / size, text.count(b"!") / n_words,
            text.count(b",") / n_words, len(set(words)) / n_words, n_words / len(lines),
            sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines), len(packer.compress(text)) / size,
            sum(len(w) == 1 for w in words) / n_words)


@F.arrow_udf(spark_struct(FIELDS))
def _statistics(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in texts:
        yield structs([statistics(v.as_py() or b"", packer) for v in batch], FIELDS)


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, lowest or -inf, highest or inf), low < x <= high."""
    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([(x[:, f] > lo) & (x[:, f] <= hi) for f, lo, hi in self.bounds])

    def column(self, stats: Column) -> Column:
        tests = []
        for f, lo, hi in self.bounds:
            value = stats[STATISTICS[f]]
            tests += [value > lo] * bool(lo > -np.inf) + [value <= hi] * bool(hi < np.inf)
        return reduce(lambda a, b: a & b, tests)

    def __str__(self) -> str:
        return " and ".join(f"{lo:.4g} < {STATISTICS[f]} <= {hi:.4g}" for f, lo, hi in self.bounds)


@dataclass
class Ensemble:
    bias: float
    weights: list[tuple[float, Rule]]

    def column(self, stats: Column) -> Column:
        """The score, 0 to 1, as a Spark column over the statistics."""
        z = F.lit(float(self.bias))
        for w, rule in self.weights:
            z = z + F.when(rule.column(stats), F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for w, rule in self.weights:
            z = z + w * rule.holds(x)
        return 1 / (1 + np.exp(-z))


def _split(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], features: np.ndarray) -> tuple[int, float] | None:
    """The (feature, cut) that lowers the squared error most."""
    best, found = 1e-9, None
    whole = y.sum() ** 2 / len(y)
    for f in features:
        at = np.searchsorted(cuts[f], x[:, f], side="left")
        n = np.cumsum(np.bincount(at, minlength=len(cuts[f]) + 1))[:-1]
        s = np.cumsum(np.bincount(at, weights=y, minlength=len(cuts[f]) + 1))[:-1]
        fit = (n >= MIN_LEAF) & (len(y) - n >= MIN_LEAF)
        if fit.any():
            gain = np.where(fit, s ** 2 / np.maximum(n, 1) + (y.sum() - s) ** 2 / np.maximum(len(y) - n, 1) - whole, 0)
            if gain.max() > best:
                best, found = gain.max(), (int(f), float(cuts[f][int(gain.argmax())]))
    return found


def grow(x: np.ndarray, y: np.ndarray, seed: int) -> list[Rule]:
    """Rules of all tree nodes below the roots, without repeats."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    rules: dict[tuple, Rule] = {}

    def node(rows: np.ndarray, bounds: dict[int, tuple[float, float]], depth: int) -> None:
        if bounds:
            key = tuple((f, lo, hi) for f, (lo, hi) in sorted(bounds.items()))
            rules.setdefault(key, Rule(key))
        if depth == DEPTH or len(rows) < 2 * MIN_LEAF:
            return
        features = rng.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False)
        found = _split(x[rows], y[rows], cuts, features)
        if found is None:
            return
        f, cut = found
        lo, hi = bounds.get(f, (-np.inf, np.inf))
        left = x[rows, f] <= cut
        node(rows[left], bounds | {f: (lo, min(hi, cut))}, depth + 1)
        node(rows[~left], bounds | {f: (max(lo, cut), hi)}, depth + 1)

    for _ in range(TREES):
        node(rng.choice(len(x), size=max(2, len(x) // 2), replace=False), {}, 0)
    return list(rules.values())


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, k = a.shape
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    v, vb, t = w.copy(), b, 1.0
    rate = 4.0 / (np.linalg.norm(a, 2) ** 2 / n + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a @ v + vb)))
        g, gb = a.T @ (p - y) / n, (p - y).mean()
        nw, nb = v - rate * g, vb - rate * gb
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return b, w


def fit_ensemble(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Ensemble:
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Ensemble(float(np.log((share + 1e-4) / (1 - share + 1e-4))), [])
    rules = grow(x, y, seed)
    if not rules:
        return Ensemble(float(np.log(y.mean() / (1 - y.mean()))), [])
    a = np.array([r.holds(x) for r in rules], dtype=float).T
    apart = np.random.default_rng(seed).random(len(y)) < 0.2
    if apart.all() or not apart.any():
        apart = np.zeros(len(y), bool)
    best = None
    for penalty in (0.0005, 0.001, 0.002, 0.005, 0.01):
        b, w = lasso(a[~apart], y[~apart], penalty)
        test = apart if apart.any() else ~apart
        p = np.clip(1 / (1 + np.exp(-(a[test] @ w + b))), 1e-6, 1 - 1e-6)
        loss = -(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).mean()
        if best is None or loss < best[0] - 1e-4:
            best = (loss, penalty)
    b, w = lasso(a, y, best[1])
    keep = [i for i in np.argsort(-np.abs(w)) if abs(w[i]) > 1e-6][:MAX_RULES]
    if len(keep) < (np.abs(w) > 1e-6).sum():
        b, kept = lasso(a[:, keep], y, best[1])
        return Ensemble(b, [(float(v), rules[i]) for v, i in zip(kept, keep) if abs(v) > 1e-6])
    return Ensemble(b, [(float(w[i]), rules[i]) for i in keep])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", learn: Column | None = None,
        max_rows: int = MAX_ROWS) -> Ensemble:
    """Fit on documents with a label where ``learn`` (over ``doc_id``) holds.
    At most ``2 * max_rows`` ids are broadcast; only statistics reach the driver."""
    known = labels.select("doc_id", F.col(label_col).alias("label")).filter("label is not null and doc_id is not null")
    known = (known if learn is None else known.filter(learn)).groupBy("doc_id").agg(F.min("label").alias("label"))
    n = known.count()
    if n == 0:
        return fit_ensemble(np.zeros((0, len(STATISTICS))), np.zeros(0))
    picked = known.filter(unit_hash(F.col("doc_id"), seed=11) < F.lit(max_rows / n)).limit(2 * max_rows)
    sample = (docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(picked), "doc_id")
              .select("doc_id", "label", _statistics("text").alias("s")).select("doc_id", "label", "s.*")
              .toPandas().sort_values("doc_id"))
    return fit_ensemble(sample[list(STATISTICS)].to_numpy(float), sample["label"].to_numpy(float))


def scored(docs: DataFrame, model: Ensemble, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and the statistics of every text."""
    rows = docs.select("doc_id", _statistics(text_bytes(text_col)).alias("s"))
    score = model.column(F.col("s"))
    return rows.select("doc_id", score.alias("score"), (score >= cut).cast("int").alias("predicted"), "s.*")


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), learn=id_bucket("doc_id", 5) != 0)
    out = scored(docs, model).withColumn("held_out", held_out("doc_id", 5, 0))
    return out.select("doc_id", "held_out", "score", "predicted", *STATISTICS)
