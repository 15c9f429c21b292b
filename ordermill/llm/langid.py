"""Language ID: averaged hashed subword embeddings and a linear softmax.

The text's letters, lower-cased, are cut into byte n-grams that see word
borders; each n-gram is hashed to an embedding, the mean embedding goes
through a linear softmax.  Both are trained by stochastic gradient descent in
numpy on a bounded sample of labelled whole texts: some ``per_lang`` rows of
each language, and fewer if their texts take more than ``SAMPLE_BYTES``.  The
driver holds these texts and the bag of n-grams of one at a time (a bag is
several times as long as its text).  More than ``MAX_LANGS`` labels are an error, not
cut off.  The model takes 4 MB, and 64 kB a language.

A fifth of the sample is kept apart to scale the confidence and to place the
two rejection limits: the confidence, and, as a softmax is confident on what it
never saw, how usual the n-grams are for the predicted language (mean log
frequency against that of its own texts).  Each lies halfway between the least
right predictions and texts with shuffled letters (the second also texts of a
left-out language).

Cases: null texts and texts without a letter are ``und`` with score 0 and
rejected; a table without labelled rows, or an empty one, predicts ``und``
everywhere; repeated rows get equal predictions; a null id is used neither as
held out nor for learning; equal scores go to the first language in sorted
order; under ``LEAST_TEXTS`` labelled texts are too few to say which n-grams are
usual; a very long text is cut into n-grams whole; predictions read the text
only, training the id, text and lang, and other columns pass through untouched
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, id_bucket, spark_struct, structs, table, text_bytes, unit_hash

BUCKET_BITS = 16
DIM = 16
GRAMS = (2, 3, 4)
EPOCHS = 6
RATE = 1.0
PER_LANG = 1500
MAX_LANGS = 4000
SAMPLE_BYTES = 32 << 20  # of text, expected
ACCEPT_SHARE = 0.999  # of right calibration predictions that stay accepted
LEAST_TEXTS = 50  # to keep a fifth apart
FEW_GRAMS = 20.0  # so many n-grams count half against a text
UNKNOWN = "und"
LOG_STEP = -0.1  # of stored log frequencies, 256 of them
#: ASCII letters lower-cased, bytes of other scripts kept, the rest a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
ASCII_LETTER = re.compile("[A-Za-z]")
FIELDS = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])


Bag = tuple[np.ndarray, np.ndarray]  # distinct buckets and how often each occurs


@dataclass
class LangModel:
    langs: list[str]
    table: np.ndarray  # bucket -> embedding
    out: np.ndarray  # language -> weights of the softmax layer
    bias: np.ndarray
    temperature: float
    threshold: float
    known: np.ndarray | None = None  # bucket, language -> log frequency in steps of LOG_STEP
    usual: np.ndarray | None = None  # its mean over a language's own texts
    least: float = -np.inf  # least familiarity that is accepted


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text)


def gram_buckets(text: str) -> np.ndarray:
    """Hash buckets of all n-grams of the whole text."""
    raw = b" %b " % b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS).split())
    at = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    found = []
    for n in GRAMS:
        if len(at) >= n:
            key = at[:len(at) - n + 1].copy()
            for i in range(1, n):
                key |= at[i:len(at) - n + 1 + i] << np.uint32(8 * i)
            found.append(((key + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def bag_of(grams: np.ndarray) -> Bag:
    times = np.bincount(grams, minlength=1 << BUCKET_BITS)
    found = np.flatnonzero(times)
    return found, times[found]


def mean_of(values: np.ndarray, bag: Bag) -> np.ndarray:
    """Mean of the buckets' values over the bag."""
    return bag[1].astype(np.float64) @ values[bag[0]] / bag[1].sum()


def familiarity(known: np.ndarray, usual: np.ndarray, lang: int, bag: Bag) -> float:
    """How usual the text's n-grams are for the language; 0 as in its own texts, few n-grams weigh less."""
    n = int(bag[1].sum())
    return float((mean_of(known[:, lang], bag) * LOG_STEP - usual[lang]) * n / (n + FEW_GRAMS))


def shuffled_letters(text: str, rng: np.random.Generator) -> str:
    """The text's letters in random order; all else stays in place."""
    letters = iter(rng.permutation([c for c in text if c.isalpha()]).tolist())
    return "".join(next(letters) if c.isalpha() else c for c in text)


def bag(text: bytes) -> Bag:
    return bag_of(gram_buckets(text.decode("utf-8", "replace")))


def noise_bag(text: bytes) -> Bag:
    """The bag of the text with shuffled letters."""
    return bag_of(gram_buckets(shuffled_letters(text.decode("utf-8", "replace"), np.random.default_rng(zlib.crc32(text)))))


def usual_grams(texts: list[bytes], y: np.ndarray, fit: np.ndarray, apart: np.ndarray, logits) -> tuple[np.ndarray, np.ndarray, float]:
    """(known, usual, least) of a LangModel: counted on ``fit``, placed on ``apart``."""
    langs = int(y.max()) + 1
    counts = np.full((1 << BUCKET_BITS, langs), 0.5, np.float32)
    for i in fit:
        found, times = bag(texts[i])
        counts[found, y[i]] += times
    known = np.clip(np.rint(np.log(counts / counts.sum(axis=0)) / LOG_STEP), 0, 255).astype(np.uint8)
    del counts
    own: dict[int, list[float]] = {}
    for i in apart:
        mine = bag(texts[i])
        if len(mine[0]):
            own.setdefault(int(y[i]), []).append(mean_of(known[:, y[i]], mine) * LOG_STEP)
    every = np.mean([v for held in own.values() for v in held] or [0.0])
    usual = np.array([np.mean(own[lang]) if lang in own else every for lang in range(langs)])
    right, wrong = [], []
    for i in apart:
        mine, noise = bag(texts[i]), noise_bag(texts[i])
        if not len(mine[0]):
            continue
        z = logits(mine)
        if int(z.argmax()) == y[i]:
            right.append(familiarity(known, usual, y[i], mine))
        if langs > 1:  # as if its language had not been learned
            z[y[i]] = -np.inf
            wrong.append(familiarity(known, usual, int(z.argmax()), mine))
        if len(noise[0]):
            wrong.append(familiarity(known, usual, int(logits(noise).argmax()), noise))
    if not right:
        return known, usual, -np.inf
    least = float(np.quantile(right, 1 - ACCEPT_SHARE))
    return known, usual, min(least, (least + float(np.median(wrong))) / 2 if wrong else least)


def train(texts: list[str | bytes], labels: list[str], seed: int = 5) -> LangModel | None:
    texts = [t.encode("utf-8", "replace") if isinstance(t, str) else t for t in texts]
    langs = sorted(set(labels))
    if not langs:
        return None
    place = {v: i for i, v in enumerate(langs)}
    y = np.array([place[v] for v in labels])
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((len(langs), DIM), np.float32), np.zeros(len(langs), np.float32)
    order = rng.permutation(len(texts))
    apart, fit = (order[:len(order) // 5], order[len(order) // 5:]) if len(order) >= LEAST_TEXTS else (order, order)
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            u, times = bag(texts[i])
            share = (times / max(int(times.sum()), 1)).astype(np.float32)[:, None]
            rate, done = RATE * (1 - done / steps), done + 1
            mean = (emb[u] * share).sum(axis=0)
            grad = softmax(out @ mean + bias)
            grad[y[i]] -= 1
            back = grad @ out
            out -= rate * np.outer(grad, mean)
            bias -= 0.1 * rate * grad
            emb[u] -= (rate * 10) * share * back
    logits = lambda mine: out @ (mean_of(emb, mine) if len(mine[0]) else np.zeros(DIM)) + bias
    held = np.array([logits(bag(texts[i])) for i in apart])
    grid = np.geomspace(0.1, 20, 60)
    grid = grid[grid >= 1]  # a sample without errors is no reason to sharpen
    loss = [-np.log(softmax(held / t)[np.arange(len(apart)), y[apart]] + 1e-12).mean() for t in grid]
    heat = float(grid[int(np.argmin(loss))])
    p = softmax(held / heat)
    right = p.max(axis=1)[p.argmax(axis=1) == y[apart]]
    least = float(np.quantile(right, 1 - ACCEPT_SHARE)) if len(right) else 0.0
    unsure = [softmax(logits(noise) / heat).max() for noise in (noise_bag(texts[i]) for i in apart) if len(noise[0])]
    if unsure:
        least = min(least, (least + float(np.median(unsure))) / 2)
    model = LangModel(langs, emb, out, bias, heat, least)
    if len(order) >= LEAST_TEXTS:
        model.known, model.usual, model.least = usual_grams(texts, y, fit, apart, logits)
    return model


def predict(model: LangModel | None, text: str | None) -> tuple[str, float, bool]:
    if model is None or text is None or not has_letter(text):
        return UNKNOWN, 0.0, False
    mine = bag_of(gram_buckets(text))
    p = softmax((model.out @ mean_of(model.table, mine) + model.bias) / model.temperature)
    best = int(p.argmax())
    accepted = p[best] >= model.threshold and (
        model.known is None or familiarity(model.known, model.usual, best, mine) >= model.least)
    return model.langs[best], float(p[best]), bool(accepted)


def fit(docs: DataFrame, per_lang: int = PER_LANG, learn: Column | None = None) -> LangModel | None:
    """Train on rows of ``docs`` (doc_id, text, lang) where ``learn`` holds.
    The sample is drawn by a hash of the id, at most ``2 * per_lang * languages``
    rows; of each language it is the share that keeps both limits."""
    rows = docs.filter("text is not null and lang is not null")
    rows = rows if learn is None else rows.filter(learn)
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).limit(MAX_LANGS + 1).collect()
    if not sizes:
        return None
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} language labels")
    shares = {r["lang"]: min(1.0, per_lang / r["n"], SAMPLE_BYTES / len(sizes) / max(r["bytes"], 1)) for r in sizes}
    share = F.element_at(F.create_map(*[F.lit(v) for pair in shares.items() for v in pair]), F.col("lang"))
    sample = rows.filter(unit_hash(F.col("doc_id"), seed=9) < share).select("doc_id", text_bytes().alias("text"), "lang")
    got = sample.limit(2 * per_lang * len(sizes)).toArrow().sort_by("doc_id")
    return train(got.column("text").to_pylist(), got.column("lang").to_pylist())


def language(model: LangModel | None, text_col: str = "text") -> Column:
    """A struct (lang_pred, score, accepted) of the whole text."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf(spark_struct(FIELDS))
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield structs([predict(shared.value, v.as_py()) for v in batch], FIELDS)

    return run(F.col(text_col).cast("string"))


def learning_rows() -> Column:
    return id_bucket("doc_id", 4) != 2


def keep_languages(docs: DataFrame, model: LangModel | None, text_col: str = "text") -> DataFrame:
    """Rows whose language is recognised; rejected ones go."""
    return docs.filter(language(model, text_col)["accepted"])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, learn=learning_rows())
    return (docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), language(model).alias("p"))
            .select("doc_id", "held_out", "p.*"))
