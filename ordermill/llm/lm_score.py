"""LM scoring: subword lattice likelihood.

The pieces of an existing tokenizer are the vocabulary.  Their unigram scores
are learned from the corpus: the training tokens' segmentations are counted
over the distinct words, smoothed, and normalised.  A word's probability sums
over *all* its segmentations, by a forward recursion in log space; words start
with the vocabulary's word mark, so a text's probability is the product over
its words and its end.  A word-unigram score is given beside it.

Counts are aggregated by word on Spark.  At most ``head`` words, the most
frequent by a histogram of the counts, travel to every task; the other words
of each text are joined with the word table.

Cases: a null text is empty (one end token); words the pieces cannot spell
fall back to byte pieces; without training rows all counts are 0 and the
scores are uniform; repeated rows are scored each; rows with a null id are
scored, kept out of training and not held out; only id and text are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import id_bucket, held_out, table, text_bytes

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 150_000
SMOOTH = 0.1
FLUSH = 1_000_000  # distinct words a task holds before it passes counts on
WORD_MARK = "▁"
END = "</s>"
LN10 = math.log(10.0)


def load_pieces(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


# --- word counts ---------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, learn) -> partial (word, count); words of other rows count 0."""
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.binary()),
                                          "n": pa.array(list(counts.values()), pa.int64())})
        counts.clear()
        return out

    for batch in batches:
        for text, learn in zip(batch.column(0), batch.column(1).to_pylist()):
            found = tokens(text.as_py())
            if learn:
                counts.update(found)
            else:
                for w in found:
                    counts.setdefault(w, 0)
            if len(counts) > FLUSH:
                yield flush()
    yield flush()


def count_words(rows: DataFrame) -> DataFrame:
    """``rows``: text bytes and ``learn``.  One row per distinct word: its training count."""
    partial = rows.select("text", "learn").mapInArrow(_count_words, "word binary, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


# --- pieces --------------------------------------------------------------

def count_pieces(words: DataFrame, model: bytes) -> DataFrame:
    """Training counts of the pieces, from each distinct word's segmentation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts = load_pieces(model), Counter()
        for batch in batches:
            spelled = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            for ids, n in zip(pieces.encode(spelled, num_threads=1), batch.column(1).to_pylist()):
                for i in ids:
                    counts[i] += n
        yield pa.RecordBatch.from_pydict({"piece": pa.array(list(counts), pa.int64()),
                                          "n": pa.array(list(counts.values()), pa.int64())})

    return (words.filter("n > 0").select("word", "n").mapInArrow(run, "piece bigint, n bigint")
            .groupBy("piece").agg(F.sum("n").alias("n")))


def piece_scores(counts: dict[int, int], ends: int, model: bytes) -> dict[str, float]:
    """Natural-log probability of every piece and of the end; they sum to 1."""
    pieces = load_pieces(model)
    ids = [i for i in range(pieces.vocab_size()) if not (pieces.is_control(i) or pieces.is_unknown(i))]
    whole = math.log(sum(counts.values()) + ends + SMOOTH * (len(ids) + 1))
    scores = {pieces.id_to_piece(i): math.log(counts.get(i, 0) + SMOOTH) - whole for i in ids}
    scores[END] = math.log(ends + SMOOTH) - whole
    return scores


def lattice(scores: dict[str, float]) -> Callable[[str], float]:
    """word -> natural log of the summed probability of all its segmentations."""
    longest = max((len(p) for p in scores), default=1)
    byte_scores = [scores.get(f"<0x{b:02X}>", -30.0) for b in range(256)]
    exp, log = math.exp, math.log

    def forward(word: str) -> float:
        text = WORD_MARK + word
        ahead = [0.0]  # ahead[i]: log probability of all ways to spell text[:i]
        for end in range(1, len(text) + 1):
            ways = []
            for start in range(max(0, end - longest), end):
                p = scores.get(text[start:end])
                if p is not None:
                    ways.append(ahead[start] + p)
            if text[end - 1] not in scores:  # no piece for the character: its bytes
                ways.append(ahead[end - 1] + sum(byte_scores[b] for b in text[end - 1].encode("utf-8", "replace")))
            top = max(ways)
            ahead.append(top if len(ways) == 1 else top + log(sum([exp(w - top) for w in ways])))
        return ahead[-1]

    return forward


def score_words(words: DataFrame, scores: dict[str, float]) -> DataFrame:
    """Adds ``spelled``: the word's log10 probability under the lattice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forward = lattice(scores)
        for batch in batches:
            found = [forward(w.decode("utf-8", "replace")) / LN10 for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())],
                                             names=["word", "n", "spelled"])

    return words.select("word", "n").mapInArrow(run, "word binary, n bigint, spelled double")


# --- texts ---------------------------------------------------------------

def frequent(words: DataFrame, head: int) -> DataFrame:
    """The most frequent words, at most ``head``: the least count is read off
    a histogram over some hundred logarithmic steps."""
    step = F.floor(F.log2("n") * 8).cast("int")
    bars = words.filter("n > 0").groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    taken, least = 0, None
    for bar in bars:
        taken += bar["count"]
        if taken > head:
            break
        least = bar["step"]
    return words.filter("n > 0").filter(step >= least if least is not None else F.lit(False))


def _part_scores(common, word_base: Callable[[int], float]):
    """One row per text with what the common words give, one per other word.

    The first kind carries ``whole`` and a ``word`` with a space, which equals no token.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = common.value
        schema = pa.schema([("word", pa.binary()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("times", pa.int32()),
                            ("whole", pa.struct([("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                                                 ("base", pa.float64()), ("score", pa.float64())]))])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        rows: list[tuple] = []
        for batch in batches:
            for doc_id, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = text.as_py() or b""
                mark = xxhash.xxh3_64_intdigest(raw) - (1 << 63)
                found = tokens(raw)
                known, base, score = 0, 0.0, 0.0
                for w, times in Counter(found).items():
                    hit = known_words.get(w)
                    if hit is None:
                        rows.append((w, doc_id, mark, times, None))
                    else:
                        known, base, score = known + times, base + times * hit[0], score + times * hit[1]
                rows.append((b" %d" % mark, doc_id, mark, 1,
                             {"held_out": held, "n_tokens": len(found) + 1, "known": known, "base": base, "score": score}))
                if len(rows) > 20_000:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)

    return run


def score_texts(docs: DataFrame, learn, path: str = PIECES, head: int = HEAD, id_col: str = "doc_id",
                text_col: str = "text", held=None) -> DataFrame:
    """One row per row of ``docs``: counts, word-unigram and lattice log10 scores."""
    spark = docs.sparkSession
    with open(path, "rb") as f:  # read once here and sent along: workers need no file
        model = f.read()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"),
                       (F.lit(False) if held is None else held).alias("held_out"))
    base = scratch_path(spark, "lm")
    count_words(rows).write.parquet(f"{base}/counts")
    counts = spark.read.parquet(f"{base}/counts")
    ends = rows.filter("learn").count()
    found = counts.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    total, distinct = (found[0] or 0) + ends, found[1] + (ends > 0)
    scores = piece_scores({r["piece"]: r["n"] for r in count_pieces(counts, model).collect()}, ends, model)
    score_words(counts, scores).write.parquet(f"{base}/words")
    words = spark.read.parquet(f"{base}/words")

    norm = total + SMOOTH * (distinct + 1)

    def word_base(n: int) -> float:
        return math.log10((n + SMOOTH) / norm)

    common = {bytes(r["word"]): (word_base(r["n"]), r["spelled"]) for r in frequent(words, head).toLocalIterator()}
    shared = spark.sparkContext.broadcast(common)
    parts = rows.select("doc_id", "held_out", "text").mapInArrow(
        _part_scores(shared, word_base),
        "word binary, doc_id bigint, mark bigint, times int, whole struct<held_out:boolean,n_tokens:bigint,known:bigint,"
        "base:double,score:double>")
    joined = parts.join(words, "word", "left")
    tail = F.col("whole").isNull()
    n = F.coalesce("n", F.lit(0))
    per_text = joined.groupBy("doc_id", "mark").agg(
        F.count("whole").alias("rows"), F.first("whole", ignorenulls=True).alias("whole"),
        F.sum(F.when(tail & (n > 0), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(tail, F.col("times") * F.log10((n + SMOOTH) / F.lit(norm))).otherwise(0.0)).alias("base"),
        F.sum(F.when(tail, F.col("times") * F.col("spelled")).otherwise(0.0)).alias("score"))
    end_known, end_base, end_score = int(ends > 0), word_base(ends), scores[END] / LN10
    copies = F.explode(F.sequence(F.lit(1), F.col("rows")))  # equal rows of one id were summed together
    return (per_text.withColumn("copy", copies)
            .select("doc_id", "whole.held_out", "whole.n_tokens",
                    (F.col("whole.known") + (F.col("known") / F.col("rows")).cast("bigint") + end_known).alias("n_known"),
                    F.lit(total).cast("bigint").alias("train_tokens"),
                    (F.col("whole.base") + F.col("base") / F.col("rows") + end_base).alias("base_score"),
                    (F.col("whole.score") + F.col("score") / F.col("rows") + end_score).alias("score")))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), learn=id_bucket("doc_id", 10) != 0,
                       held=held_out("doc_id", 10, 0))
