"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Three-word n-grams of the test items, with and without a gap (``SHAPES``), are
looked up in every training text.  Those rare in the corpus are seeds, and, so that a copy repeated a million times
keeps seeds, the rarer half of every item's that occur at all and the rarest of
every run of words that alone would be a leak.  One seed joins a stretch of the
text to an item; so do some of the item's other n-grams close together, however
frequent each is.  The stretch is aligned to the item word by word (local
alignment with gaps), which finds edited copies; the score is relative to a
full match.

The test items are a stated query set: they go to every task in blocks of at
most ``block_words`` words, with two passes over the texts per block, so the
memory of a task does not depend on the size of the benchmark.  All pairing
and aligning happens where the text is read; nothing is grouped by item.

Cases: null and empty texts match nothing; items under three words cannot be
seeded and match nothing; an item with a null id is looked for like any other
and reported with that id; long items are cut to passages, each its own
target; a repeated item counts once, repeated texts are each reported; no
items or no texts give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: The words of a seed, counted from its first: three in a row, and with a gap,
#: which a copy with every third word changed still holds.
SHAPES = ((0, 1, 2), (0, 1, 3))
SEED_WORDS = len(SHAPES[0])
PASSAGE_WORDS = 200
BLOCK_WORDS = 1_000_000
BYTES_A_WORD = 6  # of an item, about
RARE_DOCS, RARE_SHARE = 5, 1e-4
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5  # of a full match
RUN_WORDS = 13  # so many equal words in a row leak an item too
CROWD_SHARE, CROWD_LEAST = 8, 2  # an eighth of a passage's n-grams close together, at least two, join like a seed
CHUNK_WORDS = 2_000  # of a text, whose n-grams are counted at a time
CROWD_SLOTS = 1 << 19  # places in passages that are held at a time
#: ASCII digits and letters, and all bytes beyond ASCII; the rest parts words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
HIT = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("run_words", pa.int32()),
                 ("first_word", pa.int32()), ("last_word", pa.int32())])
HIT_TYPE = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                                     T.StructField("run_words", T.IntegerType()), T.StructField("first_word", T.IntegerType()),
                                     T.StructField("last_word", T.IntegerType())]))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(WORD_BYTES).split()


@dataclass
class Block:
    """Test passages as word numbers (from 1; 0 is any other word) and their n-grams."""
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    passages: list[tuple[int, np.ndarray]] = field(default_factory=list)  # (item_id, word numbers)
    grams: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # sorted keys
    #: Where n-gram g stands: slots starts[g] to starts[g + 1] of (passage, position in it).
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    holder: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    place: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    by_holder: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # gram and passage of every slot
    crowd: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # n-grams that join, by passage

    def numbers(self, text: str) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in words_of(text)], dtype=np.int64)

    def keys(self, at: np.ndarray, shape: int) -> np.ndarray:
        """The key of the n-gram of a shape at each position; -1 where a word is unknown."""
        span, base = SHAPES[shape][-1] + 1, len(self.vocabulary) + 1
        n = len(at) - span + 1
        if n <= 0:
            return np.empty(0, np.int64)
        key, known = np.zeros(n, np.int64), np.ones(n, bool)
        for i in SHAPES[shape]:
            part = at[i:i + n]
            key = key * base + part
            known &= part > 0
        return np.where(known, key + shape * base ** SEED_WORDS, -1)

    def find(self, at: np.ndarray, shapes=range(len(SHAPES))) -> tuple[np.ndarray, np.ndarray]:
        """(positions, gram indexes) of this block's n-grams, by position."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for shape in shapes if len(self.grams) else ():
            keys = self.keys(at, shape)
            where = np.flatnonzero(keys >= 0)
            index = np.minimum(np.searchsorted(self.grams, keys[where]), len(self.grams) - 1)
            right = self.grams[index] == keys[where]
            found.append((where[right], index[right]))
        where, index = (np.concatenate(part) for part in zip(*found))
        order = np.argsort(where, kind="stable")
        return where[order], index[order]


def block_of(items: list[tuple[int, list[bytes]]]) -> Block:
    block = Block()
    for _, words in items:
        for w in words:
            block.vocabulary.setdefault(w, len(block.vocabulary) + 1)
    for item_id, words in items:
        at = np.array([block.vocabulary[w] for w in words], dtype=np.int64)
        for start in range(0, len(at), PASSAGE_WORDS):
            start = max(0, min(start, len(at) - PASSAGE_WORDS))
            block.passages.append((item_id, at[start:start + PASSAGE_WORDS]))
    keys = [block.keys(at, shape) for _, at in block.passages for shape in range(len(SHAPES))]
    if keys:
        block.grams, gram = np.unique(np.concatenate(keys), return_inverse=True)
        sizes = np.array([len(k) for k in keys])
        order = np.argsort(gram, kind="stable")
        block.starts = np.searchsorted(gram[order], np.arange(len(block.grams) + 1))
        block.holder = np.repeat(np.arange(len(keys)) // len(SHAPES), sizes)[order]
        block.place = np.concatenate([np.arange(n) for n in sizes])[order]
        block.by_holder = gram[order] * len(block.passages) + block.holder
        block.crowd = np.maximum(CROWD_LEAST, sizes.reshape(-1, len(SHAPES)).sum(axis=1) // CROWD_SHARE)
    return block


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[Block]:
    """The distinct items in blocks of at most ``block_words`` words (or one item).
    They are read in parts of about a block: a job each, not one per shuffle partition."""
    items, held = [], 0
    rows = benchmark.select("item_id", "text").filter("text is not null")
    length = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    for r in rows.dropDuplicates().coalesce(length // (BYTES_A_WORD * block_words) + 1).toLocalIterator():
        words = words_of(r["text"])
        if len(words) < SEED_WORDS:  # no seed
            continue
        if items and held + len(words) > block_words:
            yield block_of(items)
            items, held = [], 0
        items.append((r["item_id"], words))
        held += len(words)
    if items:
        yield block_of(items)


def document_counts(docs: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """For each n-gram of the block the number of texts that hold it, and all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(len(block.grams), np.int64), 0
        for batch in batches:
            for v in batch.column(0):
                n += 1
                _, index = block.find(block.numbers(v.as_py() or ""))
                counts[np.unique(index)] += 1
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"gram": pa.array([*seen, -1], pa.int64()), "n": pa.array([*counts[seen], n], pa.int64())})

    totals = np.zeros(len(block.grams) + 1, np.int64)  # the last of all texts, as gram -1
    found = docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    totals[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return totals[:-1], int(totals[-1])


def choose_seeds(block: Block, counts: np.ndarray, n: int) -> dict[int, list[tuple[int, int]]]:
    """gram index -> (passage, position in it) for the rare n-grams and the
    rarest three in a row of every ``RUN_WORDS`` words, among those that occur."""
    rare = max(RARE_DOCS, int(RARE_SHARE * n))
    seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, (_, at) in enumerate(block.passages):
        for shape in range(len(SHAPES)):
            where, index = block.find(at, [shape])
            held = counts[index]
            occurs = held > 0
            if not occurs.any():
                continue
            keep = occurs & (held <= max(rare, int(np.median(held[occurs]))))
            if not shape:
                order = np.where(occurs, held, np.iinfo(np.int64).max)
                runs = np.lib.stride_tricks.sliding_window_view(order, min(RUN_WORDS - SEED_WORDS + 1, len(order)))
                keep[np.arange(len(runs)) + runs.argmin(axis=1)] = True
            for i in np.flatnonzero(keep & occurs).tolist():
                seeds[int(index[i])].append((p, int(where[i])))
    return dict(seeds)


def crowds(block: Block, where: np.ndarray, index: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(position in the text, passage, position in it) of n-grams where enough of a
    passage's stand about as far apart as in the passage.  A copy over ``MIN_SCORE`` is at
    most two passages long and shifts by at most one, so two neighbouring bands of starts
    hold it, and chunks overlap by two passages.  Passages are taken a range at a time, so
    that n-grams that many share make no more than some ``CROWD_SLOTS`` rows at once."""
    last = int(where[-1]) if len(where) else -1
    bands, slots, passages = last // PASSAGE_WORDS + 3, len(block.holder) + 1, len(block.passages)
    for start in range(0, last + 1, CHUNK_WORDS):
        lo, hi = np.searchsorted(where, (start - 2 * PASSAGE_WORDS, start + CHUNK_WORDS))
        gram, spot = index[lo:hi], where[lo:hi]
        total = int((block.starts[gram + 1] - block.starts[gram]).sum())
        step = max(1, passages // max(1, -(-total // CROWD_SLOTS)))
        for low in range(0, passages if total else 0, step):
            first, n = block.starts[gram], block.starts[gram + 1] - block.starts[gram]
            if step < passages:  # a gram's slots are in order of their passages
                first = np.searchsorted(block.by_holder, gram * passages + low)
                n = np.searchsorted(block.by_holder, gram * passages + min(low + step, passages)) - first
            slot = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pos, holder, place = np.repeat(spot, n), block.holder[slot], block.place[slot]
            band = holder * bands + (pos - place) // PASSAGE_WORDS + 1
            key, size = np.unique(np.unique(band * slots + slot) // slots, return_counts=True)
            follows = np.append(key[1:] == key[:-1] + 1, False)
            enough = size + np.where(follows, np.append(size[1:], 0), 0) >= block.crowd[key // bands]
            joined = np.isin(band, np.append(key[enough], key[enough & follows] + 1))
            yield from zip(pos[joined].tolist(), holder[joined].tolist(), place[joined].tolist())


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """(best local score / full score, longest run of equal words, end in text)."""
    steps = np.arange(len(text) + 1) * -GAP
    above = np.zeros(len(text) + 1)
    runs = np.zeros(len(text) + 1, np.int64)
    best, longest, end = 0.0, 0, 0
    for word in item:
        same = text == word
        row = np.zeros(len(text) + 1)
        row[1:] = np.maximum(0, np.maximum(above[:-1] + np.where(same, MATCH, MISMATCH), above[1:] + GAP))
        above = np.maximum.accumulate(row + steps) - steps  # gaps along the text
        runs[1:] = np.where(same, runs[:-1] + 1, 0)
        runs[0] = 0
        top = int(above.argmax())
        if above[top] > best:
            best, end = float(above[top]), top
        longest = max(longest, int(runs.max()))
    return best / (MATCH * len(item)), longest, end


def leaks(block: Block, seeds: dict[int, list[tuple[int, int]]], text: str) -> list[dict]:
    """The best alignment of every item that the text leaks."""
    at = block.numbers(text)
    where, index = block.find(at)
    spots: dict[int, list[tuple[int, int]]] = defaultdict(list)
    joins = [(pos, p, in_item) for pos, g in zip(where.tolist(), index.tolist()) for p, in_item in seeds.get(g, ())]
    for pos, p, in_item in chain(joins, crowds(block, where, index)):
        size = len(block.passages[p][1])
        first = pos - in_item - size // 2
        spots[p].append((max(0, first), min(len(at), first + 2 * size)))
    found: dict[int, dict] = {}
    for p, stretches in spots.items():
        item_id, item = block.passages[p]
        merged: list[list[int]] = []
        for lo, hi in sorted(stretches):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        for lo, hi in merged:
            score, run, end = align(item, at[lo:hi])
            if score >= MIN_SCORE or run >= RUN_WORDS:
                hit = {"item_id": item_id, "score": score, "run_words": run, "first_word": lo, "last_word": lo + end - 1}
                if item_id not in found or (score, run) > (found[item_id]["score"], found[item_id]["run_words"]):
                    found[item_id] = hit
    return [found[i] for i in sorted(found, key=lambda i: (i is None, i or 0))]


def leak_column(block: Block, seeds: dict[int, list[tuple[int, int]]], text_col: str = "text") -> Column:
    @F.arrow_udf(HIT_TYPE)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([leaks(block, seeds, v.as_py() or "") for v in batch], pa.list_(HIT))

    return run(F.col(text_col).cast("string"))


def leak_columns(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Column]:
    """For each block of test items, the leaks of a row of ``docs``."""
    for block in blocks(benchmark, block_words):
        yield leak_column(block, choose_seeds(block, *document_counts(docs, block)))


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per leaked (doc_id, item_id): score, longest run, word range."""
    found = None
    for column in leak_columns(docs, benchmark, block_words):
        part = docs.select("doc_id", F.explode(column).alias("h")).select("doc_id", "h.*")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.select("doc_id", F.explode(F.array().cast(HIT_TYPE)).alias("h")).select("doc_id", "h.*")
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they were."""
    clean = docs
    for column in leak_columns(docs, benchmark, block_words):
        clean = clean.filter(F.size(column) == 0)
    return clean


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
