"""Hard-negative mining over rotated one-bit codes.

Every vector ``x`` (integers) is rotated into ``BITS_PER_DIM`` times as many
dimensions by one seeded matrix with orthonormal rows; the signs there are its
code.  ``c``, the code turned back, is never stored; what is stored besides the
code are its alignment ``<x, c>``, its length and that of ``x``.  An anchor
``q`` is rotated too and cut into bit planes, so ``<q, c>`` is a sum of
popcounts, up to an error that is known when ``q`` is cut.  With
``b = <x, c> / <c, c>`` the score is ``b <q, c>`` plus the product of two
residuals, both at right angles to ``c``, which Cauchy and Schwarz bound by
their lengths.  The interval holds the score for certain, so nothing is lost:
only rows whose interval reaches the best scores so far, and for negatives the
band below the positive's score, are scored on the integers.

Anchors go to all tasks in blocks of ``BLOCK_BYTES`` at most; every block reads
the coded rows twice, for its positives and for their negatives.  A task holds
one batch of rows and the best few per anchor of the block.  Labels are
compared, not partitioned on, so a hot label is no hot key.

Cases: rows with a null label or vector, or a null or non-finite component,
take no part; a null id is no anchor and comes last among ties; rows with one id or
equal vectors are rows of their own; a shorter vector counts as filled up with
zeros; scores beyond a long are cut to its limits; an empty table or one
without anchors gives no rows; only the three named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import table
from .components import saved

SCALE = 256
NEAREST = 5
LOW, HIGH = 80, 100  # a negative's score in hundredths of the positive's
BITS_PER_DIM = 4
PLANES = 6
SEED = 11
BLOCK_BYTES = 32 << 20
TILE = 1 << 20  # pairs estimated at once
GATHER = 1 << 16  # pairs scored at once
NO_ID = np.iinfo(np.int64).max
LONG = np.iinfo(np.int64)
CODED = "row bigint, vec_id bigint, label bigint, vector binary, code binary, along double, length double, norm double"


def rotation(dims: int, bits_per_dim: int = BITS_PER_DIM, seed: int = SEED) -> np.ndarray:
    """(dims, bits) with orthonormal rows; bits is a multiple of 64."""
    bits = -(-dims * bits_per_dim // 64) * 64
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dims)))[0].T


def vectors_of(column: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    for i, raw in enumerate(column):
        v = np.frombuffer(raw.as_py(), np.int64)
        out[i, :len(v)] = v
    return out


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, words), alignment with the code vector, its squared length, own squared length."""
    signs = (x @ turn >= 0)
    code = np.packbits(signs, axis=1, bitorder="little").view(np.uint64)
    c = np.where(signs, 1.0, -1.0) @ turn.T
    return code, np.einsum("ij,ij->i", x, c), np.einsum("ij,ij->i", c, c), np.einsum("ij,ij->i", x, x)


@dataclass
class Anchors:
    """A block of queries: exact vectors, and their rotated forms cut into bit planes."""
    row: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    planes: np.ndarray  # (anchors, planes, words)
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray
    error: np.ndarray  # of 2 * <rotated, bits>, at most
    norm: np.ndarray

    @classmethod
    def of(cls, row: np.ndarray, label: np.ndarray, vector: np.ndarray, turn: np.ndarray) -> Anchors:
        q = vector.astype(float)
        y = q @ turn
        low = y.min(1)
        step = np.maximum((y.max(1) - low) / ((1 << PLANES) - 1), 1e-300)
        cut = np.rint((y - low[:, None]) / step[:, None])
        off = y - low[:, None] - cut * step[:, None]
        error = 2 * np.maximum(np.maximum(off, 0).sum(1), np.maximum(-off, 0).sum(1))
        bits = (cut.astype(np.int64)[:, None, :] >> np.arange(PLANES)[None, :, None]) & 1
        planes = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)
        return cls(row, label, vector, planes, low, step, y.sum(1), error, np.einsum("ij,ij->i", q, q))

    def bounds(self, at: slice, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of the anchors ``at`` with every row."""
        met = np.zeros((len(self.low[at]), len(rows.row)), np.float64)
        for p in range(PLANES):
            for w in range(rows.code.shape[1]):
                met += float(1 << p) * np.bitwise_count(self.planes[at, p, w][:, None] & rows.code[None, :, w])
        of = lambda a: a[at][:, None]
        t = 2 * (of(self.low) * rows.ones + of(self.step) * met) - of(self.total)
        least = np.maximum(np.abs(t) - of(self.error), 0)
        across = np.sqrt(np.maximum(of(self.norm) - least * least / rows.length, 0) * rows.residual)
        slack = 1e-7 * np.sqrt(of(self.norm) * rows.norm) + 1e-3
        middle, width = rows.share * t, np.abs(rows.share) * of(self.error) + across + slack
        return np.clip(middle - width, LONG.min, LONG.max), np.clip(middle + width, LONG.min, LONG.max)


class Rows:
    """One Arrow batch of coded rows."""

    def __init__(self, batch: pa.RecordBatch, dims: int):
        get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        numbers = lambda n: get[n].to_numpy(zero_copy_only=False)
        self.row, self.label = numbers("row"), numbers("label")
        self.known = get["vec_id"].is_valid().to_numpy(zero_copy_only=False)
        self.vec_id = get["vec_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.vector = vectors_of(get["vector"], dims)
        self.code = np.stack([np.frombuffer(c.as_py(), np.uint64) for c in get["code"]])
        self.ones = np.bitwise_count(self.code).sum(1, dtype=np.int64).astype(float)
        self.length = np.maximum(numbers("length"), 1e-9)
        self.norm = numbers("norm")
        self.share = numbers("along") / self.length
        self.residual = np.maximum(self.norm - self.share * numbers("along"), 0)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of paired rows, cut to the limits of a long."""
    most = np.abs(q.astype(float)).max(initial=0) * np.abs(x.astype(float)).max(initial=0) * max(q.shape[1], 1)
    if most < 2.0 ** 62:
        return np.einsum("ij,ij->i", q, x)
    whole = [sum(int(a) * int(b) for a, b in zip(u, v)) for u, v in zip(q, x)]
    return np.array([min(max(s, LONG.min), LONG.max) for s in whole], np.int64)


class Best:
    """The first ``NEAREST`` of every slot: higher scores, then smaller ids."""

    def __init__(self, slots: int, keep: int):
        self.keep, self.least = keep, np.full(slots, LONG.min, np.int64)
        self.held = [np.empty(0, np.int64) for _ in range(3)] + [np.empty(0, bool)]  # slot, score, id, known

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, known: np.ndarray) -> None:
        near = score >= self.least[slot]
        if not near.any():
            return
        slot, score, vec_id, known = (np.concatenate([h, n[near]]) for h, n in zip(self.held, (slot, score, vec_id, known)))
        order = np.lexsort((~known, vec_id, -score.astype(float) if np.abs(score).max() < 1 << 52 else ~score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        first = place < self.keep
        self.held = [a[order][first] for a in (score, vec_id, known)]
        self.held.insert(0, slot[first])
        last = place[first] == self.keep - 1
        self.least[self.held[0][last]] = self.held[1][last]


def _positives(anchors: Anchors, keep: int) -> tuple[Best, Callable, Callable]:
    """Slots are anchors; rows of the anchor's label other than itself."""
    best = Best(len(anchors.row), keep)

    def meet(at: slice, rows: Rows, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (anchors.label[at][:, None] == rows.label) & (anchors.row[at][:, None] != rows.row) & (high >= best.least[at][:, None])

    def take(i: np.ndarray, j: np.ndarray, score: np.ndarray, rows: Rows) -> None:
        best.add(i, score, rows.vec_id[j], rows.known[j])

    return best, meet, take


def _negatives(anchors: Anchors, positive: np.ndarray, there: np.ndarray, keep: int) -> tuple[Best, Callable, Callable]:
    """Slots are (anchor, positive); rows of other labels within the positive's band."""
    each = positive.shape[1]
    best = Best(positive.size, keep)
    low = LOW * (positive // HIGH) - -LOW * (positive % HIGH) // HIGH  # rounded up, without leaving a long
    floor = np.where(there, low, LONG.max)
    top = np.where(there, positive, LONG.min).max(1)

    def meet(at: slice, rows: Rows, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        need = np.maximum(floor[at], best.least.reshape(-1, each)[at]).min(1)[:, None]
        return (anchors.label[at][:, None] != rows.label) & (high >= need) & (low <= top[at][:, None])

    def take(i: np.ndarray, j: np.ndarray, score: np.ndarray, rows: Rows) -> None:
        for p in range(each):
            fits = (score >= floor[i, p]) & (score <= positive[i, p]) & there[i, p]
            best.add(i[fits] * each + p, score[fits], rows.vec_id[j[fits]], rows.known[j[fits]])

    return best, meet, take


def _search(anchors: Anchors, dims: int, goal: Callable[[Anchors], tuple], each: int) -> Callable:
    """The best rows of one task for every slot of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = anchors.value
        best, meet, take = goal(block)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Rows(batch, dims)
            tall = max(TILE // len(rows.row), 1)
            for start in range(0, len(block.row), tall):
                at = slice(start, start + tall)
                i, j = np.nonzero(meet(at, rows, *block.bounds(at, rows)))
                i += start
                for s in range(0, len(i), GATHER):
                    a, r = i[s:s + GATHER], j[s:s + GATHER]
                    take(a, r, scores(block.vector[a], rows.vector[r]), rows)
        slot, score, vec_id, known = best.held
        yield pa.RecordBatch.from_pydict({
            "anchor": pa.array(block.row[slot // each], pa.int64()), "place": pa.array(slot % each, pa.int32()),
            "score": pa.array(score, pa.int64()), "vec_id": pa.array(vec_id, pa.int64(), mask=~known)})

    return run


def first_of(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` of every (anchor, place), with their rank from 1."""
    by = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= keep)


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """vec_id, label and the integer vector of the rows that take part."""
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull()).filter(sound)
    return rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"),
                       F.monotonically_increasing_id().alias("row"))


def coded(rows: DataFrame, dims: int, turn) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            x = np.zeros((batch.num_rows, dims), np.int64)
            for i, v in enumerate(lists):
                v = v.values.to_numpy(zero_copy_only=False)
                x[i, :len(v)] = v
            code, along, length, norm = encode(x.astype(float), turn.value)
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "vector": pa.array([v.tobytes() for v in x], pa.binary()), "code": pa.array([c.tobytes() for c in code], pa.binary()),
                "along": along, "length": length, "norm": norm})

    return rows.select("row", "vec_id", "label", "v").mapInArrow(run, CODED)


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   keep: int = NEAREST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score: for every anchor and each of its first ``keep`` positives
    the first ``keep`` negatives within the band.  ``is_anchor`` may use ``vec_id``."""
    spark = rows.sparkSession
    path = scratch_path(spark, "negatives")
    whole = saved(usable(rows, id_col, vector_col, label), f"{path}/rows")
    dims = max(whole.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    turn = spark.sparkContext.broadcast(rotation(dims))
    index = saved(coded(whole, dims, turn), f"{path}/index")
    queries = index.filter(is_anchor)
    bytes_each = 8 * dims + 8 * PLANES * turn.value.shape[1] // 64 + 64 * keep * keep
    blocks = -(-queries.count() // max(BLOCK_BYTES // bytes_each, 1))
    found = []
    for b in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b)
        found.append(_block(spark, index, block, dims, turn, keep, f"{path}/block{b}"))
    if not found:
        return whole.filter(F.lit(False)).select(
            *[F.col("vec_id").alias(c) for c in ("anchor_id", "positive_id")], F.col("vec_id").cast("int").alias("rank"),
            *[F.col("vec_id").alias(c) for c in ("negative_id", "positive_score", "negative_score")])
    return spark.read.schema(found[0].schema).parquet(*[f"{path}/block{b}/negatives" for b in range(blocks)])


def _block(spark: SparkSession, index: DataFrame, block: DataFrame, dims: int, turn, keep: int, path: str) -> DataFrame:
    held = block.select("row", "vec_id", "label", "vector").toArrow().sort_by("row").combine_chunks()
    numbers = lambda c: held.column(c).to_numpy()
    row = numbers("row")
    anchors = Anchors.of(row, numbers("label"), vectors_of(held.column("vector"), dims), turn.value)
    shared = spark.sparkContext.broadcast(anchors)
    ddl = "anchor bigint, place int, score bigint, vec_id bigint"

    search = _search(shared, dims, lambda a: _positives(a, keep), 1)
    positives = saved(first_of(index.mapInArrow(search, ddl), keep), f"{path}/positives")
    score, there = np.zeros((len(row), keep), np.int64), np.zeros((len(row), keep), bool)
    of = [c.to_numpy() for c in positives.select("anchor", "rank", "score").toArrow().columns]
    i, j = np.searchsorted(row, of[0]), of[1] - 1
    score[i, j], there[i, j] = of[2], True

    search = _search(shared, dims, lambda a: _negatives(a, score, there, keep), keep)
    negatives = first_of(index.mapInArrow(search, ddl), keep).select(
        "anchor", (F.col("place") + 1).alias("of"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = block.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = positives.select("anchor", F.col("rank").alias("of"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = negatives.join(pairs, ["anchor", "of"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    out = saved(out, f"{path}/negatives")
    shared.unpersist()
    return out


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


HARD_NEGATIVES_SQL = f"""
with v as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, row_number() over () as row,
    list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) as e
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
met as (select a.row as anchor, a.vec_id as anchor_id, a.label as own, v.row, v.vec_id, v.label,
    cast(list_dot_product(a.e, v.e) as bigint) as score
  from v a join v on a.vec_id % 100 = 0 and a.row <> v.row),
p as (select * from met where own = label
  qualify row_number() over (partition by anchor order by score desc, vec_id) <= {NEAREST}),
n as (select p.anchor_id, p.vec_id as positive_id,
    row_number() over (partition by p.anchor, p.row order by m.score desc, m.vec_id) as rank,
    m.vec_id as negative_id, p.score as positive_score, m.score as negative_score
  from p join met m on m.anchor = p.anchor and m.label <> m.own
    and {LOW} * p.score <= {HIGH} * m.score and {HIGH} * m.score <= {HIGH} * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= {NEAREST}"""
