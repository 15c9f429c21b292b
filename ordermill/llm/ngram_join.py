"""N-gram Jaccard join with multiple-global-order filtering.

A document is its set of five-word shingles.  Under any total order of the
shingles, two sets that share ``whole`` shingles have their first common one
among the first ``n - whole + 1`` of either set.  Several orders must all
agree.  Each puts rare shingles first, by a sketch of document counts over all
texts: the first order by the count itself, the others by its power of two
and then by a hash of their own.  The first order's prefixes are joined; a
pair is made only where the shingle lies early enough in both for their sizes.
The other orders' prefixes are intersected before the whole texts are verified.

Equal sets are one node.  The component of a node, not every pair, is asked
for.  While the shingles could make more pairs across components than there were
postings at first, each is cut into slices, of which only one hub each meets the
shingle's members in other components; linked nodes drop out, hubs are done, and
the next round has twice as many slices.  The pairs that are left are joined in
full.  No link between different texts is lost, and no round
makes more pairs than slices times postings.

Tables of ids and hashes are written by as many tasks as the text asks for, not
by one per shuffle partition: what a round costs the driver, which hears of
every task, follows the text.

A shingle's sketch count bounds its postings: those under ``GROUP_ROWS`` are
grouped in one place; others are combined map-side, and joined under as many
salts as their exact count asks for.  The sketch grows with the text up to
``MOST_BITS``; beyond some 100 GB most shingles take the second path.

Cases: null and empty texts have no shingles and stand alone; a text under
five words is one shingle; equal rows share a component; rows with one id are
each reported; a null id gets the component of its text, whose smallest id
ignores nulls (a text that only null ids hold is linked with equal texts); only
id and text are read.  Shingles and nodes are 64-bit hashes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..session import scratch_path
from .common import table, text_bytes
from .components import connected, saved

WORDS = 5
PERCENT = 80
ORDERS = 3
LEAST_BITS, MOST_BITS = 20, 24  # of the sketch: 4 to 64 MB
BYTES_A_COUNTER = 768  # of text: some hundred shingles
SLICE = 1 << 13
GROUP_ROWS = 1000
PART_BYTES = 8 << 20  # of text, for each task that writes a table of the join, and two tasks a core at least
BROADCAST_ROWS = 200_000  # ids and nodes that may be sent to all tasks, some 10 MB
#: Odd multipliers, one per order and one for combining word hashes.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
STEP = np.uint64(0xFF51AFD7ED558CCD)


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    if len(found) < words:
        return np.array([digest(b" ".join(found), seed=1)], dtype=np.uint64)
    at = np.fromiter(map(digest, found), np.uint64, len(found))
    n = len(at) - words + 1
    out = at[:n].copy()
    for i in range(1, words):
        out *= STEP
        out += at[i:i + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(FACTORS[-1])
    out ^= out >> np.uint64(29)
    return np.unique(out)


def alike(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both) and both > 0


def counts_of(tokens: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The tokens' counters; their number is a power of two."""
    return sketch[((tokens * np.uint64(FACTORS[0])) >> np.uint64(65 - len(sketch).bit_length())).astype(np.int64)]


def prefix(tokens: np.ndarray, counts: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
    """Where the first shingles under an order stand in ``tokens``."""
    keep = len(tokens) - -(-percent * len(tokens) // 100) + 1
    if not order:
        return np.argsort(counts, kind="stable")[:keep]
    scale = np.frexp(counts.astype(np.float64))[1]
    return np.lexsort((tokens * np.uint64(FACTORS[order]), scale))[:keep]


def parts_of(rows: DataFrame, length: int) -> int:
    """How many tasks write a table of ids or hashes of ``length`` bytes of text."""
    return max(length // PART_BYTES + 1, 2 * rows.sparkSession.sparkContext.defaultParallelism)


def sketch(rows: DataFrame, path: str, length: int, parts: int) -> np.ndarray:
    """Document counts of hashed shingles of texts of ``length`` bytes.

    Tasks count into arrays and pass them on in slices; each slice is summed
    as it streams in, so no task holds more than its own slices.  The sums are
    written and read back a file split at a time: a job each, not one per
    shuffle partition."""
    bits = min(max((length // BYTES_A_COUNTER).bit_length(), LEAST_BITS), MOST_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << bits, np.int32)
        for batch in batches:
            for v in batch.column(0):
                tokens = shingles(v.as_py())
                np.add.at(found, ((tokens * np.uint64(FACTORS[0])) >> np.uint64(64 - bits)).astype(np.int64), 1)
        yield from sliced({i: part.astype(np.int64) for i, part in enumerate(found.reshape(-1, SLICE)) if part.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(raw.as_py(), np.int64)
                sums[i] = sums[i] + part if i in sums else part
        yield from sliced({i: np.minimum(p, np.iinfo(np.int32).max).astype(np.int32) for i, p in sums.items()})

    def sliced(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(parts), pa.int32()),
                                          "counts": pa.array([p.tobytes() for p in parts.values()], pa.binary())})

    ddl = "slice int, counts binary"
    total = np.zeros(((1 << bits) // SLICE, SLICE), np.int32)
    sums = saved(rows.select("text").mapInArrow(count, ddl).repartition("slice").mapInArrow(add, ddl), f"{path}/sketch", parts)
    for r in sums.toLocalIterator():
        total[r["slice"]] = np.frombuffer(bytes(r["counts"]), np.int32)
    return total.reshape(-1)


def prefixes(rows: DataFrame, counts: Broadcast, orders: int, percent: int) -> DataFrame:
    """Per document: node, set size, its first prefix with a mark for hot
    shingles, and the other prefixes in 32 bits a shingle.  A node that a task
    has met before gets none, so copies in one task send theirs once."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
                        ("first", pa.list_(pa.int64())), ("hot", pa.list_(pa.bool_())), ("others", pa.list_(pa.list_(pa.int32())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, met = counts.value, set()
        for batch in batches:
            out = []
            for doc_id, mark, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                tokens = shingles(v.as_py())
                node = node_of(tokens) if len(tokens) else None
                if node is None or node in met:
                    out.append((doc_id, mark, node, len(tokens), None, None, None))
                    continue
                met.add(node)
                held = counts_of(tokens, known)
                first = prefix(tokens, held, 0, percent)
                out.append((doc_id, mark, node, len(tokens), tokens[first].view(np.int64), held[first] > GROUP_ROWS,
                            [tokens[prefix(tokens, held, i, percent)].astype(np.uint32).view(np.int32) for i in range(1, orders)]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    ddl = ("doc_id bigint, mark bigint, node bigint, n bigint, first array<bigint>, hot array<boolean>, "
           "others array<array<int>>")
    return rows.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(run, ddl)


def shared_postings(docs: DataFrame, path: str, percent: int, parts: int) -> DataFrame:
    """(token, node, n, at, shared, salt, salts) of first-order prefix shingles
    that two nodes or more share; ``at`` counts from 0, ``shared`` counts the
    node's shingles here.  A posting that no size of its shingle's nodes can
    link by is left out."""
    spread = docs.filter("first is not null").select("node", "n", F.posexplode(F.arrays_zip("first", "hot")).alias("at", "p"))
    spread = spread.select(F.col("p.first").alias("token"), "node", "n", "at", F.col("p.hot").alias("hot"))
    by_token = Window.partitionBy("token")
    few = spread.filter("not hot").select(
        "token", "node", "n", "at", F.min("n").over(by_token).alias("least"), F.max("n").over(by_token).alias("most"),
        (F.min("node").over(by_token) != F.max("node").over(by_token)).alias("in_two"))
    few = few.filter("in_two").dropDuplicates(["token", "node"]).drop("in_two")
    few = few.withColumns({"salt": F.lit(0), "salts": F.lit(0)})
    many = saved(spread.filter("hot").drop("hot").distinct(), f"{path}/many", parts)
    sizes = many.groupBy("token").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("k"),
                                      (F.min("node") != F.max("node")).alias("in_two"))
    sizes = sizes.filter("in_two").select("token", "least", "most", F.ceil(F.col("k") / GROUP_ROWS).cast("int").alias("salts"))
    many = many.join(sizes, "token").withColumn("salt", (F.pmod("node", "salts") + 1).cast("int"))
    found = few.unionByName(many).withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("node")))
    # Least at either end of the sizes; 1 less, as rounding bends the curve between.
    need = F.least(*[_need(F.col("n"), F.col(c), percent) for c in ("least", "most")])
    smallest = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    early = F.col("at") <= F.col("n") - _whole(F.col("n"), smallest, percent)
    return (found.filter(F.col("shared") >= F.greatest(need - 1, F.lit(1))).filter(early)
            .drop("least", "most"))


def _salts() -> Column:
    """The salts a shingle's postings lie under."""
    return F.when(F.col("salts") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.col("salts")))


def _live(postings: DataFrame, slices: int) -> DataFrame:
    """Shingles with nodes of two components or more: their largest component,
    how many pairs of nodes lie in different ones, and a hub per slice of their
    nodes: the one with the largest part of its prefix shared, so that most of
    its kin link to it."""
    hub = F.struct((F.col("shared") / F.col("n")).alias("part"), "node", "n", "comp", "shared", "at")
    if slices == 1:  # the first round: each node is a component, and stands once under a shingle
        comps = postings.groupBy("token").agg(F.count(F.lit(1)).alias("all"), F.max("comp").alias("big"), F.max("salts").alias("salts"),
                                              F.array(F.max(hub)).alias("hubs"))
        comps = comps.withColumn("across", F.col("all") * (F.col("all") - 1) / 2).filter("across > 0")
        return comps.withColumn("salt", F.explode(_salts())).drop("salts")
    parts = postings.groupBy("token", "comp", F.pmod(F.xxhash64("node"), F.lit(slices)).alias("slice")).agg(
        F.count(F.lit(1)).alias("k"), F.max("salts").alias("salts"), F.max(hub).alias("hub"))
    comps = parts.groupBy("token", "comp").agg(F.sum("k").alias("k"), F.max("salts").alias("salts"))
    comps = comps.groupBy("token").agg(F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("same"),
                                       F.max(F.struct("k", "comp"))["comp"].alias("big"), F.max("salts").alias("salts"))
    comps = comps.withColumn("across", (F.col("all") * F.col("all") - F.col("same")) / 2).filter("across > 0")
    hubs = parts.groupBy("token", "slice").agg(F.max("hub").alias("hub")).groupBy("token").agg(F.collect_list("hub").alias("hubs"))
    return comps.join(hubs, "token").withColumn("salt", F.explode(_salts())).drop("same", "salts")


def _prefix_length(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100) + 1


def _whole(n: Column, m: Column, percent: int) -> Column:
    """How many shingles sets of these sizes must share to link."""
    return F.ceil((n + m) * percent / (100 + percent))


def _need(n: Column, m: Column, percent: int) -> Column:
    """How many prefix shingles two sets of these sizes must share to link: of
    the set whose prefix ends first, at most those behind its prefix are equal
    elsewhere."""
    return _whole(n, m, percent) - F.greatest(n - _prefix_length(n, percent), m - _prefix_length(m, percent))


def _fits(x: str, y: str, percent: int) -> Column:
    """May nodes ``x`` and ``y`` (prefixes of n, comp, shared, at) link, their
    first common shingle being this one?"""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    whole = _whole(n, m, percent)
    return ((F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m))
            & (F.col(f"{x}at") <= n - whole) & (F.col(f"{y}at") <= m - whole)
            & (F.least(F.col(f"{x}shared"), F.col(f"{y}shared")) >= F.greatest(_need(n, m, percent), F.lit(1)))
            & (F.col(f"{x}comp") != F.col(f"{y}comp")))


def _ends(x: str, y: str) -> list[Column]:
    i, j = F.col(f"{x}node"), F.col(f"{y}node")
    return [F.least(i, j).alias("a"), F.greatest(i, j).alias("b")]


def node_of(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


@F.arrow_udf(BooleanType())
def _verified(a: pa.Array, x: pa.Array, b: pa.Array, y: pa.Array, percent: pa.Array) -> pa.Array:
    """Do the texts ``x`` and ``y`` belong to nodes ``a`` and ``b``, and are they alike?"""
    node, held, out = None, None, []
    for i, s, j, t, p in zip(a.to_pylist(), x, b.to_pylist(), y, percent.to_pylist()):
        if i != node:
            node, held = i, shingles(s.as_py())
            if node_of(held) != i:  # the text of another row with this id
                node = None
        other = shingles(t.as_py())
        out.append(node is not None and node_of(other) == j and alike(held, other, p))
    return pa.array(out, pa.bool_())


def _small(rows: DataFrame) -> DataFrame:
    """A written table of ids, sent to all tasks if it is counted to be small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _of_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows (node, ...) whose node is in a written table of pairs.  Few
    nodes are sent to all tasks as they are, so nothing is shuffled."""
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    ends = F.broadcast(ends) if 2 * pairs.count() <= BROADCAST_ROWS else ends.distinct()
    return rows.join(ends, "node", "left_semi")


def _ended(pairs: DataFrame, rows: DataFrame, *values: str) -> DataFrame:
    """Pairs (a, b) with the values of the rows (node, ...) of either end."""
    end = lambda c: rows.select(F.col("node").alias(c), *[F.col(v).alias(f"{v}_{c}") for v in values])
    return pairs.join(end("b"), "b").join(end("a"), "a")


@dataclass
class JaccardJoin:
    """The state of one run: its tables under ``path``."""
    rows: DataFrame  # doc_id, text
    sets: DataFrame  # node, n, first, others of at least one row per node
    nodes: DataFrame  # node, doc_id (the smallest)
    path: str
    percent: int
    parts: int  # files of a table

    def verified(self, pairs: DataFrame, path: str) -> DataFrame:
        """The pairs that share enough of the first prefixes, whose prefixes
        meet under every other order too, and whose whole texts reach the
        threshold.  Only the nodes and texts in question are shuffled."""
        n, m = F.col("n_a"), F.col("n_b")
        whole = _whole(n, m, self.percent)
        cut = lambda x, size: F.slice(x, F.lit(1), (size - whole + 1).cast("int"))
        meets = F.forall(F.zip_with("others_a", "others_b", lambda x, y: F.arrays_overlap(cut(x, n), cut(y, m))), lambda v: v)
        enough = F.size(F.array_intersect("first_a", "first_b")) >= _need(n, m, self.percent)
        sets = _of_pairs(self.sets.filter("first is not null"), pairs).dropDuplicates(["node"])
        agreed = saved(_ended(pairs, sets, "n", "first", "others").filter(enough).filter(meets).select("a", "b"), f"{path}/agreed")
        needed = saved(_of_pairs(self.nodes.filter("doc_id is not null"), agreed), f"{path}/ids")
        texts = saved(self.rows.join(_small(needed), "doc_id").select("node", "text"), f"{path}/texts")
        same = _verified("a", "text_a", "b", "text_b", F.lit(self.percent))
        return _ended(agreed, texts, "text").filter(same).select("a", "b")

    def links(self, postings: DataFrame) -> DataFrame:
        """Links that connect every component in full."""
        tried, found = [], []
        few = postings.count()
        postings = postings.withColumn("comp", F.col("node"))
        for turn in itertools.count():
            path = f"{self.path}/turn{turn}"
            live = saved(_live(postings, 1 << turn), f"{path}/live", self.parts)
            left = live.filter("salt < 2").agg(F.sum("across")).first()[0]
            if not left:
                break
            postings = postings.join(live.select("token", "salt", "big", "hubs"), ["token", "salt"])
            if last := left <= few:
                pairs = self._all_pairs(postings)
            else:
                met = postings.select("*", F.explode("hubs").alias("hub")).filter(_fits("", "hub.", self.percent))
                pairs = met.select(*_ends("", "hub.")).distinct()
            if tried:
                pairs = pairs.join(_union(tried), ["a", "b"], "left_anti")
            pairs = saved(pairs, f"{path}/pairs", self.parts)
            tried.append(pairs)
            found.append(saved(self.verified(pairs, path), f"{path}/links"))
            if last:
                break
            labels = saved(connected(_union(found), f"{path}/comp", self.parts), f"{path}/labels", self.parts)
            rest = postings.filter(~F.array_contains("hubs.node", F.col("node"))).drop("comp", "big", "hubs")
            rest = rest.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
            postings = saved(rest, f"{path}/postings", self.parts)
        return _union(found) if found else postings.select(F.col("node").alias("a"), F.col("node").alias("b")).filter(F.lit(False))

    def _all_pairs(self, postings: DataFrame) -> DataFrame:
        """Every pair of nodes that lie in different components and may link:
        per shingle, the nodes outside its largest component against all."""
        sides = ("node", "n", "comp", "shared", "at")
        postings = postings.drop("hubs")
        minor = postings.filter("comp <> big").withColumn("salt", F.explode(_salts()))
        minor = minor.select("token", "salt", *[F.col(c).alias(f"x_{c}") for c in sides])
        once = (F.col("comp") == F.col("big")) | (F.col("x_node") < F.col("node"))
        met = minor.join(postings, ["token", "salt"]).filter(_fits("x_", "", self.percent) & once)
        return met.select(*_ends("x_", "")).distinct()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _joined(docs: DataFrame, id_col: str, text_col: str, percent: int, orders: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, node, n) of every row, ``mark`` being its text's hash, and
    (node, doc_id, label) of every node."""
    spark = docs.sparkSession
    path = scratch_path(spark, "jaccard")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    length = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_of(rows, length)
    counts = spark.sparkContext.broadcast(sketch(rows, path, length, parts))
    sets = saved(prefixes(rows, counts, orders, percent), f"{path}/docs")
    counts.unpersist()
    nodes = saved(sets.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")), f"{path}/nodes", parts)
    postings = saved(shared_postings(sets, path, percent, parts), f"{path}/postings", parts)
    links = JaccardJoin(rows, sets, nodes, path, percent, parts).links(postings)
    labels = saved(connected(links, f"{path}/comp", parts), f"{path}/labels", parts)
    mine = nodes.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    return sets.select("doc_id", "mark", "node", "n"), mine


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    orders: int = ORDERS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest
    id that links reach (itself included)."""
    rows, mine = _joined(docs, id_col, text_col, percent, orders)
    least = mine.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = mine.join(least, "label").select("node", "component_id")
    return rows.join(found, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: the one with its smallest id, of
    several texts under that id the one with the smallest hash, of equal rows
    any; a null id comes last.  So texts that are not linked stay whatever
    their ids, and copies go whatever theirs.  Rows without words stay."""
    rows, mine = _joined(docs, "doc_id", "text", PERCENT, ORDERS)
    rows = rows.join(mine.select("node", "label"), "node")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__id"),
                           F.col("mark").alias("__mark")))
    stays = rows.groupBy("label").agg(first.alias("one")).select("one.*")
    worded = F.coalesce(F.col("text").rlike("[^ \\t\\n\\x0B\\f\\r]"), F.lit(False))
    keys = ["__none", "__id", "__mark"]
    one = docs.filter(worded).withColumns({
        "__none": F.col("doc_id").isNull(), "__id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), "__mark": F.xxhash64(text_bytes())})
    one = one.join(stays, keys, "left_semi").dropDuplicates(keys).drop(*keys)
    return one.unionByName(docs.filter(~worded))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
