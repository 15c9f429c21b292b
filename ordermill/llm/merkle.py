"""Merkle manifest of a dataset: a digest per row, a tree per language, one root,
and for every row the siblings that prove it.

A row's leaf hashes its columns.  Per language the leaves, in order of id, are
the bottom of a tree of up to eight children a node; the languages' subroots
are the leaves of the tree that ends in the root.

The trees are built by a nested-struct rollup.  A leaf's rank is written in
digits to the base eight.  Blocks of ``ARITY ** BLOCK_LEVELS`` leaves are dealt
out once, and inside a block one digit column after the other is grouped away,
each group nesting the structs of its children, so no further shuffle and no
unbounded group occurs.  The blocks' digests are the leaves of the next round
until one is left per tree.  On the way down a block's nested struct is
transformed and exploded level by level; each child gets the digests to its
left and right.  What lies above the block comes into its group as one more
row, so no proof is joined.

Cases: null columns hash as ``-`` and an empty text as ``0:``; null languages
form their own tree, the first; null ids come first within a language and are
never tampered with; rows with one id are ordered by leaf digest, and equal
rows are leaves of their own; an empty table gives no rows; only the five named
columns are read, so others may clash; a long text is hashed whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import held_out, table
from .components import saved

ARITY = 8
BITS = 3  # of a digit
BLOCK_LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<l: string, r: string>"
ABOVE = f"struct<path: array<{STEP}>, subroot: string, root: string>"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def leaves(docs: DataFrame) -> DataFrame:
    """g (the language's sort key), doc_id, leaf, tampered (the leaf of a tampered row, else null)."""
    tampered = held_out("doc_id", 3, 0)
    leaf = lambda text: digest(F.concat(*[encoded(text if c == "text" else F.col(c)) for c in COLUMNS]))
    lang = F.col("lang").cast("string")
    return docs.select(*COLUMNS).select(
        F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang)).alias("g"), "doc_id",
        leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(lower_ascii(F.col("text")))).alias("tampered"),
        F.monotonically_increasing_id().alias("tie"))


def ranked(rows: DataFrame, order: list[str], path: str) -> DataFrame:
    """``rows`` (with a group ``g``) plus rank (from 0, in ``order`` within the
    group) and n (rows of the group).  The rows are range partitioned and
    sorted; a group's earlier partitions are added up from one row each."""
    rows = saved(rows, f"{path}/rows")
    seats = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    seats = saved(seats.withColumn("seat", F.monotonically_increasing_id()), f"{path}/seats")
    seats = seats.withColumn("part", F.shiftright("seat", 33))
    counts = seats.groupBy("g", "part").agg(F.count(F.lit(1)).alias("k"), F.min("seat").alias("first"))
    of = Window.partitionBy("g")
    before = F.sum("k").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("k").over(of).alias("n"))
    return seats.join(counts, ["g", "part"]).withColumn("rank", F.col("seat") + F.col("shift")).drop("seat", "part", "shift")


def _digit(level: int) -> Column:
    return F.shiftright("rank", BITS * level).bitwiseAND(ARITY - 1).cast("int").alias(f"d{level}")


def _rolled(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """Blocks (g, block, n, above, node) of ``nodes`` (g, n, rank, digest, row):
    ``node`` nests (digest, run of (place, node)) down to (digest, row).  A
    level is hashed where the group has several nodes at it; else its one node
    is handed on."""
    levels = range(BLOCK_LEVELS)
    empty = F.lit(None)
    parts = nodes.select("g", F.shiftright("rank", BITS * BLOCK_LEVELS).alias("block"), *[_digit(i) for i in levels], "n",
                         empty.cast(ABOVE).alias("above"), F.struct("digest", "row").alias("node"))
    if above is not None:
        kind = parts.schema["node"].dataType
        parts = parts.unionByName(above.select(
            "g", F.col("rank").alias("block"), *[empty.cast("int").alias(f"d{i}") for i in levels],
            empty.cast("bigint").alias("n"), "above", empty.cast(kind).alias("node")))
    parts = parts.repartition("g", "block")
    for level in levels:
        child = F.when(F.col("node").isNotNull(), F.struct(F.col(f"d{level}").alias("place"), "node"))
        parts = parts.groupBy("g", "block", *[f"d{i}" for i in levels[level + 1:]]).agg(
            F.max("n").alias("n"), F.first("above", ignorenulls=True).alias("above"),
            F.array_sort(F.collect_list(child), lambda x, y: x["place"] - y["place"]).alias("run"))
        several = F.col("n") > F.lit(ARITY ** level)
        value = F.when(several, digest(F.array_join(F.col("run.node.digest"), ""))).otherwise(F.col("run")[0]["node"]["digest"])
        parts = parts.withColumn("node", F.when(F.size("run") > 0, F.struct(value.alias("digest"), "run"))).drop("run")
    return parts


def _unrolled(blocks: DataFrame) -> DataFrame:
    """The nodes of ``_rolled`` blocks again: g, rank, digest, row, above, whose
    path leads from the node itself to the top."""
    rows = blocks.select("g", F.col("block").alias("rank"), "n", "node", "above.path", "above.subroot", "above.root")
    for level in reversed(range(BLOCK_LEVELS)):
        rows = rows.withColumn("all", F.col("node.run.node.digest"))
        step = lambda x, i: F.struct(
            x["place"].alias("place"), x["node"].alias("node"),
            F.array_join(F.slice("all", F.lit(1), i), "").alias("l"),
            F.array_join(F.slice("all", i + 2, F.lit(ARITY)), "").alias("r"))
        rows = rows.select("g", "rank", "n", "path", "subroot", "root", F.explode(F.transform("node.run", step)).alias("c"))
        here = F.when(F.col("n") > F.lit(ARITY ** level), F.array(F.struct("c.l", "c.r"))).otherwise(F.array().cast(f"array<{STEP}>"))
        rows = rows.select("g", (F.col("rank") * ARITY + F.col("c.place")).alias("rank"), "n", F.concat(here, "path").alias("path"),
                           "subroot", "root", F.col("c.node").alias("node"))
    return rows.select("g", "rank", "node.digest", "node.row", F.struct("path", "subroot", "root").alias("above"))


def climb(nodes: DataFrame, path: str) -> DataFrame:
    """g, rank, digest, row and ``above`` (path to the top of the group; subroot
    is the top) of ``nodes`` (g, n, rank, digest, row)."""
    nodes = saved(nodes, f"{path}/nodes")
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= 1:
        above = F.struct(F.array().cast(f"array<{STEP}>").alias("path"), F.col("digest").alias("subroot"), F.lit(None).cast("string").alias("root"))
        return nodes.select("g", "rank", "digest", "row", above.alias("above"))
    slim = nodes.withColumn("row", F.lit(None).cast("boolean"))
    tops = _rolled(slim, None).select(
        "g", F.ceil(F.col("n") / ARITY ** BLOCK_LEVELS).alias("n"), F.col("block").alias("rank"), "node.digest",
        F.lit(None).cast("boolean").alias("row"))
    return _unrolled(_rolled(nodes, climb(tops, f"{path}/up")))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, tampered (null where untouched),
    subroot, root and path, the siblings (l, r) of every level from the leaf to
    the root, left and right of the proven node."""
    path = scratch_path(docs.sparkSession, "merkle")
    rows = ranked(leaves(docs), ["doc_id", "leaf", "tie"], f"{path}/ranked")
    nodes = rows.select("g", "n", "rank", F.col("leaf").alias("digest"), F.struct("doc_id", "tampered").alias("row"))
    proofs = saved(climb(nodes, f"{path}/tree"), f"{path}/proofs")
    tops = proofs.filter("rank = 0").select(F.lit("").alias("g"), F.col("g").alias("lang"), F.col("above.subroot").alias("digest"))
    tops = ranked(tops, ["lang"], f"{path}/langs")
    tops = climb(tops.select("g", "n", "rank", "digest", F.struct("lang").alias("row")), f"{path}/root")
    tops = tops.select(F.col("row.lang").alias("g"), F.col("above.path").alias("rest"), F.col("above.subroot").alias("root"))
    return proofs.join(tops, "g").select(
        "row.doc_id", F.col("digest").alias("leaf"), "row.tampered", "above.subroot", "root",
        F.concat("above.path", "rest").alias("path"))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda held, s: digest(F.concat(s["l"], held, s["r"])))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def _tree_sql(rows: str, group: str, levels: int, name: str) -> str:
    """CTEs ``name``0..: nodes (group, n, rank, digest) of every level."""
    out = [f"{name}0 as (select * from {rows})"]
    for i in range(levels):
        run = "sha256(string_agg(digest, '' order by rank))"
        out.append(f"{name}{i + 1} as (select {group}, max(n) as n, rank // {ARITY} as rank, "
                   f"case when max(n) > {ARITY ** i} then {run} else max(digest) end as digest "
                   f"from {name}{i} group by {group}, rank // {ARITY})")
    return ",\n".join(out)


def _sides_sql(levels: int, name: str, start: str, group: str) -> str:
    """CTE ``name``_sides: (group, rank, l0, r0, l1, ...) of every bottom node; null where no level is hashed."""
    cols = []
    for i in range(levels):
        for side, op in (("l", "<"), ("r", ">")):
            cols.append(f"case when b.n > {ARITY ** i} then coalesce((select string_agg(s.digest, '' order by s.rank) from {name}{i} s "
                        f"where s.{group} = b.{group} and s.rank // {ARITY} = b.rank // {ARITY ** (i + 1)} "
                        f"and s.rank {op} b.rank // {ARITY ** i}), '') end as {name}{side}{i}")
    return f"{name}_sides as (select b.{group}, b.rank, {', '.join(cols)} from {start} b)"


_LANG_LEVELS, _TOP_LEVELS = 6, 3  # enough for 8**6 rows of a language, 8**3 languages
_SIDES = [f"{t}{{}}{i}" for t, k in (("t", _LANG_LEVELS), ("u", _TOP_LEVELS)) for i in range(k)]




def _folds_sql() -> str:
    """CTEs that fold one level each, so that no expression doubles."""
    out, last = [], "f0"
    for i, s in enumerate(_SIDES):
        low, high = s.format("l"), s.format("r")
        out.append(f"f{i + 1} as (select * replace (case when {low} is null then folded else sha256({low} || folded || {high}) end as folded) from {last})")
        last = f"f{i + 1}"
    return ",\n".join(out)


_ENC = " || ".join(f"case when {{{c}}} is null then '-' else octet_length(encode(cast({{{c}}} as varchar)))::varchar || ':' "
                   f"|| cast({{{c}}} as varchar) end" for c in COLUMNS)
_LOW = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
#: CRC-32 by its bitwise rule (reflected polynomial 0xEDB88320) over the id's decimal text.
_CRC = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ord(c)::bigint)), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::bigint[]), "
        "lambda x, k: xor(x >> 1, case when x & 1 = 1 then 3988292384::bigint else 0 end))), 4294967295::bigint)")

MERKLE_SQL = f"""
with hashed as (select coalesce('=' || lang, '') as g, doc_id, sha256({_ENC.format(**{c: c for c in COLUMNS})}) as leaf,
    case when {_CRC} % 3 = 0 then sha256({_ENC.format(**{c: _LOW if c == 'text' else c for c in COLUMNS})}) end as tampered from documents),
ordered as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by g) as n from hashed),
bottom as (select g, n, rank, leaf as digest from ordered),
{_tree_sql('bottom', 'g', _LANG_LEVELS, 't')},
langs as (select 0 as z, count(*) over () as n, row_number() over (order by g) - 1 as rank, digest, g from t{_LANG_LEVELS}),
tops as (select z, n, rank, digest from langs),
{_tree_sql('tops', 'z', _TOP_LEVELS, 'u')},
{_sides_sql(_LANG_LEVELS, 't', 'bottom', 'g')},
{_sides_sql(_TOP_LEVELS, 'u', 'tops', 'z')},
f0 as (select o.doc_id, o.leaf, l.digest as subroot, (select digest from u{_TOP_LEVELS}) as root, t_sides.* exclude (g, rank), u_sides.* exclude (z, rank),
    coalesce(o.tampered, o.leaf) as folded
  from ordered o join langs l on o.g = l.g join t_sides on t_sides.g = o.g and t_sides.rank = o.rank join u_sides on u_sides.rank = l.rank),
{_folds_sql()}
select doc_id, leaf, subroot, root,
  sha256({' || '.join(f"coalesce({s.format(x)}, '')" for s in _SIDES for x in 'lr')}) as proof_sha256,
  folded as folded_root, folded = root as verified
from f{len(_SIDES)}"""
