"""Correlation, global rank and exact median that scale out.

* ``pearson`` computes any number of pairs in one aggregate pass, in the
  covariance form ``covar_pop / (stddev_pop * stddev_pop)`` over pair-complete
  rows.  That equals SQL ``corr`` but gives NULL (never an error, never NaN)
  on constant or empty input.  ``null_policy="zero"`` treats NULL as 0.0 as
  ``DataFrame.stat.corr`` does; ``"pairwise"`` drops incomplete pairs.

* ``global_rank`` / ``exact_median`` replace ``rank().over(Window.orderBy(v))``
  and a median over one sorted partition, which both move every row to one
  task.  Cut points split the values into buckets of about
  ``ROWS_PER_BUCKET`` rows (at most ``MAX_BUCKETS``).  They come from a sample
  of some ``SAMPLE_PER_BUCKET`` values per bucket, drawn where the rows lie:
  no task gathers what grows with the number of tasks.  So **planning a rank
  or a median runs two small jobs per column** (a count and the sample), and
  the cut points are literals from then on: a recomputed stage buckets as
  before.  Each row gets an order-preserving sub-bucket: NULL, exactly a cut
  point, the open interval between two cuts, or NaN (above all).  Numeric,
  date and timestamp values are keyed by two JVM ``Bucketizer`` binary
  searches over an exact double order key; other types by a small comparison
  tree of at most ``MAX_TREE_BUCKETS`` leaves.  A value holding more than a few
  buckets' worth of rows is practically always sampled as a cut point; its
  rows take their rank from the counts and are spread by a salt.  Sub-bucket
  counts (at most ``2 * buckets + 2`` rows per group, broadcast) give offsets;
  the other rows are ordered only within their own open interval.  Cut points
  balance load; they never change a result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StructField, StructType, TimestampNTZType, TimestampType)

from .clean import round_to

# Bucket sizing: about ROWS_PER_BUCKET rows per open interval, so a window
# task's share stays bounded as the data grows; the cut points, their sample
# and the per-sub-bucket counts broadcast back stay bounded by MAX_BUCKETS.
ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS, MAX_BUCKETS = 64, 20_000
SAMPLE_PER_BUCKET = 64
# Types that are not exactly representable as double (strings, decimals,
# bigints beyond 2**53) use a comparison tree, whose expression size caps the
# bucket count.
MAX_TREE_BUCKETS = 256
SALTS = 64  # over which the rows of a sub-bucket that needs no sorting are spread


def default_buckets(n_rows: int) -> int:
    """About one bucket per ROWS_PER_BUCKET rows."""
    return max(MIN_BUCKETS, min(MAX_BUCKETS, -(-n_rows // ROWS_PER_BUCKET)))


# ---------------------------------------------------------------- Pearson
def pearson_expr(a: Column, b: Column) -> Column:
    """Pearson over pair-complete rows; NULL on constant / empty input."""
    both = a.isNotNull() & b.isNotNull()
    x = F.when(both, a.cast("double"))
    y = F.when(both, b.cast("double"))
    den = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.when(den != 0, den)


def _policy(c: Column, null_policy: str) -> Column:
    if null_policy == "zero":
        return F.coalesce(c.cast("double"), F.lit(0.0))
    if null_policy == "pairwise":
        return c.cast("double")
    raise ValueError(f"null_policy must be 'zero' or 'pairwise', not {null_policy!r}")


def pearson(df: DataFrame, pairs: Sequence[tuple[str, str]], null_policy: str = "zero",
            digits: int | None = 4) -> DataFrame:
    """One row per pair: ``metric_a, metric_b, pearson_corr``; one pass."""
    aggs = []
    for i, (a, b) in enumerate(pairs):
        r = pearson_expr(_policy(F.col(a), null_policy), _policy(F.col(b), null_policy))
        aggs.append((round_to(r, digits) if digits is not None else r).alias(f"_r{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', _r{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (metric_a, metric_b, pearson_corr)")


# ----------------------------------------------------- positions and rank
EXACT_DOUBLE = 2 ** 53 - 2  # integers strictly inside this bound are exact as doubles
_TIME_TYPES = (DateType, TimestampType, TimestampNTZType)


def _order_key(value: str, dtype) -> Column:
    """The column itself, or for dates / timestamps an exact integer with the
    same order (days or microseconds since the epoch), which the Bucketizer
    can key exactly."""
    c = F.col(value)
    if isinstance(dtype, DateType):
        return F.unix_date(c)
    if isinstance(dtype, TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{value}`)")
    return c


def _from_order_key(k: Column, dtype) -> Column:
    """Inverse of ``_order_key`` (cut points back to the column's type)."""
    if isinstance(dtype, DateType):
        return F.date_from_unix_date(k.cast("int"))
    if isinstance(dtype, TimestampType):
        return F.timestamp_micros(k)
    if isinstance(dtype, TimestampNTZType):
        return F.expr("timestampadd(MICROSECOND, _ck, timestamp_ntz'1970-01-01 00:00:00')")
    return k.cast(dtype)


def _bucketizable(dtype, cuts: list | None = None) -> bool:
    """Whether the Bucketizer (which compares as double) keys this column
    exactly.  A bigint qualifies when every cut point is exact as a double:
    any larger value then lies beyond all cuts, in an outer open interval
    that is ordered by the exact value."""
    if isinstance(dtype, (ByteType, ShortType, IntegerType, FloatType, DoubleType)):
        return True
    if isinstance(dtype, (LongType, *_TIME_TYPES)):  # time types: cuts are integer order keys
        return cuts is None or all(abs(c) < EXACT_DOUBLE for c in cuts)
    return False


def _thin(cuts: list, keep: int) -> list:
    """At most ``keep`` of the cut points, evenly spaced (still valid cuts)."""
    if len(cuts) <= keep:
        return cuts
    step = len(cuts) / keep
    return sorted({cuts[int(i * step)] for i in range(keep)})


def usable_cuts(dtype, cuts: list) -> list:
    """The cut points a column's keying can take: all of them for the
    Bucketizer, at most ``MAX_TREE_BUCKETS - 1`` for the comparison tree."""
    return cuts if _bucketizable(dtype, cuts) else _thin(cuts, MAX_TREE_BUCKETS - 1)


def value_cuts_many(df: DataFrame, values: Sequence[str], buckets: int | None = None) -> dict[str, list]:
    """Per column, sorted distinct cut points (at most ``buckets - 1``).

    One aggregate counts each column's values; then each column is sampled at
    the rate that gives about ``SAMPLE_PER_BUCKET`` values per bucket, and
    every k-th sampled value is a cut.  NULLs do not count, so a column that is
    mostly NULL gets as many cuts as its values call for.
    """
    if not values:
        return {}
    keys = {v: _order_key(v, df.schema[v].dataType) for v in values}
    found = df.agg(*[F.count(k).alias(f"_n{i}") for i, k in enumerate(keys.values())]).first()
    return {v: _sampled_cuts(df, v, k, found[f"_n{i}"], buckets) for i, (v, k) in enumerate(keys.items())}


def _sampled_cuts(df: DataFrame, value: str, key: Column, n: int, buckets: int | None) -> list:
    dtype = df.schema[value].dataType
    b = default_buckets(n) if buckets is None else buckets
    if not _bucketizable(dtype):
        b = min(b, MAX_TREE_BUCKETS)
    if n == 0 or b <= 1:
        return []
    rows = df.select(key.alias("_k")).filter(F.col("_k").isNotNull())
    if isinstance(dtype, (FloatType, DoubleType)):
        rows = rows.filter(~F.isnan("_k"))
    want = SAMPLE_PER_BUCKET * b
    if n > want:
        rows = rows.sample(fraction=want / n, seed=17)
    sample = sorted(r[0] for r in rows.collect())  # about ``want`` values
    step = max(1, len(sample) // b)
    cuts = sample[step - 1::step][: b - 1]
    return usable_cuts(dtype, sorted({c + 0 if isinstance(c, float) else c for c in cuts}))  # -0.0 is 0.0


def value_cuts(df: DataFrame, value: str, buckets: int | None = None) -> list:
    return value_cuts_many(df, [value], buckets)[value]


def _sub_of(v: Column, cuts: list, lo: int = 0, hi: int | None = None) -> Column:
    """Sub-bucket of v: 2j for the open interval (c[j-1], c[j]), 2j+1 for v == c[j]."""
    hi = len(cuts) if hi is None else hi
    if lo >= hi:  # lo = number of cut points <= v
        return F.lit(0) if lo == 0 else F.when(v == F.lit(cuts[lo - 1]), F.lit(2 * lo - 1)).otherwise(F.lit(2 * lo))
    mid = (lo + hi) // 2
    return F.when(v >= F.lit(cuts[mid]), _sub_of(v, cuts, mid + 1, hi)).otherwise(_sub_of(v, cuts, lo, mid))


def sub_bucket_column(value: str | Column, cuts: list) -> Column:
    """Order-preserving key as one expression (comparison tree): -1 for NULL,
    odd = exactly a cut point, even = between cuts."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v.isNull(), F.lit(-1)).otherwise(_sub_of(v, cuts))


def with_sub_bucket(df: DataFrame, value: str, cuts: list, out: str = "_sb") -> DataFrame:
    """``df`` plus the sub-bucket of ``value``: -1 NULL, 2j+1 for v == c[j],
    2j for the open interval (c[j-1], c[j]).

    A value holding more than about 1/buckets of the rows is always a cut
    point, so it lands in its own odd sub-bucket and no open (even)
    sub-bucket holds a hot value.  Numeric values go through two JVM
    ``Bucketizer`` binary searches: splits at each cut give ``#cuts <= v``,
    splits just above each cut give ``#cuts < v``; their sum is the key.
    Other types use a comparison tree; pass cuts through ``usable_cuts``.
    """
    dtype = df.schema[value].dataType
    if not cuts and isinstance(dtype, (FloatType, DoubleType)):
        v = F.col(value)
        return df.withColumn(out, F.when(v.isNull(), F.lit(-1)).when(F.isnan(v), F.lit(_nan_sub(cuts)))
                             .otherwise(F.lit(0)))
    key = _order_key(value, dtype)
    if not cuts or not _bucketizable(dtype, cuts):
        return df.withColumn(out, sub_bucket_column(key, cuts))
    inf = float("inf")
    x = key.cast("double")
    tmp = df.withColumn("_bz_x", F.when(x == 0.0, F.lit(0.0)).otherwise(x))  # -0.0 sorts as 0.0
    cuts_d = [float(c) for c in cuts]
    at_most = Bucketizer(splits=[-inf, *cuts_d, inf], inputCol="_bz_x", outputCol="_bz_le", handleInvalid="keep")
    below = Bucketizer(splits=[-inf, *[math.nextafter(c, inf) for c in cuts_d], inf], inputCol="_bz_x",
                       outputCol="_bz_lt", handleInvalid="keep")
    tmp = below.transform(at_most.transform(tmp))
    key = (F.when(F.col(value).isNull(), F.lit(-1))
           # NaN sorts above every number and equals itself: one point sub-bucket at the top
           .when(F.isnan(F.col("_bz_x")), F.lit(_nan_sub(cuts)))
           .otherwise((F.col("_bz_le") + F.col("_bz_lt")).cast("int")))
    return tmp.withColumn(out, key).drop("_bz_x", "_bz_le", "_bz_lt")


def _nan_sub(cuts: list) -> int:
    """Point sub-bucket for NaN: just above the last open interval (2 * len(cuts))."""
    return 2 * len(cuts) + 1


def _sub_offsets(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Per (groups, _sb): row count ``_c``, rows in earlier sub-buckets
    ``_off`` and the group size ``_n``.  At most 2 * buckets + 2 rows per
    group; the window runs over these counts only."""
    per_group = Window.partitionBy(*groups)
    return (rows.groupBy(*groups, "_sb").agg(F.count(F.lit(1)).alias("_c"))
            .withColumn("_off", F.coalesce(F.sum("_c").over(
                per_group.orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_n", F.sum("_c").over(per_group)))


def global_rank(df: DataFrame, value: str, out: str, buckets: int | None = None,
                cuts: list | None = None, counts_from: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``out`` = ``rank()`` over ascending ``value``, nulls first.

    Equal to ``F.rank().over(Window.orderBy(value))`` (ties share the lowest
    rank) without moving the rows to one partition, reading them once.  Rows
    equal to a cut point (a hot value among them) or NULL take ``offset + 1``;
    the other rows rank inside their open sub-bucket, a slice of about
    1/buckets of the rows.  ``counts_from`` (same rows, e.g.
    the base of an earlier rank) lets the counts skip recomputing ``df``.
    """
    cuts = value_cuts(df, value, buckets) if cuts is None else usable_cuts(df.schema[value].dataType, cuts)
    base = counts_from if counts_from is not None else df
    offsets = F.broadcast(  # at most 2 * len(cuts) + 2 rows: a proven bound
        _sub_offsets(with_sub_bucket(base, value, cuts), []).select(F.col("_sb").alias("_osb"), "_off"))
    # One window over all rows.  Rows that equal a cut point (or are NULL) all
    # have the first place of their sub-bucket; a salt spreads them, so a hot
    # value fills no task.  The others share a sub-bucket, salt 0, and are sorted.
    point = (F.col("_sb") == -1) | (F.col("_sb") % 2 == 1)
    salted = (with_sub_bucket(df, value, cuts)
              .withColumn("_salt", F.when(point, F.pmod(F.spark_partition_id(), F.lit(SALTS)) + 1).otherwise(0)))
    inside = F.rank().over(Window.partitionBy("_sb", "_salt").orderBy(F.col(value).asc_nulls_first()))
    placed = salted.withColumn("_r", F.when(point, F.lit(1)).otherwise(inside))
    joined = placed.join(offsets, placed["_sb"] == offsets["_osb"], "inner")
    # bigint: a rank passes 2**31 long before 100 TB
    return joined.withColumn(out, (F.col("_off") + F.col("_r")).cast("long")).drop("_sb", "_salt", "_osb", "_off", "_r")


def global_ranks(df: DataFrame, specs: Sequence[tuple[str, str]], buckets: int | None = None) -> DataFrame:
    """Several global ranks of the same rows.

    All cut points come from one pass over ``df``, and every rank's counts
    come from ``df`` itself (the same rows), not from the previous rank's
    output.
    """
    cuts = value_cuts_many(df, [v for v, _ in specs], buckets)
    out = df
    for value, name in specs:
        out = global_rank(out, value, name, buckets, cuts[value], counts_from=df)
    return out


def exact_median(df: DataFrame, value: str, groups: Sequence[str] = (), out: str | None = None,
                 buckets: int | None = None, cuts: list | None = None) -> DataFrame:
    """Lower median (``percentile_disc(0.5)``) of non-null ``value`` per group.

    The value at 1-based position ``k = ceil(n / 2)`` in ascending order,
    exact at any scale and partitioning.  Sub-bucket counts locate the
    sub-bucket holding position k; if it is a cut point the answer is that
    cut, otherwise only that open sub-bucket's rows (about 1/buckets of the
    group) are sorted.  Global (no groups): one row, NULL when there are no
    values.  Grouped: one row per group that has a value.
    """
    out = out or f"median_{value}"
    groups = list(groups)
    vals = df.select(*groups, value).filter(F.col(value).isNotNull())
    cuts = value_cuts(vals, value, buckets) if cuts is None else usable_cuts(df.schema[value].dataType, cuts)
    rows = with_sub_bucket(vals, value, cuts)
    k = F.ceil(F.col("_n") / 2)
    target = (_sub_offsets(rows, groups).filter((F.col("_off") < k) & (F.col("_off") + F.col("_c") >= k))
              .select(*groups, "_sb", (k - F.col("_off")).alias("_k")))
    dtype = df.schema[value].dataType
    # Cut point j is the value of sub-bucket 2j+1: a table of at most
    # MAX_BUCKETS rows, built from the bounded cut list.
    points = [(2 * j + 1, c) for j, c in enumerate(cuts)]
    if isinstance(dtype, (FloatType, DoubleType)):
        points.append((_nan_sub(cuts), float("nan")))
    if isinstance(dtype, _TIME_TYPES):  # cut points are order keys: convert back
        cut_table = (df.sparkSession.createDataFrame(points, "_sb int, _ck bigint")
                     .select("_sb", _from_order_key(F.col("_ck"), dtype).alias(out)))
    else:
        cut_table = df.sparkSession.createDataFrame(
            points, StructType([StructField("_sb", IntegerType()), StructField(out, dtype)]))
    from_cut = (target.filter(F.col("_sb") % 2 == 1).join(F.broadcast(cut_table), "_sb", "inner")
                .select(*groups, out))
    open_t = target.filter(F.col("_sb") % 2 == 0)
    if not groups:
        open_t = F.broadcast(open_t)  # at most one row
    cand = rows.filter(F.col("_sb") % 2 == 0)
    cond = cand["_sb"] == open_t["_sb"]
    for g in groups:
        cond = cond & cand[g].eqNullSafe(open_t[g])
    sel = cand.join(open_t, cond, "inner").select(*[cand[g] for g in groups], cand[value], cand["_sb"], "_k")
    picked = (sel.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*groups, "_sb").orderBy(F.col(value))))
        .filter(F.col("_rn") == F.col("_k"))
        .select(*groups, F.col(value).alias(out)))
    hit = from_cut.unionByName(picked)
    if groups:
        return hit
    return hit.agg(F.max(out).alias(out))
