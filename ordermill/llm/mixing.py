"""Mixing sources to target weights by Poisson replication.

Each document draws a repetition count from a Poisson distribution whose mean
is its source's target repetition rate.  The draw inverts the distribution at
a hash of (seed, doc_id), so a retried task draws the same counts.  Copies are
exploded and dealt out by a hash key, which is the global shuffle.

Cases: a null or unlisted source belongs to one pooled group of weight
``other_weight``; repeated rows of one id draw equal counts; a null id hashes
the text ``null``; empty and null texts are mixed like any other; an empty
table gives an empty result; columns of the input named as an added column
are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UNIT_BITS = 52  # 13 hexadecimal digits of an md5

#: Production mixture: the large source is held to a fifth of the corpus.
WEIGHTS = {"src0": 4.75} | {f"src{i}": 1.0 for i in range(1, 20)}
OTHER_WEIGHT = 1.0
EPOCHS = 1.0
SEED = 17


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """(k0, cumulative probabilities from k0 on): the count drawn at ``u`` is
    k0 plus the number of entries that are <= u.  Bounded by some 24 standard
    deviations; what lies outside is less likely than one step of ``u``."""
    spread = 12 * math.sqrt(rate) + 40
    k0 = max(0, math.floor(rate - spread))
    total, steps = 0.0, []
    for k in range(k0, math.ceil(rate + spread) + 1):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        steps.append(total)
        if total >= 1 - 2.0 ** -(UNIT_BITS + 1):
            break
    return k0, steps


def hashed_text(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def mix(docs: DataFrame, weights: dict[str, float], other_weight: float = 0.0, epochs: float = 1.0,
        seed: int = 0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Rows of ``docs``, repeated so that source ``s`` makes up about
    ``weights[s] / sum of weights of the sources present`` of
    ``epochs * rows``.  Adds ``replica`` (1 up), ``rate`` (the mean count of
    its source) and ``shuffle_key``; rows lie in random order.

    Only ``len(weights) + 1`` group sizes reach the driver.
    """
    listed = F.col(source_col).isin(list(weights))
    group = F.when(listed, F.col(source_col))  # null: the pooled group
    sizes = {r[0]: r[1] for r in docs.groupBy(group).count().collect()}
    share = {g: (other_weight if g is None else weights[g]) for g in sizes}
    rows, whole = sum(sizes.values()), sum(share[g] for g in sorted(sizes, key=str))
    rates = {g: epochs * rows * share[g] / whole / n if share[g] else 0.0 for g, n in sizes.items()}

    draw = F.conv(F.substring(hashed_text(F.lit(f"mix|{seed}"), F.col(id_col)), 1, UNIT_BITS // 4), 16, 10)
    u = draw.cast("double") / F.lit(float(1 << UNIT_BITS))
    count, rate = F.lit(0), F.lit(0.0)
    for g, r in rates.items():
        mine = group.isNull() if g is None else group == g
        k0, steps = poisson_steps(r) if r > 0 else (0, [])
        drawn = F.lit(k0) + F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s <= u)) if steps else F.lit(0)
        count, rate = F.when(mine, drawn).otherwise(count), F.when(mine, F.lit(r)).otherwise(rate)
    copies = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return (docs.withColumn("rate", rate)
            .withColumn("replica", F.explode(copies))
            .withColumn("shuffle_key", hashed_text(F.lit(f"shuffle|{seed}"), F.col(id_col), F.col("replica")))
            .repartition("shuffle_key")
            .sortWithinPartitions("shuffle_key"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), WEIGHTS, OTHER_WEIGHT, EPOCHS, SEED)


_LISTED = ", ".join(f"('{k}', {v!r}::double)" for k, v in WEIGHTS.items())
MIXING_SQL = f"""
with weights(source, weight) as (values {_LISTED}),
grouped as (select d.*, w.source as grp from documents d left join weights w on d.source = w.source),
sizes as (select grp, count(*)::double as n from grouped group by grp),
shares as (select s.grp, s.n, coalesce(w.weight, {OTHER_WEIGHT}::double) as weight
           from sizes s left join weights w on s.grp = w.source),
rates as (select grp, {EPOCHS}::double * (select sum(n) from shares) * weight / (select sum(weight) from shares) / n as rate
          from shares),
steps as (select grp, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1.0))) over (partition by grp order by k) as cdf
          from (select grp, rate, unnest(range(0, (rate + 12 * sqrt(rate) + 41)::bigint)) as k from rates)),
drawn as (select g.*, r.rate,
                 ('0x' || substr(md5('mix|{SEED}|' || coalesce(g.doc_id::varchar, 'null')), 1, 13))::bigint::double
                 / {float(1 << UNIT_BITS)!r}::double as u
          from grouped g join rates r on g.grp is not distinct from r.grp),
counts as (select grp, rate, list(cdf order by k) as cdfs from steps group by grp, rate),
copies as (select d.*, unnest(range(1, 1 + len(list_filter(c.cdfs, lambda x: x <= d.u)))) as replica
           from drawn d join counts c on d.grp is not distinct from c.grp)
select doc_id, text, lang, source, n_chars, rate, replica::integer as replica,
       md5('shuffle|{SEED}|' || coalesce(doc_id::varchar, 'null') || '|' || replica) as shuffle_key
from copies
"""
