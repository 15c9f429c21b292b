"""Personal data: patterns, and the terms around them that give them away.

Four kinds of protected entities are found by pattern (``KINDS``).  What else
reveals an entity is estimated from the whole corpus: of ``N`` documents
``n(e)`` hold entity ``e``, ``n(t)`` hold term ``t``, and ``n(e, t)`` have
``t`` beside ``e``.  Their pointwise mutual information
``log(N n(e, t) / (n(e) n(t)))`` is the part of the entity's own information
``log(N / n(e))`` that the term discloses.  Where that share reaches
``DISCLOSED``, seen in at least ``SUPPORT`` different surroundings, every
occurrence of the term in a document that holds the entity is a span of kind
``term``.  It is generalised to its first letters if these disclose less than
that of every such entity of the document, and else removed.

Everything is DataFrame functions.  Spans are found row by row, without a
shuffle; counts are combined before they are shuffled; only rows with an
entity are joined, on the text's digest.  Matching takes time in proportion to
the text: the patterns are written so that no start and no repeat is tried
twice.  A document's spans are held in its row.

Cases: null and empty texts have no spans; equal texts get equal spans, whatever
their ids; only id and text are read, so other columns may clash; an empty
table gives no rows.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import table
from .components import saved

KINDS = ("email", "ip", "card", "phone")
BESIDE = 80  # code points on either side whose words count as beside an entity
SUPPORT = 3
DISCLOSED = 0.7
STEM = 3  # letters of a generalised term
SPANS = "array<struct<kind: string, start: bigint, end: bigint, replacement: string>>"
RUN, LEVELS = 64, 4  # of running sums: 64 ** 5 matches, more than a text can hold

_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: The kinds' patterns without second tries: a match starts where a run of its
#: first characters starts or the last match ended, and repeats are possessive.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A word of letters that is no part of an address, a number or an identifier.
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}{2,}+(?![\p{N}@_%+-]|\.[\p{L}\p{N}])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def running_sums(values: Column, levels: int = LEVELS) -> Column:
    """Sums of an array up to and with every element: within its run of ``RUN``
    elements, plus the running sums of the runs."""
    within = lambda a, i: _sum(F.slice(a, i - i % RUN + 1, i % RUN + 1))

    def summed(a: Column) -> Column:
        few = F.transform(a, lambda x, i: within(a, i))
        if not levels:
            return few
        runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / RUN).cast("int") - 1), lambda k: _sum(F.slice(a, k * RUN + 1, F.lit(RUN))))
        many = let(running_sums(runs, levels - 1), lambda before: F.transform(
            a, lambda x, i: within(a, i) + F.coalesce(F.get(before, F.floor(i / RUN).cast("int") - 1), F.lit(0))))
        return F.when(F.size(a) <= RUN, few).otherwise(many)

    return let(values, summed)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value, before,
    after); ``before`` and ``after`` are the text up to the neighbouring matches."""
    def placed(found: Column) -> Column:
        def zipped(pieces: Column) -> Column:
            lengths = F.zip_with(pieces, found, lambda p, m: F.length(p) + F.length(m))
            ends = running_sums(F.slice(lengths, F.lit(1), F.size(found)))
            parts = F.arrays_zip(ends.alias("end"), found.alias("value"), F.slice(pieces, F.lit(1), F.size(found)).alias("before"),
                                 F.slice(pieces, F.lit(2), F.size(found)).alias("after"))
            return F.transform(parts, lambda x: F.struct(
                (x["end"] - F.length(x["value"])).alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                x["before"].alias("before"), x["after"].alias("after")))

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), zipped))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small_parts(value: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))


def _luhn(value: Column) -> Column:
    def total(digits: Column) -> Column:
        def worth(d: Column, i: Column) -> Column:
            twice = (i % 2 == 1) & (d > 4)
            return F.when(i % 2 == 1, 2 * d).otherwise(d) - F.when(twice, F.lit(9)).otherwise(F.lit(0))

        return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: worth(c.cast("int"), i)), F.lit(0), lambda a, x: a + x)

    return F.length(_digits(value)).between(13, 19) & (total(F.substring(_digits(value), 1, 19)) % 10 == 0)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}
#: How two spellings of an entity are told to be the same.
SAME: dict[str, Callable[[Column], Column]] = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}


def words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def stem(word: Column) -> Column:
    """The generalised form, told from a word by its mark."""
    return F.concat(F.substring(word, 1, STEM), F.lit("*"))


def tokens(found: Column) -> Column:
    """Distinct words and their generalised forms."""
    return let(F.array_distinct(found), lambda w: F.array_union(w, F.transform(w, stem)))


def _beside(found: Column) -> tuple[Column, Column]:
    """The code points next to a match, without a word that was cut."""
    before, after = found["before"], found["after"]
    near = F.when(F.length(before) > BESIDE, F.regexp_replace(F.right(before, F.lit(BESIDE)), r"^\S*", "")).otherwise(before)
    far = F.when(F.length(after) > BESIDE, F.regexp_replace(F.left(after, F.lit(BESIDE)), r"\S*$", "")).otherwise(after)
    return near, far


def entities(text: Column) -> Column:
    """All valid matches: array of (kind, start, end, entity, surroundings, tokens)."""
    def of(kind: str) -> Column:
        def described(m: Column) -> Column:
            near, far = _beside(m)
            return F.struct(
                F.lit(kind).alias("kind"), m["start"].cast("bigint").alias("start"), m["end"].cast("bigint").alias("end"),
                F.concat(F.lit(f"{kind}:"), SAME[kind](m["value"])).alias("entity"),
                F.xxhash64(near, far).alias("surroundings"), tokens(F.concat(words(near), words(far))).alias("tokens"))

        kept = F.filter(matches(text, PATTERNS[kind]), lambda m: VALID[kind](m["value"]))
        return F.coalesce(F.transform(kept, described), F.array())

    return F.concat(*[of(k) for k in KINDS])


def disclosing(found: DataFrame, texts: DataFrame, path: str) -> DataFrame:
    """entity, term, replacement: the terms that disclose an entity of
    ``found`` (row, entities), given all ``texts`` (text)."""
    total = texts.agg(F.count(F.lit(1)).alias("total"))
    frequency = texts.select(F.explode(tokens(words(F.col("text")))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("with_token"))
    held = found.select("row", F.explode("entities").alias("e"))
    per_entity = held.groupBy(F.col("e.entity").alias("entity")).agg(F.count_distinct("row").alias("with_entity"))
    beside = held.select("row", "e.entity", "e.surroundings", F.explode("e.tokens").alias("token"))
    beside = beside.groupBy("entity", "token").agg(
        F.count_distinct("row").alias("with_both"), F.count_distinct("surroundings").alias("support"))
    beside = beside.filter(F.col("support") >= SUPPORT).join(frequency, "token").join(per_entity, "entity")
    n = total.scalar()
    shared = F.log(n * F.col("with_both") / (F.col("with_entity") * F.col("with_token")))
    share = (shared / F.log(n / F.col("with_entity"))).alias("share")  # null where all documents hold the entity
    shares = saved(beside.select("entity", "token", share), f"{path}/shares")  # read twice, counted once
    general = shares.select("entity", F.col("token").alias("general"), F.col("share").alias("general_share"))
    terms = shares.filter((F.col("share") >= DISCLOSED) & ~F.col("token").endswith("*")).withColumn("general", stem(F.col("token")))
    safe = F.coalesce(F.col("general_share"), F.lit(1.0)) < DISCLOSED
    return terms.join(general, ["entity", "general"], "left").select(
        "entity", F.col("token").alias("term"), F.when(safe, F.col("general")).otherwise("").alias("replacement"))


def term_spans(text: Column, terms: Column) -> Column:
    """Spans of ``terms`` (map of term to replacement) in a text."""
    found = F.filter(matches(text, TERM), lambda m: F.map_contains_key(terms, F.lower(m["value"])))
    return F.transform(found, lambda m: F.struct(
        F.lit("term").alias("kind"), m["start"].cast("bigint").alias("start"), m["end"].cast("bigint").alias("end"),
        F.element_at(terms, F.lower(m["value"])).alias("replacement")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text and ``spans``, an array of (kind, start,
    end, replacement) by kind and start; text is null where there are none."""
    path = scratch_path(docs.sparkSession, "pii")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = texts.withColumn("entities", entities(F.col("text")))
    held = F.size("entities") > 0
    rows = saved(rows.select("doc_id", "entities", F.when(held, F.col("text")).alias("text"), F.when(held, F.sha2("text", 256)).alias("key"),
                             F.monotonically_increasing_id().alias("row")), f"{path}/rows")
    found = rows.filter(F.col("key").isNotNull())
    terms = saved(disclosing(found, texts.select("text"), path), f"{path}/terms")
    # The texts' own words meet the terms, not the entities all of theirs.  One
    # entry per text and term: removed if any entity asks for it.
    said = found.select("key", F.col("entities.entity").alias("held"), "text").dropDuplicates(["key"])
    said = said.select("key", "held", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    asked = said.join(terms, "term").filter(F.array_contains("held", F.col("entity")))
    asked = asked.groupBy("key", "term").agg(F.min("replacement").alias("replacement"))
    asked = asked.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "replacement"))).alias("terms"))
    base = F.transform("entities", lambda e: F.struct(
        e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end"),
        F.concat(F.lit("["), F.upper(e["kind"]), F.lit("]")).alias("replacement")))
    more = F.when(F.col("terms").isNotNull(), term_spans(F.col("text"), F.col("terms")))
    with_terms = found.select("doc_id", "text", "entities", "key").join(asked, "key", "left").select(
        "doc_id", "text", F.concat(base, F.coalesce(more, F.array().cast(SPANS))).alias("spans"))
    without = rows.filter(F.col("key").isNull()).select("doc_id", "text", base.alias("spans"))
    return with_terms.unionByName(without)


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span replaced; of overlapping spans the first one's text is put in."""
    ordered = F.array_sort(spans, lambda x, y: F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(
        F.signum(y["end"] - x["end"])).cast("int"))
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def put(held: Column, s: Column) -> Column:
        between = F.substring(text, (held["at"] + 1).cast("int"), (s["start"] - held["at"]).cast("int"))
        out = F.when(s["start"] < held["at"], held["out"]).otherwise(F.concat(held["out"], between, s["replacement"]))
        return F.struct(F.greatest(held["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(ordered, begin, put, lambda h: F.concat(h["out"], F.substring(text, (h["at"] + 1).cast("int"), F.length(text))))


def told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id", *map(count_of, KINDS), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
