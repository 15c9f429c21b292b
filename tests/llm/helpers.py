"""Shared inputs: a table with every odd case, and prose to plant things in."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("rate", "replica", "shuffle_key", "node", "n", "token", "score", "kept", "label", "salt", "held_out", "copy")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    parts = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w.capitalize() + "." if i % 11 == 10 else w for i, w in enumerate(made))


LONG = prose(99, 30_000)


def odd_rows() -> list[tuple]:
    """Null and empty texts, no letters, a very long text, ties, repeats, null keys."""
    text = prose(1, 120)
    rows = [(1, None, "en", "src0"), (2, "", "en", "src0"), (3, " \n\t ", None, None), (4, "1234 !!", "de", "src1"),
            (5, LONG, "en", "src0"), (6, text, "en", "src0"), (6, text, "en", "src0"), (7, text, None, "src2"),
            (8, "one two", "fr", None), (9, "one two", "fr", "src3"), (None, prose(2, 80), "en", "src0"),
            (None, None, None, None), (10, prose(3, 60) + "\x00 ☃ \U0001F600", "es", "elsewhere")]
    return [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]


def odd_docs(spark):
    """The odd rows with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    return docs.withColumns({c: F.lit("x") for c in CLASH})


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts: dict, lang: str = "en"):
    return spark.createDataFrame([(i, t, lang, "src0", len(t or "")) for i, t in texts.items()], SCHEMA)
