"""From raw documents to a training mixture, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its
predecessor kept.  All but the last return the columns of documents; the last
repeats or leaves out documents and adds ``rate``, ``replica`` and
``shuffle_key``.  Between stages the documents are written as Parquet to the
shared folder and read again, so a lost executor costs one stage at most.

Cases: rows with a null, empty or letterless text go in the first stage.  Null
ids, languages and sources are kept as values: a row without an id neither
trains nor is held out, is mixed under one draw with its like, and gives way to
a copy that has an id.  Rows with one id but texts that are not linked all
stay; of equal rows one stays.  Columns besides those of documents pass through
all stages; they may not be called ``rate``, ``replica`` or ``shuffle_key``.
An empty table gives no rows; long texts are read whole in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import decontam, langid, mixing, ngram_join, quality_rules
from ordermill.llm.common import table
from ordermill.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language the model recognises; it learns from rows outside the held-out fold."""
    return langid.keep_languages(docs, langid.fit(docs, learn=langid.learning_rows()))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rule and the compression bands keep."""
    return quality_rules.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of linked texts."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that leak no item of the benchmark table."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows repeated to the production mixture and shuffled."""
    return mixing.mix(docs, mixing.WEIGHTS, mixing.OTHER_WEIGHT, mixing.EPOCHS, mixing.SEED)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mix),
]

#: SQL has neither zstandard nor alignment; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
