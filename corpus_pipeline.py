"""A training corpus from ``documents``: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame with the columns of
``documents``; the last adds the shard columns.  ``run`` writes each stage's result
to the shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import decontaminate, langid, mixing, ngramjoin, sharding
from skyledger.llm.common import drop_materialized, materialize, materialized, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is known."""
    found = langid.identify(docs, langid.fit(docs, "text", "lang", folds=2))
    return found.where("NOT lang_rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles of Jaccard 0.8 or more."""
    return ngramjoin.keep_one(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten words in a row of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), action="drop")
    return found.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as it takes them."""
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard of 40 and their place in it."""
    return sharding.shard_documents(docs, 40)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Naive Bayes sums cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), materialized()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        drop_materialized(spark, before, keep=(docs._materialized,))  # the stage before and what this one made on the way
    return STAGES[-1][1](spark, docs, sf_dir)
