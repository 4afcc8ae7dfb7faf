"""The corpus pipeline: five stages over documents, each written and read again.

Every stage works on all rows that the one before kept. A row is known by its
id and a hash of its text, so repeated ids do not mix up rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontamination, mixing, simhash, substrings, toxicity
from riskweave.llm.common import read, remainder_of
from riskweave.session import clean_up, new_path, paths_made

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine calls toxic go."""
    machine = toxicity.fit(docs, read(spark, sf_dir, "labels"), remainder_of(F.col("doc_id"), 5) == 0)
    return toxicity.score(docs, machine, COLUMNS).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the least id stays."""
    return simhash.without_near_duplicates(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeat a document with a smaller id go; every document stays."""
    kept = substrings.deduplicate(docs, keep=("doc_id", "lang", "source")).withColumn("text", F.col("kept_text"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with their texts and the number of words that
    each gives (its first ones, where it is less than all); others go."""
    return mixing.mix(docs, keep=("text", "lang")).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
#: No SQL: a trained model, XXH64 and bytes are beyond it; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; only the last table stays in the shared folder."""
    docs, made, path = read(spark, sf_dir, "documents"), paths_made(), ""
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        clean_up(spark, made, (path,))
    return docs
