"""From raw documents to packed sequences: language ID, near-dedup, decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and, but for the last, returns the
columns of documents. Between stages the rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palmares.llm import decontam, language, packing, pii, simhash
from palmares.llm.common import written
from palmares.llm.queries import pii_key, table


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence."""
    return language.accepted(docs, declared=docs["lang"], address=docs["source"], host=docs["source"])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints (4-word shingles, 4 bits)."""
    return simhash.one_of_each(docs, shingle=4, radius=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the personal data in their texts; n_chars follows the text."""
    return pii.pseudonymised(docs, pii_key(spark)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("language_id", by_language),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

#: SQL has neither XXH64 nor best-fit packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
