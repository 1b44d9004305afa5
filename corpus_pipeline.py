"""The corpus pipeline: quality rules, near-dedup, decontamination, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a runner writes it as Parquet and reads it back as the next stage's
docs. All but the last return the columns of documents. ORACLE_SQL is None: the adaptive thresholds (quantile sketches)
and the tokenizer have no SQL form; tests/llm checks the stages against brute force.

Defined results: the filtering stages judge rows by what they hold, not by id, so a null id is kept or dropped like any other and rows that
share an id are judged each for itself. Null, empty and very short texts go with the quality rules. Of the rows of a group of
near-copies one stays: that with the smallest id, a row without an id only if no row of the group has one, and of rows that repeat id
and text any one. Extra columns pass through to the packing stage, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernel.llm import decontamination, packing, quality_rules, secret_scan, simhash_neardup
from quernel.llm.common import stash, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_neardup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
