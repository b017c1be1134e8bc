"""Corpus pipeline over ``documents``: toxicity filter, SimHash near-dedup, benchmark
decontamination, PII redaction, mixing to target weights.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's documents. All but the last return the columns of ``documents``;
the mix adds ``copy``, the number of each repetition.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from opslens.llm import decontam, mixing, pii, simhash, toxicity
from opslens.llm.common import scratch_table, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the Kneser-Ney models predict toxic go."""
    return toxicity.keep_ordinary(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (4-word shingles, at most 4 differing bits)."""
    return simhash.keep_representatives(docs, shingle=4, max_bits=4)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; ``n_chars`` follows the text."""
    return pii.redact(docs, n_chars_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def _shipped(stage):
    """The stage, with the package sent to the workers before its first task."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _shipped(drop_toxic)),
    ("near_dedup", _shipped(drop_near_duplicates)),
    ("decontamination", _shipped(drop_benchmark_passages)),
    ("pii", _shipped(redact_pii)),
    ("mixing", _shipped(mix_sources)),
]

# The trained models, the CGK walk and the pivotal rounding have no SQL form;
# the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
