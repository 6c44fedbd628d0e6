"""A training-data pipeline over ``documents``: five stages, each one of the corpus operators.

Every stage works on all rows its predecessor kept; all but the last return the columns of
``documents``. ``run`` writes each stage as Parquet under the shared checkpoint folder and reads
it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import apportion, chosen_path, spaced_seeds, token_blocks, toxicity_fst
from riskframe.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents which the toxicity grammar rejects (score 0.5 or more) go."""
    return toxicity_fst.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class at 0.8 five-word Jaccard stays, the one with the smallest doc_id."""
    return chosen_path.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return spaced_seeds.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeat or go so that the sources reach their target weights."""
    return apportion.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as PFOR token segments; one row per document read back from them."""
    return token_blocks.token_blocks(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixture", mix_sources),
    ("tokens", write_tokens),
]

# The learned scores, the seeded selection and the token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
