"""Applicant-level assembly: families once, left-joined to each applicant frame.

Every family table is grouped by the applicant key, so each comes out
hash-partitioned on it; the join chain then shuffles only the applicant side
(or nothing, when AQE turns a small family into a broadcast after measuring
it). Families stored bucketed by the key (``stored_families``) are joined to any
number of applicant frames without an exchange of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.catalog import write_parquet


def feature_groups(families: Mapping[str, DataFrame], key: str,
                   application_derived: Sequence[str]) -> dict[str, list[str]]:
    groups = {"application_derived": list(application_derived)}
    for name, df in families.items():
        groups[name] = [c for c in df.columns if c != key]
    return groups


def join_families(applicants: DataFrame, families: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Left join in a fixed order; applicants without child rows keep nulls."""
    out = applicants
    for df in families.values():
        out = out.join(df, on=key, how="left")
    return out


def build_applicant_tables(frames: Mapping[str, DataFrame], families: Mapping[str, DataFrame],
                           key: str) -> dict[str, DataFrame]:
    """Same family tables joined to every applicant frame (train, test ...)."""
    return {name: join_families(df, families, key) for name, df in frames.items()}


def write_families(families: Mapping[str, DataFrame], root: str, key: str, buckets: int, prefix: str = "family_") -> None:
    """Persist each family bucketed by the applicant key (co-located joins), one file per bucket."""
    for name, df in families.items():
        write_parquet(df.repartition(buckets, key), f"{root}/{name}", bucket_by=(buckets, key), table_name=f"{prefix}{name}")


@contextmanager
def stored_families(spark: SparkSession, families: Mapping[str, DataFrame], root: str, key: str,
                    buckets: int | None = None) -> Iterator[dict[str, DataFrame]]:
    """The families written bucketed below ``root``, as tables that joins on ``key`` read in place.

    ``buckets`` defaults to ``spark.sql.shuffle.partitions``. The catalog holds the tables, under names of this
    run, until the block ends; the files stay.
    """
    prefix = f"family_{uuid.uuid4().hex}_"
    try:
        write_families(families, root, key, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), prefix)
        yield {name: spark.table(f"{prefix}{name}") for name in families}
    finally:
        for name in families:
            spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
