"""Shared helpers of the corpus operators: tables, written intermediates, ranks, components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.operators.joins import null_safe_join
from riskframe.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scopes: list[list[str]] = []


def materialise(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage at a stored table: a lost executor re-reads it, nothing is recomputed.
    Inside ``scratch`` the table goes with the scope unless ``keep`` is set.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    scopes = _scopes[:-1] if keep else _scopes
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Tables materialised inside are deleted at the end; results leave as ``materialise(..., keep=True)``."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand texts to Python at most ``rows`` at a time: Spark's 10,000 would hold whole books in memory.

    Lowers ``spark.sql.execution.arrow.maxRecordsPerBatch`` of the session if it is above ``rows``.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def with_row_ids(docs: DataFrame, tag: str) -> DataFrame:
    """``docs`` stored with a row id ``rid`` that later reads agree on."""
    return materialise(docs.withColumn("rid", F.monotonically_increasing_id()), tag)


def with_rank(df: DataFrame, groups: Sequence[str], order: Sequence[Column], spread: Column, n_rows: int, out: str,
              per_bucket: int = 4096, weight: str | None = None, tier: Column | None = None, n_tiers: int = 1) -> DataFrame:
    """Gapless rank (from 0) within ``groups``, or the running sum of ``weight`` before each row.

    Rows are dealt into ``n_rows / per_bucket`` buckets by the hash ``spread`` and ranked inside
    each bucket; offsets come from the small bucket-total table. No group, however large, is
    sorted in one task. The order is: ``tier`` (0 to ``n_tiers`` - 1) if given, bucket, then ``order``.
    """
    n_buckets = max(1, -(-n_rows // per_bucket))
    bucket = F.pmod(spread, F.lit(n_buckets))
    keyed = df.withColumn("_b", bucket if tier is None else tier * n_buckets + bucket)
    n_buckets *= n_tiers
    keys = [*groups, "_b"]
    size = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    totals = keyed.groupBy(*keys).agg(size.alias("_n"))
    # Offsets over buckets: one row per (group, bucket), prefix-summed within super-buckets first.
    width = max(1, int(n_buckets ** 0.5))
    totals = totals.withColumn("_s", (F.col("_b") / width).cast("long"))
    inner = Window.partitionBy(*groups, "_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    supers = totals.groupBy(*groups, "_s").agg(F.sum("_n").alias("_sn"))
    outer = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0)))
    supers = supers.withColumn("_so", F.coalesce(F.sum("_sn").over(
        outer.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sn")
    offsets = totals.withColumn("_io", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    offsets = null_safe_join(offsets, supers, [*groups, "_s"]).select(*keys, (F.col("_io") + F.col("_so")).alias("_o"))
    within = Window.partitionBy(*keys).orderBy(*order)
    if weight:
        before = F.coalesce(F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    else:
        before = (F.row_number().over(within) - 1).cast("long")
    ranked = keyed.withColumn("_r", before)
    return null_safe_join(ranked, offsets, keys).withColumn(out, (F.col("_r") + F.col("_o")).cast("long")).drop("_r", "_o", "_b")


def connected_components(edges: DataFrame, tag: str, max_rounds: int = 40) -> DataFrame:
    """Smallest reachable node of every node in ``edges`` (a, b): columns (node, component).

    Alternates min-label propagation over the edges with pointer jumping; each round is one
    join plus one min aggregate (combined map-side, so a hub costs one row per map task) and is
    written to the shared folder. Raises when it has not converged after ``max_rounds``.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.where("a <> b").distinct(), f"{tag}-edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("component")), f"{tag}-cc")
    for _ in range(max_rounds):
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("m"))
        step = labels.join(near, labels.node == near.a).select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        heads = labels.select(F.col("node").alias("h"), F.col("component").alias("hc"))
        jumped = step.join(heads, step.component == heads.h, "left").select(
            "node", "old", F.least("component", F.coalesce("hc", "component")).alias("component"))
        jumped = materialise(jumped, f"{tag}-cc")
        labels = jumped.select("node", "component")
        if not jumped.where("old <> component").limit(1).count():
            return labels
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")
