"""Registry and shared inputs of the registered queries.

A registered query is ``name -> (spark, sf_dir) -> DataFrame`` running a
library operator on whole driver tables. Double outputs are rounded to
``DIGITS`` places so results compare exactly with the reference SQL in
:mod:`riskframe.plans.oracle` (summation order differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, FloatType

from riskframe.operators.quantiles import sql_name
from riskframe.plans import tpch
from riskframe.plans.assemble import join_families
from riskframe.session import cut_lineage, ensure_checkpoint_dir

DIGITS = 6
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_half_away_sql(value: str, digits: int = DIGITS) -> str:
    """The SQL expression ``value`` rounded on the binary value, half away from zero:
    sign(y) * floor(|y| + 0.5) / 10^d with y = x * 10^d. The SQL engine used as the
    reference rounds doubles this way, so identical doubles round identically on both
    sides (``round`` rounds the shortest decimal string instead, which differs at some ties)."""
    scale = f"{float(10 ** digits)!r}D"
    y = f"(CAST({value} AS DOUBLE) * {scale})"
    return (f"CASE WHEN abs({y}) < {2.0 ** 52!r}D THEN signum({y}) * CAST(floor(abs({y}) + 0.5D) AS DOUBLE) / {scale} "
            f"ELSE {y} / {scale} END")


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Every double rounded; one SQL expression a column, so wide tables cost one call instead of one for each column and operand."""
    names = [(sql_name(f.name), isinstance(f.dataType, (DoubleType, FloatType))) for f in df.schema.fields]
    return df.selectExpr(*[f"{round_half_away_sql(c, digits)} AS {c}" if is_double else c for c, is_double in names])


def families(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Family tables for the applicant join; families sharing a source are
    aggregated together (same columns, same order)."""
    return {name: build(spark, sf_dir) for name, build in tpch.MERGED_FAMILIES.items()}


def applicant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: one wide feature row per customer (unrounded)."""
    return join_families(tpch.applicants(spark, sf_dir), families(spark, sf_dir), tpch.KEY)


def features(spark, sf_dir):
    return applicant_features(spark, sf_dir)


def stored_features(spark, sf_dir):
    """The applicant table written once to the shared checkpoint folder, for
    queries that read it in several passes (fits, splits)."""
    return cut_lineage(features(spark, sf_dir))


def split_assignment(spark, sf_dir):
    from riskframe.operators.prepare import stratified_split

    apps = tpch.applicants(spark, sf_dir).select(tpch.KEY, tpch.TARGET)
    return stratified_split(apps, tpch.KEY, tpch.TARGET, test_size=0.2, seed=42)


def union_all(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage_dir(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never a node-local temp dir)."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex[:12]}"


# Inputs named by several queries and by their SQL twins (fixed choices of columns).
CORR_COLUMNS = ["TARGET", "c_nationkey", "n_regionkey", "BUREAU_O_TOTALPRICE_MEAN", "PREV_O_TOTALPRICE_SUM",
                "INST_L_QUANTITY_MEAN", "INST_INST_DPD_MEAN", "POS_VALUE_MEAN", "CC_VALUE_MEAN"]
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax"]
STATUS_SOURCES = [("orders", "o_orderstatus"), ("orders", "o_orderpriority"), ("lineitem", "l_returnflag"),
                  ("events", "event_type")]
RECORD_SOURCES = [("lineitem", "l_orderkey"), ("orders", "o_custkey"), ("events", "user_id")]
OVERVIEW_TABLES = {"customer": "c_custkey", "orders": "o_custkey", "lineitem": "l_orderkey",
                   "events": "user_id", "part": "p_partkey", "supplier": "s_suppkey"}
