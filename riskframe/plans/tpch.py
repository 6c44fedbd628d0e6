"""Binding of the roll-up specs to the driver's TPC-H-like tables.

Roles (one applicant = one customer):

=====================  ================================================
applicant              ``customer`` (+ ``nation``); TARGET = in debt
bureau (child)         ``orders`` by ``o_custkey``, status ``o_orderstatus``
bureau_balance         ``lineitem`` by ``l_orderkey``, status ``l_returnflag``
previous_application   ``orders`` by ``o_custkey``, status ``o_orderpriority``
pos_cash / credit_card ``events`` by ``user_id``, status ``event_type``
installments           ``lineitem`` joined to ``orders``, lateness =
                       days from order to shipment
=====================  ================================================

Readers select only the columns a family uses, so the Parquet scan reads
just those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.exprs import clip_lower, safe_divide, sentinel_to_null
from riskframe.operators.rollup import Flag, RollupSpec, attach, rollup, rollup_many, two_level_rollup
from riskframe.sources.catalog import read_parquet_table

KEY = "c_custkey"
TARGET = "TARGET"

# Status values of the driver tables (fixed values).
ORDER_STATUS = {"OPEN": "O", "FILLED": "F", "PARTIAL": "P"}
RETURN_FLAGS = ("A", "N", "R")
PRIORITY_FLAGS = {"URGENT": "1-URGENT", "HIGH": "2-HIGH", "LOW": "5-LOW"}
POS_EVENT_FLAGS = {"PURCHASE": "purchase", "CLICK": "click", "VIEW": "view"}
CC_EVENT_FLAGS = {"SIGNUP": "signup", "ERROR": "error", "CLICK": "click"}
# Day-of-month 1 is treated as a "no value" placeholder for ORDER_DAY.
ORDER_DAY_SENTINEL = 1
# Value thresholds for the overdue-style flags on events.value.
DPD_THRESHOLD, DPD_30_THRESHOLD, DPD_DEF_THRESHOLD = 0, 30, 100
# Decimal places of the summed doubles: money and rates as stored, ratios to where a
# double still resolves the largest of them.
ORDER_SCALES = {"o_totalprice": 2, "PREV_PRICE_DAY_RATIO": 9}
EVENT_SCALES = {"value": 2, "CC_VALUE_HOUR_RATIO": 9, "CC_MINUTE_VALUE_RATIO": 9}
LINE_SCALES = {"l_quantity": 2, "l_extendedprice": 2, "l_discount": 2, "INST_PAYMENT_RATIO": 12,
               "INST_TAX_DISCOUNT_RATIO": 12, "INST_PAYMENT_DIFF": 4}


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    return read_parquet_table(spark, f"{sf_dir}/{name}.parquet", columns)


# ------------------------------------------------------------------ applicants

def applicant_derived() -> dict:
    return {
        TARGET: (F.col("c_acctbal") < 0).cast("int"),
        "APP_NATION_REGION_RATIO": safe_divide("c_nationkey", "n_regionkey"),
        "APP_REGION_NATION_RATIO": safe_divide("n_regionkey", "c_nationkey"),
    }


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: key, raw features, derived columns and TARGET.

    ``c_acctbal`` defines TARGET, so it is dropped from the features.
    ``nation`` is a fixed 25-row dimension; the planner broadcasts it under
    ``autoBroadcastJoinThreshold`` (a size check on its statistics).
    """
    cust = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey", "n_name"])
    joined = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").drop("n_nationkey")
    return joined.withColumns(applicant_derived()).select(
        KEY, "c_nationkey", "n_regionkey", "c_mktsegment", "n_name",
        "APP_NATION_REGION_RATIO", "APP_REGION_NATION_RATIO", TARGET)


APPLICATION_DERIVED_COLUMNS = ["APP_NATION_REGION_RATIO", "APP_REGION_NATION_RATIO"]


# ------------------------------------------------------------------ bureau family

def bureau_balance_spec() -> RollupSpec:
    return RollupSpec(
        prefix="BB", key="l_orderkey", min_max=("l_linenumber",),
        flags=[Flag(f"BB_STATUS_{v}", F.col("l_returnflag") == v) for v in RETURN_FLAGS])


def bureau_spec() -> RollupSpec:
    bb = bureau_balance_spec().feature_names()
    return RollupSpec(
        prefix="BUREAU", key="o_custkey", unique="o_orderkey",
        flags=[Flag(f"BUREAU_{name}", F.col("o_orderstatus") == v) for name, v in ORDER_STATUS.items()],
        numerics=("o_totalprice", *bb), scales=ORDER_SCALES)


def bureau_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"])
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    out = two_level_rollup(lineitem, orders, bureau_balance_spec(), bureau_spec(), link="o_orderkey")
    return out.withColumnRenamed("o_custkey", KEY)


# ------------------------------------------------------------------ previous applications

def previous_spec() -> RollupSpec:
    day = F.dayofmonth("o_orderdate")
    return RollupSpec(
        prefix="PREV", key="o_custkey", unique="o_orderkey",
        derived={
            "ORDER_DAY": sentinel_to_null(day, ORDER_DAY_SENTINEL),
            "ORDER_MONTH": F.month("o_orderdate"),
            "PREV_PRICE_DAY_RATIO": safe_divide("o_totalprice", day - F.lit(1)),
        },
        flags=[Flag(f"PREV_{name}", F.col("o_orderpriority") == v) for name, v in PRIORITY_FLAGS.items()],
        numerics=("o_totalprice", "ORDER_DAY", "ORDER_MONTH", "PREV_PRICE_DAY_RATIO"), scales=ORDER_SCALES)


def previous_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return rollup(orders, previous_spec()).withColumnRenamed("o_custkey", KEY)


# ------------------------------------------------------------------ monthly balances (events)

def _dpd_flags(prefix: str) -> list[Flag]:
    v = F.col("value")
    return [Flag(f"{prefix}_DPD", v > DPD_THRESHOLD, rate=True),
            Flag(f"{prefix}_DPD_30", v >= DPD_30_THRESHOLD, rate=True),
            Flag(f"{prefix}_DPD_DEF", v >= DPD_DEF_THRESHOLD, rate=True)]


def pos_spec() -> RollupSpec:
    return RollupSpec(
        prefix="POS", key="user_id", unique="props",
        derived={"EVENT_HOUR": F.hour("ts"), "EVENT_MONTH": F.month("ts")},
        flags=[Flag(f"POS_{name}", F.col("event_type") == v) for name, v in POS_EVENT_FLAGS.items()]
        + _dpd_flags("POS"),
        numerics=("value", "EVENT_HOUR", "EVENT_MONTH"), scales=EVENT_SCALES)


def credit_card_spec() -> RollupSpec:
    return RollupSpec(
        prefix="CC", key="user_id", unique="props",
        derived={
            "EVENT_MINUTE": F.minute("ts"),
            "CC_VALUE_HOUR_RATIO": safe_divide("value", F.hour("ts")),
            "CC_MINUTE_VALUE_RATIO": safe_divide(F.minute("ts"), "value"),
        },
        flags=[Flag(f"CC_{name}", F.col("event_type") == v) for name, v in CC_EVENT_FLAGS.items()]
        + _dpd_flags("CC"),
        numerics=("value", "EVENT_MINUTE", "CC_VALUE_HOUR_RATIO", "CC_MINUTE_VALUE_RATIO"), scales=EVENT_SCALES)


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events", ["user_id", "ts", "event_type", "value", "props"])


def pos_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(_events(spark, sf_dir), pos_spec()).withColumnRenamed("user_id", KEY)


def credit_card_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(_events(spark, sf_dir), credit_card_spec()).withColumnRenamed("user_id", KEY)


# ------------------------------------------------------------------ instalments

def installments_spec() -> RollupSpec:
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    paid = price * (F.lit(1.0) - disc)
    lag = F.datediff("l_shipdate", "o_orderdate")
    return RollupSpec(
        prefix="INST", key="o_custkey", unique="l_orderkey",
        derived={
            "SHIP_LAG_DAYS": lag,
            "INST_PAYMENT_RATIO": safe_divide(paid, price),
            "INST_TAX_DISCOUNT_RATIO": safe_divide("l_tax", disc),
            "INST_PAYMENT_DIFF": price - paid,
            "INST_DPD": clip_lower(lag, 0),
            "INST_DBD": clip_lower(F.datediff("o_orderdate", "l_shipdate"), 0),
        },
        flags=[Flag("INST_LATE", lag > 0, rate=True),
               Flag("INST_LATE_30", lag >= 30, rate=True),
               Flag("INST_UNDERPAY", paid < price, rate=True)],
        numerics=("l_quantity", "l_extendedprice", "l_discount", "SHIP_LAG_DAYS", "INST_PAYMENT_RATIO",
                  "INST_TAX_DISCOUNT_RATIO", "INST_PAYMENT_DIFF", "INST_DPD", "INST_DBD"), scales=LINE_SCALES)


def installments_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem",
                     ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"])
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    rows = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").drop("o_orderkey")
    # The orders that have a line: the same pairs as in the joined lines, from a join of keys.
    ids = orders.join(lineitem, lineitem.l_orderkey == orders.o_orderkey, "left_semi").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    return rollup(rows, installments_spec(), ids).withColumnRenamed("o_custkey", KEY)


def orders_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bureau and previous-application roll-ups share ``orders`` and its customer
    key: one scan of orders, one aggregation for both (the BB join is 1:1)."""
    lineitem = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"])
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate", "o_orderpriority"])
    enriched = attach(orders, rollup(lineitem, bureau_balance_spec()), on="o_orderkey", features_key="l_orderkey")
    return rollup_many(enriched, [bureau_spec(), previous_spec()]).withColumnRenamed("o_custkey", KEY)


def events_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POS and card roll-ups in one scan and one aggregation of ``events``."""
    return rollup_many(_events(spark, sf_dir), [pos_spec(), credit_card_spec()]).withColumnRenamed("user_id", KEY)


# Same columns as FAMILIES, fewer scans and shuffles: used to build the applicant table.
MERGED_FAMILIES = {
    "orders": orders_families,
    "events": events_families,
    "installments": lambda spark, sf_dir: installments_family(spark, sf_dir),
}

FAMILIES = {
    "bureau": bureau_family,
    "previous_application": previous_family,
    "pos_cash": pos_family,
    "credit_card": credit_card_family,
    "installments": installments_family,
}

FAMILY_SPECS = {
    "bureau": bureau_spec,
    "previous_application": previous_spec,
    "pos_cash": pos_spec,
    "credit_card": credit_card_spec,
    "installments": installments_spec,
}
