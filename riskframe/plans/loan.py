"""Binding of the roll-up specs to the raw loan tables (CSV with header).

``build_processed_datasets`` is the whole applicant-level job: clean the two
application tables, roll up the five families once, left-join them to both,
write Parquet and a manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from riskframe.functions.exprs import (
    clip_lower, row_max, row_mean, row_min, safe_divide, sentinel_to_null,
)
from riskframe.operators.rollup import Flag, RollupSpec, rollup, two_level_rollup
from riskframe.plans.assemble import build_applicant_tables, feature_groups, stored_families
from riskframe.sources.catalog import TableRegistry, manifest_of, write_json, write_parquet

KEY = "SK_ID_CURR"
TARGET = "TARGET"

# ---------------------------------------------------------------- fixed values
# Table files, sentinel, status values, derived and numeric column lists as used
# by the reference pipeline (they define the feature names).
RAW_TABLE_FILES = {
    "application_train": "application_train.csv",
    "application_test": "application_test.csv",
    "bureau": "bureau.csv",
    "bureau_balance": "bureau_balance.csv",
    "previous_application": "previous_application.csv",
    "pos_cash_balance": "POS_CASH_balance.csv",
    "credit_card_balance": "credit_card_balance.csv",
    "installments_payments": "installments_payments.csv",
}
DAYS_SENTINEL = 365243
APPLICATION_DERIVED_COLUMNS = [
    "APP_CREDIT_INCOME_RATIO", "APP_ANNUITY_INCOME_RATIO", "APP_ANNUITY_CREDIT_RATIO",
    "APP_GOODS_CREDIT_RATIO", "APP_INCOME_PER_PERSON", "APP_EMPLOYED_BIRTH_RATIO",
    "APP_CHILDREN_RATIO", "APP_EXT_SOURCE_MEAN", "APP_EXT_SOURCE_MIN", "APP_EXT_SOURCE_MAX",
]
PREVIOUS_DAY_COLUMNS = [
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
]
BB_STATUS_VALUES = ["0", "1", "2", "3", "4", "5", "C", "X"]
CREDIT_ACTIVE_VALUES = {"ACTIVE": "Active", "CLOSED": "Closed", "SOLD": "Sold", "BAD_DEBT": "Bad debt"}
PREV_STATUS_VALUES = {"APPROVED": "Approved", "REFUSED": "Refused", "CANCELED": "Canceled"}
CONTRACT_STATUS_VALUES = {"ACTIVE": "Active", "COMPLETED": "Completed", "SIGNED": "Signed"}
BUREAU_NUMERICS = [
    "DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT",
    "AMT_CREDIT_MAX_OVERDUE", "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
    "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT_UPDATE", "AMT_ANNUITY",
]
PREVIOUS_NUMERICS = [
    "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
    "HOUR_APPR_PROCESS_START", "NFLAG_LAST_APPL_IN_DAY", "RATE_DOWN_PAYMENT", "SELLERPLACE_AREA",
    "CNT_PAYMENT", "DAYS_DECISION", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION", "NFLAG_INSURED_ON_APPROVAL",
    "PREV_APPLICATION_CREDIT_RATIO", "PREV_DOWN_PAYMENT_RATIO",
]
POS_NUMERICS = ["MONTHS_BALANCE", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"]
CREDIT_CARD_NUMERICS = [
    "MONTHS_BALANCE", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_ATM_CURRENT",
    "AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT",
    "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT",
    "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE", "CNT_DRAWINGS_ATM_CURRENT",
    "CNT_DRAWINGS_CURRENT", "CNT_DRAWINGS_OTHER_CURRENT", "CNT_DRAWINGS_POS_CURRENT",
    "CNT_INSTALMENT_MATURE_CUM", "SK_DPD", "SK_DPD_DEF", "CC_DRAWINGS_LIMIT_RATIO",
    "CC_PAYMENT_BALANCE_RATIO",
]
INSTALLMENTS_NUMERICS = [
    "NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT",
    "AMT_INSTALMENT", "AMT_PAYMENT", "INST_PAYMENT_RATIO", "INST_PAYMENT_DIFF", "INST_DPD", "INST_DBD",
]
# ---------------------------------------------------------------- end of fixed values


def _declared(keys: list[str], strings: list[str], numbers: list[str]) -> StructType:
    """Keys BIGINT, text STRING, every other number DOUBLE (nullable)."""
    seen, fields = set(), []
    for names, kind in ((keys, LongType()), (strings, StringType()), (numbers, DoubleType())):
        for n in names:
            if n not in seen:
                seen.add(n)
                fields.append(StructField(n, kind))
    return StructType(fields)


def _raw(cols: list[str], prefix: str) -> list[str]:
    """The numerics read from the file; those the roll-up derives carry the family's prefix."""
    return [c for c in cols if not c.startswith(f"{prefix}_")]


def _scales(numerics: list[str]) -> dict[str, int]:
    """Decimal places of exact sums: 12 for ratios, 6 for amounts, rates and day counts."""
    return {c: 12 if "RATIO" in c else 6 for c in numerics}


# ---------------------------------------------------------------- specs

def application_derived() -> dict:
    """Ten derived columns plus the sentinel replacement, evaluated in parallel on
    the input row: the employed/birth ratio therefore still sees 365243."""
    return {
        "DAYS_EMPLOYED": sentinel_to_null("DAYS_EMPLOYED", DAYS_SENTINEL),
        "APP_CREDIT_INCOME_RATIO": safe_divide("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "APP_ANNUITY_INCOME_RATIO": safe_divide("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "APP_ANNUITY_CREDIT_RATIO": safe_divide("AMT_ANNUITY", "AMT_CREDIT"),
        "APP_GOODS_CREDIT_RATIO": safe_divide("AMT_GOODS_PRICE", "AMT_CREDIT"),
        "APP_INCOME_PER_PERSON": safe_divide("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "APP_EMPLOYED_BIRTH_RATIO": safe_divide("DAYS_EMPLOYED", "DAYS_BIRTH"),
        "APP_CHILDREN_RATIO": safe_divide("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
        "APP_EXT_SOURCE_MEAN": row_mean("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"),
        "APP_EXT_SOURCE_MIN": row_min("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"),
        "APP_EXT_SOURCE_MAX": row_max("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"),
    }


def clean_application(df: DataFrame) -> DataFrame:
    return df.withColumns(application_derived())


def bureau_balance_spec() -> RollupSpec:
    return RollupSpec(prefix="BB", key="SK_ID_BUREAU", min_max=("MONTHS_BALANCE",),
                      flags=[Flag(f"BB_STATUS_{v}", F.col("STATUS") == v) for v in BB_STATUS_VALUES])


def bureau_spec() -> RollupSpec:
    return RollupSpec(
        prefix="BUREAU", key=KEY, unique="SK_ID_BUREAU",
        flags=[Flag(f"BUREAU_{n}", F.col("CREDIT_ACTIVE") == v) for n, v in CREDIT_ACTIVE_VALUES.items()],
        numerics=(*BUREAU_NUMERICS, *bureau_balance_spec().feature_names()), scales=_scales(BUREAU_NUMERICS))


def previous_spec() -> RollupSpec:
    derived = {c: sentinel_to_null(c, DAYS_SENTINEL) for c in PREVIOUS_DAY_COLUMNS}
    derived["PREV_APPLICATION_CREDIT_RATIO"] = safe_divide("AMT_APPLICATION", "AMT_CREDIT")
    derived["PREV_DOWN_PAYMENT_RATIO"] = safe_divide("AMT_DOWN_PAYMENT", "AMT_APPLICATION")
    return RollupSpec(
        prefix="PREV", key=KEY, unique="SK_ID_PREV", derived=derived,
        flags=[Flag(f"PREV_{n}", F.col("NAME_CONTRACT_STATUS") == v) for n, v in PREV_STATUS_VALUES.items()],
        numerics=PREVIOUS_NUMERICS, scales=_scales(PREVIOUS_NUMERICS))


def _contract_flags(prefix: str) -> list[Flag]:
    dpd, dpd_def = F.col("SK_DPD"), F.col("SK_DPD_DEF")
    return ([Flag(f"{prefix}_{n}", F.col("NAME_CONTRACT_STATUS") == v) for n, v in CONTRACT_STATUS_VALUES.items()]
            + [Flag(f"{prefix}_DPD", dpd > 0, rate=True), Flag(f"{prefix}_DPD_30", dpd >= 30, rate=True),
               Flag(f"{prefix}_DPD_DEF", dpd_def > 0, rate=True)])


def pos_spec() -> RollupSpec:
    return RollupSpec(prefix="POS", key=KEY, unique="SK_ID_PREV", flags=_contract_flags("POS"),
                      numerics=POS_NUMERICS, scales=_scales(POS_NUMERICS))


def credit_card_spec() -> RollupSpec:
    return RollupSpec(
        prefix="CC", key=KEY, unique="SK_ID_PREV", flags=_contract_flags("CC"),
        derived={"CC_DRAWINGS_LIMIT_RATIO": safe_divide("AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL"),
                 "CC_PAYMENT_BALANCE_RATIO": safe_divide("AMT_PAYMENT_TOTAL_CURRENT", "AMT_BALANCE")},
        numerics=CREDIT_CARD_NUMERICS, scales=_scales(CREDIT_CARD_NUMERICS))


def installments_spec() -> RollupSpec:
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    return RollupSpec(
        prefix="INST", key=KEY, unique="SK_ID_PREV",
        derived={
            "INST_PAYMENT_RATIO": safe_divide("AMT_PAYMENT", "AMT_INSTALMENT"),
            "INST_PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
            "INST_DPD": clip_lower(late, 0),
            "INST_DBD": clip_lower(F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT"), 0),
        },
        flags=[Flag("INST_LATE", late > 0, rate=True), Flag("INST_LATE_30", late >= 30, rate=True),
               Flag("INST_UNDERPAY", F.col("AMT_PAYMENT") < F.col("AMT_INSTALMENT"), rate=True)],
        numerics=INSTALLMENTS_NUMERICS, scales=_scales(INSTALLMENTS_NUMERICS))


# Declared schemas of the child tables: the columns the roll-ups read, in a
# fixed order. CSV headers are matched by name (``enforceSchema`` off), so the
# files may hold further columns in any order; those are not read.
CHILD_SCHEMAS = {
    "bureau_balance": _declared(["SK_ID_BUREAU"], ["STATUS"], ["MONTHS_BALANCE"]),
    "bureau": _declared([KEY, "SK_ID_BUREAU"], ["CREDIT_ACTIVE"], BUREAU_NUMERICS),
    "previous_application": _declared([KEY, "SK_ID_PREV"], ["NAME_CONTRACT_STATUS"], _raw(PREVIOUS_NUMERICS, "PREV")),
    "pos_cash_balance": _declared([KEY, "SK_ID_PREV"], ["NAME_CONTRACT_STATUS"], POS_NUMERICS),
    "credit_card_balance": _declared([KEY, "SK_ID_PREV"], ["NAME_CONTRACT_STATUS"], _raw(CREDIT_CARD_NUMERICS, "CC")),
    "installments_payments": _declared([KEY, "SK_ID_PREV"], [], _raw(INSTALLMENTS_NUMERICS, "INST")),
}


# Application tables: these columns are text, the key a long, the target an integer and every
# other column of the header a double.
APPLICATION_TEXT = ["NAME_CONTRACT_TYPE", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "NAME_TYPE_SUITE", "NAME_INCOME_TYPE",
                    "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "OCCUPATION_TYPE", "WEEKDAY_APPR_PROCESS_START",
                    "ORGANIZATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE"]


def application_type(column: str) -> DataType:
    if column == KEY:
        return LongType()
    if column == TARGET:
        return IntegerType()
    return StringType() if column in APPLICATION_TEXT else DoubleType()


def registry(root: str) -> TableRegistry:
    return TableRegistry(root=root, files=RAW_TABLE_FILES, schemas=CHILD_SCHEMAS,
                         column_types={"application_train": application_type, "application_test": application_type})


# ---------------------------------------------------------------- families

def bureau_family(bureau: DataFrame, bureau_balance: DataFrame) -> DataFrame:
    return two_level_rollup(bureau_balance, bureau, bureau_balance_spec(), bureau_spec(), link="SK_ID_BUREAU")


def families(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "bureau": bureau_family(tables["bureau"], tables["bureau_balance"]),
        "previous_application": rollup(tables["previous_application"], previous_spec()),
        "pos_cash": rollup(tables["pos_cash_balance"], pos_spec()),
        "credit_card": rollup(tables["credit_card_balance"], credit_card_spec()),
        "installments": rollup(tables["installments_payments"], installments_spec()),
    }


def build_processed_datasets(spark: SparkSession, raw_dir: str, out_dir: str, buckets: int | None = None) -> dict:
    """Raw CSVs -> ``train_features`` / ``test_features`` Parquet + manifest JSON.

    Each family is rolled up and written once, below ``out_dir/families`` and bucketed by the
    applicant key; both applicant tables join the stored families without moving them again.
    """
    reg = registry(raw_dir)
    raw = {name: reg.read(spark, name) for name in RAW_TABLE_FILES}
    frames = {"train": clean_application(raw["application_train"]),
              "test": clean_application(raw["application_test"])}
    with stored_families(spark, families(raw), f"{out_dir}/families", KEY, buckets) as fams:
        out = build_applicant_tables(frames, fams, KEY)
        for name, df in out.items():
            write_parquet(df, f"{out_dir}/{name}_features.parquet")
        groups = feature_groups(fams, KEY, APPLICATION_DERIVED_COLUMNS)
    written = {name: spark.read.parquet(f"{out_dir}/{name}_features.parquet") for name in out}
    manifest = manifest_of(written, TARGET, groups)
    write_json(spark, manifest, f"{out_dir}/feature_definitions.json")
    return manifest
