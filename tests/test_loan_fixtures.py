"""Hand-made loan rows with expected values (reference semantics)."""

import math

from pyspark.sql import functions as F

from riskframe.operators.rollup import rollup, unique_counts
from riskframe.plans import loan


def test_application_cleaning_parallel_semantics(spark):
    df = spark.createDataFrame(
        [(1, 365243.0, -10000.0, 100.0, 0.0, 0.2, None, 0.4, 1.0, 50.0, 10.0, 20.0, 0.0),
         (2, -100.0, -10000.0, 100.0, 2.0, None, None, None, 1.0, 50.0, 10.0, 20.0, 1.0)],
        "SK_ID_CURR long, DAYS_EMPLOYED double, DAYS_BIRTH double, AMT_INCOME_TOTAL double, "
        "CNT_FAM_MEMBERS double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double, "
        "AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double, CNT_CHILDREN double, x double")
    r = {row.SK_ID_CURR: row for row in loan.clean_application(df).collect()}
    a = r[1]
    assert a.DAYS_EMPLOYED is None
    assert math.isclose(a.APP_EMPLOYED_BIRTH_RATIO, -36.5243)  # computed on the input value
    assert a.APP_INCOME_PER_PERSON is None                      # zero family members
    assert math.isclose(a.APP_EXT_SOURCE_MEAN, 0.3)
    assert (a.APP_EXT_SOURCE_MIN, a.APP_EXT_SOURCE_MAX) == (0.2, 0.4)
    b = r[2]
    assert b.APP_EXT_SOURCE_MEAN is None and b.APP_EXT_SOURCE_MIN is None and b.APP_EXT_SOURCE_MAX is None
    assert b.APP_INCOME_PER_PERSON == 50.0


def _bureau_frames(spark):
    bb = spark.createDataFrame([(10, -1.0, "0"), (10, 0.0, "C"), (10, -2.0, None), (11, -5.0, "1")],
                               "SK_ID_BUREAU long, MONTHS_BALANCE double, STATUS string")
    cols = ", ".join(f"{c} double" for c in loan.BUREAU_NUMERICS if c != "AMT_CREDIT_SUM")
    schema = f"SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, AMT_CREDIT_SUM double, {cols}"
    nulls = (None,) * (len(loan.BUREAU_NUMERICS) - 1)
    bureau = spark.createDataFrame([(1, 10, "Active", 100.0, *nulls), (1, 12, "Closed", None, *nulls),
                                    (2, 11, None, None, *nulls)], schema)
    return bureau, bb


def test_two_level_rollup_fixture(spark):
    bureau, bb = _bureau_frames(spark)
    fam = loan.bureau_family(bureau, bb)
    apps = spark.createDataFrame([(1,), (2,), (3,)], "SK_ID_CURR long")
    rows = {r.SK_ID_CURR: r for r in apps.join(fam, "SK_ID_CURR", "left").collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert (one.BUREAU_RECORD_COUNT, one.BUREAU_ACTIVE_COUNT, one.BUREAU_CLOSED_COUNT) == (2, 1, 1)
    assert (one.BUREAU_AMT_CREDIT_SUM_MEAN, one.BUREAU_AMT_CREDIT_SUM_SUM) == (100.0, 100.0)
    assert (one.BUREAU_BB_RECORD_COUNT_MEAN, one.BUREAU_BB_RECORD_COUNT_SUM) == (3.0, 3)
    assert one.BUREAU_BB_STATUS_C_COUNT_SUM == 1
    assert (two.BUREAU_RECORD_COUNT, two.BUREAU_ACTIVE_COUNT, two.BUREAU_CLOSED_COUNT) == (1, 0, 0)
    assert two.BUREAU_AMT_CREDIT_SUM_MEAN is None
    assert two.BUREAU_AMT_CREDIT_SUM_SUM == 0            # all-null group sums to 0
    assert (two.BUREAU_BB_RECORD_COUNT_MEAN, two.BUREAU_BB_RECORD_COUNT_SUM) == (1.0, 1)
    assert two.BUREAU_BB_STATUS_C_COUNT_SUM == 0
    # no child rows at all: null after the left join, also for sums
    assert three.BUREAU_RECORD_COUNT is None and three.BUREAU_AMT_CREDIT_SUM_SUM is None
    assert three.BUREAU_BB_STATUS_C_COUNT_SUM is None


def test_bureau_feature_width(spark):
    assert len(loan.bureau_spec().feature_names()) == 98
    assert len(loan.previous_spec().feature_names()) == 81
    assert len(loan.pos_spec().feature_names()) == 31
    assert len(loan.credit_card_spec().feature_names()) == 99
    assert len(loan.installments_spec().feature_names()) == 48
    total = 98 + 81 + 31 + 99 + 48 + 120 + len(loan.APPLICATION_DERIVED_COLUMNS)
    assert total == 487


def test_installments_fixture(spark):
    cols = ["SK_ID_CURR", "SK_ID_PREV", "AMT_INSTALMENT", "AMT_PAYMENT", "DAYS_INSTALMENT",
            "DAYS_ENTRY_PAYMENT", "NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER"]
    df = spark.createDataFrame(
        [(1, 100, 100.0, 90.0, -10.0, 25.0, 1.0, 1.0), (1, 100, 0.0, 50.0, -10.0, -12.0, 1.0, 2.0),
         (1, 101, 100.0, None, -5.0, None, 1.0, 1.0)],
        ", ".join(f"{c} {'long' if c.startswith('SK_') else 'double'}" for c in cols))
    spec = loan.installments_spec()
    from riskframe.operators.rollup import prepare_children
    rows = prepare_children(df, spec).orderBy("NUM_INSTALMENT_NUMBER", "SK_ID_PREV").collect()
    r1 = [r for r in rows if r.SK_ID_PREV == 100 and r.NUM_INSTALMENT_NUMBER == 1.0][0]
    r2 = [r for r in rows if r.SK_ID_PREV == 100 and r.NUM_INSTALMENT_NUMBER == 2.0][0]
    r3 = [r for r in rows if r.SK_ID_PREV == 101][0]
    assert (r1.INST_PAYMENT_RATIO, r1.INST_PAYMENT_DIFF, r1.INST_DPD, r1.INST_DBD) == (0.9, 10.0, 35.0, 0.0)
    assert (r1.INST_LATE_FLAG, r1.INST_LATE_30_FLAG, r1.INST_UNDERPAY_FLAG) == (1, 1, 1)
    assert (r2.INST_PAYMENT_RATIO, r2.INST_PAYMENT_DIFF, r2.INST_DPD, r2.INST_DBD) == (None, -50.0, 0.0, 2.0)
    assert (r2.INST_LATE_FLAG, r2.INST_LATE_30_FLAG, r2.INST_UNDERPAY_FLAG) == (0, 0, 0)
    assert (r3.INST_PAYMENT_RATIO, r3.INST_PAYMENT_DIFF, r3.INST_DPD, r3.INST_DBD) == (None, None, None, None)
    assert (r3.INST_LATE_FLAG, r3.INST_LATE_30_FLAG, r3.INST_UNDERPAY_FLAG) == (0, 0, 0)
    agg = rollup(df, spec).first()
    assert (agg.INST_RECORD_COUNT, agg.INST_UNIQUE_LOAN_COUNT) == (3, 2)
    assert math.isclose(agg.INST_LATE_RATE, 1 / 3)
    assert (agg.INST_INST_DPD_MEAN, agg.INST_INST_DPD_SUM, agg.INST_INST_DBD_SUM) == (17.5, 35.0, 2.0)
    assert agg.INST_INST_PAYMENT_RATIO_SUM == 0.9


def test_unique_count_counts_null_once(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (1, 5)], "k long, v long")
    assert unique_counts(df, "k", "v", ["n"]).first().n == 2
    df2 = spark.createDataFrame([(1, 5), (1, 6)], "k long, v long")
    assert unique_counts(df2, "k", "v", ["n"]).first().n == 2


def test_rollup_many_equals_separate_rollups(spark):
    from riskframe.plans import tpch

    sf = "/root/testdata/sf0.001"
    merged = tpch.orders_families(spark, sf)
    separate = tpch.bureau_family(spark, sf).join(tpch.previous_family(spark, sf), tpch.KEY, "full")
    assert sorted(merged.columns) == sorted(separate.columns)
    cols = sorted(merged.columns)

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())

    assert rows(merged) == rows(separate)
    ev = tpch.events_families(spark, sf)
    ev_sep = tpch.pos_family(spark, sf).join(tpch.credit_card_family(spark, sf), tpch.KEY, "full")
    cols = sorted(ev.columns)
    assert rows(ev) == rows(ev_sep)
