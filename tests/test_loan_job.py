"""The whole applicant-level job on tiny loan CSVs: CSV in, Parquet + manifest out."""

import csv
import json

from riskframe.plans import loan
from riskframe.plans.assemble import build_applicant_tables, stored_families, write_families
from riskframe.sources.catalog import read_csv_table

APP_COLS = ["SK_ID_CURR", "TARGET", "DAYS_EMPLOYED", "DAYS_BIRTH", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
            "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS", "CNT_CHILDREN", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
            "CODE_GENDER"]


def _write(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def _child(schema_name, extra=("EXTRA_TEXT",)):
    names = loan.CHILD_SCHEMAS[schema_name].fieldNames()
    return list(reversed(names)) + list(extra)  # other order + an undeclared column


def _value(name, i):
    if name.startswith("SK_ID_CURR"):
        return 1 + i % 2
    if name.startswith("SK_ID"):
        return 10 + i
    if name == "STATUS":
        return ["0", "C", "X"][i % 3]
    if name in ("CREDIT_ACTIVE", "NAME_CONTRACT_STATUS"):
        return ["Active", "Closed", "Approved"][i % 3]
    if name == "EXTRA_TEXT":
        return "x"
    return "" if i == 2 else i * 1.5


def test_build_processed_datasets(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _write(raw / "application_train.csv", APP_COLS,
           [[1, 0, 365243, -10000, 100, 50, 5, 45, 2, 0, 0.2, "", 0.4, "M"],
            [2, 1, -500, -12000, 200, 80, 8, 70, 1, 0, "", "", "", "F"],
            [3, 0, -100, -9000, 150, 60, 6, 55, 3, 1, 0.5, 0.6, 0.7, "F"]])
    _write(raw / "application_test.csv", [c for c in APP_COLS if c != "TARGET"],
           [[4, -300, -11000, 120, 40, 4, 35, 1, 0, 0.3, 0.3, 0.3, "M"]])
    for table in loan.CHILD_SCHEMAS:
        header = _child(table)
        _write(raw / loan.RAW_TABLE_FILES[table], header, [[_value(h, i) for h in header] for i in range(4)])
    out = tmp_path / "processed"
    out.mkdir()
    manifest = loan.build_processed_datasets(spark, str(raw), str(out))
    assert manifest["train_rows"] == 3 and manifest["test_rows"] == 1
    groups = manifest["feature_groups"]
    assert [len(groups[k]) for k in ("bureau", "previous_application", "pos_cash", "credit_card", "installments")] \
        == [98, 81, 31, 99, 48]
    assert json.loads((out / "feature_definitions.json").read_text())["target_column"] == "TARGET"
    train = spark.read.parquet(str(out / "train_features.parquet"))
    row = {r.SK_ID_CURR: r for r in train.collect()}
    assert row[1].DAYS_EMPLOYED is None and abs(row[1].APP_EMPLOYED_BIRTH_RATIO + 36.5243) < 1e-12
    assert row[3].BUREAU_RECORD_COUNT is None          # no bureau rows for applicant 3
    assert row[1].BUREAU_RECORD_COUNT == 2 and row[2].INST_RECORD_COUNT == 2
    # declared child schema: undeclared text column is not read, declared types hold
    bureau = read_csv_table(spark, str(raw / "bureau.csv"), loan.CHILD_SCHEMAS["bureau"])
    assert "EXTRA_TEXT" not in bureau.columns and dict(bureau.dtypes)["AMT_CREDIT_SUM"] == "double"
    assert read_csv_table(spark, str(raw / "bureau.csv"), loan.CHILD_SCHEMAS["bureau"], n_rows=2).count() == 2


def test_bucketed_families_join_without_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(100).selectExpr("id AS k", "id * 2 AS a")
        b = spark.range(100).selectExpr("id AS k", "id * 3 AS b")
        write_families({"fa": a, "fb": b}, str(tmp_path / "fam"), "k", 4)
        joined = spark.table("family_fa").join(spark.table("family_fb"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_families_are_joined_in_place(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fams = {n: spark.range(0, 100, i + 2).selectExpr("id AS k", f"id * {i} AS {n}") for i, n in enumerate("abcde")}
        frames = {"train": spark.range(60).selectExpr("id AS k", "id AS x"), "test": spark.range(60, 90).selectExpr("id AS k", "id AS x")}
        with stored_families(spark, fams, str(tmp_path / "fam"), "k", 4) as stored:
            before = len(spark.catalog.listTables())
            for name, df in build_applicant_tables(frames, stored, "k").items():
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert plan.count("Exchange hashpartitioning") == 1  # the applicants
                assert plan.count("SortMergeJoin") == 5 and plan.count("Bucketed: true") == 5
                got = {r.k: r for r in df.collect()}
                assert len(got) == frames[name].count()
                assert all(r.b == (k if k % 3 == 0 else None) and r.c == (2 * k if k % 4 == 0 else None) for k, r in got.items())
        assert len(spark.catalog.listTables()) == before - 5
        assert spark.read.parquet(str(tmp_path / "fam" / "a")).count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
