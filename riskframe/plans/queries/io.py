"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import metrics as met
from riskframe.operators import prepare as prep
from riskframe.plans import tpch
from riskframe.plans.queries.common import features, register, round_doubles, split_assignment, stage_dir
from riskframe.plans.queries.evaluation import model_scores
from riskframe.sources import catalog as cat
from riskframe.sources.inference import infer_csv


@register("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf_dir):
    path = stage_dir(spark, "bureau")
    cat.write_parquet(tpch.bureau_family(spark, sf_dir), path)
    return round_doubles(cat.read_parquet_table(spark, path))


ORDER_CSV_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


@register("csv_scan")
def q_csv_scan(spark, sf_dir):
    path = stage_dir(spark, "orders-csv")
    cols = [f.split()[0] for f in ORDER_CSV_SCHEMA.split(", ")]
    tpch.table(spark, sf_dir, "orders", cols).write.mode("overwrite").option("header", True).csv(path)
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(ORDER_CSV_SCHEMA)
    return cat.read_csv_table(spark, path, schema, columns=["o_orderkey", "o_custkey", "o_totalprice"])


@register("csv_inferred")
def q_csv_inferred(spark, sf_dir):
    """Orders as CSV in key order, with three null spellings and, in the second half, some fractions among whole
    amounts: per column the inferred type, nulls, values that didn't parse and the total."""
    path = stage_dir(spark, "orders-untyped")
    orders = tpch.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    k = F.col("o_orderkey")
    last = orders.agg(F.max(k).alias("__last"))
    whole = F.floor("o_totalprice").cast("string")
    amount = F.when(k % 11 == 0, "NA").when(k % 11 == 1, "n/a").when(k % 11 == 2, F.lit(None)).otherwise(
        F.concat(whole, F.when((k * 2 > F.col("__last")) & (k % 13 == 0), ".5").otherwise("")))
    text = orders.crossJoin(F.broadcast(last)).select(  # one-row side
        "o_orderkey", amount.alias("amount"), (F.col("o_orderstatus") == "O").alias("is_open"), F.col("o_orderstatus").alias("status"))
    text.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.mode("overwrite").option("header", True).csv(path)
    table = infer_csv(spark, path, null_spellings=["NA", "n/a"])
    typed = table.read().select("o_orderkey", F.col("amount").cast("double").alias("amount"), F.col("is_open").cast("int").alias("is_open"))
    totals = typed.agg(*[F.sum(c).cast("double").alias(c) for c in typed.columns]).unpivot([], typed.columns, "column", "total")
    return table.failures().join(totals, "column", "left")


@register("csv_report_roundtrip")
def q_csv_report_roundtrip(spark, sf_dir):
    path = stage_dir(spark, "threshold-report")
    report = met.threshold_table(model_scores(spark, sf_dir), met.report_grid(), ["model"])
    cat.write_report_csv(report, path)
    back = cat.read_report_csv(spark, path, report.schema)
    return round_doubles(back)


@register("feature_manifest")
def q_feature_manifest(spark, sf_dir):
    feats, split = features(spark, sf_dir), split_assignment(spark, sf_dir)
    train = prep.select_part(feats, split, tpch.KEY, "train")
    test = prep.select_part(feats, split, tpch.KEY, "validation").drop(tpch.TARGET)
    groups = {name: spec().feature_names() for name, spec in tpch.FAMILY_SPECS.items()}
    groups["application_derived"] = tpch.APPLICATION_DERIVED_COLUMNS
    return cat.manifest_frame({"train": train, "test": test}, tpch.TARGET, groups)


@register("manifest_roundtrip")
def q_manifest_roundtrip(spark, sf_dir):
    """The manifest of the applicant tables written as JSON and read back: one row per feature group."""
    apps = tpch.applicants(spark, sf_dir)
    groups = {name: spec().feature_names() for name, spec in tpch.FAMILY_SPECS.items()}
    path = f"{stage_dir(spark, 'manifest')}/feature_definitions.json"
    cat.write_json(spark, cat.manifest_of({"applicants": apps}, tpch.TARGET, groups), path)
    back = cat.read_json(spark, path)
    rows = [(g, len(cols), cols[0], cols[-1], back["applicants_rows"]) for g, cols in back["feature_groups"].items()]
    return spark.createDataFrame(rows, "feature_group string, features int, first_feature string, last_feature string, applicants_rows long")
