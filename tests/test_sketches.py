"""Sketches of columns: errors, merging, refreshed parts, odd columns; approximate options."""

import math

from pyspark.sql import functions as F

from riskframe.operators import prepare as prep
from riskframe.operators import profile as prof
from riskframe.operators import sketches as sk


def _table(spark, n=40_000):
    return spark.range(n).select((F.col("id") % 4).alias("p"), (F.col("id") % 9000).alias("few"), F.when(F.col("id") % 5 > 0, F.sqrt("id")).alias("root"),
                                 F.concat(F.lit("t"), F.col("id") % 300).alias("text"), F.lit(None).cast("double").alias("none"))


def test_errors_hold_and_parts_merge(spark):
    df = _table(spark)
    one = {r.column: r for r in sk.sketch_statistics(sk.column_sketches(df), {"q10": 0.1, "q50": 0.5}).collect()}
    many = {r.column: r for r in sk.sketch_statistics(sk.column_sketches(df, part="p"), {"q10": 0.1, "q50": 0.5}).collect()}
    assert set(one) == set(df.columns) and set(many) == set(df.columns) - {"p"}
    for got in (one, many):
        assert got["few"].n_rows == 40_000 and got["root"].n_values == 32_000
        for c, exact in (("few", 9000), ("root", 32_000), ("text", 300)):
            assert abs(got[c].n_unique - exact) <= 4 * sk.DISTINCT_ERROR * exact + 1
        for name, p in (("q10", 0.1), ("q50", 0.5)):
            at = sk.rank_range(df, "root", got["root"][name]).first()
            assert at.low - 2 * sk.RANK_ERROR <= p <= at.high + 2 * sk.RANK_ERROR
        assert got["text"].q50 is None and got["none"].q50 is None and got["none"].n_unique == 0


def test_refresh_replaces_only_its_parts(spark, tmp_path):
    df, path = _table(spark, 4000), str(tmp_path / "sketches")
    sk.refresh_sketches(spark, path, df, "p", ["few", "text"])
    more = df.where("p = 1").unionByName(df.where("p = 1"))
    stored = sk.refresh_sketches(spark, path, more.unionByName(df.limit(10).withColumn("p", F.lit(None).cast("long"))), "p", ["few", "text"])
    rows = {r.part: r.n_rows for r in stored.where("column = 'few'").collect()}
    assert rows == {"0": 1000, "1": 2000, "2": 1000, "3": 1000, None: 10}
    assert {r.column: r.n_rows for r in sk.sketch_statistics(stored).collect()} == {"few": 5010, "text": 5010}


def test_odd_columns(spark):
    df = spark.createDataFrame([(math.nan, True, "a", 1), (1.0, None, "", 1), (None, False, None, 1), (1.0, True, "a", 2)], "`a.b` double, column boolean, part string, n_rows int")
    got = {r.column: r for r in sk.sketch_statistics(sk.column_sketches(df), {"mid": 0.5}).collect()}
    assert (got["a.b"].n_values, got["a.b"].n_unique, got["a.b"].mid) == (2, 1, 1.0)
    assert (got["column"].n_unique, got["part"].n_unique, got["n_rows"].mid) == (2, 2, 1.0)
    assert {(r.part, r.column) for r in sk.column_sketches(df, ["a.b"], "part").collect()} == {("a", "a.b"), ("", "a.b"), (None, "a.b")}
    assert sk.column_sketches(df, []).count() == 0 and sk.sketch_statistics(sk.column_sketches(df.limit(0), part="part")).count() == 0


def test_approximate_options(spark):
    df = _table(spark)
    got = {r.feature: r.n_unique for r in prof.categorical_cardinality(df, approximate=True).collect()}
    assert got.keys() == {"text"} and abs(got["text"] - 300) <= 4 * sk.DISTINCT_ERROR * 300 + 1
    exact, near = prep.fit_medians(df, ["few", "root", "none"]), prep.fit_medians(df, ["few", "root", "none"], approximate=True)
    assert near["none"] is None and exact["none"] is None
    assert abs(near["few"] / exact["few"] - 1) < 0.05 and abs(near["root"] / exact["root"] - 1) < 0.05
