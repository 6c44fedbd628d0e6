"""Column profiling in single passes (missing values, cardinality, distributions,
correlations, constant columns, class balance).

Wide tables are profiled with ONE aggregate over all columns and then
unpivoted (the aggregate result is one row, so the unpivot is free);
per-value statistics (cardinality, quantiles) go through a long
(column, value) form so that Spark plans one distinct / one quantile job for
all columns instead of one ``Expand`` per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from riskframe.functions.exprs import clip_upper
from riskframe.operators.joins import null_safe_join, small_side
from riskframe.operators.sketches import column_sketches, sketch_statistics
from riskframe.operators.quantiles import quantile_columns, sql_name, sql_str
from riskframe.session import cut_lineage


def stack_rows(one_row: DataFrame, rows: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Unpivot a one-row aggregate result into ``len(rows)`` rows with ONE
    ``stack`` expression (each row is a list of SQL expressions)."""
    body = ", ".join(e for r in rows for e in r)
    return one_row.selectExpr(f"stack({len(rows)}, {body}) as ({', '.join(names)})")


# ------------------------------------------------------------------ schema helpers

def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (NumericType, BooleanType)) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (NumericType, BooleanType)) and f.name not in exclude]


def schema_summary(df: DataFrame, table_name: str) -> DataFrame:
    """rows (one count aggregate), columns, numeric and categorical counts."""
    n_num, n_cat = len(numeric_columns(df)), len(categorical_columns(df))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(table_name).alias("table_name"), "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(n_num).alias("numeric_columns"), F.lit(n_cat).alias("categorical_columns"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """Column count per Spark data type (schema metadata, one row per type)."""
    spark = df.sparkSession
    rows = [(f.dataType.simpleString(), f.name) for f in df.schema.fields]
    return (spark.createDataFrame(rows, "dtype string, column string")
            .groupBy("dtype").agg(F.count(F.lit(1)).alias("columns")))


def table_overview(tables: Mapping[str, DataFrame], id_cols: Mapping[str, str] | None = None,
                   sample_width: int = 8) -> DataFrame:
    """Per table: id column, row count, column count, first column names."""
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"),
            F.lit((id_cols or {}).get(name)).cast("string").alias("id_col"),
            "rows", F.lit(len(df.columns)).alias("cols"),
            F.lit(", ".join(df.columns[:sample_width])).alias("sample_columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ missing values

def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, ordinal, null_count, null_pct) from ONE aggregate over all columns."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0).cast("long")).alias(f"__n{i}")
        for i, c in enumerate(cols)]
    rows = [[sql_str(c), str(i), f"__n{i}", f"100.0D * __n{i} / __rows"] for i, c in enumerate(cols)]
    return stack_rows(df.agg(*aggs), rows, ["column", "ordinal", "null_count", "null_pct"])


def top_missing(df: DataFrame, top_n: int = 10) -> DataFrame:
    """Columns with the highest null share; ties keep table order."""
    return missing_profile(df).orderBy(F.desc("null_pct"), F.asc("ordinal")).limit(top_n)


def missing_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Null share (percent) per train column next to the test share; a column
    absent from the test frame gets 0 (reindex with fill 0)."""
    tr = missing_profile(train).select("column", "ordinal", F.col("null_pct").alias("train_missing_pct"))
    te = missing_profile(test).select("column", F.col("null_pct").alias("test_missing_pct"))
    return (tr.join(F.broadcast(te), "column", "left")
            .select("column", "ordinal", "train_missing_pct",
                    F.coalesce("test_missing_pct", F.lit(0.0)).alias("test_missing_pct")))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Column-name set algebra between two tables, as rows (column, in_left,
    in_right, left_nulls, right_nulls): a full join of their per-column null
    profiles, so both tables are read once."""
    a = missing_profile(left).select("column", F.col("null_count").alias("left_nulls"))
    b = missing_profile(right).select("column", F.col("null_count").alias("right_nulls"))
    return (a.join(b, "column", "full")
            .select("column", F.col("left_nulls").isNotNull().alias("in_left"),
                    F.col("right_nulls").isNotNull().alias("in_right"), "left_nulls", "right_nulls"))


# ------------------------------------------------------------------ categories

def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """(value, count, proportion) over non-null values."""
    src = df.where(F.col(column).isNotNull()) if dropna else df
    counts = src.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("__total"))
    return counts.crossJoin(F.broadcast(total)).select(  # one-row side
        column, "count", (F.col("count") / F.col("__total")).alias("proportion"))


def status_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per category, the null category kept, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"))


def rate_by_category(df: DataFrame, category: str, target: str) -> DataFrame:
    """Mean target per non-null category, highest first."""
    return (df.where(F.col(category).isNotNull()).groupBy(category)
            .agg(F.avg(target).alias("rate"), F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("rate")))


def categorical_cardinality(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per categorical column, via one long-form distinct.

    ``approximate`` estimates them from sketches instead: one pass, no shuffle of values, a relative
    error of ``sketches.DISTINCT_ERROR`` (one standard deviation).
    """
    cols = list(columns or categorical_columns(df))
    if approximate:
        return (sketch_statistics(column_sketches(df, cols)).select(F.col("column").alias("feature"), "n_unique")
                .orderBy(F.desc("n_unique"), "feature"))
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "value") if len(cols) > 1 else df.select(
        F.lit(cols[0]).alias("feature"), F.col(cols[0]).cast("string").alias("value"))
    return (long.groupBy("feature").agg(F.count_distinct("value").alias("n_unique"))
            .orderBy(F.desc("n_unique"), "feature"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: count, balanced weight n / (k * n_class) and, on every row,
    scale_pos_weight = negatives / positives (binary labels)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("__n"), F.count(F.lit(1)).alias("__k"),
                        F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("__neg"),
                        F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("__pos"))
    return counts.crossJoin(F.broadcast(totals)).select(  # one-row side
        label, "n", (F.col("__n") / (F.col("__k") * F.col("n"))).alias("balanced_weight"),
        F.when(F.col("__pos") > 0, F.col("__neg") / F.col("__pos")).alias("scale_pos_weight"))


# ------------------------------------------------------------------ per-id distribution

def records_per_id(df: DataFrame, id_col: str, table_name: str) -> DataFrame:
    """ids, mean / median / p95 / max of the number of records per id.

    The records are read once; the passes of the quantiles read one stored number per id.
    """
    counts = cut_lineage(df.groupBy(id_col).agg(F.count(F.lit(1)).alias("record_count")).select("record_count"))
    q = quantile_columns(counts, ["record_count"], {"median_records": 0.5, "p95_records": 0.95})
    basic = counts.agg(F.count(F.lit(1)).alias("unique_ids"), F.avg("record_count").alias("mean_records"),
                       F.max("record_count").alias("max_records"))
    return basic.crossJoin(q.drop("column")).select(  # one row x one row
        F.lit(table_name).alias("table_name"), F.lit(id_col).alias("id_col"), "unique_ids", "mean_records",
        "median_records", "p95_records", "max_records")


def clip_at_quantile(df: DataFrame, column: str, q: float = 0.99, out: str | None = None) -> DataFrame:
    """Upper-clip a column at its exact q-quantile (one-row threshold, broadcast)."""
    thr = quantile_columns(df, [column], {"__q": q}).select("__q")
    c = F.col(column)
    return df.crossJoin(F.broadcast(thr)).withColumn(
        out or column, clip_upper(c.cast("double"), F.col("__q"))).drop("__q")


# ------------------------------------------------------------------ numeric summaries

def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Transposed describe: count, mean, std (sample), min, 25%, 50%, 75%, max."""
    cols = list(columns or numeric_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    rows = [[sql_str(c), f"c{i}", f"m{i}", f"s{i}", f"lo{i}", f"hi{i}"] for i, c in enumerate(cols)]
    basic = stack_rows(df.agg(*aggs), rows, ["column", "count", "mean", "std", "min", "max"])
    q = quantile_columns(df, cols, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return basic.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation for every ordered pair, pairwise-complete rows
    (``corr`` skips rows where either side is null); one aggregate for all pairs."""
    cols = list(columns)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    one = df.agg(*[F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"r{i}_{j}")
                   for i, j in pairs])
    rows = []
    for i, j in pairs:
        rows.append([sql_str(cols[i]), sql_str(cols[j]), f"r{i}_{j}"])
        if i != j:
            rows.append([sql_str(cols[j]), sql_str(cols[i]), f"r{i}_{j}"])
    return stack_rows(one, rows, ["feature_a", "feature_b", "corr"])


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over non-null values; the top edge falls in the last
    bin, every bin is present (count 0 when empty)."""
    x = F.col(column).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    rng = vals.agg(F.min("x").alias("lo0"), F.max("x").alias("hi0")).select(
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    idx = F.floor((F.col("x") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo"))).cast("int")
    binned = (vals.crossJoin(F.broadcast(rng))  # one-row side
              .select(F.least(idx, F.lit(bins - 1)).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    all_bins = rng.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return all_bins.join(binned, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0).cast("long")).alias("count"))


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme values inside the fences) and
    outlier count per group."""
    q = quantile_columns(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, group_cols=[by]).drop("column")
    q = small_side(cut_lineage(q), [by])  # one row per group
    fences = q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns({
        "lo_fence": F.col("q1") - 1.5 * F.col("iqr"), "hi_fence": F.col("q3") + 1.5 * F.col("iqr")})
    x = F.col(column).cast("double")
    rows = null_safe_join(df.where(x.isNotNull()).select(by, x.alias("x")), fences, [by])
    inside = (F.col("x") >= F.col("lo_fence")) & (F.col("x") <= F.col("hi_fence"))
    return rows.groupBy(by, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("outliers"))


# ------------------------------------------------------------------ constant columns

def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, ordinal, is_constant): at most one distinct value, null counting as a value.

    Constant  <=>  all null, or no null and min = max. One aggregate, no
    distinct (so no ``Expand`` for hundreds of columns).
    """
    cols = list(columns or df.columns)
    aggs = [F.expr(f"count({c}) = 0 OR (count({c}) = count(1) AND min({c}) = max({c})) AS k{i}") for i, c in enumerate(map(sql_name, cols))]
    rows = [[sql_str(c), str(i), f"k{i}"] for i, c in enumerate(cols)]
    return stack_rows(df.agg(*aggs), rows, ["column", "ordinal", "is_constant"])
