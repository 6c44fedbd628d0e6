"""Stored sketches of columns: distinct counts and quantiles with a stated error, merged when parts change.

A sketch table is long: one row per part and column with the row and value counts, a HyperLogLog sketch
of the values and, for numbers, a KLL quantile sketch. Both merge, so a table's statistics are those of
its parts: ``refresh_sketches`` sketches only the parts it is given and replaces theirs. Sketches have a
fixed size (16 KB and about 10 KB), are combined before the shuffle and don't grow with rows or skew.

Errors: a distinct count is within ``DISTINCT_ERROR`` (one standard deviation, relative); a quantile's rank is
within ``RANK_ERROR`` of the wanted one, as a share of the values, with 99 % confidence.

Defined cases: nulls and NaN count as rows but not as values; a column without values has 0 distinct
values and null quantiles; a null part is a part, which stored also holds the part named by the empty
string; an empty table has no parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

HLL_BITS = 14
KLL_SIZE = 800
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 2.296 / KLL_SIZE**0.9021  # as published for this sketch
PART = "part"


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None, part: str | None = None) -> DataFrame:
    """(part, column, n_rows, n_values, distinct, quantiles) from one pass over ``df``.

    ``part`` names the column whose values are sketched apart, taken as a string; without it all rows are one part.
    """
    names = [c for c in (df.columns if columns is None else columns) if c != part]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    number = {c: isinstance(kinds[c], NumericType) for c in names}
    # Sketches of names that no column has: parts and columns may share names.
    values = []
    for i, c in enumerate(names):
        x = F.col(f"`{c}`")
        if kinds[c].typeName() in ("double", "float"):
            x = F.when(~F.isnan(x), x)
        values.append(x.alias(f"__x{i}"))
    rows = df.select((F.col(f"`{part}`").cast("string") if part else F.lit("")).alias("__part"), *values)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(names):
        x = F.col(f"__x{i}")
        # The sketch leaves out empty strings, which are values here.
        aggs += [F.count(x).alias(f"__n{i}"), F.hll_sketch_agg(F.concat(F.lit("="), x.cast("string")), HLL_BITS).alias(f"__d{i}")]
        if number[c]:
            aggs.append(F.kll_sketch_agg_double(x.cast("double"), KLL_SIZE).alias(f"__q{i}"))
    cells = [F.struct(F.lit(c).alias("column"), F.col("__n").alias("n_rows"), F.col(f"__n{i}").alias("n_values"), F.col(f"__d{i}").alias("distinct"),
                      (F.col(f"__q{i}") if number[c] else F.lit(None).cast("binary")).alias("quantiles")) for i, c in enumerate(names)]
    out = rows.groupBy("__part").agg(*aggs)
    return out.select(F.col("__part").alias(PART), F.inline(F.array(*cells))) if names else out.selectExpr(
        f"__part AS {PART}", "'' AS column", "__n AS n_rows", "0L AS n_values", "CAST(NULL AS BINARY) AS distinct", "CAST(NULL AS BINARY) AS quantiles").limit(0)


def refresh_sketches(spark: SparkSession, path: str, df: DataFrame, part: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Write the sketches of the parts in ``df`` over those at ``path``; other parts stay. Returns the whole stored table."""
    column_sketches(df, columns, part).repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return read_sketches(spark, path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    schema = f"column string, n_rows long, n_values long, distinct binary, quantiles binary, {PART} string"
    return spark.read.schema(schema).parquet(path)


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column: the sketches of all its parts together."""
    return sketches.groupBy("column").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"),
                                          F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def sketch_statistics(sketches: DataFrame, probs: Mapping[str, float] | None = None) -> DataFrame:
    """column, n_rows, n_values, n_unique and one column per named probability."""
    wanted = [F.when((F.col("n_values") > 0) & F.col("has_quantiles"), F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(name)
              for name, p in (probs or {}).items()]
    known = sketches.groupBy("column").agg(F.max(F.col("quantiles").isNotNull()).alias("has_quantiles"))
    return merged_sketches(sketches).join(known, "column").select(
        "column", "n_rows", "n_values", F.when(F.col("n_values") > 0, F.hll_sketch_estimate("distinct")).otherwise(0).cast("long").alias("n_unique"), *wanted)


def rank_range(df: DataFrame, column: str, value) -> DataFrame:
    """One row (low, high): the ranks that ``value`` takes among a column's values, as shares of them."""
    x = F.col(f"`{column}`")
    n = F.count(x)
    return df.agg((F.count_if(x < value) / n).alias("low"), (F.count_if(x <= value) / n).alias("high"))
