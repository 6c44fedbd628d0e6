"""Model-safe column names as a DataFrame operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.exprs import safe_name_column
from riskframe.session import cut_lineage


def safe_names(names: DataFrame, name: str = "name", order: str = "ordinal", out: str = "safe_name") -> DataFrame:
    """``names`` with unique model-safe names in ``out``.

    Rows take their cleaned name in the order of ``order``; one that is taken gets the
    smallest suffix ``_1``, ``_2`` ... still free. Each round settles all rows whose wish
    no earlier row shares; the others wish for their next suffix, until no two agree.
    """
    rank = F.row_number().over(Window.partitionBy("__base").orderBy(order)) - 1
    rows = names.withColumn("__base", safe_name_column(name)).withColumn("__k", rank)
    wish = F.when(F.col("__k") == 0, F.col("__base")).otherwise(F.concat_ws("_", "__base", F.col("__k").cast("string")))
    while True:
        rows = rows.withColumn(out, wish)
        beaten = F.row_number().over(Window.partitionBy(out).orderBy(order)) > 1
        rows = cut_lineage(rows.withColumn("__beaten", beaten))
        if not rows.where("__beaten").limit(1).count():
            return rows.drop("__base", "__k", "__beaten")
        rows = rows.withColumn("__k", F.col("__k") + F.col("__beaten").cast("int"))


def safe_name_list(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Safe names of a list of column names, in its order."""
    rows = spark.createDataFrame(list(enumerate(names)), "ordinal int, name string").coalesce(1)
    return [r.safe_name for r in sorted(safe_names(rows).collect(), key=lambda r: r.ordinal)]
