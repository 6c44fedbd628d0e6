"""Readers, writers and the table registry.

* Raw tables are CSV with a header; they are read with a declared
  ``StructType``, or typed by their first rows (no inference pass over the data).
* Stage tables are Parquet. Writers overwrite one path per stage.
* Small reports (metric tables, manifests) are written as one CSV / JSON file
  each; they are report-sized by construction (one row per model, threshold,
  feature ...), never row-level data.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from riskframe.sources.inference import infer_csv


@dataclass(frozen=True)
class TableRegistry:
    """Name -> (file name, schema) under one root folder."""

    root: str
    files: Mapping[str, str]
    schemas: Mapping[str, StructType]
    # Tables read whole: the type of every column the header names.
    column_types: Mapping[str, Callable[[str], DataType]] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.files[name]}"

    def read(self, spark: SparkSession, name: str, columns: Sequence[str] | None = None,
             n_rows: int | None = None) -> DataFrame:
        return read_csv_table(spark, self.path(name), self.schemas.get(name), columns, n_rows,
                              column_type=self.column_types.get(name))

    def register_views(self, spark: SparkSession, names: Sequence[str] | None = None) -> None:
        for name in names or list(self.files):
            self.read(spark, name).createOrReplaceTempView(name)


def read_csv_table(spark: SparkSession, path: str, schema: StructType | None = None,
                   columns: Sequence[str] | None = None, n_rows: int | None = None,
                   null_values: Sequence[str] | None = None,
                   column_type: Callable[[str], DataType] | None = None) -> DataFrame:
    """CSV with header; empty fields are null. ``null_values`` adds spellings
    (such as ``NA``) for pandas-style readers, in columns of every type. Types come from
    ``schema`` or, for all columns of the header, from ``column_type``; a file with neither
    takes those of its first rows (see :mod:`riskframe.sources.inference`), and values
    further down that don't fit read as null. Values that don't fit a declared type raise.

    ``columns`` and ``n_rows`` become a projection and a limit that Catalyst
    pushes into the scan.
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        # Declared columns are matched to the header by name: the header row alone
        # gives the file's column order (no inference pass over the data); columns
        # that are not declared are read as strings and not selected by default.
        header = spark.read.option("header", True).csv(path).columns
        declared = {f.name: f for f in schema.fields}
        missing = [n for n in declared if n not in header]
        if missing:
            raise ValueError(f"{path}: declared columns missing from the header: {missing}")
        full = StructType([declared.get(h, StructField(h, StringType())) for h in header])
        reader = reader.schema(full)
        if columns is None:
            columns = schema.fieldNames()
    elif column_type is not None:
        header = spark.read.option("header", True).csv(path).columns
        reader = reader.schema(StructType([StructField(h, column_type(h)) for h in header]))
    else:
        return infer_csv(spark, path, null_spellings=null_values or ()).read(columns, n_rows)
    df = reader.csv(path)
    if null_values:
        # Spellings are compared as text, before the declared types are taken.
        text = reader.schema(StructType([StructField(c, StringType()) for c in df.columns])).csv(path)
        spelled = {c: F.trim(F.col(f"`{c}`")).isin(*null_values) for c in df.columns}
        df = text.select(*[F.when(~spelled[f.name], F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    if columns:
        df = df.select(*columns)
    if n_rows is not None:
        df = df.limit(n_rows)
    return df


def read_parquet_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  bucket_by: tuple[int, str] | None = None, table_name: str | None = None) -> None:
    """Overwrite one stage output.

    ``bucket_by=(n, key)`` with ``table_name`` writes a bucketed table so that
    later joins on ``key`` need no shuffle (the five family tables share the
    applicant key).
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by and table_name:
        n, key = bucket_by
        writer.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table_name)
        return
    writer.parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header for a report-sized table."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


# ------------------------------------------------------------------ manifests

def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with ``<name>_rows`` of every table (one aggregate each)."""
    counts = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias(f"{name}_rows"))
        counts = c if counts is None else counts.crossJoin(c)  # one row x one row
    return counts


def manifest_frame(tables: Mapping[str, DataFrame], target: str, feature_groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Long manifest (section, name, ordinal, value): row counts, the column list of each
    table, the target and the feature groups. One row per column, so report-sized."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(f"{t}_columns", c, i, None) for t, df in tables.items() for i, c in enumerate(df.columns)]
    rows += [("target_column", target, 0, None)]
    rows += [(f"feature_groups.{g}", c, i, None) for g, cols in feature_groups.items() for i, c in enumerate(cols)]
    lists = spark.createDataFrame(rows, "section string, name string, ordinal int, value long")
    counts = row_counts(tables)
    names = [f"{t}_rows" for t in tables]
    stacked = counts.selectExpr(f"stack({len(names)}, " + ", ".join(f"'{n}', {n}" for n in names) + ") as (name, value)")
    return stacked.select(F.lit("rows").alias("section"), "name", F.lit(0).alias("ordinal"), "value").unionByName(lists)


def manifest_of(tables: Mapping[str, DataFrame], target: str, feature_groups: Mapping[str, Sequence[str]]) -> dict:
    """The manifest as a dictionary: counts from Spark, column lists from the schemas."""
    counts = row_counts(tables).first()
    return {**{f"{t}_rows": counts[f"{t}_rows"] for t in tables}, **{f"{t}_columns": list(df.columns) for t, df in tables.items()},
            "target_column": target, "feature_groups": {k: list(v) for k, v in feature_groups.items()}}


def _file(spark: SparkSession, path: str):
    """(file system, path) of a URI, through the session's Hadoop configuration."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_json(spark: SparkSession, obj, path: str) -> None:
    """One JSON file for a metadata dict (column lists, counts), on any file system Spark writes to."""
    fs, where = _file(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(json.dumps(obj, indent=2).encode("utf-8")))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file(spark, path)
    return fs.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that this library wrote; nothing happens where there is none."""
    fs, where = _file(spark, path)
    fs.delete(where, True)
