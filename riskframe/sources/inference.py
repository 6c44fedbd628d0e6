"""CSV files without a declared schema: types from the first rows, one typed read, a count of what didn't parse.

Types come from at most ``SAMPLE_ROWS`` rows at the start of the first file (files in order of their paths):
whole numbers, then numbers, then booleans, else strings; a column without a value there is a string. No
pass over the data infers anything. Values further down that don't fit their column's type (a
fraction in a column of whole numbers) read as null, and ``failures`` counts them per column, so a caller can tell
them from nulls and read again with ``types`` of its own.

Null spellings hold for columns of every type: they are compared before the cast, without the
white space around them. An empty field is always null. A file with a header only gives strings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SAMPLE_ROWS = 5000
NULL_SPELLINGS = ("", "NA", "NaN", "null")
# In this order; a column takes the first type that all its sampled values have.
_PATTERNS = {"bigint": r"^[+-]?[0-9]{1,19}$", "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$", "boolean": r"^(?i:true|false)$"}


@dataclass(frozen=True)
class InferredCsv:
    """A CSV table as text and the type of each column."""

    text: DataFrame
    types: Mapping[str, str]
    null_spellings: tuple[str, ...]

    def _value(self, column: str) -> Column:
        x = F.col(f"`{column}`")
        return F.when(~F.trim(x).isin(*self.null_spellings), x)

    def _typed(self, column: str) -> Column:
        kind = self.types[column]
        value = self._value(column)
        return value if kind == "string" else F.when(F.trim(value).rlike(_PATTERNS[kind]), F.trim(value).try_cast(kind))

    def read(self, columns: Sequence[str] | None = None, n_rows: int | None = None) -> DataFrame:
        """The typed table; projection and limit reach the scan."""
        out = self.text.select(*[self._typed(c).alias(c) for c in columns or self.text.columns])
        return out if n_rows is None else out.limit(n_rows)

    def failures(self) -> DataFrame:
        """column, type, rows, nulls, unparsed: one pass, one row per column."""
        names = list(self.types)
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, c in enumerate(names):
            aggs += [F.count_if(self._value(c).isNull()).alias(f"__null{i}"), F.count_if(self._value(c).isNotNull() & self._typed(c).isNull()).alias(f"__bad{i}")]
        cells = [F.struct(F.lit(c).alias("column"), F.lit(self.types[c]).alias("type"), F.col("__n").alias("rows"), F.col(f"__null{i}").alias("nulls"),
                          F.col(f"__bad{i}").alias("unparsed")) for i, c in enumerate(names)]
        return self.text.agg(*aggs).select(F.inline(F.array(*cells)))


def infer_csv(spark: SparkSession, path: str, sample_rows: int = SAMPLE_ROWS, null_spellings: Sequence[str] = NULL_SPELLINGS,
              types: Mapping[str, str] | None = None) -> InferredCsv:
    """Types of a CSV with a header; ``types`` fixes some (``bigint``, ``double``, ``boolean``, ``string``)."""
    spellings = tuple(dict.fromkeys(["", *null_spellings]))
    reader = spark.read.option("header", True)
    names = reader.csv(path).columns
    reader = reader.schema(StructType([StructField(c, StringType()) for c in names]))
    text = reader.csv(path)
    rows: list = []
    for file in sorted(text.inputFiles()):
        rows += reader.csv(file).take(sample_rows - len(rows))  # bounded by the parameter
        if len(rows) >= sample_rows:
            break
    sample = InferredCsv(spark.createDataFrame(rows, text.schema), dict.fromkeys(names, "string"), spellings)
    fits = [F.count(sample._value(c)).alias(f"n{i}") for i, c in enumerate(names)]
    fits += [F.count_if(F.trim(sample._value(c)).rlike(p) & F.trim(sample._value(c)).try_cast(k).isNotNull()).alias(f"{k}{i}") for i, c in enumerate(names) for k, p in _PATTERNS.items()]
    found = sample.text.agg(*fits).first()
    chosen = {c: next((k for k in _PATTERNS if found[f"n{i}"] and found[f"{k}{i}"] == found[f"n{i}"]), "string") for i, c in enumerate(names)}
    unknown = sorted(set(types or {}) - set(names))
    if unknown:
        raise ValueError(f"{path}: no such columns: {unknown}")
    return InferredCsv(text, chosen | dict(types or {}), spellings)
