"""Exact quantiles (linear interpolation, as pandas / ``quantile_cont``) at scale.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which for a whole column means one task holding the whole
column. Here the exact answer comes from three passes that never do that, the
same for every input size:

1. per group, one wide aggregate: the non-null count ``n`` of each column and,
   from ``percentile_approx`` with accuracy ``A``, a bracket ``[lo, hi]`` around
   each wanted rank (rank error of the sketch is at most ``n / A``, the bracket
   spans ``2 n / A`` each side);
2. per group, one wide conditional aggregate: the number of values below ``lo``,
   and the next value outside each end, which widens the bracket by a rank;
3. only the values inside a bracket leave their row: counted per distinct value
   (about ``4n/A`` of them at most), cut into sub-ranges with prefix sums, they
   give the values at ranks ``floor(p(n-1))`` and ``ceil(p(n-1))``.

A rank that falls outside its bracket, which the sketch's error bound rules out,
raises an error instead of giving a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.joins import null_safe_join, small_side
from riskframe.session import cut_lineage

DEFAULT_ACCURACY = 1_000  # a sketch of every column and task is merged in one task at the end, so it is kept small


def sql_str(text: str) -> str:
    """A SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(column: str) -> str:
    """A column's name as a SQL identifier."""
    return "`" + column.replace("`", "``") + "`"


SUB_RANGES = 256


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (), accuracy: int = DEFAULT_ACCURACY,
                    rank_rule: str = "interpolate") -> DataFrame:
    """Long result: group..., column, p, n, quantile (null when no values).

    ``rank_rule="interpolate"``: linear interpolation at position p(n-1).
    ``rank_rule="round"``: the value at 0-based rank round(p*n) - 1, i.e. the
    largest of the first round(p*n) values (null when that count is 0).
    """
    g, cols, ps = list(group_cols), list(columns), [float(p) for p in probs]
    values = df.select(*g, *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    # Each step's result is read by several later ones: stored once (a row per group, then the band).
    brackets = small_side(cut_lineage(_brackets(values, g, len(cols), ps, accuracy)), g)
    edges = small_side(cut_lineage(_edges(values, brackets, g, len(cols), ps)), g)
    # One row per group, column and p: its rank, bracket and the count below the bracket.
    cells = edges.select(*g, F.expr("inline(array(" + ", ".join(
        f"struct({sql_str(c)} AS column, {p!r}D AS p, __n{i} AS n, __below{i}_{j} AS below, {_first(i, j)} AS first, {_last(i, j)} AS last, __lo{i}_{j} AS lo)"
        for i, c in enumerate(cols) for j, p in enumerate(ps)) + "))"))
    pos = F.col("p") * (F.col("n") - 1) if rank_rule == "interpolate" else F.round(F.col("p") * F.col("n")) - 1
    cells = cells.withColumn("pos", pos).withColumn("r_lo", F.floor("pos")).withColumn("r_hi", F.ceil("pos"))

    band = cut_lineage(_band(values, edges, g, cols, ps))
    found = _at_ranks(band, cells, [*g, "column", "p"])
    out = null_safe_join(cells, found, [*g, "column", "p"], "left")
    missed = (F.col("n") > 0) & (F.col("pos") >= 0) & (F.col("v_lo").isNull() | F.col("v_hi").isNull())
    quantile = F.col("v_lo") + (F.col("pos") - F.col("r_lo")) * (F.col("v_hi") - F.col("v_lo"))
    return out.select(*g, "column", "p", "n", F.when(missed, F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")).otherwise(quantile).alias("quantile"))


# Wide tables have hundreds of columns, so the steps below are written as SQL expressions:
# one call for each instead of one for each operand.

def _first(i: int, j: int) -> str:
    return f"least(__lo{i}_{j}, __under{i}_{j})"


def _last(i: int, j: int) -> str:
    return f"greatest(__hi{i}_{j}, __over{i}_{j})"


def _brackets(values: DataFrame, g: Sequence[str], n_cols: int, ps: Sequence[float], accuracy: int) -> DataFrame:
    """Per group: the count of each column and a bracket around each wanted rank."""
    eps = 2.0 / accuracy
    wanted = ", ".join(f"{q!r}D" for p in ps for q in (max(0.0, p - eps), min(1.0, p + eps)))
    aggs = [F.expr(e) for i in range(n_cols) for e in (f"count(__v{i}) AS __n{i}", f"percentile_approx(__v{i}, array({wanted}), {accuracy}) AS __q{i}")]
    sides = [f"__q{i}[{2 * j + side}] AS __{name}{i}_{j}" for i in range(n_cols) for j in range(len(ps)) for side, name in enumerate(("lo", "hi"))]
    return values.groupBy(*g).agg(*aggs).selectExpr(*[f"`{c}`" for c in g], *[f"__n{i}" for i in range(n_cols)], *sides)


def _beside(values: DataFrame, table: DataFrame, g: Sequence[str]) -> DataFrame:
    """Every row with its group's row of ``table``; without groups that one row as literals, which no row has to carry."""
    if g:
        return null_safe_join(values, table, g)
    row = table.first()
    return values.selectExpr("*", *[f"{_literal(row[c])} AS `{c}`" for c in table.columns])


def _literal(value: float | int | None) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(value, int):
        return f"{value}L"
    return f"({value!r}D)" if isfinite(value) else f"CAST('{value!r}' AS DOUBLE)"


def _edges(values: DataFrame, brackets: DataFrame, g: Sequence[str], n_cols: int, ps: Sequence[float]) -> DataFrame:
    """Brackets with the count below them and the next values outside."""
    aggs = []
    for i in range(n_cols):
        for j in range(len(ps)):
            v, lo, hi = f"__v{i}", f"__lo{i}_{j}", f"__hi{i}_{j}"
            aggs += [f"count_if({v} < {lo}) AS __below{i}_{j}", f"max(CASE WHEN {v} < {lo} THEN {v} END) AS __under{i}_{j}", f"min(CASE WHEN {v} > {hi} THEN {v} END) AS __over{i}_{j}"]
    return null_safe_join(brackets, _beside(values, brackets, g).groupBy(*g).agg(*[F.expr(e) for e in aggs]), g)


def _band(values: DataFrame, edges: DataFrame, g: Sequence[str], cols: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """(group..., column, p, value, cnt) of the values inside each widened bracket."""
    hits = ", ".join(f"CASE WHEN __v{i} BETWEEN {_first(i, j)} AND {_last(i, j)} THEN struct({sql_str(c)} AS column, {p!r}D AS p, __v{i} AS value) END"
                     for i, c in enumerate(cols) for j, p in enumerate(ps))
    rows = _beside(values, edges, g).select(*g, F.expr(f"inline(filter(array({hits}), x -> x IS NOT NULL))"))
    return rows.groupBy(*g, "column", "p", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _at_ranks(band: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values at ranks r_lo and r_hi: running counts within sub-ranges of each bracket."""
    band = null_safe_join(band, cells.select(*keys, "first", "last", "lo", "below", "r_lo", "r_hi"), keys)
    span = F.col("last") - F.col("first")
    sub = F.when(span > 0, F.least(F.lit(SUB_RANGES - 1), F.floor((F.col("value") - F.col("first")) / span * SUB_RANGES))).otherwise(0)
    band = band.withColumn("sub", sub.cast("int"))
    totals = band.groupBy(*keys, "sub").agg(F.sum("cnt").alias("t"), F.sum(F.when(F.col("value") < F.col("lo"), F.col("cnt")).otherwise(0)).alias("early"))
    upto = Window.partitionBy(*keys).orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    # Values of the band before lo are also counted in ``below``.
    starts = totals.select(*keys, "sub", (F.coalesce(F.sum("t").over(upto), F.lit(0)) - F.sum("early").over(Window.partitionBy(*keys))).alias("before"))
    inside = Window.partitionBy(*keys, "sub").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    band = null_safe_join(band.withColumn("run", F.sum("cnt").over(inside)), starts, [*keys, "sub"])
    upto_value: Column = F.col("below") + F.col("before") + F.col("run")
    return band.withColumn("cum", upto_value).groupBy(*keys).agg(
        F.min(F.when((F.col("cum") > F.col("r_lo")) & (F.col("cum") - F.col("cnt") <= F.col("r_lo")), F.col("value"))).alias("v_lo"),
        F.min(F.when((F.col("cum") > F.col("r_hi")) & (F.col("cum") - F.col("cnt") <= F.col("r_hi")), F.col("value"))).alias("v_hi"))


def quantile_columns(df: DataFrame, columns: Sequence[str], probs: dict[str, float],
                     group_cols: Sequence[str] = (), accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Wide form: group..., column, one output column per named probability."""
    names = list(probs)
    long = exact_quantiles(df, columns, [probs[n] for n in names], group_cols, accuracy)
    g = list(group_cols) + ["column"]
    return long.groupBy(*g).agg(*[
        F.max(F.when(F.col("p") == F.lit(float(probs[n])), F.col("quantile"))).alias(n) for n in names])
