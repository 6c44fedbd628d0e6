"""Spec-driven roll-up of child records to one row per parent key.

A :class:`RollupSpec` says which columns to derive on the child rows, which
0/1 flags to count (and average), which numeric columns to summarise with
MEAN / MAX / MIN / SUM, and under which prefix. :func:`rollup` turns it into
one ``withColumns`` (parallel: every derived expression sees the *input*
frame) followed by one ``groupBy(key).agg(...)``.

Scale notes
-----------
* Every wide aggregate is algebraic (count / sum / min / max), so Spark runs a
  partial aggregate before the shuffle: a key holding a third of all rows costs
  one partial row per map task, not a hot reducer.
* The unique count runs on its own over the two columns it needs (distinct
  (key, id) pairs, then a count per key) and is joined on the key; the wide
  buffers are never shuffled by (key, id).
* A numeric with a declared decimal scale is summed exactly, so its sum and mean
  don't depend on partitioning or on the order of additions.
* Output is hash-partitioned by the key, so a later join on the same key
  (the applicant table) reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import flag as _flag
from riskframe.operators.joins import null_safe_join
from riskframe.operators.quantiles import sql_name

# Fixed output suffixes, in output order for the numeric pack.
NUMERIC_STATS = ("MEAN", "MAX", "MIN", "SUM")


@dataclass(frozen=True)
class Flag:
    """A 0/1 indicator counted per parent (``{name}_COUNT``), optionally also
    averaged over all child rows (``{name}_RATE``; null conditions count as 0)."""

    name: str
    condition: Column
    rate: bool = False


@dataclass(frozen=True)
class RollupSpec:
    prefix: str
    key: str
    derived: Mapping[str, Column] = field(default_factory=dict)
    unique: str | None = None
    min_max: Sequence[str] = ()
    flags: Sequence[Flag] = ()
    numerics: Sequence[str] = ()
    scales: Mapping[str, int] = field(default_factory=dict)  # numeric -> decimal places summed exactly
    unique_name: str = "UNIQUE_LOAN_COUNT"

    def feature(self, column: str, stat: str) -> str:
        return f"{self.prefix}_{column.upper()}_{stat}"

    @property
    def count_name(self) -> str:
        return f"{self.prefix}_RECORD_COUNT"

    def feature_names(self) -> list[str]:
        """Output columns besides the key, in output order."""
        names = [self.count_name]
        if self.unique:
            names.append(f"{self.prefix}_{self.unique_name}")
        for c in self.min_max:
            names += [self.feature(c, "MIN"), self.feature(c, "MAX")]
        for fl in self.flags:
            names.append(f"{fl.name}_COUNT")
            if fl.rate:
                names.append(f"{fl.name}_RATE")
        for c in self.numerics:
            names += [self.feature(c, s) for s in NUMERIC_STATS]
        return names


def decimal_sum(c: str, scale: int) -> str:
    """``sum(CAST(c AS DECIMAL(28, scale)))`` as SQL, most of it in whole numbers (a decimal that wide is an object for each row).

    A value below 1e14 units of the last place whose units are no nearer than 0.1 to a half rounds to the
    same whole number as a double and as a decimal: the error of the double is below 0.05. Its high and low
    bits are summed apart, so no sum of many rows overflows. All other values are summed as decimals.
    """
    y = f"({c} * {float(10 ** scale)!r}D)"
    units = f"CASE WHEN abs({y}) < 1e14D AND abs({y} - rint({y})) < 0.4D THEN CAST(rint({y}) AS BIGINT) END"
    high, low = f"sum(shiftright({units}, 24))", f"sum(({units}) & 16777215)"
    rest = f"sum(CAST({c} AS DECIMAL(28, {scale}))) FILTER (WHERE ({units}) IS NULL)"
    whole = f"{high} * {_decimal(1 << 24, scale)} + {low} * {_decimal(1, scale)}"
    rest = f"CAST({rest} AS DECIMAL(37, {scale}))"
    return f"coalesce({whole} + coalesce({rest}, 0), {rest})"


def _decimal(units: int, scale: int) -> str:
    """A SQL literal of this many units of the last of ``scale`` places."""
    digits = str(units).rjust(scale + 1, "0")
    return f"{digits[:len(digits) - scale]}.{digits[len(digits) - scale:]}BD" if scale else f"{digits}BD"


def numeric_pack(column: str, spec: RollupSpec) -> list[Column]:
    """MEAN, MAX, MIN, SUM; the sum of an all-null group is 0, the others null.

    With a scale in ``spec.scales`` the sum is taken in decimals of that many
    places and only then turned into a double; the mean is that sum over the count.
    """
    c = sql_name(column)
    packed = {"MEAN": f"avg({c})", "MAX": f"max({c})", "MIN": f"min({c})", "SUM": f"coalesce(sum({c}), 0)"}
    if column in spec.scales:  # the sum once; see finished
        packed |= {"MEAN": f"count({c})", "SUM": f"CAST({decimal_sum(c, spec.scales[column])} AS DOUBLE)"}
    return [_named(packed[s], spec.feature(column, s)) for s in NUMERIC_STATS]


def finished(spec: RollupSpec) -> dict[str, Column]:
    """What becomes of the sums and counts of decimals in :func:`numeric_pack`: sums of 0 for none, and means."""
    out = {}
    for c in spec.scales:
        if c in spec.numerics:
            total, n = sql_name(spec.feature(c, "SUM")), sql_name(spec.feature(c, "MEAN"))
            out |= {spec.feature(c, "MEAN"): _named(f"{total} / {n}", spec.feature(c, "MEAN")), spec.feature(c, "SUM"): _named(f"coalesce({total}, 0D)", spec.feature(c, "SUM"))}
    return out


def _named(aggregate: str, name: str) -> Column:
    return F.expr(f"{aggregate} AS {sql_name(name)}")


def aggregations(spec: RollupSpec) -> list[Column]:
    """All aggregates but the unique count (see ``unique_counts``), as SQL: one call for each
    output column instead of one for each operand."""
    aggs = [_named("count(1)", spec.count_name)]
    for c in spec.min_max:
        aggs += [_named(f"{f}({sql_name(c)})", spec.feature(c, f.upper())) for f in ("min", "max")]
    for fl in spec.flags:
        flag_col = sql_name(f"{fl.name}_FLAG")
        aggs.append(_named(f"sum({flag_col})", f"{fl.name}_COUNT"))
        if fl.rate:
            aggs.append(_named(f"avg({flag_col})", f"{fl.name}_RATE"))
    for c in spec.numerics:
        aggs += numeric_pack(c, spec)
    return aggs


def unique_counts(df: DataFrame, key: str, column: str, names: Sequence[str]) -> DataFrame:
    """Distinct values of ``column`` per key, null counted as one value, under every name."""
    pairs = df.select(key, column).distinct()
    return pairs.groupBy(key).agg(*[F.count(F.lit(1)).alias(n) for n in names])


def _with_unique(wide: DataFrame, children: DataFrame, specs: Sequence[RollupSpec], key: str) -> DataFrame:
    names: dict[str, list[str]] = {}
    for s in specs:
        if s.unique:
            names.setdefault(s.unique, []).append(f"{s.prefix}_{s.unique_name}")
    for column, out in names.items():
        wide = null_safe_join(wide, unique_counts(children, key, column, out), [key])
    done = {n: c for s in specs for n, c in finished(s).items()}
    return wide.select(key, *[done.get(n, sql_name(n)) for s in specs for n in s.feature_names()])


def prepare_children(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """Derived columns and flag columns in ONE ``withColumns`` (parallel semantics)."""
    new_cols = dict(spec.derived)
    for fl in spec.flags:
        new_cols[f"{fl.name}_FLAG"] = _flag(fl.condition)
    return df.withColumns(new_cols) if new_cols else df


def rollup(df: DataFrame, spec: RollupSpec, ids: DataFrame | None = None) -> DataFrame:
    """One row per ``spec.key`` with ``spec.feature_names()`` columns.

    ``ids``: another frame with the same different pairs of key and unique id as ``df``, where one costs less
    than reading ``df`` a second time.
    """
    wide = prepare_children(df, spec).groupBy(spec.key).agg(*aggregations(spec))
    return _with_unique(wide, df if ids is None else ids, [spec], spec.key)


def attach(parent: DataFrame, features: DataFrame, on: str, features_key: str | None = None) -> DataFrame:
    """Left join of pre-aggregated features; parents without children keep null."""
    if features_key and features_key != on:
        features = features.withColumnRenamed(features_key, on)
    return parent.join(features, on=on, how="left")


def two_level_rollup(grandchild: DataFrame, child: DataFrame, inner: RollupSpec,
                     outer: RollupSpec, link: str) -> DataFrame:
    """grandchild -> child (``inner``), left-joined on ``link``, then child -> parent (``outer``).

    ``inner.key`` is the grandchild's reference to the child; ``link`` the child's
    own key. The inner aggregate is pre-computed before the join, so the join
    sees one row per child.
    """
    inner_agg = rollup(grandchild, inner)
    enriched = attach(child, inner_agg, on=link, features_key=inner.key)
    return rollup(enriched, outer)


def rollup_many(df: DataFrame, specs: Sequence[RollupSpec]) -> DataFrame:
    """Several specs over the same child rows and key in ONE wide aggregation, plus one
    narrow unique count per id column (same result as joining the separate roll-ups)."""
    keys = {s.key for s in specs}
    if len(keys) != 1:
        raise ValueError(f"specs must share one key, got {keys}")
    new_cols: dict = {}
    for s in specs:
        cols = dict(s.derived)
        cols.update({f"{fl.name}_FLAG": _flag(fl.condition) for fl in s.flags})
        clash = set(cols) & set(new_cols)
        if clash:
            raise ValueError(f"derived column names collide across specs: {sorted(clash)}")
        new_cols.update(cols)
    prepared = df.withColumns(new_cols) if new_cols else df
    key = keys.pop()
    return _with_unique(prepared.groupBy(key).agg(*[a for s in specs for a in aggregations(s)]), df, specs, key)
