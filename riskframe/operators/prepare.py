"""Fitted preparation: split, sample, impute, scale, one-hot, ready tables.

``fit_*`` functions run one or two aggregate passes and return a small spec
(one entry per column: a median, a mean and scale, a category list); these
specs are the only things collected to the driver, and their size is bounded
by the number of columns of the output (``one_hot_vectors`` keeps categories
in a model for columns of very many values). ``transform`` is a single ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from math import isfinite

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.profile import categorical_columns, constant_columns, numeric_columns
from riskframe.operators.joins import null_safe_join
from riskframe.operators.sketches import column_sketches, sketch_statistics
from riskframe.operators.quantiles import exact_quantiles, quantile_columns, sql_name, sql_str

# ------------------------------------------------------------------ split and sample


def hash_order(key: Column | str, seed: int) -> Column:
    """Seeded pseudo-random order of a key: md5 of 'seed:key' (engine independent)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def _hash_number(key, seed) -> Column:
    # First 13 hex digits of the md5: 52 bits, exact as a double, same order as the string.
    return F.conv(F.substring(hash_order(key, seed), 1, 13), 16, 10).cast("double")


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42,
                     method: str = "cut", out: str = "split") -> DataFrame:
    """Add ``out`` = 'validation' for the first round(test_size * n_class) rows of
    each class in hash order, 'train' for the rest.

    ``method="cut"`` (scale): per class, the exact hash value at that rank comes
    from :func:`exact_quantiles` (sketch bracket + small band), then a broadcast
    per-class threshold; no window holds a whole class.
    ``method="window"``: ``row_number`` per class (one task per class; for tests).
    """
    if method == "window":
        w = Window.partitionBy(label).orderBy(hash_order(key, seed), F.col(key))
        n = F.count(F.lit(1)).over(Window.partitionBy(label))
        return df.withColumn(out, F.when(F.row_number().over(w) <= F.round(n * test_size), "validation")
                             .otherwise("train"))
    h = df.select(label, _hash_number(key, seed).alias("__h"))
    cuts = (exact_quantiles(h, ["__h"], [test_size], group_cols=[label], rank_rule="round")
            .select(label, F.col("quantile").alias("__cut")))
    return (null_safe_join(df, cuts, [label], "left")
            .withColumn(out, F.when(_hash_number(key, seed) <= F.col("__cut"), "validation").otherwise("train"))
            .drop("__cut"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Add ``out``: 0 to k - 1, dealt by hash order within each class. Fold i of a class of n rows holds
    round((i + 1) n / k) - round(i n / k) of them, so the folds of a class differ by one row at most.

    The k - 1 hash values at which folds change are exact quantiles of every class, joined on the
    class: no window holds a whole class. A null class is a class.
    """
    h = df.select(label, _hash_number(key, seed).alias("__h"))
    cuts = exact_quantiles(h, ["__h"], [i / k for i in range(1, k)], group_cols=[label], rank_rule="round") if k > 1 else None
    if cuts is None:
        return df.withColumn(out, F.lit(0))
    # A class too small for a fold has no value at its rank: that fold ends before the first row.
    per_class = cuts.groupBy(label).agg(F.collect_list(F.coalesce("quantile", F.lit(-1.0))).alias("__cuts"))
    below = F.size(F.filter("__cuts", lambda c: c < F.col("__h")))
    joined = null_safe_join(df.withColumn("__h", _hash_number(key, seed)), per_class, [label], "left")
    return joined.withColumn(out, below.cast("int")).drop("__h", "__cuts")


PARTS = ("train", "validation")


def select_part(df: DataFrame, assignment: DataFrame, key: str, part: str, split_col: str = "split") -> DataFrame:
    """Rows of ``df`` whose key is assigned to ``part`` (semi join on the key)."""
    keys = assignment.where(F.col(split_col) == part).select(key)
    return df.join(keys, key, "left_semi")


def mark_parts(df: DataFrame, assignment: DataFrame, key: str, split_col: str = "split") -> DataFrame:
    """``df`` with a flag for each part, so that :func:`marked_part` finds the rows of :func:`select_part`
    without another join. For frames that are stored and read in several passes."""
    marks = assignment.groupBy(key).agg(*[F.max(F.col(split_col) == p).alias(f"__in_{p}") for p in PARTS])
    return df.join(marks, key, "left")


def marked_part(marked: DataFrame, part: str | None = None) -> DataFrame:
    """The rows of a part (of all by default) of :func:`mark_parts`, without its flags."""
    rows = marked if part is None else marked.where(F.col(f"__in_{part}"))
    return rows.drop(*[f"__in_{p}" for p in PARTS])


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Seeded uniform sample of exactly min(n, rows) rows (deterministic top-n by hash)."""
    return df.orderBy(hash_order(key, seed), F.col(key)).limit(n)


# ------------------------------------------------------------------ fitted statistics

def fit_medians(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> dict[str, float | None]:
    """Exact median per column (linear interpolation); null-only columns -> None.

    ``approximate`` takes a value whose rank is within ``sketches.RANK_ERROR`` of the middle, from one pass.
    """
    if not columns:
        return {}
    if approximate:
        rows = sketch_statistics(column_sketches(df, columns), {"median": 0.5}).collect()  # one row per column
        got = {r.column: r.median for r in rows}
        return {c: got.get(c) for c in columns}
    rows = quantile_columns(df, list(columns), {"median": 0.5}).collect()  # one row per column
    got = {r.column: r.median for r in rows}
    return {c: got.get(c) for c in columns}


EPS = 2.220446049250313e-16  # float64 machine epsilon


def constant_variance(var: Column, mean: Column, n: Column) -> Column:
    """True when a population variance is zero up to floating-point error:
    var <= n*eps*var + (n*mean*eps)^2. Merging partial moments can leave a
    constant column with a variance of ~1e-33 instead of 0."""
    return var <= n * F.lit(EPS) * var + F.pow(n * mean * F.lit(EPS), 2)


def scaling_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, scale) from one aggregate; population std, constant or undefined -> 1."""
    from riskframe.operators.profile import stack_rows

    aggs = []
    for i, c in enumerate(columns):
        x = f"CAST({sql_name(c)} AS DOUBLE)"
        mean, var, n = (F.expr(f"{f}({x})") for f in ("avg", "var_pop", "count"))
        aggs += [F.expr(f"coalesce(avg({x}), 0D) AS m{i}"), F.when(var.isNull() | constant_variance(var, mean, n), F.lit(1.0)).otherwise(F.expr(f"sqrt(var_pop({x}))")).alias(f"s{i}")]
    rows = [[sql_str(c), f"m{i}", f"s{i}"] for i, c in enumerate(columns)]
    return stack_rows(df.agg(*aggs), rows, ["column", "mean", "scale"])


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column in one aggregate; constant (or undefined) -> 1."""
    if not columns:
        return {}
    got = {r.column: (r.mean, r.scale) for r in scaling_frame(df, columns).collect()}  # one row per column
    return {c: got[c] for c in columns}


def modes_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): most frequent non-null value per column, ties -> smallest value."""
    cols = list(columns)
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
            if len(cols) > 1 else df.select(F.lit(cols[0]).alias("column"), F.col(cols[0]).cast("string").alias("value")))
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v"))).alias("mode"))


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value per column (ties: smallest value)."""
    if not columns:
        return {}
    got = {r.column: r.mode for r in modes_frame(df, columns).collect()}  # one row per column
    return {c: got.get(c) for c in columns}


def fit_categories(df: DataFrame, columns: Sequence[str], null_category: str = "own") -> dict[str, list]:
    """Sorted category list per column; null is its own (last) category when
    ``null_category="own"`` and present. One entry per output column of the wide
    encoding; for columns of very many values use ``one_hot_vectors``."""
    if not columns:
        return {}
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value")
    cats: dict[str, list] = {c: [] for c in columns}
    for r in long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).select("column", "value").toLocalIterator():
        if r.value is not None or null_category == "own":
            cats[r.column].append(r.value)
    return {c: sorted(v, key=lambda x: (x is None, x or "")) for c, v in cats.items()}


def one_hot_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One sparse 0/1 vector column ``<column>_onehot`` per column, for any number of
    categories (alphabetical positions; null and unseen values share the last position)."""
    index = StringIndexer(inputCols=list(columns), outputCols=[f"__{c}" for c in columns], handleInvalid="keep", stringOrderType="alphabetAsc")
    hot = OneHotEncoder(inputCols=[f"__{c}" for c in columns], outputCols=[f"{c}_onehot" for c in columns], dropLast=False)
    fitted = index.fit(df).transform(df)
    return hot.fit(fitted).transform(fitted).drop(*[f"__{c}" for c in columns])


def one_hot_sql(value: str, column: str, categories: Sequence) -> list[str]:
    """One 0/1 double per category of the string expression ``value``; null matches the null category; unknown -> all 0."""
    return [f"CASE WHEN {value} <=> {'CAST(NULL AS STRING)' if v is None else sql_str(v)} THEN 1D ELSE 0D END AS {sql_name(f'{column}_{v}')}" for v in categories]


def one_hot_columns(column: str, categories: Sequence) -> list[Column]:
    """The columns of :func:`one_hot_sql` for a column of any type."""
    return [F.expr(e) for e in one_hot_sql(f"CAST({sql_name(column)} AS STRING)", column, categories)]


# ------------------------------------------------------------------ preprocessor

@dataclass
class PrepSpec:
    numeric: list[str]
    categorical: list[str]
    medians: dict = field(default_factory=dict)
    scaling: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    scale_numeric: bool = False
    null_category: str = "own"

    def output_columns(self) -> list[str]:
        return self.numeric + [f"{c}_{v}" for c in self.categorical for v in self.categories[c]]


def with_scaling(df: DataFrame, spec: PrepSpec) -> PrepSpec:
    """A fitted preparation that standardises its imputed numeric columns as well."""
    imputed = df.selectExpr(*[f"{imputed_sql(c, spec.medians[c])} AS {sql_name(c)}" for c in spec.numeric])
    return replace(spec, scale_numeric=True, scaling=fit_scaling(imputed, spec.numeric))


def fit_preprocessor(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     scale_numeric: bool, null_category: str = "own") -> PrepSpec:
    """Median imputation (+ standardisation) for numeric columns; most-frequent
    imputation and one-hot for categorical columns. ``null_category="own"``
    keeps null as its own category (the reference behaviour), ``"mode"``
    imputes it with the most frequent value first."""
    spec = PrepSpec(list(numeric), list(categorical), null_category=null_category)
    spec.medians = fit_medians(df, spec.numeric)
    if scale_numeric:
        spec = with_scaling(df, spec)
    if null_category == "mode":
        spec.modes = fit_modes(df, spec.categorical)
        src = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(spec.modes[c])).alias(c)
                          for c in spec.categorical])
    else:
        src = df
    spec.categories = fit_categories(src, spec.categorical, null_category=null_category)
    return spec


def sql_double(value: float) -> str:
    """A SQL literal of a double, whatever its value."""
    x = float(value)
    return f"({x!r}D)" if isfinite(x) else f"CAST('{x!r}' AS DOUBLE)"


def imputed_sql(column: str, value) -> str:
    x = f"CAST({sql_name(column)} AS DOUBLE)"
    return x if value is None else f"coalesce({x}, {sql_double(value)})"


def impute(column: str, value) -> Column:
    return F.expr(imputed_sql(column, value))


def transform(df: DataFrame, spec: PrepSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric block then one-hot block, as doubles; ``keep`` columns (key, target) first. Written as
    SQL expressions: one call for each output column instead of one for each operand."""
    out = [sql_name(k) for k in keep]
    for c in spec.numeric:
        x = imputed_sql(c, spec.medians.get(c))
        if spec.scale_numeric:
            m, s = spec.scaling[c]
            x = f"({x} - {sql_double(m)}) / {sql_double(s)}"
        out.append(f"{x} AS {sql_name(c)}")
    for c in spec.categorical:
        value = f"CAST({sql_name(c)} AS STRING)"
        if spec.null_category == "mode" and spec.modes.get(c) is not None:
            value = f"coalesce({value}, {sql_str(spec.modes[c])})"
        out += one_hot_sql(value, c, spec.categories[c])
    return df.selectExpr(*out)


# ------------------------------------------------------------------ ready tables

def constant_feature_columns(train: DataFrame, exclude: Sequence[str]) -> list[str]:
    cols = [c for c in train.columns if c not in exclude]
    return [r.column for r in constant_columns(train, cols).where("is_constant").collect()]  # names only


def build_ready(train: DataFrame, test: DataFrame | None, key: str, target: str,
                scale_numeric: bool, null_category: str = "own",
                unscaled: tuple[PrepSpec, list] | None = None) -> tuple[DataFrame, DataFrame | None, PrepSpec, list]:
    """Drop train-constant columns, split by dtype, fit on train, transform both.

    The key is kept in both outputs and the target in train, so later steps
    join on the key instead of relying on row positions. ``unscaled``: the spec and dropped
    columns already fitted on the same train part without scaling, to which scaling is added.
    """
    if unscaled is not None:
        spec, dropped = unscaled
        if scale_numeric:
            spec = with_scaling(train, spec)
    else:
        protect = [key, target]
        dropped = constant_feature_columns(train, protect)
        feats = [c for c in train.columns if c not in protect and c not in dropped]
        base = train.select(*feats)
        numeric = numeric_columns(base)
        categorical = categorical_columns(base)
        spec = fit_preprocessor(train, numeric, categorical, scale_numeric, null_category)
    ready_train = transform(train, spec, keep=[key, target])
    keep_test = [key] + ([target] if test is not None and target in test.columns else [])
    ready_test = transform(test, spec, keep=keep_test) if test is not None else None
    return ready_train, ready_test, spec, dropped
