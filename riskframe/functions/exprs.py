"""Column factories (scalar expressions).

All of these return ``pyspark.sql.Column`` objects built from built-in
functions, so they stay inside whole-stage codegen. Null semantics follow the
reference pipeline (see the module tests):

* ratios are null when the denominator is null or zero, operands as double;
* flags turn a null condition into 0;
* a lower clip keeps null (unlike ``greatest(null, 0)``, which is 0);
* row-wise mean/min/max skip nulls and give null when every input is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """``numerator / denominator`` as double; null when the denominator is null or 0."""
    n, d = col(numerator), col(denominator)
    return F.when(d.isNotNull() & (d != 0), n.cast("double") / d.cast("double"))


def sentinel_to_null(c: ColumnLike, sentinel) -> Column:
    """Replace one placeholder value (such as 365243 days) by null."""
    c = col(c)
    return F.when(c != F.lit(sentinel), c)


def flag(condition: Column) -> Column:
    """0/1 indicator; a null condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def equals_flag(c: ColumnLike, value) -> Column:
    return flag(col(c) == F.lit(value))


def clip_lower(c: ColumnLike, lower=0) -> Column:
    """Clip from below, keeping null (``greatest`` would turn null into the bound)."""
    c = col(c)
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def clip_upper(c: ColumnLike, upper: ColumnLike) -> Column:
    c, u = col(c), (upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(c > u, u).otherwise(c)


def row_mean(*cols: ColumnLike) -> Column:
    """Mean across columns of one row, nulls skipped, all-null -> null."""
    cs = [col(c).cast("double") for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in cs), F.lit(0))
    return F.when(present > 0, total / present)


def row_min(*cols: ColumnLike) -> Column:
    return F.least(*[col(c).cast("double") for c in cols])


def row_max(*cols: ColumnLike) -> Column:
    return F.greatest(*[col(c).cast("double") for c in cols])


def years_from_days(days: ColumnLike) -> Column:
    """Relative day counts (negative = before the application) to years."""
    return (-col(days)).cast("double") / F.lit(365.0)


def blend(primary: ColumnLike, secondary: ColumnLike, primary_weight: float | Column = 0.5) -> Column:
    w = primary_weight if isinstance(primary_weight, Column) else F.lit(float(primary_weight))
    return w * col(primary) + (F.lit(1.0) - w) * col(secondary)


def sigmoid(logit: ColumnLike) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(logit)))


def hard_decision(score: ColumnLike, threshold: float | Column = 0.5) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (col(score) >= t).cast("int")


# ---------------------------------------------------------------- names

def safe_name_column(name: ColumnLike) -> Column:
    """A name with unsafe runs turned to '_', trimmed of them; 'feature' if nothing is left."""
    cleaned = F.regexp_replace(F.regexp_replace(col(name), r"[^A-Za-z0-9_]+", "_"), r"^_+|_+$", "")
    return F.when(cleaned == "", F.lit("feature")).otherwise(cleaned)


def prefix_family(name: ColumnLike, families: Sequence[tuple[str, str]], default: str) -> Column:
    """Label a feature name by the first matching prefix."""
    c = col(name)
    expr = None
    for prefix, label in families:
        cond = c.startswith(prefix)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
