"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key equals a null key; keeps the left side's key columns.

    Without keys both sides hold one row and are put side by side.
    """
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one-row side
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


SMALL_ROWS = 1000


def small_side(df: DataFrame, keys: Sequence[str], rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcasting if it holds few rows, as a table of few groups does: a join on its keys
    would send all rows of a group to one task. For stored frames, which it reads."""
    return F.broadcast(df) if keys and df.limit(rows + 1).count() <= rows else df
