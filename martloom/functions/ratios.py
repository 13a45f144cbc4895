"""Guarded ratios. Operands may be decimal or double; results are doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` where whole is positive, else null."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def percentage(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` to two places; 0 without a positive whole.

    A null part of a positive whole stays null.
    """
    return F.when(whole > 0, F.round(ratio(part, whole) * 100, 2)).otherwise(F.lit(0.0))


def per_day(weekly: Column) -> Column:
    """Weekly total spread over seven days."""
    return weekly.cast("double") / F.lit(7.0)


def mean(total: Column, count: Column) -> Column:
    """Average out of an exact sum and a count; null when nothing was counted."""
    return F.when(count > 0, total.cast("double") / count.cast("double"))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Publish exact decimal measures as doubles, as the mart tables declare them."""
    exact = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    if not exact:
        return df
    return df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" if c in exact else f"`{c}`" for c in df.columns])
