"""Small helpers shared by operator modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fact_date(fact: DataFrame) -> Column:
    """The reading's calendar date: stored ``full_date`` or decoded ``date_key``."""
    if "full_date" in fact.columns:
        return F.col("full_date")
    return F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")



def label(cond_values, default=None) -> Column:
    """Searched CASE: first matching (condition, value) wins."""
    expr = None
    for cond, value in cond_values:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default) if default is not None else expr
