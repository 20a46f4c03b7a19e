"""Columns that are computed once, however often they are used afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_value(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a column whose expression is costly.

    The optimizer copies the expression of a projected column into every filter
    on it, so a filter on cleaned text would clean each text twice.  It does not
    do that across a generator, and exploding an array of one element is one.
    """
    columns = [F.col(column) for column in df.columns if column != name]
    ordered = df.select(*columns, F.explode(F.array(value)).alias(name))
    return ordered.select(*df.columns) if name in df.columns else ordered
