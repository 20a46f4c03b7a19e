"""The agency dimension: which agencies are active, foreign or tied to one category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom import fixed_values as fv


def active_agencies(agencies: DataFrame) -> DataFrame:
    """Agencies that are collected; an unknown flag counts as no."""
    return agencies.filter("is_parsing is true").select("telegram")


def foreign_agencies(agencies: DataFrame) -> DataFrame:
    """Agencies of the foreign group; any unknown language, flag or priority drops the row."""
    return agencies.filter(
        (F.col("language") != "")
        & F.expr("is_parsing is false")
        & (F.col("priority") != fv.SKIPPED_PRIORITY)
    ).select("telegram")


def agencies_of_group(agencies: DataFrame, group: str) -> DataFrame:
    """Agencies polled for the ``russian`` or the ``foreign`` group."""
    return active_agencies(agencies) if group == "russian" else foreign_agencies(agencies)


def mono_categories(agencies: DataFrame, order: Column | None = None) -> DataFrame:
    """One category per specialised agency.

    The text ``None`` and NULL do not count.  Where an agency has several rows,
    the last one in ``order`` wins (by default the greatest category).
    """
    order = order if order is not None else F.col("mono_category")
    kept = agencies.filter((F.col("is_parsing") == F.lit(True)) & ~(F.col("mono_category") == fv.NO_CATEGORY))
    return kept.groupBy("telegram").agg(
        F.max(F.struct(order.alias("place"), F.col("mono_category").alias("value")))["value"].alias("mono_category")
    )
