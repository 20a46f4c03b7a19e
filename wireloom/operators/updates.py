"""Keyed column updates and the summary backfill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom.functions import dates
from wireloom.functions import text as tx
from wireloom.operators.enrich import summarize, value_of
from wireloom.operators.joins import lookup_join
from wireloom.session import checkpointed


def missing_on_anniversaries(history: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of earlier years on the same day that have no summary yet."""
    without = F.col("resume").isNull() | (F.col("resume") == "")
    return history.filter(dates.on_days(F.col("date"), dates.anniversary_days(as_of)) & without)


def last_update_per_key(updates: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """One value per key: the one that comes last in ``order``."""
    return (
        updates.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(order.alias("place"), F.col(value).alias("value")))["value"].alias(value))
    )


def apply_updates(target: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """Set a column on every row whose key has an update, whatever its other columns say.

    Of several values for one key the greatest counts; ``last_update_per_key``
    picks by another order beforehand.
    """
    changes = updates.groupBy(key).agg(F.struct(F.max(column).alias("value")).alias("_change"))
    joined = lookup_join(target, changes, key, "left")
    return joined.select(
        *[
            F.when(F.col("_change").isNotNull(), F.col("_change.value")).otherwise(F.col(column)).alias(column)
            if name == column
            else F.col(name)
            for name in target.columns
        ]
    )


def resume_updates(
    history: DataFrame, as_of: dt.date, resume: Callable[[Column], Column] = summarize
) -> DataFrame:
    """(url, resume) for rows with a missing summary on the anniversaries of a day.

    Rows are taken newest first, so of several with one URL the oldest wins, and
    of those on one date the least text.  Rows that a plugged-in model fails on are
    left for the next time.
    """
    made = missing_on_anniversaries(history, as_of).select("url", "date", resume(F.col("news")).alias("resume"))
    missing = value_of(made, "resume").withColumn("resume", tx.sql_safe(F.col("resume")))
    ranked = missing.filter(F.col("url").isNotNull() & F.col("resume").isNotNull())
    return ranked.groupBy("url").agg(F.min(F.struct("date", "resume"))["resume"].alias("resume"))


def backfill_resumes(
    history: DataFrame, as_of: dt.date, resume: Callable[[Column], Column] = summarize
) -> DataFrame:
    """The history with the missing summaries of a day's anniversaries filled in.

    The summaries are checkpointed: a model must not run again for the size check
    or after a lost executor.
    """
    made = checkpointed(resume_updates(history, as_of, resume))
    return apply_updates(history, made, "url", "resume")
