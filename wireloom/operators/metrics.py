"""Counts, rates and positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireloom import fixed_values as fv
from wireloom.functions import dates
from wireloom.operators.joins import lookup_join
from wireloom.session import checkpointed

COPIES_PER_ROW = 4096


def collected_per_agency(news: DataFrame) -> DataFrame:
    """Rows per agency, and the total in the row whose agency is NULL and is_total true."""
    return (
        news.rollup("agency")
        .agg(F.count(F.lit(1)).alias("news_amount"), (F.grouping("agency") == 1).alias("is_total"))
        .select("agency", "is_total", "news_amount")
    )


def enrich_counts(classified: DataFrame, category: str = "category") -> DataFrame:
    """One row: how many news were processed and how many were skipped as no news."""
    processed = F.col(category).isNotNull() & ~F.col(category).isin(*fv.NON_NEWS_LABELS)
    done = F.count_if(processed)
    return classified.agg(done.alias("processed"), (F.count(F.lit(1)) - done).alias("skipped"))


def seconds_per_item(seconds: Column, items: Column, epsilon: float = fv.PER_ITEM_EPSILON_COLLECT) -> Column:
    """Seconds per item, rounded to 2; the epsilon keeps zero items from dividing by zero."""
    return F.round(seconds / (items + F.lit(epsilon)), 2)


def throughput(log: DataFrame, key: str, time: str, epsilon: float = fv.PER_ITEM_EPSILON_COLLECT) -> DataFrame:
    """Per key: items, minutes from first to last, seconds per item."""
    seconds = F.col("seconds")
    return (
        log.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("items"),
            dates.elapsed_seconds(F.min(time), F.max(time)).alias("seconds"),
        )
        .select(
            key,
            "items",
            F.round(seconds / 60, 2).alias("minutes"),
            seconds_per_item(seconds, F.col("items"), epsilon).alias("sec_per_item"),
        )
    )


def batch_positions(news: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Place of every row within its group: (group, *order, place, total), place from 1.

    A window over the group would put a large group into one task.  Here copies
    are counted first, the distinct keys are range-partitioned and checkpointed
    so that their layout is fixed, each part numbers its own rows, and the counts
    of the earlier parts of the group are added.  Copies of one key get
    consecutive places.
    """
    keys = [group, *order]
    counted = news.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    laid_out = checkpointed(counted.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))

    per_part = laid_out.groupBy(group, "part").agg(F.sum("copies").alias("in_part"))
    within_group = Window.partitionBy(group)  # one row per part and group
    offsets = per_part.select(
        F.struct(group, "part").alias("slot"),
        (F.sum("in_part").over(within_group.orderBy("part")) - F.col("in_part")).alias("before"),
        F.sum("in_part").over(within_group).alias("total"),
    )
    local = Window.partitionBy("slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = laid_out.withColumn("slot", F.struct(group, "part")).withColumn("upto", F.sum("copies").over(local))
    placed = lookup_join(numbered, offsets, "slot", "left").select(
        *keys, (F.col("before") + F.col("upto") - F.col("copies")).alias("start"), "copies", "total"
    )
    return _one_row_per_copy(placed, keys)


def _one_row_per_copy(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expand copies in two steps, so that no row grows an array beyond a fixed size."""
    chunk = F.lit(COPIES_PER_ROW)
    chunks = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / chunk))))
    first = F.col("chunk") * chunk
    last = F.least(first + chunk, F.col("copies")) - 1
    return chunks.withColumn("copy", F.explode(F.sequence(first, last))).select(
        *keys, (F.col("start") + F.col("copy") + 1).alias("place"), "total"
    )
