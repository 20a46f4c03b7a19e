"""Message ids: what is known, what is newest, what is fresh."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom import fixed_values as fv
from wireloom.functions import dates, links
from wireloom.operators.joins import lookup_join

IDS_PER_CHUNK = 1024
KEY_AGENCY, KEY_ID = "_key_agency", "_key_id"

#: Seen ids: a word stands for this many consecutive ids of an agency (two to the power of the shift), a bit of its mask for one.
WORD_SHIFT = 6
WORDS = T.StructType([T.StructField("agency", T.StringType()), T.StructField("word", T.LongType()), T.StructField("mask", T.LongType())])


def table_ids(news: DataFrame, excluded_agency: str = fv.EXCLUDED_AGENCY) -> DataFrame:
    """(agency, id) of every row of one news table.

    One agency is left out, and with it rows without an agency.  A URL without a
    numeric id cannot match anything and is left out too; see ``rows_without_id``.
    """
    return (
        news.filter(F.col("agency") != excluded_agency)
        .select("agency", links.url_part_id(F.col("url")).alias("id"))
        .filter(F.col("id").isNotNull())
    )


def rows_without_id(news: DataFrame) -> DataFrame:
    """Rows whose URL carries no numeric id, to be looked at by hand."""
    return news.filter(links.url_part_id(F.col("url")).isNull())


def known_ids(*tables: DataFrame, excluded_agency: str = fv.EXCLUDED_AGENCY) -> DataFrame:
    """Bag union of the ids of several news tables."""
    return reduce(DataFrame.unionByName, [table_ids(table, excluded_agency) for table in tables])


def id_lists(agencies: DataFrame, ids: DataFrame, per_chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """All ids of each agency as (agency, chunk, ids, copies).

    ``ids`` is ascending and ``copies`` counts each of them, so the bag is whole.
    A chunk covers ``per_chunk`` consecutive id values and cannot grow beyond
    them, however many rows an agency has.  An agency without ids gets one row
    with chunk NULL and empty arrays.
    """
    counted = ids.groupBy("agency", "id").agg(F.count(F.lit(1)).alias("copies"))
    chunks = (
        counted.groupBy("agency", F.expr(f"id div {per_chunk}").alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("id", "copies"))).alias("entries"))
        .select("agency", "chunk", F.col("entries.id").alias("ids"), F.col("entries.copies").alias("copies"))
    )
    empty = F.array().cast("array<bigint>")
    return _names(agencies).join(chunks, "agency", "left").select(
        "agency", "chunk", F.coalesce("ids", empty).alias("ids"), F.coalesce("copies", empty).alias("copies")
    )


def article_ids(agencies: DataFrame, news: DataFrame) -> DataFrame:
    """(agency, article_id, copies) per active agency; ids are text, as they stand in the URL.

    An agency without articles gets one row with article_id NULL and 0 copies.
    """
    counted = news.groupBy("agency", links.last_segment(F.col("url")).alias("article_id")).agg(F.count(F.lit(1)).alias("copies"))
    return _names(agencies).join(counted, "agency", "left").select("agency", "article_id", F.coalesce("copies", F.lit(0)).alias("copies"))


def _names(agencies: DataFrame) -> DataFrame:
    return agencies.select(F.col("telegram").alias("agency")).distinct()


def articles_of(articles: DataFrame, agency: str) -> DataFrame:
    """The ids of one agency."""
    return articles.filter(F.col("agency") == agency)


def latest_per_agency(news: DataFrame) -> DataFrame:
    """Newest date of each agency."""
    return news.groupBy("agency").agg(F.max("date").alias("date"))


def last_message_ids(agencies: DataFrame, news: DataFrame) -> DataFrame:
    """(channel_link, last_id) of each active agency; 0 where it has no news.

    Ties on the newest date go to the greatest id.
    """
    message_id = links.message_id(F.col("url"))
    newest = (
        news.filter(F.col("agency").isNotNull() & F.col("date").isNotNull())
        .select("agency", message_id.alias("id"), _recency(F.col("date"), message_id).alias("recency"))
        .groupBy("agency")
        .agg(F.max_by("id", "recency").alias("last_id"))
    )
    return agencies.select(F.col("telegram").alias("agency")).join(newest, "agency", "left").select(
        links.channel_page(F.col("agency")).alias("channel_link"),
        F.coalesce("last_id", F.lit(0)).alias("last_id"),
    )


def _recency(date: Column, message_id: Column) -> Column:
    """(date, id) as one fixed-width number, so that the newest row is found by a hash aggregate."""
    return dates.micros(date).cast("decimal(18,0)") * F.lit(2**63 - 1).cast("decimal(19,0)") + F.coalesce(
        message_id, F.lit(-1)
    ).cast("decimal(19,0)")


def words(seen: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Ids (agency, id) as (agency, word, mask), one row per word; ``within`` are further key columns."""
    numbered = seen.filter(F.col("agency").isNotNull() & F.col("id").isNotNull())
    return (
        numbered.groupBy(*within, "agency", F.shiftright("id", WORD_SHIFT).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _place("id"))).alias("mask"))
    )


def merged_words(seen: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Words of several runs, one row per word."""
    return seen.groupBy(*within, "agency", "word").agg(F.bit_or("mask").alias("mask"))


def _place(number: str) -> Column:
    """The bit of an id within its word."""
    return F.col(number).bitwiseAND(F.lit((1 << WORD_SHIFT) - 1).cast("long")).cast("int")


def ids_of_words(seen: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(agency, id) of words."""
    one = F.lit(1).cast("long")
    numbers = F.filter(F.sequence(F.lit(0), F.lit((1 << WORD_SHIFT) - 1)), lambda place: F.call_function("shiftrightunsigned", F.col("mask"), place).bitwiseAND(one) == one)
    return seen.select(*within, "agency", "word", F.explode(numbers).alias("place")).select(*within, "agency", (F.shiftleft("word", WORD_SHIFT) + F.col("place")).alias("id"))


def fresh(messages: DataFrame, seen: DataFrame, within: Sequence[str] = (), agency: str = "agency", number: str = "id") -> DataFrame:
    """Messages whose (agency, id) has not been seen; ``seen`` are words.

    Seen ids grow without bound, so they are shuffled, not broadcast; adaptive execution still broadcasts them where they
    turn out small, and splits partitions that one hot key of the messages fills.  The join is by agency and id, by which
    keyed copies already lie.
    """
    known = ids_of_words(seen, within).select(*[F.col(name).alias(f"_seen_{name}") for name in (*within, "agency", "id")])
    same = [F.col(name) == F.col(f"_seen_{name}") for name in within]
    same += [F.col(agency) == F.col("_seen_agency"), F.col(number) == F.col("_seen_id")]
    return messages.join(known, reduce(Column.__and__, same), "left_anti")


def in_range_of(seen: DataFrame, messages: DataFrame) -> DataFrame:
    """Seen words that can matter for a batch: between its least and greatest id of the same agency.

    Ids of a page lie close together, so this leaves a sliver of a seen table that
    may be far larger than the batch, before anything is shuffled.
    """
    least, greatest = (F.shiftright(of("id"), WORD_SHIFT) for of in (F.min, F.max))
    bounds = messages.groupBy("agency").agg(least.alias("_least"), greatest.alias("_greatest"))
    return lookup_join(seen, bounds, "agency", "inner").filter(F.col("word").between(F.col("_least"), F.col("_greatest"))).select(seen.columns)


def keyed_copies(messages: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row per message: the earliest by date, then by its text; with the two key columns in front.

    ``within`` are further key columns: a message may occur once in each.

    Copies are reduced before the shuffle, so a message that fills a third of the
    input costs one row per task.  Where agency or id is NULL, nothing says that
    two rows are the same message: there the whole row is the key, next to a NULL
    id, which no numbered message has.
    """
    columns = [name for name in messages.columns if name not in within]
    ordered = sorted(columns, key=lambda name: (name != "date", name in ("agency", "id"), columns.index(name)))
    numbered = F.col("agency").isNotNull() & F.col("id").isNotNull()
    whole_row = F.to_json(F.struct(*columns))
    return (
        messages.select(
            F.when(numbered, F.col("agency")).otherwise(whole_row).alias(KEY_AGENCY),
            F.when(numbered, F.col("id")).alias(KEY_ID),
            *within,
            *columns,
        )
        .groupBy(*within, KEY_AGENCY, KEY_ID)
        .agg(F.min(F.struct(*ordered)).alias("first"))
        .select(*within, KEY_AGENCY, KEY_ID, *[F.col(f"first.{name}") for name in columns])
    )


def first_copies(messages: DataFrame) -> DataFrame:
    """One row per message, in the columns of the input."""
    return keyed_copies(messages).drop(KEY_AGENCY, KEY_ID)


def fresh_copies(copies: DataFrame, seen: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Keyed copies that have not been seen (words)."""
    return fresh(copies, seen, within, KEY_AGENCY, KEY_ID).drop(KEY_AGENCY, KEY_ID)
