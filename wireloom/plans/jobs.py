"""The jobs, each over one batch and safe to run again: a run that is done is not repeated, one that is not leaves no trace.

Each job writes all its rows in one pass, whatever tables they go to, and counts them while they are written.

pages:    channel pages → messages, for all groups

collect:  messages → fresh, valid rows; rejects with reasons
enrich:   staged rows → final rows
publish:  final rows → published rows; rejects with reasons
backfill: missing summaries of a day's anniversaries
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from wireloom import fixed_values as fv
from wireloom.functions.links import url_part_id
from wireloom.operators import agencies as ag
from wireloom.operators import enrich as en
from wireloom.operators import ids, updates, validation
from wireloom.operators import messages as messages_of
from wireloom.operators.joins import lookup_join
from wireloom.session import checkpointed
from wireloom.sources.store import BATCH, Conflict, NewsStore, routed

HOME_GROUP = "russian"
PUBLISHED = ("published", "news")
FINAL = (HOME_GROUP, "final")
ERRORS = ("error", "error_table")
FINAL_REJECTS = ("error", "final_rejects")
MODEL_REJECTS = ("error", "model_rejects")
ARCHIVE = ("time_machine", "news")
#: Digests of the messages that could not be read, so that each is kept once.
DIGESTS = ("error", "digests")

GROUP, SPACE = "target_group", "space"


def group_of(language: Column, home_language: str) -> Column:
    """Which group a row is routed to."""
    return F.when(language == home_language, HOME_GROUP).otherwise("foreign")


def news_table(group: str) -> tuple[str, str]:
    """Where staged rows of a group go."""
    return (HOME_GROUP if group == HOME_GROUP else "foreign", "news")


def id_sources(group: str) -> list[tuple[str, str]]:
    """The tables whose ids count as known for a group."""
    if group == HOME_GROUP:
        return [news_table(group), FINAL, ERRORS, PUBLISHED]
    return [news_table(group), ERRORS]


def batch_name(job: str, run: str, group: str = "") -> str:
    """Batches are named by job, group and run, so that no two runs write the same one."""
    return "-".join(part for part in (job, group, run) if part)


def seen_words(store: NewsStore, groups: Sequence[str], digests: bool = True) -> DataFrame:
    """Words of known ids by group (as ``space``): staged and final rows not yet handed over, rejects, and published rows.

    Messages without an id are known by digest, in a space of their own.  No texts or addresses are read.
    """
    known = []
    for group in groups:
        for source in id_sources(group):
            words = store.known_words(*source, pending=source in (news_table(HOME_GROUP), FINAL))
            known.append(words.filter(F.col("agency") != fv.EXCLUDED_AGENCY).withColumn(SPACE, F.lit(group)))
    if digests:
        known.append(store.known_words(*DIGESTS).withColumn(SPACE, F.lit("digests")))
    return reduce(DataFrame.unionByName, known)


def distinct_messages(messages: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Messages (url, date, news, links, agency) with their id and keys, one per id."""
    return ids.keyed_copies(messages.withColumn("id", url_part_id(F.col("url"))), within)


def staged_news(copies: DataFrame, seen: DataFrame) -> DataFrame:
    """Distinct messages that are new, with their broken rules; ``seen`` are words of known ids."""
    return validation.with_errors(ids.fresh_copies(copies, seen).drop("id"), validation.short_rules())


def polled_by(agencies: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(agency, target_group) of the agencies that the groups poll; an agency may be polled by several."""
    own = [ag.agencies_of_group(agencies, group).select(F.col("telegram").alias("agency"), F.lit(group).alias(GROUP)) for group in groups]
    return reduce(DataFrame.unionByName, own).distinct()


def _staged(store: NewsStore, run: str, messages: Callable[[], DataFrame], groups: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Stage fresh messages of all groups, unless the run is done; returns valid and invalid ones by group.

    ``messages`` is not called for a run that is done, so nothing is read or parsed again.
    """
    note = store.committed(run)
    told = _stage_new(store, run, messages(), groups) if note is None else json.loads(note or "{}")
    store.tend([*(news_table(group) for group in groups if group != HOME_GROUP), ERRORS, DIGESTS])
    return {group: (told[f"{group} valid"], told[f"{group} invalid"]) for group in groups}


def _stage_new(store: NewsStore, run: str, messages: DataFrame, groups: Sequence[str]) -> dict[str, int]:
    """Stage fresh messages (with ``target_group`` and ``parse_error``) of all groups in one pass; returns the counts of the commit.

    The distinct messages are kept for the run, because they are read for their id ranges and then for themselves.
    """
    broken = F.col("parse_error").isNotNull()
    digest = F.xxhash64("url", "news", "agency")
    keyed = messages.withColumns({"id": F.when(broken, digest).otherwise(url_part_id(F.col("url"))), SPACE: F.when(broken, "digests").otherwise(F.col(GROUP))})
    unique = ids.keyed_copies(keyed, (SPACE,)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = ids.in_range_of(seen_words(store, groups), unique.filter("id is not null"))
        fresh = ids.fresh_copies(unique, seen, (SPACE,))
        checked = validation.with_errors(fresh, validation.short_rules())
        checked = checked.withColumn("errors", F.when(broken, F.array("parse_error")).otherwise(F.col("errors")))
        valid = F.size("errors") == 0
        targets = {news_table(group): valid & (F.col(GROUP) == group) for group in groups} | {ERRORS: ~valid}
        counts = {}
        for group in groups:
            counts |= {f"{group} valid": F.count_if(valid & (F.col(GROUP) == group)), f"{group} invalid": F.count_if(~valid & (F.col(GROUP) == group))}
        return store.commit(run, run, routed(checked, targets), list(targets), counts=counts, digests=F.when(broken, F.col("id")))
    finally:
        unique.unpersist()


def collect(store: NewsStore, messages: DataFrame, group: str, batch_id: str, agencies: DataFrame | None = None) -> tuple[int, int]:
    """Stage the fresh messages of a group; returns how many were valid and how many were not.

    Rejected ids count as known afterwards.  Without ``agencies`` all are polled.
    """

    def tagged() -> DataFrame:
        own = messages if agencies is None else lookup_join(messages, polled_by(agencies, [group]).select("agency"), "agency", "left_semi")
        return own.select("url", "date", "news", "links", "agency", F.lit(None).cast("string").alias("parse_error"), F.lit(group).alias(GROUP))

    return _staged(store, batch_name("collect", batch_id, group), tagged, [group])[group]


def collect_pages(
    store: NewsStore, pages: DataFrame, agencies: DataFrame, batch_id: str, groups: Sequence[str] = (HOME_GROUP, "foreign"), reader=None
) -> dict[str, tuple[int, int]]:
    """Channel pages (channel, html) to staged news of every group: parse, clean, drop known ids, check, route, in one pass.

    A message of a channel that several groups poll goes to each of them.  Messages without a number or a readable time
    go to the rejects with the reason, each once, even if its page is read again.  Returns the counts of each group.
    """

    def wanted() -> DataFrame:
        polled = checkpointed(polled_by(agencies, groups).groupBy("agency").agg(F.collect_set(GROUP).alias("_groups")))
        read = lookup_join(pages, polled.select(F.col("agency").alias("channel")), "channel", "left_semi")  # no page is parsed in vain
        parsed = messages_of.parse_messages(read, reader or messages_of.read_bubbles).drop("id")
        met = lookup_join(parsed, polled, "agency", "inner").withColumn(GROUP, F.explode("_groups")).drop("_groups")
        return checkpointed(met)  # pages are parsed once

    return _staged(store, batch_name("collect", batch_id), wanted, groups)


def _model_errors(rows: DataFrame) -> Column:
    """What each model that failed on a row said, with the model's name."""
    failed = [F.when(F.col(name).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(name))) for name in en.MODEL_ERRORS if name in rows.columns]
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def handed_over(store: NewsStore, run: str, source: tuple[str, str], targets: Sequence[tuple[str, str]], work: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Make rows for ``targets`` of the batches that a run takes from ``source``, and use these up, once; returns them.

    If another run has used some of them meanwhile, the run takes what is left and starts anew.
    """
    while taken := store.take(run, *source):
        if store.committed(run) is not None:
            break
        try:
            store.commit(run, run, work(store.batch_rows(*source, taken)), targets, [(source, batch) for batch in taken])
        except Conflict:
            continue
        store.tend([target for target in targets if target not in (news_table(HOME_GROUP), FINAL)])
        break
    return taken


def enrich(
    store: NewsStore,
    classify: Callable[[DataFrame], DataFrame],
    agencies: DataFrame,
    batch_id: str,
    title: Callable[[Column], Column] | None = None,
    resume: Callable[[Column], Column] | None = None,
) -> list[str]:
    """Enrich the pending staged rows of the home group; returns the batches taken.

    Rows that a model fails on go to the model rejects with the model's message.
    """

    def work(rows: DataFrame) -> DataFrame:
        final = en.enrich(classify(rows), ag.mono_categories(agencies), title, resume)
        if title or resume:
            final = checkpointed(final)  # one pass of each model
        told = final.withColumn("errors", _model_errors(final))
        return routed(told, {MODEL_REJECTS: F.size("errors") > 0, FINAL: F.lit(True)})

    return handed_over(store, batch_name("enrich", batch_id), news_table(HOME_GROUP), [FINAL, MODEL_REJECTS], work)


def publish(store: NewsStore, batch_id: str) -> list[str]:
    """Publish the pending final rows that pass the rules; returns the batches taken.

    The others are kept with their reasons, outside the tables whose ids count as known.
    """

    def work(rows: DataFrame) -> DataFrame:
        checked = validation.with_errors(rows, validation.final_rules())
        return routed(checked, {FINAL_REJECTS: F.size("errors") > 0, PUBLISHED: F.lit(True)})

    return handed_over(store, batch_name("publish", batch_id), FINAL, [PUBLISHED, FINAL_REJECTS], work)


def backfill(store: NewsStore, as_of: dt.date, resume: Callable[[Column], Column] = en.summarize) -> int:
    """Fill in missing summaries in the archive; returns how many addresses got one."""
    changes = updates.resume_updates(store.read(*ARCHIVE).drop(BATCH), as_of, resume)
    made = store.update(*ARCHIVE, changes, "url", "resume")
    store.tend([ARCHIVE])
    return made
