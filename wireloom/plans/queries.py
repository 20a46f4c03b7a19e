"""The registered queries: each runs an operator over whole supplied tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom import fixed_values as fv
from wireloom import schemas
from wireloom.functions import dates, links, markup
from wireloom.functions import text as tx
from wireloom.operators import agencies as ag
from wireloom.operators import boilerplate, enrich, ids, messages, metrics, updates, validation
from wireloom.operators.joins import lookup_join
from wireloom.plans import fixtures as fx
from wireloom.plans import jobs
from wireloom.session import scratch_path
from wireloom.sources import tables
from wireloom.sources.store import NewsStore
from wireloom.streaming.ingest import ingest, ingest_pages

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2002, 3, 1)
HOME_LANGUAGE = "en"
BULKY_PAGE_ADDRESS = 2100

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _news(spark: SparkSession, folder: str) -> DataFrame:
    return fx.news(tables.table(spark, folder, "documents"))


def _decorated(spark: SparkSession, folder: str) -> DataFrame:
    return fx.decorated(fx.documents(spark, folder))


def _active(spark: SparkSession, folder: str) -> DataFrame:
    return ag.active_agencies(fx.agencies(spark, folder))


# --- agencies ----------------------------------------------------------------


@query
def active_agencies(spark, folder):
    return ag.active_agencies(fx.agencies(spark, folder))


@query
def foreign_agencies(spark, folder):
    return ag.foreign_agencies(fx.agencies(spark, folder))


@query
def mono_category_lookup(spark, folder):
    return ag.mono_categories(fx.agency_rows(spark, folder), F.col("place"))


# --- scans and routing -------------------------------------------------------


@query
def staged_scan(spark, folder):
    staged = schemas.conform(_news(spark, folder), schemas.table_schema("russian", "news"))
    return tables.run_query(spark, "SELECT * FROM {news}", {"news": staged})


@query
def limit_probe(spark, folder):
    rows = _news(spark, folder)
    probes = {"staged": fx.quarter(rows, 0), "final": fx.quarter(rows, 1), "empty": rows.filter("doc_id < 0")}
    answers = [tables.non_empty(probe).select(F.lit(name).alias("name"), "non_empty") for name, probe in probes.items()]
    return answers[0].unionByName(answers[1]).unionByName(answers[2])


@query
def route_by_group(spark, folder):
    group = jobs.group_of(F.col("lang"), HOME_LANGUAGE)
    return (
        _news(spark, folder)
        .groupBy(group.alias("lang_group"))
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("agency").alias("agencies"))
    )


# --- ids ---------------------------------------------------------------------


def _known(spark, folder):
    rows = _news(spark, folder)
    return ids.known_ids(*[fx.quarter(rows, number) for number in range(4)], excluded_agency="src7")


@query
def known_ids(spark, folder):
    return _known(spark, folder)


@query
def known_ids_foreign(spark, folder):
    rows = _news(spark, folder)
    return ids.known_ids(fx.quarter(rows, 0), fx.quarter(rows, 2), excluded_agency="src7")


@query
def agency_id_lists(spark, folder):
    bag = _known(spark, folder).withColumn("id", F.floor(F.col("id") / 3))
    lists = ids.id_lists(_active(spark, folder), bag)
    return lists.select(
        "agency", "chunk", F.array_join("ids", ",").alias("ids"), F.array_join("copies", ",").alias("copies")
    )


@query
def articles_by_agency(spark, folder):
    return ids.article_ids(_active(spark, folder), fx.quarter(_news(spark, folder), 1))


@query
def articles_of_one_agency(spark, folder):
    return ids.articles_of(articles_by_agency(spark, folder), "src5")


@query
def latest_per_agency(spark, folder):
    return ids.latest_per_agency(_news(spark, folder))


@query
def last_news_id(spark, folder):
    return ids.last_message_ids(fx.agencies(spark, folder).filter("is_parsing is true"), _news(spark, folder))


@query
def fresh_anti_join(spark, folder):
    rows = _news(spark, folder).withColumn("id", links.url_part_id(F.col("url")))
    seen = ids.words(ids.known_ids(fx.quarter(rows, 3), fx.quarter(rows, 2)))
    return ids.fresh(rows.select("agency", "id", "url", "date", "news"), seen)


# --- links and dates ---------------------------------------------------------


@query
def link_normalize(spark, folder):
    kind = F.col("page_id") % 4
    link = (
        F.when(kind == 0, F.concat(F.lit(fv.VIDEO_LINK_PREFIX + "?v="), F.col("page_id")))
        .when(kind == 1, F.lit("?only=query"))
        .otherwise(F.substring_index("url", "?utm", 1))
    )
    return tables.table(spark, folder, "pages").select("page_id", links.normalize_link(link, F.col("url")).alias("links"))


@query
def link_choose(spark, folder):
    kind, number = F.col("page_id") % 7, F.col("page_id")
    href = (
        F.when(kind == 0, "https://t.me/some_channel")
        .when(kind == 1, "https://example.com")
        .when(kind == 2, F.concat(F.lit("https://t.me/some_channel/"), number))
        .when(kind == 3, F.lit(None))
        .when(kind == 4, F.concat(F.lit("tg://resolve?domain=c"), number))
        .when(kind == 5, F.concat(F.lit("https://t.me/+c"), number))
        .otherwise(F.col("url"))
    )
    own = F.concat(F.lit("https://t.me/own/"), number)
    return tables.table(spark, folder, "pages").select("page_id", links.choose_link(href, own).alias("links"))


@query
def event_time_shift(spark, folder):
    iso = F.when(F.col("event_id") % 100 == 0, "n/a").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))
    )
    return tables.table(spark, folder, "events").select("event_id", dates.newsroom_time(iso).alias("date"))


@query
def anniversary_dates(spark, folder):
    days = tables.table(spark, folder, "orders").select(
        F.add_months(F.to_date("o_orderdate"), 48).alias("as_of")
    )
    return days.distinct().select("as_of", F.explode(dates.anniversaries(F.col("as_of"))).alias("past_date"))


@query
def anniversary_missing(spark, folder):
    found = updates.missing_on_anniversaries(fx.history(spark, folder), AS_OF)
    return found.select("o_orderkey", "url", "date", "resume")


# --- text --------------------------------------------------------------------


@query
def channel_rule(spark, folder):
    text = F.concat(F.lit("a: b: "), F.col("news"), F.lit(": end# tag"))
    return _decorated(spark, folder).select(
        "doc_id", tx.last_clause(text, F.col("agency"), fx.RULED_SOURCE).alias("news")
    )


@query
def strip_boilerplate(spark, folder):
    return boilerplate.strip_by_labels(_decorated(spark, folder), fx.labels(spark, folder))


@query
def strip_many_phrases(spark, folder):
    """Every source lists the beginnings of all its texts."""
    return boilerplate.strip_by_labels(_decorated(spark, folder), fx.beginnings(spark, folder))


@query
def strip_fixed_boilerplate(spark, folder):
    return _decorated(spark, folder).select(
        "doc_id", tx.strip_boilerplate(F.col("news"), F.col("agency")).alias("news")
    )


def _text_query(step):
    def build(spark, folder):
        return _decorated(spark, folder).select("doc_id", step(F.col("news")).alias("news"))

    return build


for _name in ("strip_emoji", "strip_trailing_url", "strip_site_links", "strip_tags_mentions"):
    QUERIES[_name] = _text_query(getattr(tx, _name))


@query
def clean_text(spark, folder):
    return _decorated(spark, folder).select("doc_id", tx.clean_text(F.col("news"), F.col("agency")).alias("news"))


@query
def label_strip(spark, folder):
    labelled = F.concat(F.lit("__label__"), F.col("lang"))
    return tables.table(spark, folder, "documents").select("doc_id", tx.label_name(labelled).alias("category"))


# --- pages -------------------------------------------------------------------


@query
def html_blocks(spark, folder):
    blocks = markup.blocks(F.col("html"), "<p>", "</p>", "</article>")
    return fx.pages(spark, folder).select("page_id", F.posexplode(blocks).alias("block_no", "block"))


@query
def html_first_link(spark, folder):
    return fx.referenced(fx.pages(spark, folder)).select("page_id", markup.first_link(F.col("html")).alias("href"))


@query
def html_text(spark, folder):
    return fx.referenced(fx.pages(spark, folder)).select("page_id", markup.visible_text(F.col("html")).alias("text"))


@query
def html_bold(spark, folder):
    return fx.referenced(fx.pages(spark, folder)).select(
        "page_id", F.array_join(markup.bold_fragments(F.col("html")), "|").alias("bold")
    )


@query
def headline_split(spark, folder):
    title = tx.join_fragments(markup.bold_fragments(F.col("html")))
    text = markup.visible_text(F.col("html"))
    return fx.referenced(fx.pages(spark, folder)).select("page_id", tx.split_headline(text, title).alias("news"))


@query
def parse_message(spark, folder):
    pages = fx.channel_pages(fx.documents(spark, folder))
    return messages.parse_messages(pages)


@query
def parse_message_regular(spark, folder):
    pages = fx.channel_pages(fx.documents(spark, folder))
    return messages.parse_messages(pages, messages.read_regular_bubbles)


# --- validation --------------------------------------------------------------


@query
def valid_url(spark, folder):
    url, number, kind = F.col("url"), F.col("page_id"), F.col("page_id") % 13
    address = (
        F.when(kind == 1, F.concat(F.lit("ftp://"), F.substring_index(url, "://", -1)))
        .when(kind == 2, F.substring_index(url, "://", -1))
        .when(kind == 3, F.concat(F.lit("http://localhost/"), number))
        .when(kind == 4, F.concat(F.lit("  "), url, F.lit("\n")))
        .when(kind == 5, F.concat(url, F.lit("/a b")))
        .when(kind == 6, F.concat(F.lit("http://10.0.0.1:8080/x?"), number))
        .when(kind == 7, F.concat(F.lit("HTTPS://user:pw@новости.рф/ы?q="), number))
        .when(kind == 8, F.concat(F.lit("http://example.com:"), F.lit(65000) + number % 1000))
        .when(kind == 9, F.concat(url, F.lit("#"), F.repeat(F.lit("a"), BULKY_PAGE_ADDRESS)))
        .when(kind == 10, F.concat(F.lit("http://[2001:db8::1]:80/"), number))
        .when(kind == 11, F.lit(None))
        .otherwise(url)
    )
    return tables.table(spark, folder, "pages").select(
        "page_id", address.alias("url"), validation.is_http_url(address).alias("is_valid")
    )


def _checked(spark, folder, rules):
    return validation.with_errors(fx.corrupted(_news(spark, folder)), rules)


@query
def validate_short_split(spark, folder):
    checked = _checked(spark, folder, validation.short_rules())
    staged = [field.name for field in schemas.STAGED]
    return checked.select("doc_id", *staged, F.array_join("errors", ",").alias("errors"))


@query
def validate_final(spark, folder):
    return validation.valid_rows(_checked(spark, folder, validation.final_rules()))


@query
def rejects_by_reason(spark, folder):
    return validation.rejects_by_reason(_checked(spark, folder, validation.final_rules()))


@query
def validation_counts(spark, folder):
    return validation.validation_counts(_checked(spark, folder, validation.final_rules()))


# --- enrichment --------------------------------------------------------------


def _classified(rows: DataFrame) -> DataFrame:
    return fx.labelled(rows).withColumn("category", tx.label_name(F.col("label"))).drop("label")


@query
def category_filter(spark, folder):
    return enrich.drop_non_news(_classified(_news(spark, folder))).select("doc_id", "url", "category")


@query
def category_override(spark, folder):
    mono = ag.mono_categories(fx.agencies(spark, folder))
    return enrich.override_category(
        _classified(_news(spark, folder)).select("doc_id", "agency", "category"), mono
    )


@query
def spread_lookup(spark, folder):
    """A lookup that is not to be broadcast: sources with a large share of the facts are spread."""
    news = tables.table(spark, folder, "documents").select("doc_id", "source")
    return lookup_join(news, news.groupBy("source").agg(F.count("doc_id").alias("of_source")), "source", max_rows=-1, by=["doc_id"])


@query
def classify_text(spark, folder):
    docs = fx.documents(spark, folder).select("doc_id", F.col("text").alias("news"), F.col("lang").alias("label"))
    return enrich.bayes_labels(docs, docs)


@query
def truncate_tokens(spark, folder):
    return fx.documents(spark, folder).select("doc_id", tx.truncate_tokens(F.col("text")).alias("text"))


@query
def summarize(spark, folder):
    return fx.documents(spark, folder).select("doc_id", enrich.summarize(F.col("text")).alias("resume"))


@query
def headline(spark, folder):
    return fx.documents(spark, folder).select("doc_id", enrich.headline(F.col("text")).alias("title"))


@query
def enrich_news(spark, folder):
    rows = _classified(fx.news(fx.documents(spark, folder)))
    final = enrich.enrich(rows, ag.mono_categories(fx.agencies(spark, folder)))
    return schemas.conform(final, schemas.ENRICHED)


@query
def resume_backfill(spark, folder):
    return updates.backfill_resumes(fx.history(spark, folder), AS_OF).select("o_orderkey", "url", "date", "resume")


# --- metrics -----------------------------------------------------------------


@query
def batch_position(spark, folder):
    rows = tables.table(spark, folder, "documents").select(
        F.col("source").alias("agency"),
        fx.minute_of(F.floor(F.col("doc_id") / 40)).alias("date"),
        F.concat(F.lit("https://t.me/"), F.col("source"), F.lit("/"), F.floor(F.col("doc_id") / 40)).alias("url"),
    )
    return metrics.batch_positions(rows, "agency", ["date", "url"])


@query
def collected_per_agency(spark, folder):
    return metrics.collected_per_agency(_news(spark, folder))


@query
def enrich_counts(spark, folder):
    return metrics.enrich_counts(_classified(_news(spark, folder)))


@query
def throughput_rate(spark, folder):
    return metrics.throughput(tables.table(spark, folder, "events"), "event_type", "ts")


@query
def enrich_rate(spark, folder):
    return metrics.throughput(tables.table(spark, folder, "events"), "event_type", "ts", fv.PER_ITEM_EPSILON_ENRICH)


@query
def tomorrow_in_zone(spark, folder):
    return tables.table(spark, folder, "events").select("event_id", dates.tomorrow(utc=F.col("ts")).alias("tomorrow"))


# --- jobs --------------------------------------------------------------------


def _derived_label(staged: DataFrame) -> DataFrame:
    return _classified(staged.withColumn("doc_id", links.url_part_id(F.col("url"))))


@query
def publish_roundtrip(spark, folder):
    store = NewsStore(spark, scratch_path(spark, "store"))
    rows = fx.news(fx.documents(spark, folder))
    agencies = fx.agencies(spark, folder)
    jobs.collect(store, rows, jobs.HOME_GROUP, "collect-1")
    for _ in range(2):
        jobs.enrich(store, _derived_label, agencies, "enrich-1")
        jobs.publish(store, "publish-1")
    return store.read(*jobs.PUBLISHED).drop("batch_id")


def _no_service(rows):
    raise InterruptedError


def _breaks_off(store, agencies, run):
    """A run that has taken its batches and then finds no classifier."""
    try:
        jobs.enrich(store, _no_service, agencies, run)
    except InterruptedError:
        return


@query
def publish_retry(spark, folder):
    """A run breaks off before its commit, new rows arrive, and it is repeated under its name."""
    store = NewsStore(spark, scratch_path(spark, "store"))
    rows = fx.news(fx.documents(spark, folder))
    agencies = fx.agencies(spark, folder)
    jobs.collect(store, rows.filter("doc_id % 3 = 0"), jobs.HOME_GROUP, "1")
    _breaks_off(store, agencies, "1")
    jobs.collect(store, rows.filter("doc_id % 3 = 1"), jobs.HOME_GROUP, "2")
    jobs.enrich(store, _derived_label, agencies, "1")
    jobs.collect(store, rows.filter("doc_id % 3 = 2"), jobs.HOME_GROUP, "3")
    for run in ("1", "2", "2"):
        jobs.enrich(store, _derived_label, agencies, run)
        jobs.publish(store, run)
    return store.read(*jobs.PUBLISHED).drop("batch_id")


@query
def handover_conflict(spark, folder):
    """A run breaks off, a second one takes its batches over, and the first one is repeated when new rows have come."""
    store = NewsStore(spark, scratch_path(spark, "store"), lease=0)
    rows = fx.news(fx.documents(spark, folder))
    agencies = fx.agencies(spark, folder)
    jobs.collect(store, rows.filter("doc_id % 2 = 0"), jobs.HOME_GROUP, "1")
    _breaks_off(store, agencies, "1")
    jobs.enrich(store, _derived_label, agencies, "2")
    jobs.collect(store, rows.filter("doc_id % 2 = 1"), jobs.HOME_GROUP, "2")
    for run in ("1", "2", "1"):
        jobs.enrich(store, _derived_label, agencies, run)
    for run in ("1", "1", "2"):
        jobs.publish(store, run)
    return store.read(*jobs.PUBLISHED).drop("batch_id")


@query
def collect_both_groups(spark, folder):
    """Both groups under one run: no group's rejects replace the other's."""
    store = NewsStore(spark, scratch_path(spark, "store"))
    rows = fx.news(fx.documents(spark, folder))
    rows = rows.withColumn("news", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("news")))
    for _ in range(2):
        jobs.collect(store, rows.filter("doc_id % 2 = 0"), jobs.HOME_GROUP, "run-1")
        jobs.collect(store, rows.filter("doc_id % 2 = 1"), "foreign", "run-1")
    parts = {"russian": jobs.news_table(jobs.HOME_GROUP), "foreign": jobs.news_table("foreign"), "error_table": jobs.ERRORS}
    return reduce(DataFrame.unionByName, [store.read(*place).select("url", F.lit(name).alias("target")) for name, place in parts.items()])


@query
def collect_pages(spark, folder):
    """Channel pages to the tables of both groups, with the rejects; agencies of src0 to src4 are polled by both."""
    store = NewsStore(spark, scratch_path(spark, "store"))
    pages = fx.channel_pages(fx.documents(spark, folder))
    for _ in range(2):
        jobs.collect_pages(store, pages, fx.polled(spark, folder), "hour-1")
    jobs.collect_pages(store, pages, fx.polled(spark, folder), "hour-2")
    return _collected(store)


def _collected(store):
    parts = {"russian": jobs.news_table(jobs.HOME_GROUP), "foreign": jobs.news_table("foreign"), "error_table": jobs.ERRORS}
    columns = [field.name for field in schemas.STAGED]
    rows = []
    for name, place in parts.items():
        own = store.read(*place)
        reasons = F.array_join("errors", ",") if "errors" in own.columns else F.lit("")
        rows.append(own.select(*columns, reasons.alias("errors"), F.lit(name).alias("target")))
    return reduce(DataFrame.unionByName, rows)


@query
def stream_pages(spark, folder):
    """The same pages as a stream of files that arrive in four parts, one of them twice, a micro-batch each; the last one is replayed.

    The files of a part are written side by side, and the stream goes on from its checkpoint when a part has arrived.
    """
    store = NewsStore(spark, scratch_path(spark, "store"))
    agencies, place = fx.polled(spark, folder), scratch_path(spark, "pages")
    pages = fx.channel_pages(fx.documents(spark, folder))
    checkpoint, done = scratch_path(spark, "stream"), []
    for part in (0, 1, 2, 0):
        pages.filter(F.pmod(F.hash("channel"), F.lit(3)) == part).write.mode("append").parquet(f"{place}/pages.parquet")
        arriving = tables.table_stream(spark, place, "pages", schemas.PAGES)
        ingest_pages(arriving, store, agencies, checkpoint, on_batch=lambda name, counts: done.append(name)).awaitTermination()
    jobs.collect_pages(store, pages, agencies, done[-1])
    return _collected(store)


@query
def query_with_parameter(spark, folder):
    """A SQL text with a parameter over a named frame."""
    return tables.run_query(spark, "SELECT url, date, agency FROM {news} WHERE agency = :agency", {"news": _news(spark, folder)}, agency="src5")


@query
def dead_letter(spark, folder):
    """The place of the rows cannot be reached: they are kept aside, the table stays as it was."""
    store = NewsStore(spark, scratch_path(spark, "store"), data="no-such-scheme://nowhere")
    try:
        store.append(*jobs.news_table(jobs.HOME_GROUP), fx.news(fx.documents(spark, folder)), "1")
    except Exception:  # noqa: BLE001 - whatever the sink raises
        pass
    kept = store.dead_letters(*jobs.news_table(jobs.HOME_GROUP)).select("url", "news", "agency")
    return kept.unionByName(store.read(*jobs.news_table(jobs.HOME_GROUP)).select("url", "news", "agency"))


@query
def backfill_store(spark, folder):
    """Missing summaries filled in through the store; only the changes are written."""
    store = NewsStore(spark, scratch_path(spark, "store"))
    store.append(*jobs.ARCHIVE, fx.history(spark, folder), "archive")
    jobs.backfill(store, AS_OF)
    return store.read(*jobs.ARCHIVE).select("url", "date", "resume")


@query
def stream_ingest(spark, folder):
    store = NewsStore(spark, scratch_path(spark, "store"))
    docs = tables.table(spark, folder, "documents")
    store.append(*jobs.PUBLISHED, fx.quarter(fx.news(docs), 3), "earlier")
    arriving = fx.news(tables.table_stream(spark, folder, "documents", docs.schema))
    faulty = arriving.withColumn("news", F.when(F.col("doc_id") % 25 == 0, "").otherwise(F.col("news")))
    ingest(faulty, store, jobs.HOME_GROUP, scratch_path(spark, "stream")).awaitTermination()
    staged = schemas.conform(store.read(*jobs.news_table(jobs.HOME_GROUP)), schemas.STAGED)
    rejected = schemas.conform(store.read(*jobs.ERRORS), schemas.STAGED)
    return staged.withColumn("target", F.lit("news")).unionByName(rejected.withColumn("target", F.lit("error_table")))


@query
def collect_slice(spark, folder):
    """Clean, drop what is known, check, and count per agency."""
    docs = fx.documents(spark, folder)
    text = tx.clean_text(F.col("news"), F.col("agency"))
    rows = fx.news(docs).drop("lang").withColumn("news", text)
    seen = ids.known_ids(*[fx.quarter(_news(spark, folder), number) for number in (1, 2, 3)])
    checked = jobs.staged_news(jobs.distinct_messages(rows), ids.words(seen))
    return checked.groupBy("agency").agg(
        F.count_if(F.size("errors") == 0).alias("news_amount"), F.count_if(F.size("errors") > 0).alias("rejects")
    )
