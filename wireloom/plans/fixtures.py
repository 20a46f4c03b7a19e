"""News-shaped views of the supplied tables, for the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom import fixed_values as fv
from wireloom.sources.tables import table

# Decorations of a text by doc_id % 12: what goes before it and what goes after it.
DECORATIONS = (
    (". ", " 😀😁"),
    ("", " https://t.me/src0/1"),
    ("", "  #Тег"),
    ("", " @mailbox"),
    ("🇺🇸", " vc.ru/a-1"),
    ("", " https://a-b.ru/c/d"),
    ("18+ ", "\u200b\u200b\u200d"),
    ("", ""),
    ("\ufe0f. ", " 🚀\ufe0f"),
    ("", " #Тег\r"),
    ("18+", "\u00a0https://a-b.ru/кд/e"),
    ("", " Techinsider (https://t.me/techinsiderru) Techinsider"),
)
LABELS = (*fv.CATEGORIES, *fv.NON_NEWS_LABELS)
RULED_SOURCE = "src1"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


# Named references as pages write them, by page_id % 6: with and without semicolon, with a rest that is no name, unknown.
NAMED = ("&eacute;", "&laquo", "&hellip;", "&notit;", "&bogus;", "&Ouml;&amp;lt;")


def referenced(rows: DataFrame) -> DataFrame:
    """Pages with a line in front that holds character references of every kind, bold with attributes, and links in all quotes."""
    n = F.col("page_id")
    number = F.concat(F.lit("&#"), n + 161, F.lit("; &#x"), F.hex(n + 1024), F.lit("; &#150;&#0; "))
    target = F.concat(F.lit("https://e.org/?p=1&amp;copy="), n, F.lit("&copy=2"))
    anchor = (
        F.when(n % 4 == 1, F.concat(F.lit("<a name=top><A class=k href='"), target, F.lit("'>")))
        .when(n % 4 == 2, F.concat(F.lit("<a rel=x HREF="), target, F.lit(">")))
        .when(n % 4 == 3, F.concat(F.lit('<a href = "'), target, F.lit('">')))
        .otherwise("")
    )
    line = F.concat(anchor, F.lit('<B class="k">'), number, F.lit("</B><i>"), pick(n, NAMED), F.lit("</i></a><p>"))
    return rows.withColumn("html", F.concat(line, "html"))


def minute_of(number: Column) -> Column:
    """A time with ties: one of 500 minutes."""
    start = F.lit("2023-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(mins=(number % 500).cast("int"))


def news(docs: DataFrame) -> DataFrame:
    """Documents as staged news, with doc_id and lang kept at the end."""
    url = F.concat(F.lit("https://t.me/"), F.col("source"), F.lit("/"), F.col("doc_id"))
    return docs.select(
        url.alias("url"),
        minute_of(F.col("doc_id")).alias("date"),
        F.col("text").alias("news"),
        url.alias("links"),
        F.col("source").alias("agency"),
        "doc_id",
        "lang",
    )


def quarter(rows: DataFrame, number: int) -> DataFrame:
    """One of four parts: 0 staged, 1 final, 2 rejected, 3 published."""
    return rows.filter(F.col("doc_id") % 4 == number)


def pick(number: Column, options: tuple[str, ...]) -> Column:
    """The option at a number, modulo their count."""
    return F.element_at(F.array(*[F.lit(option) for option in options]), (number % len(options)).cast("int") + 1)


def decorated(docs: DataFrame) -> DataFrame:
    """Documents whose text carries the things that cleaning removes."""
    before = pick(F.col("doc_id"), tuple(front for front, _ in DECORATIONS))
    after = pick(F.col("doc_id"), tuple(back for _, back in DECORATIONS))
    channel = F.when(F.col("doc_id") % 24 == 23, "techinsiderru").otherwise(F.col("source"))
    return docs.select("doc_id", F.concat(before, F.col("text"), after).alias("news"), channel.alias("agency"))


def agencies(spark: SparkSession, folder: str) -> DataFrame:
    """An agency dimension with each reason to drop a row."""
    sources = table(spark, folder, "documents").select("source").filter(F.col("source").isNotNull()).distinct()
    n = F.col("n")
    return sources.withColumn("n", F.substring("source", 4, 10).cast("int")).select(
        F.col("source").alias("telegram"),
        F.when(n % 4 == 0, "economy").when(n % 4 == 1, fv.NO_CATEGORY).when(n % 4 == 3, "sports").alias("mono_category"),
        F.when(n != 12, n % 3 != 0).alias("is_parsing"),
        F.when(n == 3, None).when(n == 9, "").when(n % 3 == 0, "en").when(n % 3 == 1, "").alias("language"),
        F.when(n != 15, n % 7).alias("priority"),
    )


def polled(spark: SparkSession, folder: str) -> DataFrame:
    """Agencies by the channels of their pages: those up to src4 are polled by both groups, others by one or none."""
    sources = table(spark, folder, "documents").select("source").filter(F.col("source").isNotNull()).distinct()
    n = F.substring("source", 4, 10).cast("int")
    home = F.when((n <= 4) | (n % 3 == 0), True)
    foreign = F.when((n <= 4) | (n % 3 == 1), False)
    return sources.select(_channel(F.col("source")).alias("telegram"), F.explode(F.array(home, foreign)).alias("is_parsing")).select(
        "telegram", F.lit(None).cast("string").alias("mono_category"), "is_parsing", F.lit("en").alias("language"), F.lit(1).alias("priority")
    )


def _channel(source: Column) -> Column:
    return F.when(source == RULED_SOURCE, fv.LAST_CLAUSE_AGENCY).otherwise(source)


def agency_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Agencies with one row per language, so that lookups have several rows to choose from."""
    rows = (
        table(spark, folder, "documents")
        .filter(F.col("source").isNotNull())
        .groupBy("source", "lang")
        .agg(F.max("doc_id").alias("place"))
    )
    category = (
        F.when(F.col("lang") == "en", "economy").when(F.col("lang") == "fr", "sports").when(F.col("lang") == "de", "None")
    )
    return rows.select(
        F.col("source").alias("telegram"),
        category.alias("mono_category"),
        (F.substring("source", 4, 10).cast("int") % 3 != 0).alias("is_parsing"),
        "place",
    )


def beginnings(spark: SparkSession, folder: str) -> DataFrame:
    """Many phrases per source: the first word, and the first two, of each of its texts."""
    words = F.array(*[F.substring_index("text", " ", n) for n in (1, 2)])
    return table(spark, folder, "documents").select(F.col("source").alias("channel"), F.explode(words).alias("phrase"))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases per source, some inside others: one for each language it publishes in."""
    phrase = F.when(F.col("lang") == "en", "tion").when(F.col("lang") == "fr", "ation").when(F.col("lang") == "de", "sch")
    return (
        table(spark, folder, "documents")
        .select(F.col("source").alias("channel"), phrase.alias("phrase"))
        .filter("channel is not null and phrase is not null")
        .distinct()
    )


def labelled(rows: DataFrame) -> DataFrame:
    """News with a label as a classifier prints it."""
    return rows.withColumn("label", F.concat(F.lit("__label__"), pick(F.col("doc_id"), LABELS)))


def corrupted(rows: DataFrame) -> DataFrame:
    """Final news with one fault by doc_id % 10; 5 and 9 have none."""
    fault = F.col("doc_id") % 10
    return rows.select(
        "doc_id",
        F.when(fault == 2, F.substring("url", 9, 1000))
        .when(fault == 3, F.concat(F.lit("https://localhost/"), F.col("doc_id")))
        .otherwise(F.col("url"))
        .alias("url"),
        "date",
        F.when(fault == 7, None).otherwise(F.col("agency")).alias("title"),
        F.lit("").alias("resume"),
        F.when(fault == 8, F.concat(F.lit("ftp"), F.substring("links", 6, 1000)))
        .otherwise(F.col("links"))
        .alias("links"),
        F.when(fault == 0, "").when(fault == 1, None).otherwise(F.col("news")).alias("news"),
        F.when(fault == 6, "other").otherwise(pick(F.col("doc_id"), fv.CATEGORIES)).alias("category"),
        F.when(fault == 4, None).when(fault == 5, "").otherwise(F.col("agency")).alias("agency"),
    )


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an archive of news; two rows share a URL."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key,
        F.concat(F.lit("https://t.me/archive/"), F.floor(key / 2)).alias("url"),
        F.col("o_orderdate").alias("date"),
        F.concat(
            F.lit("Order "), key, F.lit(". It's "), F.col("o_orderpriority"), F.lit("! Status "), F.col("o_orderstatus"),
            F.lit(". It's late. Closed."),
        ).alias("news"),
        F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_orderstatus") == "O", "").otherwise("x").alias("resume"),
    )


def _escape(text: Column) -> Column:
    for character, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(character), F.lit(reference))
    return text


# Message bodies of channel pages by doc_id % 10; {word} is the first word of the text.
# None: a message without text.
BODIES = (
    "<b>{word}</b> {text}",
    "<b>Alpha Beta</b><i>x</i><b>gamma.</b> {text}",
    '{text} <a href="https://site.example.com/a/b?utm_source=x">more</a> <a href="https://b.example.com/c/d">b</a>',
    '<a href="https://www.youtube.com/watch?v=abc&amp;t=1">video</a> {text}',
    '{text} <a href="https://t.me/somechannel">channel</a>',
    '{text} <a href="tg://resolve?domain=x">open</a>',
    None,
    '<b>{word}</b><br/>{text} <a href="https://example.com" target="_blank">site</a>',
    '{text}<br/><a href="https://example.com/p?a=1">source</a>',
    '<i class="emoji"><b>😀</b></i>{text}: last. #tag',
)


def channel_pages(docs: DataFrame) -> DataFrame:
    """Channel pages (channel, html) made of documents: at most 100 messages each."""
    doc_id, channel = F.col("doc_id"), F.col("channel")
    named = docs.withColumn("channel", _channel(F.col("source")))
    text = _escape(F.col("text"))
    word = _escape(F.substring_index("text", " ", 1))

    def fill(template: str) -> Column:
        filled = F.lit(template)
        for mark, value in (("{word}", word), ("{text}", text)):
            filled = F.replace(filled, F.lit(mark), value)
        return filled

    body = F.lit(None).cast("string")
    for number, template in enumerate(BODIES):
        if template is not None:
            body = F.when(doc_id % len(BODIES) == number, fill(template)).otherwise(body)
    own_url = F.concat(
        F.lit("https://t.me/"), channel, F.lit("/"), doc_id, F.when(doc_id % 50 == 33, "?single").otherwise("")
    )
    time = F.when(doc_id % 50 == 44, "soon").otherwise(
        F.concat(F.date_format(minute_of(doc_id), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    )
    message = F.concat(
        F.lit('<div class="tgme_widget_message_wrap"><div class="tgme_widget_message_bubble">'),
        F.lit('<a class="tgme_widget_message_owner_name" href="https://t.me/x">x</a>'),
        F.coalesce(
            F.concat(F.lit(f'<div class="{fv.TEXT_CLASS}" dir="auto">'), body, F.lit("</div>")),
            F.lit('<a class="tgme_widget_message_photo_wrap" href="https://t.me/x/1"></a>'),
        ),
        F.lit('<div class="tgme_widget_message_footer"><a class="tgme_widget_message_date" href="'),
        own_url,
        F.lit('"><time datetime="'),
        time,
        F.lit('" class="time">10:00</time></a></div></div></div>'),
    )
    return (
        named.filter("source is not null and text is not null")
        .groupBy("channel", F.floor(doc_id / 100).alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", message.alias("message")))).alias("messages"))
        .select(
            "channel",
            F.concat(
                F.lit("<!DOCTYPE html><html><head><title>t</title><script>var b='<b>x</b>';</script></head><body>"),
                F.lit('<header><a href="/x">x</a></header><main class="tgme_main"><div></div><section class="history">'),
                F.array_join("messages.message", ""),
                F.lit('</section></main><footer class="time">f</footer></body></html>'),
            ).alias("html"),
        )
    )
