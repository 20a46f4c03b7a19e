"""Channel pages to message records.

Only the reading of markup runs in Python, one Arrow batch of pages at a time;
links, dates, headlines and cleaning are built-in expressions on its output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireloom import fixed_values as fv
from wireloom.functions import dates, links, markup
from wireloom.functions import text as tx
from wireloom.operators.compute import with_value

BUBBLE_SCHEMA = (
    "channel string, block_no int, own_url string, published string, body string, href string, bold array<string>"
)
_ARROW_SCHEMA = pa.schema(
    [
        ("channel", pa.string()),
        ("block_no", pa.int32()),
        ("own_url", pa.string()),
        ("published", pa.string()),
        ("body", pa.string()),
        ("href", pa.string()),
        ("bold", pa.list_(pa.string())),
    ]
)
_PAGES_PER_OUTPUT_BATCH = 256

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))
_REGION = ("body", "main", "section")


class _Bubble:
    """What is read of one message block."""

    def __init__(self) -> None:
        self.own_url = self.published = self.href = None
        self.date_link_seen = self.time_seen = self.anchor_seen = False
        self.body: list[str] | None = None
        self.body_open = False
        self.bold: list[list[str]] = []


class _PageReader(HTMLParser):
    """Message blocks of the first ``body > main > section`` of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.bubbles: list[_Bubble] = []
        self._region = 0  # how many of _REGION have been entered
        self._open: list[tuple[str, list[Callable[[], None]]]] = []
        self._active: list[_Bubble] = []
        self._bold: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        on_close: list[Callable[[], None]] = []
        if self._region < len(_REGION) and tag == _REGION[self._region]:
            self._region += 1
            on_close.append(self._leave_region)
        elif self._region == len(_REGION):
            self._enter(tag, {name: value or "" for name, value in attrs}, on_close)
        if tag not in _VOID:
            self._open.append((tag, on_close))
        else:
            for close in on_close:
                close()

    def handle_endtag(self, tag):
        if any(name == tag for name, _ in self._open):
            while self._close_last() != tag:
                pass

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close_last()

    def handle_data(self, data):
        if self._open and self._open[-1][0] in _HIDDEN:
            return
        for bubble in self._active:
            if bubble.body_open:
                bubble.body.append(data)
        for fragment in self._bold:
            fragment.append(data)

    def _close_last(self) -> str:
        tag, on_close = self._open.pop()
        for close in on_close:
            close()
        return tag

    def _leave_region(self) -> None:
        self._region = len(_REGION) + 1  # only the first of each counts

    def _enter(self, tag, attrs, on_close) -> None:
        classes = attrs.get("class", "").split()
        for bubble in self._active:
            if bubble.body_open:
                self._enter_body(bubble, tag, attrs, on_close)
            if bubble.body is None and " ".join(classes) == fv.TEXT_CLASS:
                bubble.body, bubble.body_open = [], True
                on_close.append(lambda b=bubble: setattr(b, "body_open", False))
            if not bubble.date_link_seen and fv.DATE_LINK_CLASS in classes:
                bubble.date_link_seen, bubble.own_url = True, attrs.get("href")
            if not bubble.time_seen and fv.TIME_CLASS in classes:
                bubble.time_seen, bubble.published = True, attrs.get("datetime")
        if fv.BUBBLE_CLASS in classes:
            bubble = _Bubble()
            self.bubbles.append(bubble)
            self._active.append(bubble)
            on_close.append(lambda b=bubble: self._active.remove(b))

    def _enter_body(self, bubble, tag, attrs, on_close) -> None:
        if tag == "a" and not bubble.anchor_seen:
            bubble.anchor_seen, bubble.href = True, attrs.get("href")
        if tag == "b":
            fragment: list[str] = []
            bubble.bold.append(fragment)
            self._bold.append(fragment)
            on_close.append(lambda f=fragment: self._drop_bold(f))

    def _drop_bold(self, fragment) -> None:
        self._bold = [other for other in self._bold if other is not fragment]


def _page_rows(channel: str | None, html: str) -> Iterator[tuple]:
    """Rows of a page; one without id stands for the rest of a page that cannot be read."""
    reader = _PageReader()
    broken = False
    try:
        reader.feed(html)
        reader.close()
    except (AssertionError, ValueError):
        broken = True
    for number, bubble in enumerate(reader.bubbles):
        body = None if bubble.body is None else "".join(bubble.body)
        bold = ["".join(fragment) for fragment in bubble.bold]
        yield channel, number, bubble.own_url, bubble.published, body, bubble.href, bold
    if broken:
        yield channel, len(reader.bubbles), None, None, "", None, []


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _PAGES_PER_OUTPUT_BATCH):
            part = batch.slice(start, _PAGES_PER_OUTPUT_BATCH)
            rows = [
                row
                for channel, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                for row in _page_rows(channel, html)
            ]
            if rows:
                columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _ARROW_SCHEMA)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW_SCHEMA)


def usable_pages(pages: DataFrame) -> DataFrame:
    """Pages with content that hold at least one message block."""
    return pages.select("channel", "html").filter(
        F.col("html").isNotNull() & (F.col("html") != "") & F.contains("html", F.lit(fv.BUBBLE_CLASS))
    )


def read_bubbles(pages: DataFrame) -> DataFrame:
    """Message blocks of pages (channel, html), one row each, by a tolerant parser.

    Pages without a block never reach Python.
    """
    return usable_pages(pages).mapInArrow(_read_batches, BUBBLE_SCHEMA)


def read_regular_bubbles(pages: DataFrame) -> DataFrame:
    """The same rows for pages of the regular layout, without leaving the JVM.

    Regular means: attributes in double quotes, ``href`` and ``datetime`` in the
    tag that carries the class, no ``div`` inside the message text, no nested
    bold and only the common character references.
    """
    block = F.col("block")
    opening, closing = f'<div class="{fv.TEXT_CLASS}"', "</div>"
    body_html = F.regexp_extract(block, f"(?s){opening}[^>]*>(.*?){closing}", 1)
    bold = F.regexp_extract_all(F.col("body_html"), F.lit("(?s)<b>(.*?)</b>"), F.lit(1))
    link = F.regexp_extract(F.col("body_html"), '<a [^>]*?href="([^"]*)"', 1)
    own_url = F.regexp_extract(block, f'<a class="{fv.DATE_LINK_CLASS}"[^>]*? href="([^"]*)"', 1)
    published = F.regexp_extract(block, '<time[^>]*?datetime="([^"]*)"', 1)

    def text_of(html):
        return markup.unescape(markup.strip_tags(html))

    found = usable_pages(pages).select(
        "channel",
        F.posexplode(markup.blocks(F.col("html"), f'<div class="{fv.BUBBLE_CLASS}', "</section>")).alias("block_no", "block"),
    )
    found = with_value(found, "body_html", F.when(F.contains(block, F.lit(opening)), body_html))
    return with_value(found, "body", text_of(F.col("body_html"))).select(
        "channel",
        "block_no",
        F.nullif(markup.unescape(own_url), F.lit("")).alias("own_url"),
        F.nullif(published, F.lit("")).alias("published"),
        "body",
        F.nullif(markup.unescape(link), F.lit("")).alias("href"),
        F.coalesce(F.transform(bold, text_of), F.array().cast("array<string>")).alias("bold"),
    )


def to_messages(bubbles: DataFrame) -> DataFrame:
    """Message records (url, date, news, links, agency, id) of message blocks with a text.

    A block without a numeric id or a readable time keeps its row and gets the
    reason in ``parse_error``; the blocks after it are not affected.
    """
    own_url, agency = F.col("own_url"), F.col("agency")
    link = links.normalize_link(links.choose_link(F.col("href"), own_url), own_url)
    split = tx.split_headline(tx.last_clause(F.col("body"), agency), tx.join_fragments(F.col("bold")))
    with_text = bubbles.filter(F.col("body").isNotNull()).withColumnRenamed("channel", "agency")
    return (
        with_value(with_text, "news", tx.clean_text(split, agency))
        .select(
            own_url.alias("url"),
            dates.newsroom_time(F.col("published")).alias("date"),
            "news",
            link.alias("links"),
            "agency",
            links.message_id(own_url).alias("id"),
        )
        .withColumn(
            "parse_error",
            F.when(F.col("id").isNull(), "id").when(F.col("date").isNull(), "date"),
        )
    )


def parse_messages(pages: DataFrame, reader: Callable[[DataFrame], DataFrame] = read_bubbles) -> DataFrame:
    """Channel pages (channel, html) to message records, by either block reader."""
    return to_messages(reader(pages))


def well_formed(messages: DataFrame) -> DataFrame:
    """Records without a parse error, in the staged columns plus id."""
    return messages.filter(F.col("parse_error").isNull()).drop("parse_error")


def malformed(messages: DataFrame) -> DataFrame:
    """Records with a parse error, with the reason."""
    return messages.filter(F.col("parse_error").isNotNull())
