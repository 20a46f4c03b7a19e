"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags.  The first pass decides blocks by stop-word density, length and link
density: link-heavy blocks are boilerplate, long blocks with enough stop words are text, short ones and those between
are ambiguous.  The second pass gives ambiguous blocks the label of the nearest decided neighbours.

Where a block stands is part of both passes.  Inside elements that never hold main text (menus, footers, sidebars, forms,
and elements whose class or id says so) a block is boilerplate.  Inside an article no block is boilerplate for want of
stop words, and neighbours are sought inside the article only; if none is decided there, the article decides.

Stop words are known for four languages.  A page whose ``lang`` names another one, or without ``lang`` whose letters are
foreign to them, is of unknown language: its blocks are decided by length and links alone.  A form, or an element whose name
speaks of layout only, is taken for a mere wrapper if the page has no main text otherwise and most of its text lies inside.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one space.

Nulls: a null page has an empty text.  Repeated rows stay.  Pages of any length are read whole, in linear time.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
#: Elements whose content is never shown as text.
HIDDEN = frozenset("head title script style noscript template textarea select option datalist button svg math iframe object canvas audio video".split())
#: Hidden elements that hold raw text up to their own end tag.
RAW = frozenset("script style textarea title noscript iframe".split())
#: Elements that never hold main text.
BOILERPLATE = frozenset("nav footer header aside form menu dialog".split())
ARTICLE = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening block-level tag closes.
IMPLIED = frozenset("p".split())
#: Elements with optional end tags: what an opening tag closes, and the elements beyond which it closes nothing.
_CELLS, _ROWS, _TERMS = frozenset("td th".split()), frozenset("tr td th".split()), frozenset("dd dt".split())
_STOPS = BLOCK - frozenset("address div p br hr h1 h2 h3 h4 h5 h6 pre legend html body li dd dt".split())
_GROUPS, _TABLE = frozenset("thead tbody tfoot tr td th".split()), frozenset(["table"])
OWN_KIND = {
    "li": (frozenset(["li"]), _STOPS | _TERMS),
    "option": (frozenset(["option"]), frozenset("select".split())),
    "dd": (_TERMS, _STOPS | {"li"}),
    "dt": (_TERMS, _STOPS | {"li"}),
    "td": (_CELLS, frozenset("tr table".split())),
    "th": (_CELLS, frozenset("tr table".split())),
    "tr": (_ROWS, frozenset("thead tbody tfoot table".split())),
    "thead": (_GROUPS, _TABLE),
    "tbody": (_GROUPS, _TABLE),
    "tfoot": (_GROUPS, _TABLE),
}
#: Words of class and id that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer header masthead menu nav navbar "
    "navigation newsletter notice notices pagination popup promo related reply replies share sharing sidebar social sponsor sponsored subscribe".split()
)
STOP_WORDS = frozenset(
    "the of and to a in is it that for on as with was by be are this at from or an not but have he they his her which you we "
    "der die und das den dem ein eine einen ist im von zu mit auf für nicht als auch sich des "
    "le la les de et un une des du est en que qui dans pour par sur pas au aux "
    "el los las y que se por con para del una su al lo es no como".split()
)

#: Last words of a name that begins with a mark: ``share-buttons`` is marked, ``share-price`` is not.
PARTS = frozenset(
    "area articles bar block box buttons consent container content form holder icons inner items left link links list main menu message modal nav news notice outer overlay "
    "panel popup posts right row section slot stories thread top unit widget wrap wrapper".split()
)
#: Marks of layout: they may wrap a whole page.
LAYOUT = frozenset("header masthead newsletter notice notices popup promo related share sharing sidebar social subscribe".split())
LANGUAGES = frozenset("en de fr es".split())
#: Letters beyond ASCII of these languages.
LETTERS = frozenset("äöüßàâæçéèêëîïôœùûÿñáíóú")
FOREIGN = 0.02  # share of other letters from which a text is in none of these languages

LINKS_HIGH = 0.4  # link density from which a block is boilerplate
SHORT = 70  # characters under which a block is ambiguous
LONG = 200  # characters from which a block with many stop words is text
STOPS_LOW, STOPS_HIGH = 0.12, 0.25

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+|[^>]*)(?:>|\Z)""", re.S)
MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
LANG = re.compile(r"""\blang\s*=\s*["']?\s*([a-zA-Z]+)""", re.I)
HREF = re.compile(r"(?<![\w-])href\s*=", re.I)
WORD = re.compile(r"[^\W_]+")


def mark_of(attributes: str) -> str:
    """The mark that a class or id of an element bears: as its whole name, or as the first word of a name of such a part."""
    for found in MARKED.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").lower().split():
            first, *rest = re.split("[_-]+", name.strip("_-"))
            if first in MARKS and (not rest or rest[-1] in PARTS or rest[-1] in MARKS or rest[-1][:1].isdigit()):
                return first
    return ""


@dataclass
class Block:
    text: str
    links: float  # share of characters inside links
    section: int  # blocks of one section are neighbours
    kind: str  # article, boilerplate or open
    label: str = ""
    wrappers: tuple[int, ...] = ()  # elements around it that are boilerplate by layout only


@dataclass
class _Wrapper:
    """An element that is boilerplate by layout only, and what it would be as a mere wrapper."""

    kind: str
    section: int
    size: int = 0


@dataclass
class _Open:
    tag: str
    kind: str
    section: int
    hidden: bool
    wrappers: tuple[int, ...] = ()


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=lambda: [_Open("", "open", 0, False)])
    places: dict[str, list[int]] = field(default_factory=dict)  # where in the stack the elements of a tag stand
    sections: int = 0
    wrappers: list[_Wrapper] = field(default_factory=list)
    link: int = 0  # height of the stack where the open link began, 0 if none is open
    named: bool = False  # whether the open link has had text
    language: str = ""

    def text(self, raw: str) -> None:
        if raw and not self.stack[-1].hidden:
            self.parts.append((raw, self.link > 0))
            self.named = self.named or self.link > 0 and not raw.isspace()

    def cut(self) -> None:
        """End a block."""
        if not self.parts:
            return
        whole = " ".join(html.unescape("".join(raw for raw, _ in self.parts)).split())
        if whole:
            linked = sum(len(" ".join(html.unescape(raw).split())) for raw, link in self.parts if link)
            top = self.stack[-1]
            self.blocks.append(Block(whole, min(1.0, linked / len(whole)), top.section, top.kind, wrappers=top.wrappers))
            for wrapper in top.wrappers:
                self.wrappers[wrapper].size += len(whole)
        self.parts = []

    def leave(self, at: int) -> None:
        """Take the elements from this place on off the stack; each leaves it once."""
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()
        if len(self.stack) < self.link:  # a link ends with the element that it began in
            self.link = 0

    def last(self, tags: frozenset[str]) -> int:
        """The last place in the stack of an element with one of these tags, or -1."""
        return max((found[-1] for tag in tags if (found := self.places.get(tag))), default=-1)

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.cut()
            if self.named:  # a link may hold blocks, but one with text ends with the next block
                self.link = 0
            if self.stack[-1].tag in IMPLIED:
                self.leave(len(self.stack) - 1)
        if tag == "html" and (found := LANG.search(attributes)):
            self.language = found[1].lower()
        if tag in OWN_KIND:
            closed, bounds = OWN_KIND[tag]
            bound = self.last(bounds)
            while (at := self.last(closed)) > bound:
                self.leave(at)
        if tag in VOID:
            return
        if tag == "a":  # ends the one before; without a target it is no link
            self.link, self.named = len(self.stack) if HREF.search(attributes) else 0, False
            return
        if tag not in BLOCK and tag not in HIDDEN:
            return
        top = self.stack[-1]
        kind, section = top.kind, top.section
        mark = mark_of(attributes) if attributes and tag not in ("html", "body") else ""
        now = "boilerplate" if tag in BOILERPLATE or mark else "article" if tag in ARTICLE else ""
        wrappers = top.wrappers if kind == "boilerplate" and top.wrappers else ()
        if now and now != kind:
            self.sections += 1
            wrappers = ()
            if now == "boilerplate" and (tag == "form" or tag not in BOILERPLATE and mark in LAYOUT):
                self.wrappers.append(_Wrapper(kind, section))
                wrappers = (len(self.wrappers) - 1,)
            kind, section = now, self.sections
        elif now == "boilerplate" and not (tag == "form" or tag not in BOILERPLATE and mark in LAYOUT):
            wrappers = ()  # what is boilerplate by itself stays so
            self.sections += 1
            section = self.sections
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Open(tag, kind, section, top.hidden or tag in HIDDEN, wrappers))

    def close(self, tag: str) -> None:
        if tag in BLOCK:
            self.cut()
        if tag == "a":
            self.link = 0
            return
        if tag not in BLOCK and tag not in HIDDEN:
            return
        if found := self.places.get(tag):
            self.leave(found[-1])


def read(page: str) -> _Reader:
    """The blocks of a page in its order, with its language and wrappers."""
    reader, at = _Reader(), 0
    lower = None
    while True:
        found = TOKEN.search(page, at)
        if not found:
            reader.text(page[at:])
            break
        reader.text(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            reader.close(tag)
            continue
        reader.open(tag, found[3])
        if tag in RAW:
            lower = lower or page.lower() if len(page.lower()) == len(page) else page
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
    reader.cut()
    return reader


def known_language(language: str, blocks: Sequence[Block]) -> bool:
    """Whether stop words say something about a page: by its ``lang``, or else by its letters."""
    if language:
        return language in LANGUAGES
    letters = other = 0
    for block in blocks:
        for c in block.text if not block.text.isascii() else "":
            letters += c.isalpha()
            other += c.isalpha() and not c.isascii() and c.lower() not in LETTERS
        letters += len(block.text) if block.text.isascii() else 0
    return other < FOREIGN * letters or not other


def first_pass(block: Block, stop_words: frozenset[str] | None = STOP_WORDS) -> str:
    """text, boilerplate, or what the second pass decides: near (rather text) and short."""
    inside = block.kind == "article"
    if block.kind == "boilerplate":
        return "boilerplate"
    if block.links >= LINKS_HIGH and not (inside and len(block.text) >= LONG):
        return "near" if inside else "boilerplate"
    if len(block.text) < SHORT:
        return "short"
    if stop_words is None:
        return "text" if len(block.text) >= LONG or inside else "near"
    words = WORD.findall(block.text.lower())
    stops = sum(w in stop_words for w in words) / len(words) if words else 0.0
    if stops >= STOPS_HIGH:
        return "text" if len(block.text) >= LONG or inside else "near"
    if stops >= STOPS_LOW:
        return "text" if inside else "near"
    return "near" if inside else "boilerplate"


def second_pass(blocks: Sequence[Block]) -> None:
    """Ambiguous blocks take the label of the nearest decided neighbours of their section."""
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        decided: dict[int, str] = {}
        for i in order:
            block = blocks[i]
            if block.label in ("text", "boilerplate"):
                decided[block.section] = block.label
            else:
                block.label += " " + decided.get(block.section, "none")
    for block in blocks:
        kind, *sides = block.label.split()
        if sides:
            sides = {side for side in sides if side != "none"}
            if len(sides) == 1:
                block.label = sides.pop()
            elif sides:  # text on one side only
                block.label = "text" if kind == "near" or block.kind == "article" else "boilerplate"
            else:
                block.label = "text" if block.kind == "article" else "boilerplate"


def main_text(page: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    found = read(page or "")
    words = stop_words if known_language(found.language, found.blocks) else None
    text = _labelled(found.blocks, words)
    whole = sum(len(block.text) for block in found.blocks)
    wide = {i for i, wrapper in enumerate(found.wrappers) if 2 * wrapper.size > whole}
    if text or not wide:
        return text
    for block in found.blocks:
        if wide.intersection(block.wrappers):
            wrapper = found.wrappers[block.wrappers[0]]
            block.kind, block.section = wrapper.kind, wrapper.section
    return _labelled(found.blocks, words)


def _labelled(blocks: Sequence[Block], stop_words: frozenset[str] | None) -> str:
    """The blocks that both passes take for text, joined."""
    for block in blocks:
        block.label = first_pass(block, stop_words)
    second_pass(blocks)
    return " ".join(block.text for block in blocks if block.label == "text")


def extract_text(pages: DataFrame, columns: Sequence[str] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """These columns with the main text of each page and its length in code points."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("_html")]
            own = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *own], [*columns, "text", "n_chars"])

    kept = pages.select(*columns, F.col(html_col).alias("_html"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return kept.mapInArrow(run, schema)
