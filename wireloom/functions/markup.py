"""Markup expressions for pages of a simple, regular layout, without a parser."""

from __future__ import annotations

from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# A tag of an anchor with its attributes, whose values may hold any character; and one attribute with its value.
_ANCHOR = r"""(?i)<a[\s/]((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_ATTRIBUTE = r"""(?<![^\s"'/])[^\s"'=<>/]++\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_BOLD = r"(?is)<b(?:\s[^>]*)?>(.*?)(?:</b\s*>|</?(?:p|div|br|li|h1|article)[ />]|\z)"

_NAME = r"^[^\t\n\f <&#;]{1,32};?"
_ATTRIBUTE_NAME = "^[a-zA-Z][a-zA-Z0-9]*[;=]?"
_DECIMAL, _HEXADECIMAL = "^#([0-9]+);?", "^#[xX]([0-9a-fA-F]+);?"
_UNKNOWN = "\ufffd"
_LAST = 0x10FFFF


# Before a name in a table of names, and between the name and its text; neither is part of a name.
_BEFORE, _BETWEEN = "\x01", "\x02"


@lru_cache(maxsize=2)
def _tables(short: bool) -> list[str]:
    """The named references of HTML as one text for each first letter from A to z; ``short``: those that need no semicolon."""
    found = {chr(point): [""] for point in range(ord("A"), ord("z") + 1)}
    for name, text in html5.items():
        if not (short and name.endswith(";")):
            found[name[0]].append(f"{name}{_BETWEEN}{text}")
    return [_BEFORE.join([*own, ""]) for own in found.values()]


def _named(name: Column, short: bool = False) -> Column:
    """The text of a named reference, NULL for other names."""
    table = F.try_element_at(F.array(*map(F.lit, _tables(short))), F.ascii(name) - ord("A") + 1)
    after = F.split_part(table, F.concat(F.lit(_BEFORE), name, F.lit(_BETWEEN)), F.lit(2))
    return F.when(name.rlike("^[A-Za-z][A-Za-z0-9]*;?$"), F.nullif(F.substring_index(after, _BEFORE, 1), F.lit("")))


def _windows() -> Column:
    """Texts of the code points 128 to 159: what they mean in code page 1252, where it has them."""
    texts = [bytes([point]).decode("cp1252", "ignore") or chr(point) for point in range(128, 160)]
    return F.array(*map(F.lit, texts))


def _character(point: Column) -> Column:
    """The text of a numeric reference; NULL stands for too large a number."""
    text = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    no_character = point.between(1, 8) | (point == 11) | point.between(14, 31) | (point == 127) | point.between(0xFDD0, 0xFDEF) | (point.bitwiseAND(0xFFFE) == 0xFFFE)
    return (
        F.when(point.isNull() | (point == 0) | point.between(0xD800, 0xDFFF) | (point > _LAST), _UNKNOWN)
        .when(point.between(128, 159), F.try_element_at(_windows(), point - 127))
        .when(no_character, "")
        .otherwise(text)
    )


def _numeric(part: Column, pattern: str, base: int) -> Column:
    digits = F.ltrim(F.regexp_extract(part, pattern, 1), F.lit("0"))
    point = F.when(F.length(digits) <= 7, F.conv(F.concat(F.lit("0"), digits), base, 10).cast("int"))
    return F.concat(_character(point), F.regexp_replace(part, pattern, ""))


def _by_name(part: Column) -> Column:
    """A part after ``&``: its longest name that is known, or as it stands."""
    name = F.regexp_extract(part, _NAME, 0)
    longest = max(len(known) for known in html5 if not known.endswith(";"))
    shorter = [
        F.when(F.length(name) > size, F.concat(_named(F.substring(part, 1, size), short=True), part.substr(F.lit(size + 1), F.length(part))))
        for size in range(longest, 1, -1)
    ]
    whole = F.concat(_named(name), part.substr(F.length(name) + 1, F.length(part)))
    return F.coalesce(whole, *shorter, F.concat(F.lit("&"), part))


def _by_attribute_name(part: Column) -> Column:
    """The same in an attribute: only a whole name, and none before an equals sign."""
    name = F.regexp_extract(part, _ATTRIBUTE_NAME, 0)
    return F.coalesce(F.concat(_named(name), part.substr(F.length(name) + 1, F.length(part))), F.concat(F.lit("&"), part))


def unescape(text: Column, attribute: bool = False) -> Column:
    """Resolve all character references, each once, as HTML says: with or without semicolon, and with its rules for bad code points.

    Text without an ampersand costs one search.
    """

    def resolved(part: Column) -> Column:
        named = _by_attribute_name(part) if attribute else _by_name(part)
        return (
            F.when(part.rlike("^#[0-9]"), _numeric(part, _DECIMAL, 10))
            .when(part.rlike("^#[xX][0-9a-fA-F]"), _numeric(part, _HEXADECIMAL, 16))
            .otherwise(named)
        )

    parts = F.split(text, "&")
    whole = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), resolved), ""))
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def strip_tags(html: Column) -> Column:
    """Drop tags; the text around them is joined without a separator."""
    return F.regexp_replace(html, "<[^>]*>", "")


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles and comments."""
    for hidden in ("(?s)<script[^>]*>.*?</script>", "(?s)<style[^>]*>.*?</style>", "(?s)<!--.*?-->"):
        html = F.regexp_replace(html, hidden, "")
    return unescape(strip_tags(html))


def blocks(html: Column, opening: str, *closings: str) -> Column:
    """Array of the parts between an opening mark and the next of the closing marks."""

    def up_to_closing(part: Column) -> Column:
        for closing in closings:
            part = F.substring_index(part, closing, 1)
        return part

    parts = F.split(html, "\\Q" + opening + "\\E")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), up_to_closing)


def first_link(html: Column) -> Column:
    """Target of the first anchor that has one, NULL without; in double, single or no quotes."""

    def target(tag: Column) -> Column:
        named = F.filter(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(0)), lambda x: x.rlike(r"(?i)^href\s*="))
        return F.regexp_extract(F.get(named, 0), r"""^[^=]*=\s*(["']?)(.*)\1$""", 2)

    anchors = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1))
    targets = F.filter(F.transform(anchors, target), lambda x: x.isNotNull())
    return F.nullif(unescape(F.get(targets, 0), attribute=True), F.lit(""))


def bold_fragments(html: Column) -> Column:
    """Text of each ``<b>``, with or without attributes, inner tags dropped; an unclosed one ends with its block."""
    found = F.regexp_extract_all(html, F.lit(_BOLD), F.lit(1))
    return F.transform(found, lambda part: unescape(strip_tags(part)))
