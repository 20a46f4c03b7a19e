"""Text cleaning as Column expressions.

Every function maps a string Column to a string Column with built-in functions
only, so a whole cleaning chain runs in one pass over the scan.  Patterns that
end in ``$`` carry ``(?d)``: only ``\\n`` counts as a line end, as in the rules
these reproduce.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wireloom import fixed_values as fv

# One match for a trailing http(s) link.  It accepts the same strings as
# ``fixed_values.TRAILING_URL`` but tries each start only once: either the rest
# is all link characters with a slash after its first one, or it has exactly one
# foreign character, followed by a digit-free stretch up to the next slash.
_LINK_CHARS = "[-/_.a-zA-Z0-9]"
_LINEAR_TRAILING_URL = (
    "(?d)https?://(?:"
    f"{_LINK_CHARS}[-_.a-zA-Z0-9]*+/{_LINK_CHARS}*+"
    f"|{_LINK_CHARS}*+[^-/_.a-zA-Z0-9\\n][-_.a-zA-Z]*+/{_LINK_CHARS}*+"
    ")$"
)

_FLAGS_AND_SMILEYS = r"[\x{1F1E6}-\x{1F1FF}]{2}|[\x{1F600}-\x{1F64F}]+"
# UTF-8 lead of every flag letter and smiley.
_PLANE_ONE_LEAD = bytearray(b"\xf0\x9f")

# White space in Java's own terms, which is looked up in one step per character;
# the second class leaves out the plain space.
_SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
_OTHER_SPACE = rf"[[\x09-\x1f\x{{85}}-\x{{3000}}]&&[{_SPACE}]]"

# The span check in front keeps letters outside the emoji planes cheap.
_EMOJI = (
    r"[[\x{A9}\x{AE}\x{203C}-\x{3299}\x{1F004}-\x{1FAF8}]&&[" + fv.emoji_class() + "]]"
)

_UPPER = r"[\p{IsUppercase}\p{Lt}]"
_LOWER = r"\p{IsLowercase}"
_UNCASED = r"[^\p{IsUppercase}\p{Lt}\p{IsLowercase}]"
_TITLE_CASE = (
    rf"^{_UNCASED}*+{_UPPER}{_LOWER}*+(?:{_UNCASED}++{_UPPER}{_LOWER}*+)*+{_UNCASED}*+\z"
)


def bind(text: Column, *steps: Callable[[Column], Column]) -> Column:
    """Apply steps in turn, each to a value that is computed once.

    A step may use its argument several times; written as plain nested
    expressions, the chain would be repeated for each use.
    """
    held = F.array(text)
    for step in steps:
        held = F.transform(held, step)
    return F.get(held, 0)


def _only_with(mark: str, step: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Run a step only on texts that hold a mark which everything it removes contains."""

    def gated(text: Column) -> Column:
        return F.when(F.contains(text, F.lit(mark)), step(text)).otherwise(text)

    return gated


def strip_whitespace(text: Column) -> Column:
    """Trim every Unicode white-space character at both ends."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def collapse_spaces(text: Column) -> Column:
    """Runs of U+0020 become one space; then both ends are trimmed."""
    return strip_whitespace(bind(text, _only_with("  ", lambda t: F.regexp_replace(t, "  +", " "))))


def has_whitespace(text: Column) -> Column:
    """True where any Unicode white-space character occurs."""
    return text.rlike(f"[{_SPACE}]")


def last_clause(text: Column, agency: Column, ruled_agency: str = fv.LAST_CLAUSE_AGENCY) -> Column:
    """For one agency, keep what follows the last ``': '`` and precedes the first ``'#'``."""
    clause = F.substring_index(F.substring_index(text, ": ", -1), "#", 1)
    return F.when(agency == ruled_agency, clause).otherwise(text)


def is_title_case(word: Column) -> Column:
    """True where upper case starts every cased run and at least one letter is cased."""
    return word.rlike(_TITLE_CASE)


def join_fragments(fragments: Column) -> Column:
    """The bold fragments of a message as one headline."""
    return F.array_join(fragments, " ")


def split_headline(text: Column, headline: Column) -> Column:
    """Put ``'. '`` after a headline whose first word is in title case."""
    first_word = F.regexp_extract(headline, f"[^{_SPACE}]+", 0)
    closed = F.concat(F.rtrim(headline, F.lit(".")), F.lit(". "))
    return F.when(is_title_case(first_word), F.replace(text, headline, closed)).otherwise(text)


def _phrase_order(phrases: Sequence[str]) -> list[str]:
    return sorted(set(phrases), key=lambda phrase: (-len(phrase), phrase))


def strip_boilerplate(
    text: Column,
    channel: Column,
    phrases: Mapping[str, Sequence[str]] = fv.BOILERPLATE,
) -> Column:
    """Replace the boilerplate phrases of a channel, and the common ones, by a space.

    Phrases go longest first, then in code-point order.  The n-th phrase of each
    channel is picked by one CASE, so the chain is as long as the longest phrase
    list and not as long as all of them together; an empty search text changes
    nothing.
    """
    common = _phrase_order(phrases.get(fv.COMMON_LABELS_KEY, ()))
    per_channel = {
        name: _phrase_order([*own, *common])
        for name, own in phrases.items()
        if name != fv.COMMON_LABELS_KEY
    }
    rounds = max([len(common), *map(len, per_channel.values())])
    for turn in range(rounds):
        default = common[turn] if turn < len(common) else ""
        phrase = F.lit(default)
        picks = {
            name: own[turn]
            for name, own in per_channel.items()
            if turn < len(own) and own[turn] != default
        }
        if picks:
            choice = None
            for name, own in picks.items():
                branch = (channel == name, F.lit(own))
                choice = F.when(*branch) if choice is None else choice.when(*branch)
            phrase = choice.otherwise(phrase)
        text = F.replace(text, phrase, F.lit(" "))
    return text


def strip_listed_phrases(text: Column, phrases: Column) -> Column:
    """Replace every phrase of an array column, in array order, by a space."""
    return F.aggregate(phrases, text, lambda acc, phrase: F.replace(acc, phrase, F.lit(" ")))


def order_phrases(phrases: Column) -> Column:
    """Distinct phrases, longest first, then in code-point order."""
    keyed = F.transform(
        F.array_distinct(phrases),
        lambda phrase: F.struct((-F.char_length(phrase)).alias("shortness"), phrase.alias("phrase")),
    )
    return F.transform(F.array_sort(keyed), lambda entry: entry["phrase"])


def strip_flags_and_smileys(text: Column) -> Column:
    """Drop flag pairs and runs of emoticons."""

    def strip(held: Column) -> Column:
        present = F.contains(held.cast("binary"), F.lit(_PLANE_ONE_LEAD))
        return F.when(present, F.regexp_replace(held, _FLAGS_AND_SMILEYS, "")).otherwise(held)

    return bind(text, strip)


def strip_leading_dots(text: Column) -> Column:
    """Drop dots and spaces at the start."""
    return F.ltrim(text, F.lit(". "))


def strip_variation_selectors(text: Column) -> Column:
    """Drop emoji variation selectors at both ends."""
    return F.btrim(text, F.lit(fv.VARIATION_SELECTOR))


def strip_emoji(text: Column) -> Column:
    """Drop every character that is an emoji on its own."""
    return F.regexp_replace(text, _EMOJI, "")


def blank_invisible(text: Column) -> Column:
    """Zero-width pairs, no-break and thin spaces, joiners, newlines and tabs become spaces."""
    for invisible in (fv.ZERO_WIDTH_SPACE_PAIR, *fv.BLANKED_CHARACTERS):
        text = F.replace(text, F.lit(invisible), F.lit(" "))
    return text


def strip_trailing_url(text: Column) -> Column:
    """A link at the end becomes a space; then the same for a channel link."""

    def strip(held: Column) -> Column:
        without_link = F.regexp_replace(held, _LINEAR_TRAILING_URL, " ")
        return F.regexp_replace(without_link, "(?d)" + fv.TRAILING_CHANNEL_LINK.replace("*$", "*+$"), " ")

    return bind(text, _only_with("://", strip))


def strip_site_links(text: Column) -> Column:
    """Short links of one site become spaces wherever they stand."""
    return bind(text, _only_with("ru/", lambda held: F.regexp_replace(held, "(?d)" + fv.SITE_LINK, " ")))


def strip_tags_mentions(text: Column) -> Column:
    """One trailing hashtag, then one trailing mention, becomes a space."""
    return bind(
        text,
        _only_with("#", lambda held: F.regexp_replace(held, "(?d)" + fv.TRAILING_HASHTAG, " ")),
        _only_with("@", lambda held: F.regexp_replace(held, "(?d)" + fv.TRAILING_MENTION, " ")),
    )


def clean_text(
    text: Column,
    channel: Column,
    phrases: Mapping[str, Sequence[str]] | None = fv.BOILERPLATE,
) -> Column:
    """The whole cleaning chain in its fixed order; ``phrases=None`` leaves boilerplate in."""
    if phrases is not None:
        text = strip_boilerplate(text, channel, phrases)
    for step in (
        strip_flags_and_smileys,
        strip_variation_selectors,
        strip_leading_dots,
        strip_emoji,
        blank_invisible,
        strip_trailing_url,
        strip_site_links,
        strip_tags_mentions,
        strip_leading_dots,
        collapse_spaces,
    ):
        text = step(text)
    return text


def label_name(label: Column) -> Column:
    """``__label__sports`` → ``sports``."""
    return F.substring_index(label, "__", -1)


def sql_safe(text: Column) -> Column:
    """Apostrophes become backticks; both ends are trimmed."""
    return strip_whitespace(F.translate(text, "'", "`"))


def truncate_tokens(text: Column, limit: int = fv.MODEL_INPUT_TOKENS) -> Column:
    """The first ``limit`` white-space separated tokens: the input window of a model.

    Texts that fit are passed through with their inner spacing normalised.
    """
    return bind(
        strip_whitespace(text),
        lambda held: F.regexp_replace(held, _OTHER_SPACE, " "),
        _only_with("  ", lambda held: F.regexp_replace(held, "  +", " ")),
        lambda held: F.substring_index(held, " ", limit),
    )


def sentences(text: Column) -> Column:
    """Sentences of a text: cut after ``.``, ``!``, ``?`` or ``…`` followed by white space."""
    ends = f"(?<=[.!?…])[{_SPACE}]+"
    return F.filter(F.split(strip_whitespace(text), ends), lambda sentence: sentence != "")
