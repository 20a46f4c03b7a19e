import random
import re
import unicodedata

import regex
from helpers import column
from pyspark.sql import functions as F

from wireloom import fixed_values as fv
from wireloom.functions import text as tx

PIECES = [
    "a", "B", "é", "ж", "Ж", "ё", "漢", "ª", "ǅ", "1", " ", "  ", "\n", "\t", "\r", "\u2028", "\u2003", "\xa0", "\u200b",
    "\u200b\u200b", "\u200d", "\u2009", "\ufe0f", "😀", "😁😂", "🚀", "🇺🇸", "🇲🇴", "🇷", "🏽", "©", "#", "#Тег", "#ёж", "@", "@abc",
    "@a1", ".", "..", "/", "-", "_", ":", "?", "http://", "https://", "https://a-b.ru/c/d", "https://t.me/x_1/2",
    "https://tXme/", "vc.ru/", "go.vc.ru/a-1", "govvcxru/q", "18+", "Techinsider", "Techinsider (https://t.me/techinsiderru)",
    "McDonald", "It's", "США", "Санкт-Петербург", "'",
]


def strings(count, seed, most=9):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, most))) for _ in range(count)]


def test_emoji_table_is_the_unicode_property():
    emoji = regex.compile(r"\p{Emoji}")
    excluded = {*map(ord, "0123456789#*"), *range(0x1F1E6, 0x1F200)}
    wanted = {p for p in range(0x20000) if emoji.match(chr(p)) and p not in excluded}
    table = set()
    for span in fv.EMOJI_RANGES.split():
        first, _, last = span.partition("-")
        table.update(range(int(first, 16), int(last or first, 16) + 1))
    assert table <= wanted
    # The rest are points that Unicode 15 has not assigned yet.
    assert {unicodedata.category(chr(p)) for p in wanted - table} <= {"Cn"}


def test_whitespace_is_what_strip_takes():
    assert set(fv.WHITESPACE) == {chr(p) for p in range(0x110000) if chr(p).isspace()}


def test_strip_whitespace(spark):
    values = strings(500, 1)
    assert column(spark, values, tx.strip_whitespace(F.col("x"))) == [value.strip() for value in values]


def test_has_whitespace(spark):
    values = [*strings(300, 2, 3), *(f"a{space}b" for space in fv.WHITESPACE)]
    got = column(spark, values, tx.has_whitespace(F.col("x")))
    assert got == [any(c.isspace() for c in value) for value in values]


def test_title_case(spark):
    values = [*strings(2000, 3, 4), "Ab", "AB", "aB", "A", "", "1A", "A1b", "A1B", "Ab-Cd", "ªA", "Aª", "ǅa", "aǅ"]
    assert column(spark, values, tx.is_title_case(F.col("x"))) == [value.istitle() for value in values]


def test_trailing_url_matches_the_plain_pattern(spark):
    pieces = ["http://", "https://", "a", "Z", "7", "/", "-", ".", "_", "é", " ", "?", "\n", "t.me/"]
    rng = random.Random(4)
    values = ["".join(rng.choices(pieces, k=rng.randint(1, 10))) for _ in range(6000)]
    values += ["x https://a-b.ru/c/d", "https://a.b/", "https://a.b/1/é/x", "https://t.me/a"]
    wanted = [
        re.sub(fv.TRAILING_CHANNEL_LINK, " ", re.sub(fv.TRAILING_URL, " ", value)) for value in values
    ]
    assert column(spark, values, tx.strip_trailing_url(F.col("x"))) == wanted


def test_long_link_like_text_is_not_slow(spark):
    values = ["https://" + "a/" * 20000 + " end", "https://" + "ab." * 30000 + "é end"]
    assert column(spark, values, tx.strip_trailing_url(F.col("x"))) == values


STEPS = (
    (r"[\U0001F1E6-\U0001F1FF]{2}|[\U0001F600-\U0001F64F]", ""),
    (r"\A\ufe0f+|\ufe0f+\Z", ""),
    (r"\A[. ]+", ""),
    (r"[\p{Emoji}--[0-9#*\U0001F1E6-\U0001F1FF]]", ""),
    ("\u200b\u200b|[\xa0\u200d\u2009\n\t]", " "),
    (fv.TRAILING_URL, " "),
    (fv.TRAILING_CHANNEL_LINK.replace("[/-_", "[/-\\_"), " "),
    (fv.SITE_LINK, " "),
    (fv.TRAILING_HASHTAG, " "),
    (fv.TRAILING_MENTION, " "),
    (r"\A[. ]+", ""),
    (" +", " "),
)


def expected_clean(value, channel):
    phrases = {*fv.BOILERPLATE.get(channel, ()), *fv.BOILERPLATE[fv.COMMON_LABELS_KEY]}
    for phrase in sorted(phrases, key=lambda phrase: (-len(phrase), phrase)):
        value = value.replace(phrase, " ")
    for pattern, replacement in STEPS:
        flags = regex.V1 if "Emoji" in pattern else regex.V0
        value = regex.sub(pattern, replacement, value, flags=flags)
    return value.strip()


def test_clean_text_against_a_row_by_row_check(spark):
    values = strings(3000, 5, 12)
    for channel in ("techinsiderru", "other"):
        got = column(spark, values, tx.clean_text(F.col("x"), F.lit(channel)))
        assert got == [expected_clean(value, channel) for value in values]


def test_clean_text_properties(spark):
    for value in column(spark, strings(2000, 6, 14), tx.clean_text(F.col("x"), F.lit("other"))):
        assert value == value.strip() and "  " not in value and "\n" not in value and "\t" not in value


def test_clean_text_goldens(spark):
    cases = {
        "текст #Тег": "текст",
        "текст #один #два": "текст #один",
        "текст #ёж": "текст #ёж",
        "слово @mention": "слово",
        "mid @mention слово": "mid @mention слово",
        "text #Тег\r": "text #Тег",
        "\u2028text": "text",
        "text\u2003": "text",
        "a\u200bb\u200b\u200bc": "a\u200bb c",
        "\ufe0f. text\ufe0f": "text",
        "🇺🇸🇲🇴 text 😀😀": "text",
        "🚀. text": "text",
        "...": "",
        "18+ text": "text",
    }
    assert column(spark, list(cases), tx.clean_text(F.col("x"), F.lit("c"))) == list(cases.values())


def test_null_stays_null(spark):
    assert column(spark, [None], tx.clean_text(F.col("x"), F.lit("c"))) == [None]
    assert column(spark, [None], tx.truncate_tokens(F.col("x"))) == [None]


def test_boilerplate_for_every_channel(spark):
    for channel, phrases in fv.BOILERPLATE.items():
        got = column(spark, [f"a{phrase}b" for phrase in phrases], tx.strip_boilerplate(F.col("x"), F.lit(channel)))
        assert got == ["a b"] * len(phrases)
    assert column(spark, ["a @bbcrussian b"], tx.strip_boilerplate(F.col("x"), F.lit("vedomosti"))) == ["a @bbcrussian b"]


def test_split_headline(spark):
    rows = [
        ("Big news today", "Big news", "Big news.  today"),
        ("Big news.. today", "Big news..", "Big news.  today"),
        ("big news today", "big news", "big news today"),
        ("McDonald news", "McDonald", "McDonald news"),
        ("США news", "США", "США news"),
        ("Санкт-Петербург news", "Санкт-Петербург", "Санкт-Петербург.  news"),
        ("a a", "", "a a"),
        ("a   a", "   ", "a   a"),
        ("Ab Ab", "Ab", "Ab.  Ab. "),
    ]
    frame = spark.createDataFrame(rows, "text string, title string, wanted string")
    for row in frame.withColumn("got", tx.split_headline(F.col("text"), F.col("title"))).collect():
        assert row["got"] == row["wanted"]


def test_last_clause(spark):
    values = ["a: b: c#d#e", "none", "x#y: z"]
    assert column(spark, values, tx.last_clause(F.col("x"), F.lit(fv.LAST_CLAUSE_AGENCY))) == ["c", "none", "z"]
    assert column(spark, values, tx.last_clause(F.col("x"), F.lit("other"))) == values


def test_truncate_tokens(spark):
    values = [*strings(500, 7, 20), " ".join(map(str, range(1000)))]
    assert column(spark, values, tx.truncate_tokens(F.col("x"), 5)) == [" ".join(v.split()[:5]) for v in values]


def test_labels_and_quotes(spark):
    assert column(spark, ["__label__sports", "economy"], tx.label_name(F.col("x"))) == ["sports", "economy"]
    assert column(spark, [" It's 'x' "], tx.sql_safe(F.col("x"))) == ["It`s `x`"]
