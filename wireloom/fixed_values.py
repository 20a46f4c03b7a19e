"""They must equal the published behaviour for results to be right.

Everything here is plain data (phrases, patterns, names, formats).  The logic
that applies it lives in ``functions`` and ``operators``.
"""

from __future__ import annotations

# --- Fixed values: boilerplate phrases per channel, and for every channel -----
COMMON_LABELS_KEY = "common_labels"
BOILERPLATE = {
    "common_labels": (
        "ДАННОЕ СООБЩЕНИЕ (МАТЕРИАЛ) СОЗДАНО И (ИЛИ) РАСПРОСТРАНЕНО ИНОСТРАННЫМ СРЕДСТВОМ МАССОВОЙ ИНФОРМАЦИИ, "
        "ВЫПОЛНЯЮЩИМ ФУНКЦИИ ИНОСТРАННОГО АГЕНТА, И (ИЛИ) РОССИЙСКИМ ЮРИДИЧЕСКИМ ЛИЦОМ, ВЫПОЛНЯЮЩИМ ФУНКЦИИ "
        "ИНОСТРАННОГО АГЕНТА",
        "*Власти считают иноагентом",
        "*Минюст признал иноагентами",
        "*Минюст объявил иноагентом",
        "18+",
    ),
    "redakciya_channel": (
        "НАСТОЯЩИЙ МАТЕРИАЛ (ИНФОРМАЦИЯ) ПРОИЗВЕДЕН, РАСПРОСТРАНЕН И (ИЛИ) НАПРАВЛЕН ИНОСТРАННЫМ АГЕНТОМ "
        "ПИВОВАРОВЫМ АЛЕКСЕЕМ ВЛАДИМИРОВИЧЕМ ЛИБО КАСАЕТСЯ ДЕЯТЕЛЬНОСТИ ИНОСТРАННОГО АГЕНТА ПИВОВАРОВА АЛЕКСЕЯ "
        "ВЛАДИМИРОВИЧА",
    ),
    "thevillagemsk": (
        " Поддержите The Village подпиской https://redefine.media/about (подробная инструкция здесь)",
    ),
    "bbcrussian": ("@bbcrussian",),
    "interfaxonline": ("@interfaxonline",),
    "banksta": ("@banksta",),
    "vedomosti": ("@vedomosti",),
    "kommersant": ("@kommersant",),
    "zubarevich": ("Наталья Зубаревич",),
    "sportrian": ("Подписаться на @sportrian",),
    "thebell_io": (
        "НАСТОЯЩИЙ МАТЕРИАЛ (ИНФОРМАЦИЯ) ПРОИЗВЕДЕН И РАСПРОСТРАНЕН ИНОСТРАННЫМ АГЕНТОМ THE BELL ЛИБО КАСАЕТСЯ "
        "ДЕЯТЕЛЬНОСТИ ИНОСТРАННОГО АГЕНТА THE BELL.",
        "Подписывайтесь на The Bell",
    ),
    "moscowtimes_ru": ("Подписаться на канал | Подписаться на рассылку",),
    "techinsiderru": ("Techinsider (https://t.me/techinsiderru)", "Techinsider"),
    "Popmeh": ("Популярная механика",),
    "economika": ("𝔼ℂ𝕆ℕ𝕆𝕄𝕀𝕂𝔸",),
    "BIoomberg": ("2024[BBG]",),
}

# --- Fixed values: agencies with a rule of their own --------------------------
EXCLUDED_AGENCY = "newsru.co.il"
LAST_CLAUSE_AGENCY = "briefsmi"
SKIPPED_PRIORITY = 6

# --- Fixed values: links and pages --------------------------------------------
CHANNEL_PAGE_PREFIX = "https://t.me/s/"
VIDEO_LINK_PREFIX = "https://www.youtube.com/watch"
DEEP_LINK_PREFIXES = ("tg://resolve?domain=", "https://t.me/+")
BARE_CHANNEL_LINK = "https://t.me/[-_a-z]*$"
BARE_DOMAIN_LINK = "(https|http)://[-_a-zA-Z]*.[a-zA-Z]*[^/]$"
PUBLISH_OFFSET_HOURS = 3
FIRST_ARCHIVE_YEAR = 1999
NEWSROOM_TIME_ZONE = "Europe/Moscow"

# --- Fixed values: element classes of a channel page --------------------------
BUBBLE_CLASS = "tgme_widget_message_bubble"
TEXT_CLASS = "tgme_widget_message_text js-message_text"
DATE_LINK_CLASS = "tgme_widget_message_date"
TIME_CLASS = "time"

# --- Fixed values: trailing links, tags and mentions --------------------------
TRAILING_URL = "https?://[-/_.a-zA-Z0-9]*.[-/_.a-zA-Z]*/[-/_.a-zA-Z0-9]*$"
TRAILING_CHANNEL_LINK = "https://t.me/[/-_a-zA-Z0-9]*$"
SITE_LINK = "(go.vc.ru|vc.ru)/[-/_.a-zA-Z0-9]*"
TRAILING_HASHTAG = "#[а-яА-Я]*$"
TRAILING_MENTION = "@[a-zA-Z]*$"

# --- Fixed values: categories and labels --------------------------------------
CATEGORIES = ("economy", "science", "sports", "technology", "entertainment", "society")
NON_NEWS_LABELS = ("other", "not_news")
NO_CATEGORY = "None"
MODEL_INPUT_TOKENS = 600
PER_ITEM_EPSILON_COLLECT = 0.000001
PER_ITEM_EPSILON_ENRICH = 0.01
URL_MAX_LENGTH = 2083

# --- Fixed values: characters --------------------------------------------------
VARIATION_SELECTOR = "\ufe0f"
ZERO_WIDTH_SPACE_PAIR = "\u200b\u200b"
# No-break space, zero-width joiner, thin space, newline and tab turn to a space.
BLANKED_CHARACTERS = "\u00a0\u200d\u2009\n\t"
# Flags of two letters, and runs of smileys.
FLAGS_AND_SMILEYS = r"(\x{1F1F2}\x{1F1F4})|([\x{1F1E6}-\x{1F1FF}]{2})|([\x{1F600}-\x{1F64F}])+"
# White space as Unicode text stripping understands it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as the inside of a regex class, for Java and RE2.
WHITESPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# --- Fixed values: code points with the Unicode 15 "Emoji" property ------------
# (without digits, '#', '*' and the regional indicators).
EMOJI_RANGES = (
    "00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 "
    "25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 "
    "2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB "
    "26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 "
    "2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 "
    "27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F "
    "1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 "
    "1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A "
    "1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE "
    "1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC "
    "1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FA88 1FA90-1FABD "
    "1FABF-1FAC5 1FACE-1FADB 1FAE0-1FAE8 1FAF0-1FAF8"
)


def emoji_class() -> str:
    """The emoji code points as the inside of a regex class, for Java and RE2."""
    spans = (token.split("-") for token in EMOJI_RANGES.split())
    return "".join("-".join(rf"\x{{{point}}}" for point in span) for span in spans)
