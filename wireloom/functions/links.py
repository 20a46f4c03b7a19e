"""Link and message-id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wireloom import fixed_values as fv


def url_part_id(url: Column) -> Column:
    """The fifth ``/``-part of a message URL as a 64-bit number; NULL where it is not a number."""
    return F.split_part(url, F.lit("/"), F.lit(5)).try_cast("bigint")


def last_segment(url: Column) -> Column:
    """What follows the last ``/``."""
    return F.substring_index(url, "/", -1)


def message_id(url: Column) -> Column:
    """The last URL segment as a 64-bit number; NULL where it is not a number."""
    return last_segment(url).try_cast("bigint")


def channel_page(agency: Column) -> Column:
    """Address of the page that lists a channel's messages."""
    return F.concat(F.lit(fv.CHANNEL_PAGE_PREFIX), agency)


def choose_link(href: Column, own_url: Column) -> Column:
    """The anchor's target, or the message's own URL.

    Own URL where there is no anchor, or where it is a deep link, a bare channel
    or a bare domain; the tracking suffix of a chosen target is cut off.
    """
    deep = F.lit(False)
    for prefix in fv.DEEP_LINK_PREFIXES:
        deep = deep | href.startswith(prefix)
    bare = href.rlike("(?d)" + fv.BARE_CHANNEL_LINK) | href.rlike("(?d)" + fv.BARE_DOMAIN_LINK)
    return F.when(href.isNull() | deep | bare, own_url).otherwise(F.substring_index(href, "?utm", 1))


def normalize_link(link: Column, own_url: Column) -> Column:
    """Cut the query string, except of video links; an empty result is the own URL."""
    trimmed = F.when(link.startswith(fv.VIDEO_LINK_PREFIX), link).otherwise(F.substring_index(link, "?", 1))
    return F.coalesce(F.nullif(trimmed, F.lit("")), own_url)
