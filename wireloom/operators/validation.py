"""Named record rules, and the split into valid rows and rejects with reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom import fixed_values as fv
from wireloom.functions import text as tx
from wireloom.operators.compute import with_value

ERRORS = "errors"

# A host chunk or ending may hold letters of any script.
_CHUNK = r"[_0-9a-\x{40000}](?:[-_0-9a-\x{40000}]{0,61}[_0-9a-\x{40000}])?"
_TOP_LEVEL = r"(?:[\p{L}\p{Nl}\p{No}]{2,63}|xn--[-_0-9a-z]{2,63})"
_IPV4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
_IPV6 = r"\[[A-F0-9]*:[A-F0-9:]+\]"
_PORT = r":0*(?:6553[0-5]|655[0-2][0-9]|65[0-4][0-9]{2}|6[0-4][0-9]{3}|[1-5][0-9]{4}|[0-9]{1,4})"
HTTP_URL = (
    r"(?i)^https?://(?:[^:/]*(?::[^/]*)?@)?"
    rf"(?:{_IPV4}|{_IPV6}|(?:{_CHUNK}\.)+{_TOP_LEVEL}\.?)(?:{_PORT})?"
    r"(?:/[^?#]*)?(?:\?[^#]*)?(?:#[^#]*)?\z"
)


def is_http_url(url: Column, max_length: int = fv.URL_MAX_LENGTH) -> Column:
    """An http(s) URL with a top-level domain or an IP host, within the length limit.

    White space at both ends is forgiven, inside it is not.  NULL is not a URL.
    """
    trimmed = tx.strip_whitespace(url)
    valid = (
        F.char_length(trimmed).between(1, max_length)
        & ~tx.has_whitespace(trimmed)
        & trimmed.rlike(HTTP_URL)
    )
    return F.coalesce(valid, F.lit(False))


def short_rules() -> dict[str, Column]:
    """Rules for staged news."""
    return {
        "url": is_http_url(F.col("url")),
        "date": F.col("date").isNotNull(),
        "news": F.col("news").isNotNull() & (F.char_length("news") >= 1),
        "links": is_http_url(F.col("links")),
        "agency": F.col("agency").isNotNull(),
    }


def final_rules() -> dict[str, Column]:
    """Rules for news to be published; title and resume may be empty."""
    return {
        **short_rules(),
        "title": F.col("title").isNotNull(),
        "resume": F.col("resume").isNotNull(),
        "category": F.col("category").isin(*fv.CATEGORIES),
    }


def with_errors(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the names of the broken rules as an array, in rule order; other columns stay as they are.

    The rules run once per row, also where valid rows and rejects are taken from it.
    """
    broken = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]
    return with_value(df, ERRORS, F.array_compact(F.array(*broken)))


def valid_rows(checked: DataFrame) -> DataFrame:
    """Rows that break no rule, with their original values."""
    return checked.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejects(checked: DataFrame) -> DataFrame:
    """Rows that break a rule, with the reasons."""
    return checked.filter(F.size(ERRORS) > 0)


def validation_counts(checked: DataFrame) -> DataFrame:
    """One row: how many are valid and how many are not."""
    return checked.agg(
        F.count_if(F.size(ERRORS) == 0).alias("len_news"),
        F.count_if(F.size(ERRORS) > 0).alias("len_errors"),
    )


def rejects_by_reason(checked: DataFrame) -> DataFrame:
    """How many rows break each rule."""
    return (
        checked.select(F.explode(ERRORS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    )
