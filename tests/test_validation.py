import datetime as dt

from helpers import NEWS, column
from pyspark.sql import functions as F

from wireloom.operators import validation as va

URLS = {
    "https://t.me/a/1": True,
    "http://example.com": True,
    "HTTP://EXAMPLE.COM/A": True,
    "https://example.com.": True,
    "https://a_b.example.com/": True,
    "https://новости.рф/ы?q=1#z": True,
    "https://пример.xn--p1ai/": True,
    "https://user:pw@example.com:8080/x": True,
    "http://10.0.0.1/x": True,
    "http://[2001:db8::1]:80": True,
    "  https://example.com/a\n": True,
    "https://example.com:65535/": True,
    "https://example.com:00080/": True,
    "https://example.com:65536/": False,
    "https://example.com:/": False,
    "https://example.com/a b": False,
    "https://example.com/a\xa0b": False,
    "https://example.com/#a#b": False,
    "https://localhost/x": False,
    "https://example.c": False,
    "https://example.123": False,
    "https://-example.com": False,
    "https://exa mple.com": False,
    "https://.example.com": False,
    "https://" + "a" * 64 + ".com": False,
    "https://" + "a" * 63 + ".com": True,
    "ftp://example.com": False,
    "example.com": False,
    "//example.com": False,
    "https://": False,
    "": False,
    " ": False,
    "https://example.com/" + "a" * 2063: True,
    "https://example.com/" + "a" * 2064: False,
}


def test_urls(spark):
    got = column(spark, [*URLS, None], va.is_http_url(F.col("x")))
    assert dict(zip(URLS, got)) == URLS and got[-1] is False


def test_split_keeps_every_row_with_reasons(spark):
    time = dt.datetime(2023, 1, 1)
    rows = [
        ("https://t.me/a/1", time, "n", "https://t.me/a/1", "a"),
        ("https://t.me/a/2", None, "", "x", None),
        (None, time, None, "https://a.b/", ""),
        ("https://t.me/a/4", time, " ", "https://t.me/a/4", ""),
    ]
    checked = va.with_errors(spark.createDataFrame(rows, NEWS), va.short_rules())
    assert va.valid_rows(checked).count() == 2
    assert sorted(map(tuple, (row["errors"] for row in va.rejects(checked).collect()))) == [
        ("date", "news", "links", "agency"),
        ("url", "news", "links"),
    ]
    assert tuple(va.validation_counts(checked).first()) == (2, 2)
    reasons = {row["reason"]: row["rows"] for row in va.rejects_by_reason(checked).collect()}
    assert reasons == {"date": 1, "news": 2, "links": 1, "agency": 1, "url": 1} | {"links": reasons["links"]}
    assert sum(reasons.values()) == 7


def test_final_rules(spark):
    schema = NEWS + ", title string, resume string, category string"
    base = ("https://t.me/a/1", dt.datetime(2023, 1, 1), "n", "https://t.me/a/1", "a")
    rows = [base + extra for extra in (("", "", "economy"), (None, "", "economy"), ("t", None, "other"), ("t", "r", None))]
    checked = va.with_errors(spark.createDataFrame(rows, schema), va.final_rules())
    got = sorted(",".join(row["errors"]) for row in checked.collect())
    assert got == ["", "category", "resume,category", "title"]
