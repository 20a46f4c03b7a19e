import datetime as dt
import re

from dateutil.relativedelta import relativedelta
from helpers import column, plan
from pyspark.sql import functions as F

from wireloom import fixed_values as fv
from wireloom.functions import dates, links

HREFS = [
    None, "", "https://t.me/channel", "https://t.me/Channel", "https://t.me/channel/12", "https://t.me/+abc",
    "tg://resolve?domain=abc", "https://example.com", "https://example.com/", "http://a.b/c?utm_source=x&y=1",
    "https://www.youtube.com/watch?v=1&utm=2", "https://example.com/a?b=c", "?utm", "https://sub.example.com",
    "https://example.com/x y", "https://t.me/", "http://пример.рф", "https://t.me/channel\n",
]


def wanted_link(href, own):
    if href is None or href.startswith(fv.DEEP_LINK_PREFIXES):
        return own
    if re.search(fv.BARE_CHANNEL_LINK, href) or re.search(fv.BARE_DOMAIN_LINK, href):
        return own
    return href.partition("?utm")[0]


def test_choose_link(spark):
    got = column(spark, HREFS, links.choose_link(F.col("x"), F.lit("own")))
    assert got == [wanted_link(href, "own") for href in HREFS]


def test_normalize_link(spark):
    cases = {
        "https://a.b/c?d=e?f": "https://a.b/c",
        "https://www.youtube.com/watch?v=1": "https://www.youtube.com/watch?v=1",
        "?x": "own",
        "": "own",
    }
    assert column(spark, list(cases), links.normalize_link(F.col("x"), F.lit("own"))) == list(cases.values())


def test_ids(spark):
    urls = ["https://t.me/a/12", "https://t.me/a/12?single", "https://t.me/a", "https://t.me/a/b/7", "https://t.me/a/99999999999", "https://t.me/a/99999999999999999999"]
    assert column(spark, urls, links.url_part_id(F.col("x"))) == [12, None, None, None, 99999999999, None]
    assert column(spark, urls, links.message_id(F.col("x"))) == [12, None, None, 7, 99999999999, None]


def test_newsroom_time(spark):
    values = ["2024-02-29T23:30:00+00:00", "2024-01-01T00:00:00-05:00", "2024-01-01T10:00:00.250000Z", "soon", None]
    assert column(spark, values, dates.newsroom_time(F.col("x"))) == [
        dt.datetime(2024, 3, 1, 2, 30), dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1, 13, 0, 0, 250000), None, None,
    ]


def wanted_anniversaries(day):
    return [day - relativedelta(years=day.year - year) for year in range(1999, day.year)]


def test_anniversaries(spark):
    days = [dt.date(2004, 2, 29), dt.date(2002, 3, 1), dt.date(1999, 5, 5), dt.date(1990, 1, 1), dt.date(2024, 12, 31)]
    got = column(spark, days, dates.anniversaries(F.col("x")), "date")
    assert got == [wanted_anniversaries(day) for day in days]
    assert [dates.anniversary_days(day) for day in days] == got


def test_anniversaries_of_all_leap_days():
    for year in (2000, 2004, 2096, 2104):
        assert dates.anniversary_days(dt.date(year, 2, 29)) == wanted_anniversaries(dt.date(year, 2, 29))


def test_days_are_pushed_to_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    found = orders.filter(dates.on_days(F.col("o_orderdate"), [dt.date(1999, 3, 1), dt.date(2000, 3, 1)]))
    assert "GreaterThanOrEqual(o_orderdate" in plan(found.select("o_orderkey"))


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    # 02:30 does not exist and 01:30 happens twice in this zone.
    times = [dt.datetime(2023, 3, 12, 2, 30), dt.datetime(2023, 11, 5, 1, 30, 0, 7), dt.datetime(1969, 12, 31, 23, 59, 59, 1)]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    days = [dt.date(1999, 3, 1), dt.date(1999, 10, 31)]
    counts = []
    try:
        for name in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            epoch = dt.datetime(1970, 1, 1)
            got = column(spark, times, dates.micros(F.col("x")), "timestamp_ntz")
            assert got == [(time - epoch) // dt.timedelta(microseconds=1) for time in times]
            start = F.lit("2023-03-11 12:00:00").cast("timestamp_ntz")
            gap = column(spark, times[:1], dates.elapsed_seconds(start, F.col("x")), "timestamp_ntz")
            assert gap == [14 * 3600 + 30 * 60]
            counts.append(orders.filter(dates.on_days(F.col("o_orderdate"), days)).count())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(set(counts)) == 1


def test_tomorrow(spark):
    day = spark.range(1).select(dates.tomorrow("Europe/Moscow").alias("d")).first()["d"]
    now = dt.datetime.now(dt.timezone(dt.timedelta(hours=3)))
    assert day in {now.date() + dt.timedelta(days=1), (now - dt.timedelta(minutes=2)).date() + dt.timedelta(days=1)}
