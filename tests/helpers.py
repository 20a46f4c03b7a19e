"""Small helpers shared by the tests."""

import datetime as dt
import io
from contextlib import redirect_stdout

NEWS = "url string, date timestamp_ntz, news string, links string, agency string"


def column(spark, values, build, schema="string"):
    """Values of an expression over one column ``x``, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {schema}").repartition(3)
    return [row[1] for row in sorted(rows.select("i", build).collect())]


def plan(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def news_row(agency, number, text="text", minute=0, url=None):
    address = url or f"https://t.me/{agency}/{number}"
    return (address, dt.datetime(2023, 1, 1, 0, minute), text, address, agency)
