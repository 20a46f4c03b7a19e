"""Character references, links and bold against the standard library."""

import html
import random

from helpers import column
from pyspark.sql import functions as F

from wireloom.functions import markup


def texts():
    rng, names = random.Random(8), sorted(html.entities.html5)
    odd = ["&#0;", "&#13;", "&#128;", "&#x81;", "&#150", "&#xD800;", "&#1114112;", "&#99999999999999999999;", "&#xFFFFFFFFFF;", "&#11;", "&#8;", "&#xfdd0;", "&#x1FFFE;", "&#65;", "&#x1F600;", "&#", "&#;", "&#x;", "&#xg", "&", "&&amp;", "&amp;lt;", "& amp;", "&amp", "&ampx", "&notit;", "&notin;", "&bogus;", "&eacutesse", "&AMP;&amp", "&CounterClockwiseContourIntegral;", "&" + "a" * 40 + ";"]
    made = [None, "", "no reference", *odd]
    pieces = [*odd, "x", " ", "<", "é", ";", "#", "=", "\n", "1"]
    for _ in range(1500):
        made.append("".join(rng.choice([*pieces, "&" + rng.choice(names), "&" + rng.choice(names)[:-1], f"&#{rng.randint(0, 1200000)};", f"&#x{rng.randint(0, 70000):x}"]) for _ in range(rng.randint(1, 6))))
    return made + ["&" + name for name in names]


def test_references_in_text(spark):
    made = texts()
    assert column(spark, made, markup.unescape(F.col("x"))) == [t if t is None else html.unescape(t) for t in made]


def attribute_value(value):
    """References in an attribute: numbers, and whole names that no equals sign follows."""
    import re

    def one(match):
        ref = match[0]
        if ref.startswith("&#"):
            return html.unescape(ref)
        return html.unescape(ref) if not ref.endswith("=") and ref[1:] in html.entities.html5 else ref

    return re.sub(r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*[;=]?)", one, value)


def test_references_in_attributes(spark):
    made = [t for t in texts() if t is not None] + ["a?b=1&copy=2&amp;c=3", "a?x=1&lt", "a?x=1&ltx"]
    assert column(spark, made, markup.unescape(F.col("x"), attribute=True)) == [attribute_value(t) for t in made]


def test_links(spark):
    cases = {
        '<a href="x">': "x", "<a href='x y'>": "x y", "<a href=x/y>": "x/y", "<A class=k HREF = 'q'>": "q", "<a name=n><a href=z>": "z", '<a title="x > href=bad" href=good>': "good",
        "<abbr href=x>": None, "<a href=''>": None, "<a data-href=no href=yes>": "yes", '<a href="a?b=1&amp;c=2">': "a?b=1&c=2", "<a href=a?b=1&copy=2>": "a?b=1&copy=2", "no link": None,
        '<a href="one" href="two">': "one", "<a\nhref=x>": "x",
    }
    assert column(spark, list(cases), markup.first_link(F.col("x"))) == list(cases.values())
    assert column(spark, ["<a " + "x" * 200_000 + " href=y>"], markup.first_link(F.col("x"))) == ["y"]


def test_bold(spark):
    cases = {"<b>a</b>": "a", "<B class='x'>a &eacute;</B >": "a é", "<b>open<p>next": "open", "<body><b>in<i>ner</i></b>": "inner", "<br><b\nid=k>z</b>": "z", "none": ""}
    assert column(spark, list(cases), F.array_join(markup.bold_fragments(F.col("x")), "|")) == list(cases.values())
