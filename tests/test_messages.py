import datetime as dt

from wireloom.operators import messages as ms

TEXT = "tgme_widget_message_text js-message_text"


def bubble(body, number="1", time="2024-01-01T10:00:00+00:00", channel="chan"):
    text = "" if body is None else f'<div class="{TEXT}" dir="auto">{body}</div>'
    return (
        f'<div class="wrap"><div class="tgme_widget_message_bubble">{text}<a class="tgme_widget_message_date" '
        f'href="https://t.me/{channel}/{number}"><time datetime="{time}" class="time">x</time></a></div></div>'
    )


def page(*bubbles):
    return "<html><body><main><section>" + "".join(bubbles) + "</section></main></body></html>"


def read(spark, *pages, channel="chan", reader=ms.read_bubbles):
    frame = spark.createDataFrame([(channel, html) for html in pages], "channel string, html string")
    return sorted(reader(frame).collect(), key=lambda row: (row["block_no"], row["own_url"] or ""))


def test_blocks_of_a_regular_page(spark):
    html = page(bubble('<b>One</b> <a href="https://a.b/c?utm_x">l</a>&amp; &lt;two'), bubble(None, "2"), bubble("", "3"))
    for reader in (ms.read_bubbles, ms.read_regular_bubbles):
        one, two, three = read(spark, html, reader=reader)
        assert tuple(one) == (
            "chan", 0, "https://t.me/chan/1", "2024-01-01T10:00:00+00:00", "One l& <two", "https://a.b/c?utm_x", ["One"],
        )
        assert two["body"] is None and three["body"] == ""


def test_parser_on_irregular_markup(spark):
    body = (
        '<b>a<b>b</b></b><br>c<script>var x="<b>no</b>";</script><!-- no --><i>d<p>e</i>&nbsp;f'
        '<a>g</a><a href="https://second.com/x">h</a><div>i</div>'
    )
    (row,) = read(spark, page(bubble(body)))
    assert row["body"] == "abcde\xa0fghi"
    assert row["bold"] == ["ab", "b"]
    assert row["href"] is None


def test_only_the_first_section_of_the_first_main_counts(spark):
    html = (
        bubble("before").join(("<html><header>", "</header>"))
        + "<body><p></i><main><section>" + bubble("in") + "</section><section>" + bubble("second", "2")
        + "</section></main><main><section>" + bubble("third", "3") + "</section></main></body></html>"
    )
    assert [row["body"] for row in read(spark, html)] == ["in"]
    no_section = "<html><body><main></main><main><section>" + bubble("x") + "</section></main></body></html>"
    assert read(spark, no_section) == []


def test_pages_without_content(spark):
    assert read(spark, None, "", "<html><body>nothing</body></html>") == []


def test_classes(spark):
    html = page(
        '<div class="x tgme_widget_message_bubble y"><div class="js-message_text tgme_widget_message_text">no</div>'
        f'<div class=" {TEXT.replace(" ", "  ")} ">yes</div><div class="{TEXT}">later</div>'
        '<span class="a tgme_widget_message_date" href="https://t.me/c/5"></span><i class="time b" datetime="t"></i></div>'
    )
    (row,) = read(spark, html)
    assert (row["body"], row["own_url"], row["published"]) == ("yes", "https://t.me/c/5", "t")


def test_a_bad_block_does_not_hide_the_next(spark):
    html = page(bubble("one", "1?single"), bubble("two", "2", "soon"), bubble("three 😀 #Тег", "3"))
    frame = spark.createDataFrame([("chan", html)], "channel string, html string")
    for reader in (ms.read_bubbles, ms.read_regular_bubbles):
        parsed = ms.parse_messages(frame, reader)
        (good,) = ms.well_formed(parsed).collect()
        assert good.asDict() == {
            "url": "https://t.me/chan/3", "date": dt.datetime(2024, 1, 1, 13), "news": "three",
            "links": "https://t.me/chan/3", "agency": "chan", "id": 3,
        }
        assert sorted(row["parse_error"] for row in ms.malformed(parsed).collect()) == ["date", "id"]


def test_headline_and_channel_rule(spark):
    html = page(bubble("<b>Big News.</b>today: yes. <b>x</b> #tag"), bubble("<b>Big News</b>today: now # tag", "2"))
    frame = spark.createDataFrame([("briefsmi", html), ("other", html)], "channel string, html string")
    rows = ms.parse_messages(frame).collect()
    got = {(row["agency"], row["id"]): row["news"] for row in rows}
    assert got == {
        ("briefsmi", 1): "yes. x",
        ("briefsmi", 2): "now",
        ("other", 1): "Big News.today: yes. x #tag",
        ("other", 2): "Big News. today: now # tag",
    }


def test_many_pages_in_one_batch(spark):
    pages = [page(*[bubble(f"p{p} m{m}", f"{p * 10 + m}") for m in range(3)]) for p in range(1000)]
    frame = spark.createDataFrame([("chan", html) for html in pages], "channel string, html string").coalesce(1)
    parsed = ms.read_bubbles(frame)
    assert parsed.count() == 3000 and parsed.select("own_url").distinct().count() == 3000


def test_a_page_that_cannot_be_read_leaves_a_mark(spark, monkeypatch):
    def fail(self, data):
        raise AssertionError("unknown declaration")

    html = page(bubble("one")) + "<!DOCTYPE x>"
    rows = list(ms._page_rows("chan", html))
    monkeypatch.setattr(ms._PageReader, "handle_decl", fail)
    assert rows + [("chan", 1, None, None, "", None, [])] == list(ms._page_rows("chan", html))
