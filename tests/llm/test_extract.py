"""Main text of pages: golden pages, both passes, and pages built to a known text."""

import html
import random
import time

import pytest

from wireloom.llm import block_extract as b

PROSE = "The river of the valley is in the north and it was known to all that lived by it. " * 4
RARE = "Quartz jigsaw " * 20

PAGES = {
    "<article><h1>Head</h1><p>" + PROSE + "</article>": "Head " + PROSE,
    "<nav><a href=/>Home</a></nav><div class='ad'>" + PROSE + "</div><article><p>One &amp; two&nbsp;&#228;<br>three</p></article><footer>x</footer>": "One & two ä three",
    "<div><p>" + PROSE + "</p><p>Short one.</p><p>" + PROSE + "</p></div>": f"{PROSE} Short one. {PROSE}",
    "<div><p>" + RARE + "</p><p>Short one.</p><p>" + RARE + "</p></div>": "",
    "<p>" + PROSE + "</p><p>" + "<a href=x>" + PROSE + "</a></p>": PROSE,
    "<main><p>" + RARE + "</p><aside>no</aside><p>tail</main>": RARE + " tail",
    "<form><article><p>In a form</p></article><input></form>": "In a form",
    "<article class='comment'><p>" + PROSE + "</p></article>": "",
    "<script>var t='</p><article>no</article>';</script><!-- <article>no</article> --><article>yes</article>": "yes",
    "<article><p>a <b>bold</b>ly <i>go</i></p><style>p{}</style><p>x<script>1<2</script>y": "a boldly go xy",
    "<article><p>unclosed <a href='x>tag</p><p>next": "unclosed tag next",
    "": "",
    None: "",
    "no tags &lt;at all&gt;": "",
    "<article>&am &quot;x&quot; &copy 1 < 2</article>": '&am "x" © 1 < 2',
}


@pytest.mark.parametrize("page", PAGES)
def test_golden(page):
    assert b.main_text(page) == " ".join(PAGES[page].split())


def test_first_pass():
    def block(text, links=0.0, kind="open"):
        return b.first_pass(b.Block(text, links, 0, kind))

    assert [block(PROSE), block("Short"), block(RARE), block(PROSE, 0.9), block(PROSE, kind="boilerplate")] == ["text", "short", "boilerplate", "boilerplate", "boilerplate"]
    assert [block(RARE, kind="article"), block("the of and in " * 7), block("Short", 0.9, "article")] == ["near", "near", "near"]


def test_second_pass():
    def labels(*given):
        blocks = [b.Block("x", 0, 0, "open", label) for label in given]
        b.second_pass(blocks)
        return [x.label[0] for x in blocks]

    assert labels("text", "short", "short", "text") == list("tttt")
    assert labels("text", "short", "near", "boilerplate") == list("tbtb")
    assert labels("short", "near") == list("bb")
    assert labels("near", "text", "short") == list("ttt")


def test_tables_as_given(spark):
    """Pages of the test tables hold one article each; what stands in it is the text."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r["page_id"]: r for r in b.extract_text(pages).collect()}
    assert len(rows) == pages.count()
    for r in pages.collect():
        inner = r["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        for tag in ("h1", "p", "b", "br", "/h1", "/p", "/b"):
            inner = inner.replace(f"<{tag}>", " " if tag.strip("/") != "b" else "")
        want = " ".join(html.unescape(inner).split())
        assert rows[r["page_id"]]["text"] == want and rows[r["page_id"]]["n_chars"] == len(want)


def test_built_pages():
    rng = random.Random(5)
    words = "the of and river stone light under a in to was it".split()
    for _ in range(100):
        paragraphs = [" ".join(rng.choices(words, k=rng.choice([1, 8, 60]))) for _ in range(rng.randint(1, 8))]
        body = "".join(rng.choice(["<p>{}</p>", "<p>{}", "<div>{}</div>", "<h2>{}</h2>"]).format(html.escape(p)) for p in paragraphs)
        noise = ["<nav><ul><li><a href='/'>menu item</a></ul></nav>", "<aside>" + PROSE + "</aside>", "<div id='cookie-notice'>We use the cookies of it.</div>", "<header>top</header>"]
        page = "".join(rng.sample(noise, 3)) + f"<article>{body}</article>" + "".join(rng.sample(noise, 2)) + "<footer>end</footer>"
        assert b.main_text(page) == " ".join(paragraphs)


@pytest.mark.parametrize("many", [3, 199, 5000])
def test_elements_without_end_tags(many):
    """What follows a list, table or choice is read, however many items it leaves open."""
    rest = f"<article><p>{PROSE}</article>"
    for page in ("<select>" + "<option>Land" * many + "</select>", "<nav><ul>" + "<li>x" * many + "</ul></nav>", "<nav>" + "<li>x" * many + "</nav>", "<datalist>" + "<option>x" * many + "</datalist>"):
        assert b.main_text(page + rest) == PROSE.strip()
        assert b.main_text(page + f"<p>{PROSE}</p>") == PROSE.strip()
    for box in ("<aside>", "<div class='ad'>"):
        page = box + "<table>" + "<tr><td>x<th>y" * many + "</table>" + box.replace("<", "</").split(" ")[0].rstrip(">") + ">"
        assert b.main_text(page + f"<p>{PROSE}</p>") == PROSE.strip()
        assert b.main_text(box + "<span><div>" * many + box.replace("<", "</").split(" ")[0].rstrip(">") + ">" + rest) == PROSE.strip()
    nested = "<nav>" + "<ul><li>a<ul><li>b<li>c</ul><li>d</ul>" * many + "</nav>"
    assert b.main_text(nested + f"<p>{PROSE}</p>") == PROSE.strip()
    # A marked item ends where the next begins.
    assert b.main_text(f"<ul><li class='ad'>{RARE}<li>{PROSE}</ul>") == PROSE.strip()


def test_open_elements_in_linear_time():
    started = time.process_time()
    for page in ("<li>" * 100_000, "<select>" + "<option>" * 100_000 + "</select>", "<div>" * 100_000 + "</li>" * 100_000, "<table><tr><td>" * 50_000 + "</table>" * 50_000):
        b.main_text(page)
    assert time.process_time() - started < 20


def test_odd_rows_and_time(spark):
    rows = [(1, None, None, "t"), (None, "u", "", "t"), (2, "v", "<article>x", "t"), (2, "v", "<article>x", "t")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    assert sorted((r["text"], r["n_chars"]) for r in b.extract_text(frame).collect()) == [("", 0), ("", 0), ("x", 1), ("x", 1)]
    assert b.extract_text(frame.limit(0)).collect() == []
    started = time.process_time()
    for page in ("<a href=\"" * 50_000, "<!--" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<" * 200_000, "<script>" * 50_000, "&" * 200_000):
        b.main_text(page)
    assert time.process_time() - started < 20


FAULTS = {
    f"<div class='content has-sidebar'><p>{PROSE}</p></div>": PROSE,
    f"<div class='share-price'><p>{PROSE}</p></div><div class='share-buttons'><p>{PROSE}</p></div>": PROSE,
    f"<div id='article-header'><p>{PROSE}</p></div><div id=ad-free><p>{PROSE}</div>": PROSE + PROSE,
    f"<a name=top><p>{PROSE}</p><p>{PROSE}</p>": PROSE + PROSE,
    f"<p><a href=x>unclosed<p>{PROSE}</p><p>{PROSE}</p>": PROSE + PROSE,
    f"<ul><li><a href=https://x/>{PROSE}</a><li><a href=https://y/>{PROSE}</a></ul><p>{PROSE}</p>": PROSE,
    f"<script src='a.js'/>var the = 'of and';</script><p>{PROSE}</p>": PROSE,
    f"<form action=/><div><p>{PROSE}</p><input><p>{PROSE}</p></div></form>": PROSE + PROSE,
    f"<form><p>{PROSE}</p><nav><p>{PROSE}</p></nav><div class=comments><p>{PROSE}</p></div></form>": "",
    f"<form><p>{PROSE}{PROSE}</p><nav><p>{RARE}</p></nav><div class=comments><p>{PROSE}</p></div></form>": PROSE + PROSE,
    f"<div class=sidebar><p>{PROSE}</p></div><p>{PROSE}</p>": PROSE,
    f"<div class=comments><p>{PROSE}</p></div>": "",
    f"<a href=/story><h2>{PROSE}</h2></a><p>{PROSE}</p>": PROSE,
}


@pytest.mark.parametrize("page", FAULTS)
def test_wrappers_links_and_names(page):
    assert b.main_text(page) == " ".join(FAULTS[page].split())


LANGUAGES = {
    "pl": "Rzeka w dolinie płynie na północ i znają ją wszyscy, którzy nad nią żyją od wielu lat w tej małej wsi.",
    "ru": "Река в долине течёт на север, и её знают все, кто живёт на её берегах много лет в этой маленькой деревне.",
    "ja": "谷の川は北に流れ、その岸辺の小さな村に長年住む人々は皆この川をよく知っている。" * 3,
    "fi": "Laakson joki virtaa pohjoiseen ja kaikki sen rannalla pienessä kylässä vuosia asuneet tuntevat sen hyvin.",
    "tr": "Vadideki nehir kuzeye akar ve kıyısındaki küçük köyde yıllardır yaşayan herkes onu iyi tanır.",
    "en": "The river of the valley is in the north and it was known to all that lived by it for many years.",
}


@pytest.mark.parametrize("language", LANGUAGES)
def test_generated_pages_without_article(language):
    """Pages of a generator that knows their text: minified, with open elements, in languages with and without stop words."""
    rng = random.Random(language)
    sentence = LANGUAGES[language]
    menu = "<nav><ul>" + "".join(f"<li><a href=/{i}/>menu {i}" for i in range(6)) + "</ul></nav>"
    noise = ["<div class='cookie-notice'><p>" + sentence * 4 + "</p></div>", "<aside>" + sentence * 4 + "</aside>", "<div class=related-posts>" + f"<a href=/x/>{sentence}</a>" * 3 + "</div>",
             "<script>var x='" + sentence + "'</script>", "<footer><p>" + sentence * 3 + "</footer>", "<div class=comments><p>" + sentence * 5 + "</div>"]
    for _ in range(60):
        paragraphs = [" ".join([sentence] * rng.randint(3, 6)) for _ in range(rng.randint(1, 6))]
        closed = rng.choice(["", "</p>"])
        body = "".join(f"<p>{html.escape(p)}{closed}" for p in paragraphs)
        wrap = rng.choice(["<div class='content has-sidebar'>{}</div>", "<section>{}</section>", "<div id=article-header-main>{}</div>", "<div><a name=top></a>{}</div>", "<a name=top><div>{}</div>"])
        parts = [menu, *rng.sample(noise, 3), wrap.format(body), *rng.sample(noise, 2)]
        page = f"<!doctype html><html lang={language}><head><title>{sentence}</title></head><body>" + rng.choice(["", "\n"]).join(parts)
        assert b.main_text(page) == " ".join(paragraphs), page
    if language in ("pl", "ru", "ja", "tr"):  # their letters tell, without lang
        assert b.main_text(f"<p>{sentence * 4}</p>") == sentence * 4
