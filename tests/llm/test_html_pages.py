"""Hosts and pages on which the longest block or the first article is not the page's content."""

import pytest

from gridloom.llm import html


def texts_of(spark, pages):
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    return [r["text"] for r in html.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_a_notice_longer_than_every_article_is_template(spark):
    notice = "<div><p>" + "We and our partners store what you read. " * 50 + "</p></div>"
    pages = [("http://a.example/", f"<body><div>{notice}</div><div><p>Story {i} is short.</p><p>End {i}.</p></div></body>") for i in range(12)]
    pages += [("http://b.example/", f"<body><div>{notice}</div><article><p>Story {i} is short.</p></article></body>") for i in range(12)]
    found = texts_of(spark, pages)
    assert found[:12] == [f"Story {i} is short.\nEnd {i}." for i in range(12)]
    assert found[12:] == [f"Story {i} is short." for i in range(12)]


def test_articles_that_share_a_passage_are_different_contents(spark):
    bar = "<div><p>Follow us everywhere</p></div>"
    passage = "<blockquote>" + "a passage that all of them quote " * 10 + "</blockquote>"
    pages = [("http://a.example/", f"<body>{bar}<div><p>Story {i}.</p>{passage}</div></body>") for i in range(12)]
    assert texts_of(spark, pages) == [f"Story {i}." for i in range(12)]  # what stands on all pages goes, be it ever so long


def test_copies_with_changing_adverts_are_one_content(spark):
    pages = [("http://a.example/", f"<body><div class=ad>Buy {i}</div><div><p>The one story of this host.</p></div></body>") for i in range(12)]
    assert texts_of(spark, pages) == ["The one story of this host."] * 12


STORY = "<p>The story is told at length here, in many words.</p><p>And it goes on for a while.</p>"
TOLD = "The story is told at length here, in many words.\nAnd it goes on for a while."


@pytest.mark.parametrize(("page", "text"), [
    (f"<body><div class=content>{STORY}</div><section><article class=card><p>Teaser</p></article></section>", TOLD + "\nTeaser"),
    (f"<body><main>{STORY}</main><section><article class=card><p>Teaser</p></article></section>", TOLD + "\nTeaser"),
    (f"<body><main><h1>Headline</h1><article>{STORY}</article></main><div>else</div>", "Headline\n" + TOLD),
    (f"<body><h1>Headline</h1><article>{STORY}</article><div>else</div>", "Headline\n" + TOLD),
    (f"<body><div>else</div><article>{STORY}</article>", TOLD),
])
def test_an_article_narrows_the_page_only_if_it_holds_most(spark, page, text):
    assert texts_of(spark, [("http://a.example/", page)]) == [text]


def test_what_recurs_in_main_beside_the_article_goes(spark):
    page = lambda i: f"<body><main><p>Read all our letters</p><article><p>Same first line.</p><p>Story {i} has words.</p></article></main></body>"
    assert texts_of(spark, [("http://a.example/", page(i)) for i in range(12)]) == [f"Same first line.\nStory {i} has words." for i in range(12)]


@pytest.mark.parametrize(("page", "text"), [
    ("<p>Hello <script>a<b>c</script>brave <button>b</button>new <svg><path/><text>t</text></svg>world</p>", "Hello brave new world"),
    ("<p>An <x-term>unknown</x-term> <font>element</font>, <label>labels</label><input name=q> and <noscript><p>no</p></noscript>a <select><option>1</select>line</p><p>next</p>", "An unknown element, labels and a line\nnext"),
    ("<p>one <object><object>x</object>y</object>two <template><div>z</div></template>three<svg/> four</p>", "one two three four"),
    ("<p>never <button>closed text stays</p><p>and goes on</p>", "never closed text stays\nand goes on"),
    ("<div class='social-policy'><p>The whole policy is told here.</p></div><div class=share-bar>Share</div>", "The whole policy is told here."),
    ("<p>See the <a class=header-link href=x>linked header</a> and <span class=notice>take notice</span>, <span class='ad-slot'>buy</span>now.</p>", "See the linked header and take notice, now."),
    ("<div class=notice-board><p>Kept words</p></div><div class='cookie-bar'>We use cookies</div><div class=site-footer>foot</div>", "Kept words"),
    ("<div class=social><p>Most of the page stands in a thing of this name.</p></div><div class=site-footer>foot</div>", "Most of the page stands in a thing of this name."),
    ("<form id=aspnetForm><div class=content><h1>T</h1><p>The page in a form.</p></div></form><form><label>Find</label> words</form>", "T\nThe page in a form."),
    ("<p>A text that is longer than what is asked of the reader.</p><form><h3>Write to us</h3><p>Your name</p></form>", "A text that is longer than what is asked of the reader."),
    ("<a class=skip-to-content href=#c>Skip</a><div><p>Text</p></div><div class=related-posts><p>Much longer than the text itself, but related</p></div>", "Text"),
])
def test_what_stands_within_a_line_and_what_names_say(page, text):
    root = html.parse(f"<body>{page}</body>")
    html.hashed(root)
    parts = html.main_parts(root)
    assert html.article_text(parts, set(), parts == [root]) == text


@pytest.mark.parametrize("unit", ["</p>", "x</td>", "<li></li>", "</form>"])
def test_a_megabyte_of_tags_under_open_elements_takes_time_in_proportion(unit):
    import time

    began = time.process_time()
    html.hashed(html.parse("<div>" * 50_000 + unit * (800_000 // len(unit))))
    assert time.process_time() - began < 10


@pytest.mark.parametrize("unit", ["<svg>", "<object><p>", "</svg>", "<button>x", "<div>", "<script>", "<a ", "<p class=ad>", "<!--", "&amp", "<td>", "</div><div>"])
def test_long_pages_of_odd_markup_take_time_in_proportion(unit):
    import time

    page = unit * (300_000 // len(unit))
    began = time.process_time()
    root = html.parse(page)
    html.hashed(root)
    parts = html.main_parts(root)
    html.article_text(parts, set(), parts == [root])
    assert time.process_time() - began < 10


def test_templates_are_counted_as_by_hand(spark, small):
    """The hashes that recur on a host, counted in plain Python over the whole table."""
    from collections import Counter, defaultdict
    from urllib.parse import urlsplit

    from gridloom.llm.common import table

    pages = table(spark, small.replace("sf0.001", "sf0.01"), "pages")
    contents, holders = defaultdict(set), defaultdict(set)
    for r in pages.collect():
        root = html.parse(r["html"] or "")
        host, content = urlsplit(r["url"]).netloc.lower(), html.hashed(root)
        contents[host].add(content)
        for x in html.candidates(root, [root]):
            holders[host, x].add(content)
    wanted = defaultdict(Counter)
    for (host, x), own in holders.items():
        if len(own) >= 2 and len(own) >= 0.05 * len(contents[host]):
            wanted[host][x] += 1
    from pyspark.sql import functions as F

    hosts = pages.select("html", F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)).alias("host"))
    found = {r["of"]: Counter(x % (1 << 64) for x in r["template"]) for r in html.host_templates(hosts, 2, 0.05).collect()}
    assert found == dict(wanted) and found
