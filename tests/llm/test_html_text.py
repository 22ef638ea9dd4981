import html
import random
import re
import time

import pytest

from rejoinder.llm.html_text import extract_text, join_blocks, main_text, page_blocks


def test_boilerplate_goes_and_text_stays():
    page = """<html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li>menu</li></ul></nav><div class="cookie-banner">cookies</div><!-- <p>no</p> -->
    <article><header><p>by line</p><h1>T &amp; x&nbsp;y</h1></header><p><b>One<br>two<p>three &lt;4&gt;
    <form><p>mail</p></form><div id="userComments"><p>first!</p></div><aside>side</aside>
    <ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p hidden>no</p><div class="shadow">e</div></article>
    <footer>&copy; me</footer></body></html>"""
    assert main_text(page) == "T & x y\n\nOne two\n\nthree <4>\n\na\n\nb\n\nc\n\nd\n\ne"


def test_odd_markup():
    for page in (None, "", "<", "<p", "<!--", "<a href='x", "</p></div>", "<script>never closed", "a < b & c", "<p>&#0;&#xD800;x</p>", "<div>" * 3000 + "deep"):
        main_text(page)
    assert main_text("a < b &amp; c") == "a < b & c"
    assert main_text("<p>x" + "<b>" * 100 + "y") == "xy"
    assert main_text("plain\n\n text") == "plain text"


def test_templates_of_a_host_go(spark):
    rows = [(i, f"http://h.com/{i}", f"<div>Site bar</div><div><p>text {i}</p></div><p>Bottom line</p>") for i in range(20)]
    rows += [(100 + i, f"http://other{i}.com/", "<div>Site bar</div><p>alone</p>") for i in range(20)]
    rows += [(200, None, None), (201, "no host", "<p>x</p>"), (None, "http://h.com/z", ""), (19, "http://h.com/19", rows[19][2])]
    found = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert all(texts[i] == f"text {i}" for i in range(20)) and texts[100] == "Site bar\n\nalone"
    assert texts[200] == "" and texts[201] == "x" and texts[None] == "" and all(r.n_chars == len(r.text) for r in found)


def test_blocks_of_few_pages_of_a_large_host_go(spark):
    rows = [(i, f"http://h.com/{i}", f"<div><p>text {i}</p></div>" + ("<div>Section bar</div>" if i < 12 else "")) for i in range(200)]
    found = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {i: f"text {i}" for i in range(200)}


def test_copies_of_a_page_are_no_template(spark):
    page = "<div><p>An article that was copied.</p></div>"
    rows = [(i, "http://h.com/a", page) for i in range(50)] + [(50 + i, "http://h.com/b", f"<p>own {i}</p>") for i in range(3)]
    found = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, host string, marks string".split(", host")[0]))
    assert {r.text for r in found.collect() if r.page_id < 50} == {"An article that was copied."}


def test_text_repeated_in_articles_stays(spark):
    rows = [(i, "http://h.com/", f"<article><p>same words</p><p>own {i}</p></article>") for i in range(20)]
    found = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"same words\n\nown {r.page_id}" for r in found)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r.page_id: r.text for r in extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert found[r.page_id] == "\n\n".join(p for p in parts if p)


def test_no_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, host string, text string, marks string")
    assert extract_text(empty).collect() == []


ARTICLE = "<article><h1>Title</h1><p>The text of the article is here.</p><p>And more.</p></article>"
PLAIN = "<div id='content'><p>The text of the article is here.</p><p>And more of it.</p></div><div class='sidebar'>side</div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form action='/'><input><label>field</label>{ARTICLE}<button>go</button></form></body>",
        f"<body class='has-sidebar comments-open'>{ARTICLE}</body>",
        f"<div class='layout sidebar-right'>{ARTICLE}<div class='sidebar'>side</div></div>",
        f"<html class='js cookie-consent' hidden><body>{ARTICLE}<div class='cookie-consent'>cookies</div></body></html>",
        f"<main class='page with-banner'>{ARTICLE}</main>",
        f"<div role='dialog'><fieldset>{ARTICLE}</fieldset></div>",
        f"<header class='masthead'><div>{ARTICLE}</div></header><div class='related'><p>teaser</p></div>",
        f"<aside><article><p>a teaser with {'very ' * 30} long text</p></article></aside>{ARTICLE}",
    ],
)
def test_wrappers_keep_their_article(page):
    assert main_text(page) == "Title\n\nThe text of the article is here.\n\nAnd more."


@pytest.mark.parametrize("wrap", ["<form>{}</form>", "<div class='layout with-sidebar'>{}</div>", "<div class='page comments-enabled'>{}</div>", "<div style='display: none'>{}</div>"])
def test_wrappers_without_an_article(wrap):
    assert main_text(wrap.format(PLAIN)) == "The text of the article is here.\n\nAnd more of it."


def test_names_within_an_article():
    page = """<article><p>The article has some words of its own, more than what follows.</p><p class="notice share">prose stays</p>
    <div class="related-work">Others have done this.</div><div class="related"><a href="1">one more</a> <a href="2">two more</a></div>
    <div class="share"><a>here</a><a>there</a></div><div class="newsletter">your mail</div><div class="comments">first</div></article>"""
    assert main_text(page) == "The article has some words of its own, more than what follows.\n\nprose stays\n\nOthers have done this."


def test_comments_longer_than_the_article_go():
    page = f"<main><p>Short text.</p></main><div class='comments'>{'<p>I say so.</p>' * 50}</div>"
    assert main_text(page) == "Short text."
    assert main_text(page.replace("main>", "article>")) == "Short text."
    assert main_text(f"<div><p>Short text, but not so short.</p><div id='disqus'>{'<p>I say.</p>' * 9}</div></div>") == "Short text, but not so short."


def test_main_without_articles_of_its_own():
    page = "<main><p>The text lies in the main part.</p><article><p>teaser</p></article></main><article><p>other</p></article>"
    assert main_text(page) == "The text lies in the main part.\n\nteaser"


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 60_000 + "x",
        "<i>" * 50_000 + "</b>" * 40_000 + "x",
        "<p><button>" + "<div>" * 60_000 + "x",
        "<table><tr><td>" * 20_000 + "x",
        "<ul><li>" * 35_000 + "x",
        "<p>" * 100_000 + "x",
        "</div>" * 50_000 + "x",
        '<a "' * 75_000,
        "<div class='a" * 20_000 + "x",
        "<a b='>" * 40_000,
        "<" * 300_000,
        "<!--" * 75_000,
        "<div " + "a " * 150_000 + ">x</div>",
        "<div " + "a" + " " * 300_000 + ">x</div>",
    ],
)
def test_time_grows_with_the_length(page):
    begun = time.process_time()
    main_text(page)
    assert time.process_time() - begun < 2.5


def brute_templates(rows, least=5):
    """Every page against every other: blocks in subtrees that five different pages of the host have go."""
    found, texts = [page_blocks(h) for _, _, h in rows], []
    hosts = [re.sub(r"^https?://([^/?#]+).*", r"\1", u or "") for _, u, _ in rows]
    for i, mine in enumerate(found):
        gone = set()
        for mark in {m for _, marks in mine for m in marks}:
            on = {join_blocks(other) for j, other in enumerate(found) if hosts[j] == hosts[i] and any(mark in marks for _, marks in other)}
            if hosts[i] and len(on) >= least:
                gone.add(mark)
        texts.append(join_blocks(mine, frozenset(gone)))
    return texts


def test_counting_like_brute_force(spark):
    rng = random.Random(8)
    parts = [f"<div class='k{i}'><div>bar {i}</div><p>line {i % 4}</p></div>" for i in range(12)]
    rows = []
    for i in range(150):
        own = "" if rng.random() < 0.2 else f"<p>own text {rng.randint(0, 60)}</p>"
        page = "".join(rng.sample(parts, rng.randint(0, 4)) + [own])
        rows += [(i, rng.choice(("http://a.com/1", "http://b.com/2?x", "http://c.com", None)), rng.choice((page, page, None, "")))] * rng.choice((1, 1, 3))
    wanted = brute_templates(rows)
    found = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in found) == sorted((r[0], t, len(t)) for r, t in zip(rows, wanted))
    assert sum(join_blocks(page_blocks(r[2])) != t for r, t in zip(rows, wanted)) > 20


def test_one_part_of_a_page_at_a_time():
    found = page_blocks("<body><div>a<div>b</div>c</div><p>d</p></body>")
    assert [t for t, _ in found] == ["a", "b", "c", "d"]
    outer = set(found[0][1])
    assert outer == set(found[2][1]) < set(found[1][1]) and not outer & set(found[3][1])
    assert join_blocks(found, frozenset(set(found[1][1]) - outer)) == "a\n\nc\n\nd"
