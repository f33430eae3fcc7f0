"""Main texts of pages with known content, and the minimum cut against all labellings."""

from itertools import product

import numpy as np
import pytest

from candlewick.llm import html_extract as he

WEIGHTS = he.train(np.zeros((0, he.FEATURES)), np.zeros(0))

HEAD = "<!DOCTYPE html><html><head><title>A title, not text.</title><style>p{margin:0}</style><script>var t='</p>';</script></head>"
PAGES = [
    (HEAD + """<body class="page has-sidebar"><header class="site-header"><a href="/">Site</a><p>Our slogan is long and has words.</p></header>
     <nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><div id="cookie-notice"><p>We use cookies, many of them. Accept all?</p></div>
     <main><article><h1>The &amp; heading</h1><p>First   <b>bold</b>
     paragraph&nbsp;here.<br>Second line.<p>Unclosed second paragraph.<aside><p>An aside with a long text of its own, really.</p></aside>
     <blockquote>A quote.</blockquote><ul><li>An item</li><li>Another</li></ul></article>
     <section class="comments"><h2>Comments</h2><p>I liked this article a lot, it has words.</p></section></main>
     <div class="sidebar"><p>Related posts and other things, in a sidebar.</p></div><form><label>Mail</label><input name=q></form>
     <div class="ad">Buy this thing now, it is good.</div><footer>&copy; 2024 somebody</footer></body></html>""",
     "The & heading\n\nFirst bold paragraph here. Second line.\n\nUnclosed second paragraph.\n\nA quote.\n\nAn item\n\nAnother"),
    (HEAD + """<body><div class="nav">Home | About</div><div class="article-body"><p>Only a text in a division, long enough to be one.</p>
     <!-- <p>a comment</p> --><p>5 &lt; 6 &amp;&amp; 7 > 3</p></div><div class="footer">Imprint</div>""",
     "Only a text in a division, long enough to be one.\n\n5 < 6 && 7 > 3"),
    ("<p>A bare paragraph without any page around it, and it is long enough to count as text.", "A bare paragraph without any page around it, and it is long enough to count as text."),
    ("<body><article><div class='header'><h1>Title here</h1></div><p>Words of the text, some of them.</p><div class='share'>Share this</div></article></body>",
     "Title here\n\nWords of the text, some of them."),
    ("<html><body><div><a href=/>Home</a> <a href=/a>About</a> <a href=/b>Contact us</a></div><div><h1>The title of the story</h1><p>First paragraph with "
     "a good number of words, and some commas, to read.</p><p>Second one.</p><p>Third paragraph also has many words in it. It goes on and on for a while."
     "</p></div><div><a href=x>Privacy</a> | <a href=y>Imprint</a> &copy; 2024</div></body></html>",
     "The title of the story\n\nFirst paragraph with a good number of words, and some commas, to read.\n\nSecond one.\n\n"
     "Third paragraph also has many words in it. It goes on and on for a while."),
    ("<table><tr><td><a href=1>Menu one</a></td></tr><tr><td>The main text of this old page is in a table cell, with sentences. Many of them.</td></tr></table>",
     "The main text of this old page is in a table cell, with sentences. Many of them."),
    ("<article><p>unfinished <b>markup <i", "unfinished markup <i"), ("", ""), (None, ""), ("<html><body></body></html>", ""),
    ("<article>" + "<p>many words in here.</p>" * 4000 + "</article>", "\n\n".join(["many words in here."] * 4000)),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_pages(page, text):
    assert he.main_text(page or "", WEIGHTS) == text


def test_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(i, f"u{i}", p, "own", "own") for i, (p, _) in enumerate(PAGES)] + [(None, None, PAGES[1][0], None, None), (1, "u1", PAGES[1][0], None, None)]
    df = spark.createDataFrame(rows, schema)
    assert he.fit(df).shape == (he.FEATURES,)
    got = he.extract(df, WEIGHTS).collect()
    want = [(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(None, None, PAGES[1][1], len(PAGES[1][1])), (1, "u1", PAGES[1][1], len(PAGES[1][1]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    none = spark.createDataFrame([], schema)
    assert he.extract(none, he.fit(none)).collect() == []


def test_given_pages(spark, sf):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in he.op7_html(spark, sf).collect():
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_fitted_weights(spark, sf, page, text):
    if not hasattr(test_fitted_weights, "weights"):
        test_fitted_weights.weights = he.fit(spark.read.parquet(f"{sf}/pages.parquet"))
    assert he.main_text(page or "", test_fitted_weights.weights) == text


@pytest.mark.parametrize("seed", range(40))
def test_minimum_cut(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 9))
    excess = np.round(rng.normal(0, 2, n), 2)
    edges = [(i, j, round(float(rng.random()), 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]

    def cost(labels):  # what a labelling pays: the cheaper terminal given up, and cut edges
        own = sum(max(e, 0) if not x else max(-e, 0) for e, x in zip(excess, labels, strict=True))
        return own + sum(c for a, b, c in edges if labels[a] != labels[b])

    got = he.max_flow_labels(excess, edges).tolist()
    assert abs(cost(got) - min(map(cost, product([False, True], repeat=n)))) < 1e-9


def test_training():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, he.FEATURES - 1))])
    y = (x[:, 1] - x[:, 2] > 0).astype(float)
    assert ((x @ he.train(x, y) > 0) == y).mean() > 0.9


TEXT = "<h1>The title of it</h1><p>A paragraph of the article with a number of words, commas, and an end. Another sentence follows, so that it has the length of one.</p><p>The second paragraph is shorter, with less.</p>"
WANT = "The title of it\n\nA paragraph of the article with a number of words, commas, and an end. Another sentence follows, so that it has the length of one.\n\nThe second paragraph is shorter, with less."


@pytest.mark.parametrize("opening", [
    '<article class="post category-legal">', '<article class="post tag-privacy">', '<article class="post comments-open">', '<article class="legal">',
    '<article class="category-advertising">', '<main class="privacy">', '<main id="main" class="search-form">', '<div class="post category-legal">',
    '<div class="entry comments-closed no-sidebar">', '<div class="legal"><main>', '<div class="post legal">', '<div class="ads"><article>'])
def test_names_of_boilerplate_on_articles(opening):
    page = f'<body><nav><a href="/">Home</a></nav>{opening}{TEXT}</article></main></div><div class="comments"><p>A comment, it has words.</p></div></body>'
    assert he.main_text(page, WEIGHTS) == WANT


def test_name_is_a_finite_vote():
    """Within an article, text outweighs the name of a paragraph, but not that of a container, nor an element."""
    note = "A note of the article, of a length that no label has, with commas, and sentences. It goes on for quite a while, and then it ends. " * 3
    page = "<article><p>First paragraph, of some words.</p>{}<p>Last paragraph, of some words.</p></article>"
    kept = ["First paragraph, of some words.", note.strip(), "Last paragraph, of some words."]
    assert he.main_text(page.format(f'<p class="notice">{note}</p>'), WEIGHTS) == "\n\n".join(kept)
    for other in (f"<aside>{note}</aside>", '<p class="ad">Buy it</p>', f'<div class="comments"><p>{note}</p><p>{note}</p></div>'):
        assert he.main_text(page.format(other), WEIGHTS) == "\n\n".join(kept[::2])


@pytest.mark.parametrize(("inside", "text"), [
    ('<svg class="i"/> Two.', "Two."), ("<math/>Two.", "Two."), ("<SVG/>Two.<svg><path/></svg>", "Two."), ("<svg><svg><text>a</text></svg>b</svg>Two.", "Two."),
    ("<svg><title/><style/><path/></svg>Two.", "Two."), ("<svg><title>no</title><path/></svg>Two.", "Two."), ("Two <button>label", "Two label"),
    ("Two <button>label</button>.", "Two ."), ("Two <button>label <button>other</button>.", "Two label ."), ("Two <canvas>drawn", "Two drawn"),
    ("Two <object>own <b>text</b>", "Two own text"), ("Two <object data=x>own text</object>.", "Two own text."), ("Two <video src=x>fallback</video>.", "Two fallback."),
    ("Two <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.", "Two x=2."), ("Two <select><option>a<option>b</select>.", "Two ."),
    ("Two <template><p>no</p><template>no</template></template>.", "Two ."), ("Two <template>open", "Two open"),
    ("Two <script>if (a < b) '<p>' </script>.", "Two ."), ("Two <noscript><p>no</p></noscript><iframe src=x>no</iframe><textarea><p></textarea>.", "Two ."),
    ("Two <script>'<svg>'</script>. <!-- <button> -->", "Two .")])
def test_elements_that_do_not_swallow(inside, text):
    page = f"<article><p>One.</p><p>{inside}</p><p>Three.</p></article>"
    assert he.main_text(page, WEIGHTS) == f"One.\n\n{text}\n\nThree."


def test_unclosed_raw_and_many_openings():
    assert he.main_text("<article><p>One.</p><script>rest <p>no</p></article>", WEIGHTS) == "One."
    assert he.main_text("<article><p>One" + "<button>a" * 30_000 + "</article>", WEIGHTS) == "One" + "a" * 30_000


LONG_PARAGRAPH = "<p>" + "The history of the town is long, and it is told in many books. It was made by hand, of red cloth. " * 4 + "</p>"


@pytest.mark.parametrize(("page", "has", "lacks"), [
    ("<article><p title=it's>First one is long enough, really it is.</p><p>It's the second, and it goes on.</p></article>", ["First one", "It's the second"], []),
    ("<article><p class=\"a>b\" id='c>d'>Some words, as they come.</p></article>", ["Some words"], ["b\"", "d'"]),
    ("<article><p a=b\"c>Some words, as they come.</p></article>", ["Some words"], []),
    ("<article><p a = 'x' b>Some words, as they come.</p></article><!-- no end > here", ["Some words"], ["no end"]),
    ("<article><p>Some words.</p><!-- a > b --><p>More words.</p><![CDATA[ c > d", ["Some words", "More words"], ["a >", "c >"]),
])
def test_attributes_and_comments_as_html_reads_them(page, has, lacks):
    text = he.main_text(page, he.GENERAL)
    assert all(h in text for h in has) and not any(x in text for x in lacks)


@pytest.mark.parametrize("opening", ["<section id=banner-history>", '<div class="cookie-recipes">', '<div class="menu-of-the-day">'])
def test_a_page_that_a_name_would_empty(opening):
    """The only long text of a page is its main text, whatever the name around it; beside other content the name counts."""
    closing = "</section>" if "section" in opening else "</div>"
    alone = f"<body><nav><a href=x>Home</a></nav>{opening}{LONG_PARAGRAPH}{closing}<footer>&copy; 2024 us</footer></body>"
    assert he.main_text(alone, he.GENERAL).startswith("The history") and "2024" not in he.main_text(alone, he.GENERAL)
    beside = f"<body><article><p>Something else altogether, and it is told at length.</p></article>{opening}{LONG_PARAGRAPH}{closing}</body>"
    assert "The history" not in he.main_text(beside, he.GENERAL)


@pytest.mark.parametrize("part", ["<a x ", "<a x=\"", "<!", "<!-- ", "</", "<div></p>", "<div>", "<svg>", "<script>", "<p>t</p><!--", "<a 'x "])
def test_very_long_malformed_pages(part):
    """Half a million signs of each take no more than seconds."""
    import time

    t0 = time.process_time()
    he.main_text(part * (500_000 // len(part)), he.GENERAL)
    assert time.process_time() - t0 < 10
