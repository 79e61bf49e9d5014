import html
import itertools
import random
import re

import pytest

from tidewell.llm import html_text as H, queries

SF_DIR = "/root/testdata/sf0.01"


def cost(kept, source, sink, edges):
    cut = sum(s for s, k in zip(source, kept) if not k) + sum(t for t, k in zip(sink, kept) if k)
    return cut + sum(c for a, b, c in edges if kept[a] != kept[b])


@pytest.mark.parametrize("seed", range(60))
def test_cut_has_the_least_cost(seed):
    draw = random.Random(seed)
    n = draw.randint(1, 9)
    scores = [draw.uniform(-2, 2) for _ in range(n)]
    source, sink = [max(x, 0) for x in scores], [max(-x, 0) for x in scores]
    edges = [(a, b, draw.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]
    best = min(cost(k, source, sink, edges) for k in itertools.product([False, True], repeat=n))
    assert cost(H.minimum_cut(source, sink, edges), source, sink, edges) == pytest.approx(best)


PAGE = """<html><body><header><h1>Site</h1><a href=/>Home</a></header><div id="cookie-notice">We use cookies. Accept them please.</div>
<div class="sidebar"><p>Popular posts this week are these ones here.</p></div><div class="post-content has-sidebar"><h2>Title of it</h2>
<p>First paragraph has a <a href=x>linked</a> word,\n and goes on.</p><ul><li>Item one<li>Item two</ul><p>Short.</p>
<form><label>Mail</label><input></form><div class="ad">Buy this thing now, it is great.</div><p>Last &lt;b&gt; &amp;copy; words</p></div>
<section class="comments"><article><p>Great article, thanks for writing it. I liked it.</p></article></section><footer>(c) 2020</footer>"""
CASES = [
    (1, PAGE, "Title of it\n\nFirst paragraph has a linked word, and goes on.\n\nItem one\n\nItem two\n\nShort.\n\nLast <b> &copy; words"),
    (2, None, ""), (3, "", ""), (4, "   ", ""), (5, "<div", ""), (6, "<!-- a", ""), (7, "<script>var a = '<p>b</p>'", ""),
    (8, "<main><nav>a b</nav><article><header><h1>T</h1></header><p>One &amp; two<br>three<aside>Advert here, buy it now.</aside><p>End.</article>",
     "T\n\nOne & two three\n\nEnd."),
    (9, "<article>" + "<p>Word word word.</p>" * 3000 + "</article>", "\n\n".join(["Word word word."] * 3000)),
    (10, "<p>one<p>two</p>", "one\n\ntwo"), (11, "no markup at all & so on", "no markup at all & so on"),
    (12, "<article><h1>A</h1><p style='display: none'>hidden</p><p hidden>too</p><p>seen</p></article><footer>f</footer>", "A\n\nseen"),
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: str(c[0]))
def test_pages(case):
    assert H.main_text(case[1]) == case[2]


def test_extract(spark):
    rows = [(c[0], "u", c[1], "clash") for c in CASES] + [(None, None, "<p>one</p>", "x"), (10, "u", CASES[9][1], "y")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(((r.page_id, r.text) for r in H.extract(df).collect()), key=repr)
    assert got == sorted([(c[0], c[2]) for c in CASES] + [(None, "one"), (10, "one\n\ntwo")], key=repr)
    assert H.extract(df.limit(0)).collect() == []


def article(page):
    """The text of the only article of a test page, by its known frame."""
    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", p))).strip() for p in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(p for p in parts if p)


def test_page_query(spark):
    got = queries.page_texts(spark, SF_DIR).collect()
    pages = {r.page_id: r.html for r in queries.read(spark, SF_DIR, "pages").collect()}
    assert len(got) == len(pages)
    assert all(r.text == article(pages[r.page_id]) and r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a '" * 250_000, '<a "' * 250_000, "<div>" * 200_000, "<div>x" * 150_000, "<b>" * 5_000 + "x</p>" * 150_000, "<!--" * 250_000,
    "<script>" * 120_000, "<p title='a>b" * 80_000, "<p " * 300_000 + ">", "<li>" * 200_000 + "y", "</div>" * 150_000, "<" * 1_000_000, "& " * 400_000,
    "<a \"x\" '" * 100_000, "<div class='nav'>" * 60_000 + "z",
])
def test_broken_pages_take_linear_time(page):
    import time

    started = time.perf_counter()
    H.main_text(page)
    assert time.perf_counter() - started < 8  # some tenths of a second where nothing else runs


def test_tags_of_broken_pages():
    read = lambda page: [b.text for b in H.blocks_of(page)]
    assert read("<p>a < b and c <3 d<p>e") == ["a < b and c <3 d", "e"]
    assert read("<p>one<p title='x>y'>two</p><a href=\"q>r\">three") == ["one", "two", "three"]
    assert read("<p>one</p><p title='open>two</p><p>three</p>") == ["one", "two", "three"]  # a quote left open
    assert read("<p>kept</p><p class=x") == ["kept"]
    assert read("<p>a<!-- <p>x</p> -->b</p><!---->c<!-->d") == ["ab", "cd"] or read("<p>a<!-- x -->b") == ["ab"]
    assert read("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><td>g</table>") == list("abcdefg")
    assert read("<div><p>a<div>b</div>c</div>d") == ["a", "b", "c", "d"]


ARTICLE = "<html><body><nav><a href=/>Home</a><a href=/a>About</a></nav><main><article>{}</article></main><footer>All rights reserved.</footer></body></html>"


@pytest.mark.parametrize("names", ["login-story", "search-results-text", "story social-text", "related-content", "discussion-body", "copyright-story"])
def test_subjects_of_an_article_keep_their_text(names):
    inside = f"<p>The first paragraph is here to stay.</p><div class='{names}'><p>How the login page was found by a search.</p></div><p>It ends here, as it must.</p>"
    assert H.main_text(ARTICLE.format(inside)).split("\n\n") == [
        "The first paragraph is here to stay.", "How the login page was found by a search.", "It ends here, as it must."]


@pytest.mark.parametrize("names", ["login", "related", "comment-text", "comment-body", "sidebar-content", "newsletter-text", "footer-text", "related-posts widget", "search", "cookie-content"])
def test_boilerplate_within_an_article_goes(names):
    inside = f"<p>The first paragraph is here to stay.</p><div class='{names}'><p>Something that is beside the point of it.</p></div><p>It ends here, as it must.</p>"
    assert "beside the point" not in H.main_text(ARTICLE.format(inside))


def bare(*blocks):
    """A page without names or article elements: the classifier sees text and links only."""
    return "<body><div>" + "".join(f"<p>{b}</p>" for b in blocks) + "</div></body>"


LONG = "This is a paragraph of the page, long enough to be taken for one, and it ends with a full stop as others do."
LINK = "<a href=/x>The full report of the inquiry</a>"


def test_the_cut_decides_where_the_classifier_is_not_sure():
    scores = lambda page: H.capacities(H.blocks_of(page))
    page = bare(LONG, LONG, LINK, LONG, LONG)
    assert scores(page)[2] < 0 and H.labels(H.blocks_of(page)) == [True] * 5  # kept with what is around it
    page = bare(*[LINK] * 4, "Something short.", *[LINK] * 4)
    assert scores(page)[4] > 0 and H.labels(H.blocks_of(page)) == [False] * 9
    page = bare(LONG, LONG, *[LINK] * 6, LONG, LONG)  # a list of links stays one
    assert H.labels(H.blocks_of(page)) == [True] * 2 + [False] * 6 + [True] * 2
    # what the classifier is sure of no neighbour turns
    page = "<body><main><p>{0}</p><p class=advert>Buy it. It is the best there is of all things.</p><p>{0}</p></main></body>".format(LONG)
    assert H.labels(H.blocks_of(page)) == [True, False, True]
    worst = max(sum(c for a, b, c in H.smoothness(H.blocks_of(bare(*[LONG] * 9))) if i in (a, b)) for i in range(9))
    assert worst < H.LIMIT


def test_share_of_labels_the_cut_changes_on_planted_pages():
    """Sections of text and sections of links, each with a few blocks of the other look: the cut mends most of them."""
    draw = random.Random(11)
    changed = wrong_before = wrong_after = total = 0
    for _ in range(150):
        blocks, truth = [], []
        for _ in range(draw.randint(2, 5)):
            content = draw.random() < 0.6
            for _ in range(draw.randint(4, 10)):
                odd = draw.random() < 0.08
                text = draw.choice([LONG, LONG[:70] + "."]) if content != odd else draw.choice([LINK, "<a href=/>Home</a>"])
                if odd:
                    text = LINK if content else "More of it here."
                blocks.append(text)
                truth.append(content)
        page = bare(*blocks)
        alone = [c > 0 for c in H.capacities(H.blocks_of(page))]
        cut = H.labels(H.blocks_of(page))
        changed += sum(a != b for a, b in zip(alone, cut))
        wrong_before += sum(a != t for a, t in zip(alone, truth))
        wrong_after += sum(b != t for b, t in zip(cut, truth))
        total += len(truth)
    print(f"labels changed by the cut: {changed / total:.3f}; wrong without it {wrong_before / total:.3f}, with it {wrong_after / total:.3f}")
    assert changed > 0.02 * total and wrong_after < 0.6 * wrong_before
