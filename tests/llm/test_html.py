from __future__ import annotations

import itertools
import random
import re
import time

import pytest

from martlake.llm import html_text
from martlake.llm.queries import op8_html_text

SCHEMA = "page_id long, url string, html string, text string"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("plain", ["plain"]),
        ("<article><h1>T</h1><p>a&nbsp;b <a href='x'>link</a>s<p>c</article>", ["T", "a b links", "c"]),
        ("<header>H</header><nav>N</nav><main><p>x</p><aside>A</aside><form>F</form></main><footer>F</footer>", ["x"]),
        ("<article><header><h1>T</h1></header><p>x<footer>by</footer></article>", ["T", "x"]),
        ("<article><p>a<div class='comments'><p>c</div><p>b</article><section id=comments><p>no</section>", ["a", "b"]),
        ("<div class='ad'>buy</div><div class='cookie-notice'>ok?</div><article class='post with-sidebar'>x</article>", ["x"]),
        ("<article>x</article><article class='comment'>reader</article>", ["x"]),
        ("<article>a<script>if (a < b) { '</p>' }</script>b<style>p{}</style><!-- <p>c</p> -->d</article>", ["abd"]),
        ("<article>a<br>b<wbr>c<hr>d</article>", ["a bc", "d"]),
        ("<article>1 &lt; 2 &amp;amp; &#233;&#x1F600; &am &copy 5 < 6</article>", ["1 < 2 &amp; é😀 &am © 5 < 6"]),
        ("<article><p>open <b>bold <p>next</article>tail", ["open bold", "next"]),
        ("<article><img alt='a>b'>x<input value=\"</article>\">y</article>", ["xy"]),
        ("<div role=main><p>x</div><div role='navigation'>n</div><div hidden>h</div><div style='display: none'>s</div>", ["x"]),
        ("<ARTICLE><P>Caps</P></ARTICLE>", ["Caps"]),
        ("<article>cut <p", ["cut"]),
        ("<article><table><tr><td>1<td>2</table><ul><li>a<li>b</ul></article>", ["1", "2", "a", "b"]),
        ("<!DOCTYPE html><?xml x?><html><head><title>t</title></head><body class='has-menu'><p>x</p></body></html>", ["x"]),
        ("<article>a<noscript>n</noscript><button>b</button><iframe>i</iframe><template><p>t</template></article>", ["a"]),
        ("<article>a<svg-icon name=x></svg-icon><p>rest</article>", ["a", "rest"]),
        ("<article><title-bar>b</title-bar><style-guide>c</style-guide><p>rest</article>", ["bc", "rest"]),
        ("<article>a<svg width=1 /><p>rest</article>", ["a", "rest"]),
        ("<article>a<math/><svg/><svg title='a>b' /><p>rest</article>", ["a", "rest"]),
        ("<article>a<svg ><text>t</text><path /></svg><p>rest</article>", ["a", "rest"]),
        ("<article>a<script src=/a/></script><p>rest</article>", ["a", "rest"]),
        ("<body><form><article>story</article></form></body>", ["story"]),
        ("<form><nav>n</nav><div>menu</div><article>a story</article><div class=comments><article>a long comment</article></div></form>", ["a story"]),
        (f"<form id=aspnet><div>{'story ' * 40}</div></form>", ["story " * 39 + "story"]),
        ("<form>User <input> Password <input></form>", []),
        (f"<div class=content-sidebar-wrap><div>{'story ' * 40}</div><div class=sidebar>s</div></div>", ["story " * 39 + "story"]),
        ("<div class=widget><article>story</article></div><div class=ad>a</div>", ["story"]),
        ("<div class=comments>many words by readers</div><article>x</article><form>and a long, long form</form>", ["x"]),
        (f"<article><p>a<section class=related-work><p>{'prose ' * 40}</section><p>b</article>", ["a", "prose " * 39 + "prose", "b"]),
        (f"<article><p>a<section id=share><h2 id=search>S</h2><p>{'prose ' * 40}</section><p>b</article>", ["a", "S", "prose " * 39 + "prose", "b"]),
        (f"<article><p>a<div class=related-posts><a>{'title ' * 20}</a><p>{'prose ' * 40}</div><p>b</article>", ["a", "b"]),
        (f"<article><p>a<div class=share>{'share ' * 40}</div><div class=ad-box>{'buy ' * 80}</div><div class=share-bar>x</div></article>", ["a"]),
        ("<form>" * 3000 + "deep <a>" * 3000 + "x", []),
    ],
)
def test_lines(page, want):
    assert html_text.lines(page)[0] == want


def brute_lcs(a, b):
    for size in range(min(len(a), len(b)), -1, -1):
        subs = {tuple(b[i] for i in c) for c in itertools.combinations(range(len(b)), size)}
        if any(tuple(a[i] for i in c) in subs for c in itertools.combinations(range(len(a)), size)):
            return size
    return 0


def test_common_subsequence_is_longest():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randint(0, 8))] for _ in range(2))
        places = html_text.common_subsequence(a, b)
        assert places == sorted(set(places)) and len(places) == brute_lcs(a, b)
        it = iter(b)
        assert all(a[i] in it for i in places)


def test_repeated_lines_align_by_rows(monkeypatch):
    rnd = random.Random(4)
    monkeypatch.setattr(html_text, "REPEATS", -1)
    for _ in range(200):
        a, b = ([rnd.randrange(3) for _ in range(rnd.randint(0, 8))] for _ in range(2))
        places = html_text.common_subsequence(a, b)
        assert places == sorted(set(places)) and len(places) == brute_lcs(a, b)
        it = iter(b)
        assert all(a[i] in it for i in places)


def test_tables_of_equal_cells_align_in_time():
    rnd = random.Random(5)
    a, b = ([rnd.randrange(3) for _ in range(20_000)] for _ in range(2))
    start = time.perf_counter()
    places = html_text.common_subsequence(a, b)
    assert time.perf_counter() - start < 30 and len(places) > 10_000  # some 130 million pairs of equal lines
    it = iter(b)
    assert all(a[i] in it for i in places)


@pytest.mark.parametrize(
    ("sizes", "articles", "shared", "want"),
    [
        ([], [], [], []),
        ([5, 9, 5], [0, 1, 1], [], [1, 2]),  # an article
        ([5, 9, 5], [0, 1, 1], [1], [1, 2]),  # that quotes
        ([5, 9, 5], [0, 1, 1], [1, 2], [1, 2]),  # or has another address
        ([50, 9, 5], [0, 1, 1], [], [0, 1, 2]),  # a part of the page
        ([50, 9, 5], [0, 1, 1], [1], [0, 1, 2]),  # that quotes
        ([50, 9, 5], [0, 1, 1], [0, 2], [1, 2]),  # whose other lines are the site's
        ([50, 9], [0, 1], [1], [0]),  # a teaser
        ([9, 5], [1, 2], [1], [0]),  # a card beside an article
        ([9, 5, 2], [1, 2, 0], [0], [0, 1]),  # an article with another address beside a card
        ([5, 9, 5], [0, 0, 0], [0, 2], [1]),  # no article
    ],
)
def test_main_places(sizes, articles, shared, want):
    assert html_text.main_places(sizes, articles, shared) == want


def site_page(i, body, host="h.example"):
    return (i, f"http://{host}/news/{i:04d}", f"<div>Site name</div><div>Latest stories</div><div>{body}</div><div>All rights, always</div>", "clash")


def text_of(rows):
    return {(r.page_id, r.url): r.text for r in rows}


def test_lines_that_neighbours_share_go(spark):
    rows = [site_page(i, f"story {i} " + "word " * 20 + str(i)) for i in range(40)]
    rows.append((100, "http://alone.example/x", "<div>Site name</div><div>only here</div>", None))
    # the same page under a second address, right beside it
    rows.append((101, "http://h.example/news/0007?utm=1", rows[7][2], None))
    got = text_of(html_text.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect())
    for i in range(40):
        assert got[(i, rows[i][1])] == f"story {i} " + "word " * 20 + str(i)
    assert got[(101, rows[41][1])] == got[(7, rows[7][1])]
    assert got[(100, "http://alone.example/x")] == "Site name\nonly here"


def test_neighbours_across_blocks(spark, monkeypatch):
    rows = [site_page(i, f"story {i} " + "word " * 20 + str(i)) for i in range(30)]
    monkeypatch.setattr(html_text, "BLOCK_ROWS", 1)
    got = text_of(html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect())
    assert all(v.startswith("story") and "\n" not in v for v in got.values()) and len(got) == 30


def test_articles_keep_lines_that_others_have(spark):
    rows = [(i, f"http://h/{i}", f"<div>menu</div><article><p>Shared quote.</p><p>own {i}</p></article>", None) for i in range(10)]
    got = html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.text == f"Shared quote.\nown {r.page_id}" and r.n_chars == len(r.text) for r in got)


def test_teasers_do_not_settle_a_page(spark):
    teaser = "<article class=card>Read next</article>"
    rows = [(i, f"http://h/{i}", f"<div>Site name</div><div>story {i} {'word ' * 20}{i}</div>{teaser}", None) for i in range(10)]
    got = html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 10 and all(r.text == f"story {r.page_id} {'word ' * 20}{r.page_id}" for r in got)


def test_pages_with_articles_are_differenced(spark):
    story = ["<p>Shared quote.</p><p>story {0} {1}{0}</p>".format(i, "word " * 20) for i in range(10)]
    want = [f"Shared quote.\nstory {i} {'word ' * 20}{i}" for i in range(10)]
    # articles that other pages carry too, and text outside that is longer than the article and the site's
    card, site = "<article class=card>Most read: elsewhere</article>", f"<div>{'About this site. ' * 9}</div>"
    rows = [(i, f"http://cards/{i}", f"<article>{story[i]}{card}</article>{card}", None) for i in range(10)]
    rows += [(10 + i, f"http://site/{i}", f"{site}<article>{story[i]}</article>", None) for i in range(10)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert got == {i: want[i % 10] for i in range(20)}


def test_articles_without_neighbours_stay(spark):
    card = "<article class=card>Most read: elsewhere</article>"
    pages = [f"<article>story {i} {'word ' * 20}{i}</article>{card}" for i in range(2)]
    # hosts of one page, and a page under two addresses
    rows = [(i, f"http://host{i}/x", pages[i], None) for i in range(2)] + [(2 + i, f"http://two/{i}", pages[0], None) for i in range(2)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"story {i % 2 if i < 2 else 0} {'word ' * 20}{i % 2 if i < 2 else 0}\nMost read: elsewhere" for i in range(4)}


def test_edge_rows(spark):
    rows = [(None, None, None, None), (None, None, "<p>x</p>", "t"), (1, "not a url", "", None), (1, "not a url", "", None), (2**60 + 1, "", "<article>é😀</article>", None), (3, "http://h/", "<p>" + "long " * 100_000, None)]
    got = sorted(((r.page_id, r.url, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(None, None, 0), (None, None, 1), (1, "not a url", 0), (1, "not a url", 0), (2**60 + 1, "", 2), (3, "http://h/", 499_999)], key=str)
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, tables):
    import html

    got = {r.page_id: r for r in op8_html_text(spark, "/root/testdata/sf0.01").collect()}
    pages = tables("pages")
    assert len(got) == len(pages)
    for p in pages:  # these pages are simple enough for a pattern
        article = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", article))
        want = "\n".join(b for b in blocks if b)
        assert got[p["page_id"]].text == want and got[p["page_id"]].n_chars == len(want)
