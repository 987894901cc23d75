"""Main text of web pages: page structure, and differences from the nearest page of the host.

A page becomes lines, one for each block of text. Structure settles many of
them: menus, headers, footers, sidebars, notices, adverts, forms, scripts and
comments go. A form, or an element whose class or id names such a part, stays
where it is the page itself: it holds most of the text, no article lies outside
of it, and an article or running text lies inside.

All pages that have lines are sorted by host and URL path, each is paired with
its neighbour of the longer common path, and the lines of both are aligned by
longest common subsequence. Shared lines belong to the site, the others are the
page's own. A neighbour that shares most of a page's text is the same page under
another address; it tells nothing of the site, so the other neighbour is taken,
or none.

The own lines say what the page is. An article element without any is a card
that other pages carry too, as long as the others hold most of the articles'
text. Where the articles left are longer than the own lines outside of articles,
they are the main text, whole: lines inside are not deleted for being shared,
because articles quote and repeat each other. Elsewhere (no article, or only a
part such as a teaser) it is the page's own lines, and with them the article
elements that have some.

Defined results: null html counts as empty and has empty text; null urls form a
host of their own; pages with equal paths pair in the order of page_id;
repeated rows are copies of each other and get equal results; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from math import isqrt
from os.path import commonprefix

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ranked
from martlake.llm.flat import small_batches

# Elements and words that mark what is not main text (fixed values).
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "xmp", "noembed", "noframes")
SKIPPED = frozenset("nav footer aside button select menu dialog object audio video canvas head".split())
FORMS = frozenset(("form", "fieldset"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary dialog alertdialog alert menu menubar toolbar".split())
FORM_ROLES = frozenset(("form", "search"))
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adbox adsense banner banners breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus footer form gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices "
    "notification pager pagination paywall popup promo promoted promotion recommended recommendations related replies respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
TOPICS = frozenset("search related share sharing social menu menus recommended recommendations navigation form widget widgets".split())  # words of subjects too
HEADERS = frozenset("header site-header page-header top-header main-header global-header".split())
NEGATED = ("has", "with", "no", "not", "is", "without")
CONTENT = frozenset("article-body articlebody post-content entry-content article-content post-body story-body main-content".split())

SAME_PAGE = 0.8  # share of a page's characters from which its neighbour counts as a copy of it
PROSE, LINKED = 200, 0.2  # characters outside of links that make running text, and the share of links that makes a list of them
BLOCK_ROWS = 512
REPEATS = 32  # pairs of equal lines for each line of two pages, above which rows of bits align them

_RAW = "|".join(RAW)
_NAME = r"[a-zA-Z][^\s/>]*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    rf"|<(?P<end>/?)(?P<name>{_NAME})(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    rf"|</?{_NAME}[^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _mark(tokens: list[str], ids: list[str], name: str) -> str:
    """What the words of an element's class and id make of it: "comment", "topic", "word", "compound" or ""."""
    found = []
    for token in tokens + ([] if name in HEADINGS else ids):  # a heading's id is an anchor
        words = re.split(r"[-_]+", token)
        marked = WORDS.intersection(words) if name != "article" and words[0] not in NEGATED else WORDS.intersection((token,))
        if not marked:
            continue
        if not marked.isdisjoint(COMMENTS):
            return "comment"
        whole = token in WORDS
        found.append("topic" if marked <= TOPICS and (not whole or token not in tokens) else "word" if whole else "compound")
    return next((mark for mark in ("word", "compound", "topic") if mark in found), "")


def _zone(name: str, attrs: dict[str, str], in_article: bool) -> tuple[str, str]:
    """"skip", "article" or "" (as around it) for an element, and its mark: one that only the page's text as a whole settles."""
    if not attrs:
        if name in FORMS:
            return "", "form"
        return "skip" if name in SKIPPED or name == "header" and not in_article else "article" if name in ("article", "main") else "", ""
    tokens, ids = attrs.get("class", "").lower().split(), attrs.get("id", "").lower().split()
    role = attrs.get("role", "").lower()
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return "skip", ""
    if name in SKIPPED or role in ROLES or not in_article and (name == "header" or not HEADERS.isdisjoint(tokens + ids)):
        return "skip", ""
    mark = _mark(tokens, ids, name) if name not in ("html", "body", "main") else ""
    if mark != "comment" and (name in FORMS or role in FORM_ROLES):
        mark = "form"
    both = tokens + ids
    if name in ("article", "main") or role in ("main", "article") or attrs.get("itemprop", "").lower() == "articlebody" or not CONTENT.isdisjoint(both):
        return "article", mark
    return "", mark


@dataclass
class _Marked:
    """A marked element: its characters, those of articles in it, those in links, and whether its lines stay."""

    around: int  # the marked element around it, or -1
    mark: str
    in_article: bool
    own_article: int = 0  # outside of the marked elements inside it
    chars: int = 0
    article: int = 0
    linked: int = 0
    stays: bool = False

    @property
    def prose(self) -> bool:
        return self.chars - self.linked >= PROSE


def _settle(marked: list[_Marked], total: int, outside: int) -> None:
    """Decides which marked elements stay; ``outside`` counts the characters of articles outside of all of them.

    One stays where it is the page and not a part of it: it holds most of the
    text, no article lies outside, and an article or running text lies inside.
    So does a part of an article whose name is about the subject (related work,
    search results) and which holds running text and few links.
    """
    for m in reversed(marked):  # those around come first in the list
        m.article += m.own_article
        if m.around >= 0:
            around = marked[m.around]
            around.chars, around.article, around.linked = around.chars + m.chars, around.article + m.article, around.linked + m.linked
    for m in marked:
        if m.around >= 0 and not marked[m.around].stays:
            continue
        if m.mark == "topic" and m.in_article and m.prose and m.linked < LINKED * m.chars:
            m.stays = True
        elif m.mark != "comment" and not outside and 2 * m.chars > total:
            m.stays = m.article > 0 or m.mark != "word" and m.prose
        if m.stays:
            outside += m.own_article


def blocks(page: str) -> list[tuple[str, int]]:
    """The lines that structure leaves, each with the number of the article element that it is in, or 0."""
    found: list[tuple[str, int, int]] = []  # text, article, marked element around
    marked: list[_Marked] = []
    stack: list[tuple[str, str, int, int]] = []  # name, zone, marked element and article of open elements
    zone, inside, article, articles, links, linked, parts = "", -1, 0, 0, 0, 0, []

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            found.append((text, article, inside))
            if inside >= 0:
                own = marked[inside]
                own.chars, own.linked = own.chars + len(text), own.linked + min(linked, len(text))
                own.own_article += len(text) if zone == "article" else 0
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        parts.append(html.unescape(raw))
        if links:
            linked += len(parts[-1])

    def close(k: int) -> None:
        nonlocal links
        links -= sum(e[0] == "a" for e in stack[k:])
        del stack[k:]

    at = 0
    for m in TOKEN.finditer(page):
        if zone != "skip" and m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS or name in SKIPPED:
            flush()
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
        elif name not in VOID and not m["attrs"].endswith("/"):
            if name in BLOCKS:  # an open paragraph ends here
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in BLOCKS:
                        break
            _, around, within, which = stack[-1] if stack else ("", "", -1, 0)
            own, mark = ("skip", "") if around == "skip" else _zone(name, _attributes(m["attrs"]), around == "article")
            own = own or around
            if mark and own != "skip":
                marked.append(_Marked(within, mark, around == "article"))
                within = len(marked) - 1
            if (own, within) != (zone, inside):
                flush()
            if own == "article" and (around != "article" or name == "article"):
                articles += 1
                which = articles
            stack.append((name, own, within, which if own == "article" else 0))
            links += name == "a"
        _, new, within, which = stack[-1] if stack else ("", "", -1, 0)
        if (new, within) != (zone, inside):
            flush()
            zone, inside = new, within
        article = which
    if zone != "skip":
        add(page[at:])
    flush()
    _settle(marked, sum(len(text) for text, *_ in found), sum(len(text) for text, which, m in found if which and m < 0))
    return [(text, which) for text, which, m in found if m < 0 or marked[m].stays]


def main_places(sizes: list[int], articles: list[int], shared: list[int]) -> list[int]:
    """Places of the main text among a page's lines, of which those at ``shared`` are the site's."""
    gone, held, own = set(shared), Counter(), Counter()
    for i, (size, which) in enumerate(zip(sizes, articles, strict=True)):
        held[which] += size
        own[which] += size if i not in gone else 0
    whole = {which for which in held if which and own[which]}
    outside, text, in_whole = held[0], sum(held[w] for w in held if w), sum(held[w] for w in whole)
    if 2 * in_whole > text:
        if in_whole > own[0]:
            return [i for i, which in enumerate(articles) if which in whole]
    elif text > outside:  # the page's article has another address too
        return [i for i, which in enumerate(articles) if which]
    return [i for i, which in enumerate(articles) if i not in gone or which in whole]


def lines(page: str) -> tuple[list[str], list[int]]:
    """The main lines of a page without neighbours, and their places among the lines that structure leaves."""
    found = blocks(page)
    places = main_places([len(text) for text, _ in found], [which for _, which in found], [])
    return [found[i][0] for i in places], places


def _aligned_rows(a: list[int], b: list[int], places: dict[int, list[int]]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by rows of bits: for lines that repeat, each of many places."""
    full, size = (1 << len(b)) - 1, isqrt(len(a)) + 1

    @lru_cache(256)
    def mask(x: int) -> int:
        bits = bytearray(len(b) // 8 + 1)
        for j in places.get(x, ()):
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    def rows(row: int, lines_of: list[int]) -> Iterator[int]:
        """A zero in the row after a line of ``a``: there the subsequence with that much of ``b`` grows by one."""
        for x in lines_of:
            hits = row & mask(x)
            row = ((row + hits) | (row - hits)) & full
            yield row

    kept = [full, *islice(rows(full, a), size - 1, None, size)]  # every size-th row; those between are made again
    found, end = [], len(b)
    for k in range((len(a) - 1) // size, -1, -1):
        part = [kept[k], *rows(kept[k], a[k * size : (k + 1) * size])]
        for i in range(len(part) - 1, 0, -1):
            end = (~part[i] & ((1 << end) - 1)).bit_length()
            if not end:
                return found[::-1]
            if part[i - 1] >> (end - 1) & 1:
                found.append(k * size + i - 1)
                end -= 1
    return found[::-1]


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places = defaultdict(list)
    for j in range(head, len(b) - tail):
        places[b[j]].append(j - head)
    middle_a, middle_b = a[head : len(a) - tail], b[head : len(b) - tail]
    if sum(len(places.get(x, ())) for x in middle_a) > REPEATS * (len(middle_a) + len(middle_b)):
        return [*range(head), *(head + i for i in _aligned_rows(middle_a, middle_b, places)), *range(len(a) - tail, len(a))]
    ends: list[int] = []  # least end in b of a subsequence of each length
    links: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in reversed(places.get(a[i], ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    middle, link = [], links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def shared_lines(own: list[int], sizes: list[int], neighbours: list[list[int]]) -> list[int]:
    """Places of lines that the first neighbour which is no copy of the page shares."""
    total = sum(sizes)
    for other in neighbours:
        shared = common_subsequence(own, other)
        if sum(sizes[i] for i in shared) < SAME_PAGE * total:
            return shared
    return []


def _path_key(url: F.Column) -> tuple[F.Column, F.Column]:
    parts = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.coalesce(F.lower(parts), F.lit("")), F.coalesce(path, F.lit(""))


def _stays(pages: DataFrame) -> DataFrame:
    """For each page that loses lines, by its key: whether each of its lines stays."""
    found = F.split("text", "\n")
    lines_of = pages.filter(F.size("articles") > 0).select(
        "key",
        "page_id",
        *[c.alias(n) for c, n in zip(_path_key(F.col("url")), ("host", "path"), strict=True)],
        F.transform(found, lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform(found, F.char_length).alias("sizes"),
        "articles",
    )
    # neighbours in the order of host and path: blocks of ranks, each with the row before and the row after it
    order = ranked(lines_of.dropDuplicates(["key"]), ["host", "path", "page_id", "key"], "page-lines")
    block = F.floor(F.col("rank") / BLOCK_ROWS)
    spread = order.withColumn("block", F.explode(F.array_distinct(F.array(*[F.floor((F.col("rank") + d) / BLOCK_ROWS) for d in (-1, 0, 1)]))))
    spread = spread.withColumn("own", F.col("block") == block)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank", ignore_index=True)
        ranks, hosts, paths, keys = (group[c].tolist() for c in ("rank", "host", "path", "key"))
        hashes, sizes, articles = ([x.tolist() for x in group[c]] for c in ("hashes", "sizes", "articles"))
        out = []
        for i in group.index[group["own"]]:
            near = []
            for j in (i - 1, i + 1):
                if 0 <= j < len(ranks) and abs(ranks[j] - ranks[i]) == 1 and hosts[j] == hosts[i]:
                    near.append((-len(commonprefix((paths[i], paths[j]))), j))
            shared = shared_lines(hashes[i], sizes[i], [hashes[j] for _, j in sorted(near)])
            places = set(main_places(sizes[i], articles[i], shared))
            if len(places) < len(sizes[i]):
                out.append((keys[i], [k in places for k in range(len(sizes[i]))]))
        return pd.DataFrame(out, columns=["key", "stays"])

    return spread.groupBy("block").applyInPandas(compare, "key long, stays array<boolean>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of all pages.

    Pages are parsed twice, for the comparison and for the text: only hashes of
    lines are stored and sorted, and each text is shuffled once.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 128):
            found = [blocks(page) for page in batch.column(2).to_pylist()]
            # a line holds no line end, so that the joined text gives the lines back
            text = pa.array(["\n".join(x for x, _ in lines_of) for lines_of in found], pa.string())
            articles = pa.array([[which for _, which in lines_of] for lines_of in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text, articles], ["page_id", "url", "text", "articles"])

    parsed = rows.mapInArrow(parse, "page_id long, url string, text string, articles array<int>")
    parsed = parsed.withColumn("key", F.xxhash64("page_id", "url", "text", "articles"))
    main = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: F.get("stays", i)), "\n")
    both = parsed.drop("articles").join(_stays(parsed), "key", "left").withColumn("text", F.when(F.col("stays").isNull(), F.col("text")).otherwise(main))
    return both.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
