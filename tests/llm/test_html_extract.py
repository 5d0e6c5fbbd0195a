from __future__ import annotations

import math
import random
import time
from collections import Counter, defaultdict

import pytest

from casebook.llm import html_extract
from casebook.llm.html_extract import Page

SF = "/root/testdata/sf0.01"


def text_of(source):
    return "\n".join(t for _, t, _ in Page(source).kept())


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b <b>c\n  d<p", "a\nb c d"),
        ("<div>one<p>two</div>three", "one\ntwo\nthree"),
        ("<script>var t='</p>';x", ""),
        ("<p>a<script>1<2</script>b<style>p{}</style><!-- no <p> -->c</p>", "abc"),
        ("<nav>menu</nav><article><h1>T&eacute;</h1><p>x&nbsp;y<br>z</p><aside>no</aside></article><p>outside</p>", "Té\nx y z"),
        ("<main><div class='ad'>buy</div><ul><li>1<li>2</ul><section id=comments><p>no</p></section></main>", "1\n2"),
        ("<body><header>site</header><p>kept</p><form><p>no</p></form><footer>no</footer></body>", "kept"),
        ('<p title="a>b">c</p><p hidden>d</p><div role=navigation>e</div>', "c"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
        ("<article><p>a &lt;b&gt; &#233; &amp</p></article>", "a <b> é &"),
    ],
)
def test_blocks(source, text):
    assert text_of(source) == text


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "x") for k, u, h in rows], "page_id long, url string, html string, HTML string")


def test_repeated_branches_are_removed_and_articles_stay(spark):
    rows = []
    for host, count in (("a.org", 28), ("b.org", 3)):
        for i in range(count):
            own = f"<div class='body'><p>Words of page {i} at {host}.</p><p>More words {i * 7}.</p></div>"
            rows.append((len(rows), f"http://{host}/{i}", f"<div class='strip'><p>Our site uses things.</p></div>{own}"))
    rows += [(100 + i, "http://c.org/1", "<article><p>The same article on all pages.</p></article>") for i in range(9)]
    found = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()}
    assert all(found[i] == f"Words of page {i} at a.org.\nMore words {i * 7}." for i in range(28))
    assert all(found[100 + i] == "The same article on all pages." for i in range(9))
    assert all("Words of page" in found[28 + i] for i in range(3))


def test_entropy(spark):
    rows = [("t", "p", v) for v in (1, 1, 2, 2)] + [("t", "q", 1)] * 3 + [("t", "r", v) for v in range(5)] + [("t", "s", 1)]
    found = html_extract.entropy(spark.createDataFrame(rows, "tree string, path string, value long"), ["tree", "path"], "content")
    values = {r.path: round(r.content, 6) for r in found.collect()}
    assert values == {"p": 0.5, "q": 0.0, "r": 1.0, "s": 1.0}


def test_edge_rows(spark):
    rows = [(1, None, None), (None, "no host", "<p>x"), (2, "http://h/", "<p>" * 3000 + "deep"), (2, "http://h/", "<div>" * 3000 + "deep")]
    rows += [(3, "http://h/", "<p>" + "long word " * 50_000)]
    found = html_extract.extract(pages(spark, rows)).collect()
    assert sorted((r.page_id or 0, len(r.text), r.n_chars) for r in found) == [(0, 1, 1), (1, 0, 0), (2, 4, 4), (2, 4, 4), (3, 499_999, 499_999)]
    assert html_extract.extract(pages(spark, rows).limit(0)).count() == 0


def test_query_keeps_articles_only(spark):
    found = html_extract.op9_html_extract(spark, SF).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(found) == len(source)
    for r in found:
        assert "©" not in r.text and "track(" not in r.text and "<p>" not in r.text
        assert r.n_chars == len(r.text) > 0
        paragraphs = source[r.page_id].split("<article>")[1].split("</article>")[0].count("<p>")
        assert len(r.text.split("\n")) >= min(paragraphs, 1)


@pytest.mark.parametrize("count", [50, 2500])
@pytest.mark.parametrize("outer", ["article", "div"])
def test_own_paragraphs_stay_on_hosts_of_any_size(spark, outer, count):
    repeated = "".join(f"<p>Said on every page, {n}.</p>" for n in range(3))
    rows = [(i, f"http://a.org/{i}", f"<{outer}><h2>Kind {i % 10}</h2><p>Own words of page {i}.</p>{repeated}</{outer}>") for i in range(count)]
    found = {r.page_id: r.text.split("\n") for r in html_extract.extract(pages(spark, rows)).collect()}
    for i in range(count):
        whole = [f"Kind {i % 10}", f"Own words of page {i}.", *(f"Said on every page, {n}." for n in range(3))]
        assert found[i] == (whole if outer == "article" else whole[:2])


def test_a_rare_text_stays_where_another_repeats(spark):
    rows = [(i, f"http://a.org/{i}", f"<div><p>{f'Only here {i}.' if i % 10 == 0 else 'Nothing new.'}</p></div><pre>Page {i}</pre>") for i in range(400)]
    found = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()}
    assert all(found[i] == (f"Only here {i}.\n" if i % 10 == 0 else "") + f"Page {i}" for i in range(400))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<body class='post-template-default no-sidebar'><nav>n</nav><article><p>kept</p></article></body>", "kept"),
        ("<article class='post has-comments'><h1>head</h1><p>kept</p></article>", "head\nkept"),
        ("<main id='search-results'><p>kept</p></main>", "kept"),
        ("<div class='layout with-sidebar'><article><p>kept</p></article><div class=sidebar><p>no</p></div></div>", "kept"),
        ("<html class=widget><body id=comments><main class=search><p>kept</p></main></body></html>", "kept"),
        ("<div class=widget><div class=promo><article><p>kept</p></article></div></div>", "kept"),
        ("<body><form action=x><div><article><p>kept</p><form><p>no</p></form></article></div><p>outside</p></form></body>", "kept"),
        ("<form><body><p>kept</p></body></form>", "kept"),
        ("<body><form id=form1><h1>head</h1><div class=sidebar><p>not this long text</p></div><p>kept</p><form role=search>no</form></form></body>", "head\nkept"),
        ("<main><form><p>kept, as it is most of the page</p></form><p>kept</p></main>", "kept, as it is most of the page\nkept"),
        ("<form class=newsletter><p>the only text of the page</p></form>", ""),
        ("<div class='no-ads'><p>kept</p></div><div class='ads'><p>no</p></div>", "kept"),
        ("<body><div class=hero><p>no</p></div><p>a<span class=ad>no</span>b</p><form><label>no</label></form></body>", "a\nb"),
        ("<article><div class=comments><p>no</p></div><p>kept</p></article><aside><article>no</article></aside>", "kept"),
    ],
)
def test_names_and_forms_around_the_article(source, text):
    assert text_of(source) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ('<article><h2 id="search">Search</h2><p>kept</p><h2 id="navigation">Navigation</h2><p>as well</p></article>', "Search\nkept\nNavigation\nas well"),
        ('<article><p class="notice">Take notice.</p><p>kept</p></article>', "Take notice.\nkept"),
        ('<article><p>kept</p><section class="related"><h2>Related work</h2><p>Others.</p></section></article>', "kept\nRelated work\nOthers."),
        ('<article><p>See <span id="reply">her reply</span> to it.</p></article>', "See her reply to it."),
        ("<div class=teaser><article><p>Teaser.</p></article></div><div><p>The main text, which is longer by far.</p></div>", "Teaser.\nThe main text, which is longer by far."),
        ("<main><p>kept</p><div class=newsletter>no</div><ul class=pagination><li>1</ul><p class='ad'>no</p></main>", "kept"),
    ],
)
def test_names_are_evidence_and_no_verdict(source, text):
    assert text_of(source) == text


def test_the_tree_judges_doubtful_parts_of_articles(spark):
    rows = []
    for i in range(40):
        parts = f"<section class=related><h2>Related work</h2><p>Paper {i}</p></section><div class=share>Tell your friends</div>"
        rows.append((i, f"http://a.org/{i}", f"<article><p>Text {i}</p><p>On all pages</p>{parts}</article>"))
    found = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()}
    assert all(found[i] == f"Text {i}\nOn all pages\nPaper {i}" for i in range(40))


def by_brute_force(rows):
    """The style tree in plain Python, over the parsed pages."""
    parsed, seen, hosts = [], set(), defaultdict(list)
    for key, url, source in rows:
        page, host = Page(source), url.split("://")[1].split("/")[0]
        blocks = page.kept()
        parsed.append((key, host, blocks))
        content = (host, "\n".join(t for _, t, _ in blocks))
        if content not in seen:
            seen.add(content)
            hosts[host].append((blocks, page.styles))
    least = html_extract.LEAST_PAGES
    tree_of = {h: h if len(p) >= least else "*" for h, p in hosts.items()}
    holders, holds, looks = Counter(), Counter(), defaultdict(Counter)
    for host, own in hosts.items():
        for blocks, styles in own:
            holders.update({(tree_of[host], p) for p, _, m in blocks if not m})
            holds.update({(tree_of[host], p, t) for p, t, m in blocks if not m})
            for path, children in styles:
                looks[tree_of[host], path][children] += 1

    def importance(tree, path, text):
        n, seen = holders[tree, path], looks[tree, path.lstrip("?")]
        total = sum(seen.values())
        spread = -sum(c / total * math.log(c / total) for c in seen.values()) if total else 0
        look = 1.0 if total == 1 else min(spread / math.log(min(total, least)), 1.0) if total else 0.0
        content = min(math.log(n / holds[tree, path, text]) / math.log(least), 1.0)
        return html_extract.CONTENT_SHARE * content + (1 - html_extract.CONTENT_SHARE) * look

    found, removed = {}, 0
    for key, host, blocks in parsed:
        kept = []
        for path, text, marked in blocks:
            limit = html_extract.SUSPECT_IMPORTANCE if path.startswith("?") else html_extract.LOW_IMPORTANCE
            if marked or holders[tree_of[host], path] < least or importance(tree_of[host], path, text) >= limit:
                kept.append(text)
            else:
                removed += 1
        found[key] = "\n".join(kept)
    return found, removed


def test_the_tree_agrees_with_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        def words(many):
            return " ".join(rng.choice("abcdefgh") for _ in range(many))

        parts = [f"<{tag}{name}><p>{words(rng.choice([1, 1, 2, 5]))}</p></{tag}>" for tag, name in rng.choices([("div", ""), ("div", " class=related"), ("section", " class=x"), ("ul", " id=share")], k=rng.randrange(1, 7))]
        outer = rng.choice(["article", "div", "div"])
        rows.append((i, f"http://h{min(i % 7, 4)}/{i}", f"<body><{outer}>{''.join(parts)}</{outer}><div><p>{words(1)}</p></div></body>"))
    expected, removed = by_brute_force(rows)
    assert {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()} == expected
    assert removed > 20


def test_hostile_tags_take_linear_time():
    for source in ("<b>" * 60_000 + "</i>" * 60_000, "<div>" * 60_000 + "x", "<b>" * 30_000 + "<h1>x</h1>" * 30_000):
        start = time.perf_counter()
        Page(source)
        assert time.perf_counter() - start < 10
