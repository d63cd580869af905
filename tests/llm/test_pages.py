"""Pages: main texts and URL verdicts, against plain Python."""

from __future__ import annotations

import random
import re
from fnmatch import translate

import pyarrow as pa

from clicktally.llm import html_extract, url_filter

SCHEMA = "page_id bigint, url string, html string"


def text_of(html: str, template: set[int] | None = None) -> str:
    return html_extract.main_text(html_extract.parse(html), template or set())


def test_blocks_of_an_article():
    html = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li><a href="/x">Menu</a></li></ul></nav><header>Head</header><div class="ad">Buy</div>
    <article><h1>A &lt;title&gt;</h1><p>One <b>bold<br>and
      <i>more</i> &amp; &eacute;&#233;&#x1F600;<p>Two<div class="share-buttons">Share!</div>
      <ul><li>a<li>b</ul><table><tr><td>c<td>d</table><form><input>Name</form><pre>x
   y</pre><section id="comments"><p>Reader says</p></section><aside>Side</aside><p> </p><p>5 < 6 &notit; end</article>
    <footer>&copy; us</footer><p>outside</body></html>"""
    assert text_of(html) == "\n\n".join(
        ["A <title>", "One bold and more & éé😀", "Two", "a", "b", "c", "d", "x y", "5 < 6 ¬it; end"]
    )


def test_broken_pages():
    assert text_of("") == "" and text_of("<") == "<" and text_of("plain  text") == "plain text"
    assert text_of("<p>a<p>b</div></p>c") == "a\n\nb\n\nc"
    assert text_of("<body><script>never ended <p>x") == ""
    assert text_of("<div><!-- never ended <p>x") == ""
    assert text_of("<select><option>a<article><p>kept</article>") == "kept"
    assert text_of("<p title='a>b'>in</p><p title=it's>x</p>") == "in\n\nx"
    assert text_of("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert text_of("<p>" + "long " * 50_000 + "</p>") == ("long " * 50_000).strip()
    assert text_of("<p>\x00 <b></b>&#0;</p>").strip("\ufffd\x00 ") == ""


def test_classes_are_judged_whole():
    kept = "<p>kept</p>"
    for html in (
        f'<div class="page has-sidebar"><article>{kept}</article></div>',
        f'<div class="post no-comments">{kept}</div>',
        f'<section class="related-work">{kept}</section>',
        f'<article><div class="social-policy">{kept}</div></article>',
        f'<div class="header-navigation-theory with-sidebar no-sidebar">{kept}</div>',
        f'<form id="aspnetForm"><div class="sidebar"><article>{kept}</article></div></form>',
        f'<div class="banner"><main>{kept}</main></div><p>outside</p>',
    ):
        assert text_of(html) == "kept", html
    for said in ("ad", "site-header", "x comments", "share-buttons", "cookie-consent", "main-nav", "related-posts", "sidebar_left", "widget-3"):
        assert text_of(f'<div class="{said}"><p>gone</p></div>{kept}') == "kept", said
        assert text_of(f'<div id="{said}"><article>teaser</article></div><article>{kept}</article>') == "kept", said


def test_layouts_of_a_host_are_templates(spark):
    """Five layouts, each on a fifth of the pages; nine pages of a small host; copies of one page."""
    rows, own = [], {}
    for i in range(500):
        own[i] = f"Story {i} " + "goes on " * (5 + i % 7) + f"to {i}"
        strip = f"<div><p>Strip of layout {i % 5}</p><span>call us</span></div>"
        rows.append((i, f"http://layouts.example.com/{i}", f"<body>{strip}<div><p>{own[i]}</p></div></body>"))
    for i in range(1000, 1009):
        own[i] = f"Small story {i} of a small host"
        rows.append((i, "http://small.example.com/", f"<body><div><p>About us</p></div><p>{own[i]}</p></body>"))
    long = [f"Paragraph {k} of one text that comes in several editions." for k in range(9)]
    for i in range(2000, 2004):  # editions of one page: what they share is the article
        own[i] = "\n\n".join([f"Edition {i}", *long])
        rows.append((i, "http://editions.example.com/", "<body>" + "".join(f"<p>{t}</p>" for t in [f"Edition {i}", *long]) + "</body>"))
    found = html_extract.extract(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert {r.page_id: " ".join(r.text.split(" ")) for r in found.collect()} == {k: " ".join(v.split()) if k < 1000 else v for k, v in own.items()}


def plain_extract(rows: list[tuple]) -> dict:
    """Counts by dictionaries; pages of the same content once."""
    host = {i: (re.match(r"(?s)^.*?://([^/?#]*)", url or "") or [""] * 2)[1].lower() for i, url, _ in rows}
    trees = {i: html_extract.parse(html or "") for i, _, html in rows}
    on: dict = {}
    for i, tree in trees.items():
        for mark in html_extract._candidates(tree):
            on.setdefault((host[i], mark), set()).add(tree.mark)
    pages = {h: len({trees[i].mark for i in trees if host[i] == h}) for h in set(host.values())}
    sure = {k for k, v in on.items() if len(v) >= 10 and len(v) >= 0.3 * pages[k[0]]}
    likely = {k for k, v in on.items() if len(v) >= 3 and len(v) >= 0.05 * pages[k[0]]} - sure
    return {
        i: html_extract.main_text(tree, {m for h, m in sure if h == host[i]}, {m for h, m in likely if h == host[i]})
        for i, tree in trees.items()
    }


def test_extract_equals_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "HOST_PAGES", 30)
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    stripped = [(10**6 + i, url, re.sub("</?(?:article|main|nav|header|footer|aside)[^>]*>", "<div>", html)) for i, url, html in rows]
    for given in (rows, [*stripped, *site(40)]):
        found = html_extract.extract(spark.createDataFrame(given, SCHEMA).repartition(6))
        assert {r.page_id: r.text for r in found.collect()} == plain_extract(given)


def site(n: int) -> list[tuple[int, str, str]]:
    """Pages without a marked article: only what recurs shows the template."""
    rows = []
    for i in range(n):
        own = f"<div><p>Story {i} begins</p><p>and {i} goes on</p></div>"
        html = f"<body><div><p>Site news</p><p>Call us</p></div>{own}<p>All rights</p></body>"
        rows.append((i, f"https://Shop.example.com/{i}?q", html))
    return rows


def test_template_is_deleted(spark):
    rows = [*site(40), (100, "https://other.example.com/", site(1)[0][2]), (101, None, None), (102, None, "<p>x</p>")]
    rows += [(i, "http://copies.example.com/a", "<body><p>Same page</p></body>") for i in range(200, 240)]
    found = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == len(rows)
    assert all(found[i] == f"Story {i} begins\n\nand {i} goes on" for i in range(40))
    assert found[100].startswith("Site news") and found[101] == "" and found[102] == "x"
    assert {found[i] for i in range(200, 240)} == {"Same page"}  # copies are one page


def test_shared_paragraphs_of_articles_stay(spark):
    rows = [
        (i, "http://a.example.org/", f"<article><p>Shared line</p><p>Own {i}</p><div>Follow us</div></article>") for i in range(30)
    ]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS host", "'y' AS template", "1 AS n_chars")
    found = html_extract.extract(pages).collect()
    assert all(r.text == f"Shared line\n\nOwn {r.page_id}" and r.n_chars == len(r.text) for r in found)
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    from html import unescape

    for r in html_extract.extract(pages).collect():
        article = re.search("<article>(.*)</article>", html[r.page_id], re.DOTALL)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_automaton_is_glob_matching():
    rng = random.Random(4)
    letters = "ab/.é"
    globs = ["", "*", "a", "**a", "a*b", "*ab*", "é*", "*/.*a", "ab" * 70 + "*", *("".join(rng.choice("aab/*") for _ in range(rng.randrange(1, 9))) for _ in range(60))]
    texts = ["", "ab" * 70, "ab" * 71, *("".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(300))]
    found = url_filter.Automaton.of(globs).matches(pa.array(texts))
    for j, glob in enumerate(globs):
        want = re.compile(translate(glob))
        assert found[:, j].tolist() == [bool(want.match(t)) for t in texts], glob


URLS = [
    (None, "", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("http://EXAMPLE.net/en/x?y", "example.net", "/en/x", "example.net/en/", "allow"),
    ("http://a.b.example.net/en", "a.b.example.net", "/en", "net/", "block"),
    ("https://net", "net", "", None, "allow"),
    ("https://net/", "net", "/", "net/", "block"),
    ("https://planet/x", "planet", "/x", None, "allow"),
    ("x://example.com/de/?q", "example.com", "/de/", "example.com/de/", "block"),
    ("x://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    ("x://w.org/fr/casino#a", "w.org", "/fr/casino", "org/fr/", "allow"),
    ("x://w.org/de/casino#a", "w.org", "/de/casino", None, "block"),
    ("x://café.org?x://y.net/", "café.org", "", None, "allow"),
    ("x://ÀB.Com#z", "Àb.com", "", None, "allow"),
    ("x://a.com/" + "p" * 5000 + ".exe", "a.com", "/" + "p" * 5000 + ".exe", None, "block"),
]


def test_verdicts(spark):
    rows = [(i, u[0]) for i, u in enumerate(URLS)] + [(2, URLS[2][0]), (None, URLS[5][0])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "1 AS rule", "2 AS canonical")
    found = url_filter.judge(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        _, host, path, rule, verdict = URLS[5 if r.page_id is None else r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
    assert url_filter.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules=(), patterns=()).collect()} == {"allow"}


BOUNDARIES = [
    ("http://a.com/mirror.net/x", None, None, "allow"),
    ("http://archive.org/web/http://www.example.com/de/x", None, None, "allow"),
    ("http://a.com/x/.org/fr/", None, None, "allow"),
    ("http://a.net/mirror.example.net/en/", "net/", None, "block"),
    ("http://b.a.example.com/de/y.net/", "example.com/de/", None, "block"),
    ("http://ads.a.com", None, "ads.*", "block"),
    ("http://www.cart/cart/", None, "*/cart/*", "block"),
    ("http://a.trackers.com/x", None, "*.trackers.*/*", "block"),
]


def test_host_rules_end_with_the_host(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(BOUNDARIES)], "page_id bigint, url string")
    found = {r.page_id: (r.rule, r.pattern, r.verdict) for r in url_filter.judge(pages).collect()}
    assert [found[i] for i in range(len(BOUNDARIES))] == [u[1:] for u in BOUNDARIES]
    # a rule without a path is not the start of a longer host; a pattern may go over the end of the host
    rules, patterns = [("block", "b.com", ""), ("block", "d.com", "*/x")], [("block", "c.com/x"), ("block", "a#*")]
    urls = ["x://b.com", "x://a.b.com/y", "x://b.community/", "x://d.com/a/x", "x://e.com/d.com/x", "x://c.com/x", "x://a/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r.page_id: r.rule or r.pattern for r in url_filter.judge(pages, rules, patterns).collect()}
    assert [found[i] for i in range(len(urls))] == ["b.com", "b.com", None, "d.com*/x", None, "c.com/x", None]
