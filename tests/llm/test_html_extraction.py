import re
from html import unescape

import pytest

from reviewgate.llm.html_extraction import (_parsed, best_path, container_scores, extract_pages, host_paths,
                                            page_text)

SCHEMA = "page_id long, url string, html string"


def alone(html):
    return page_text(_parsed(html, {}), None)


def extracted(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("host", "path", "text", "n_chars", "votes", "host_path", "w"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return {(r.page_id, r.url): r for r in extract_pages(df, **options).collect()}


def test_whole_table_against_plain_cutting(spark, sf_pages):
    """The given pages keep their article in one element: cut it out by string search."""
    want = {}
    for page_id, html in sf_pages:
        inner = html[html.index("<article>") + 9:html.index("</article>")]
        lines = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>|<br>", " ", inner))
        want[page_id] = "\n".join(x for x in (" ".join(unescape(line).split()) for line in lines) if x)
    rows = [(i, f"http://h{i % 7}.example.org/{i}", html) for i, html in sf_pages]
    got = {k[0]: r.text for k, r in extracted(spark, rows).items()}
    assert got == want


@pytest.fixture(scope="module")
def sf_pages(spark):
    import os
    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    return [(r.page_id, r.html) for r in spark.read.parquet(path).collect()]


BODY = "<p>One two three four five six seven.</p><p>Eight nine&nbsp;ten &amp; eleven &#8212; more words here.</p>"
TEXT = "One two three four five six seven.\nEight nine ten & eleven — more words here."


@pytest.mark.parametrize("html", [
    f"<html><body><nav><a href=x>Menu</a></nav><div class='post-body'>{BODY}</div><footer>Foot</footer></body></html>",
    f"<body><header><h1>Site name</h1></header><main><section>{BODY}</section></main><aside>Side bar words</aside>",
    f"<div id=wrap><div class='site-nav'>Home</div><div id=content>{BODY}<div class='ad-slot'>Buy this now</div></div></div>",
    f"<article>{BODY}<section class='comments'><article class='comment'><p>First! A long reader comment.</p></article></section></article>",
    f"<article><header><span>By a writer</span></header>{BODY}<form><label>Mail</label><input></form></article>",
    f"<article>{BODY}<div id='cookieNotice'>We use cookies.</div><div class=newsletter-signup>Join us</div></article>",
    f"<ARTICLE>{BODY}</ARTICLE><script>document.write('<p>no</p>')</script><style>p > a {{}}</style>",
    f"<article>{BODY.replace('</p>', '')}<div role='complementary'>More from us</div>",
    f"<article><p>One two three four<br>five <i>six</i> seven.<!-- <p>not this</p> --><p>Eight nine&#160;ten &amp; ele<b>ven</b> &mdash;\n\t more words here.</article>",
    f"<table><tr><td class=sidebar>Links and links<td><div class=story>{BODY}</div></table>",
    f"<div class='main no-sidebar'><article>{BODY}</article></div><div style='display: none'>Hidden words</div>",
])
def test_templates(html):
    assert alone(html) == TEXT


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("   \n ", ""), ("plain words", "plain words"), ("a < b and c", "a < b and c"),
    ("<p>cut off <a href='x", "cut off"), ("<script>never closed <p>x</p>", ""), ("<!-- never closed <p>x</p>", ""),
    ("<p>&amp &am &bogus; &#x41;&#0;</p>", "& &am &bogus; A�"), ("</p></div>stray</b>", "stray"),
    ("<nav>only a menu</nav>", ""), ('<p title="a > b">kept</p>', "kept"), ("<article><h1>Title</h1><ul><li>a<li>b</ul></article>", "Title\na\nb"),
    ("<article><header><h1>Title</h1><p>By me</p></header><p>Words and words.</p></article>", "Title\nWords and words."),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>" + "w " * 500_000, "w " * 499_999 + "w"),
    ("<a b=\"" * 2000, ""),
])
def test_odd_markup(html, want):
    assert alone(html) == want


def page(main, ad="", cls="entry-{}", n=0):
    return (f"<html><body class='page-{n}'><div class='x1'>{ad}</div><div class='col'>"
            f"<div class='{cls.format(n)}'>{main}</div></div></body></html>")


def test_the_host_decides(spark):
    """One page's unmarked box is longer than its article: the neighbours' path wins."""
    long = "<p>" + "a long unmarked box " * 40 + "</p>"
    rows = [(n, "http://a.example.org/x", page(f"<p>Article {n} has these plain words in it.</p>" * 6, n=n)) for n in range(8)]
    rows.append((8, "https://A.example.org./y", page("<p>Short.</p>", long, n=8)))
    rows.append((9, "http://b.example.org/z", page("<p>Short.</p>", long, n=9)))
    rows.append((10, None, page("<p>Short.</p>", long, n=10)))
    got = extracted(spark, rows)
    assert got[8, "https://A.example.org./y"].text == "Short."
    assert got[9, "http://b.example.org/z"].text == " ".join(("a long unmarked box " * 40).split()) + "\nShort."
    assert got[10, None].text == got[9, "http://b.example.org/z"].text and got[10, None].host_path is None
    winners = {r.host: r for r in host_paths(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(winners) == {"a.example.org", "b.example.org"} and winners["a.example.org"].pages == 8


def test_joins_agree_and_odd_rows(spark):
    rows = [(n, f"http://h{n % 3}.example.org/", f"<article><p>Words of page {n}.</p></article><footer>F</footer>") for n in range(20)]
    rows += [(3, "http://h0.example.org/", rows[3][2]), (30, "", None), (31, "no url", ""), (None, None, "<p>x</p>")]
    small, wide = extracted(spark, rows), extracted(spark, rows, broadcast_bytes=0)
    assert {k: r.text for k, r in small.items()} == {k: r.text for k, r in wide.items()}
    assert small[3, "http://h0.example.org/"].text == "Words of page 3."
    assert (small[30, ""].text, small[30, ""].n_chars, small[None, None].text) == ("", 0, "x")
    assert sum(1 for _ in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()) == len(rows)
    assert extracted(spark, []) == {}


def test_scores_prefer_the_pure_and_deep():
    p = _parsed(f"<body><div class=a><div class=b>{BODY}</div></div><nav>menu menu menu</nav></body>", {})
    scores = container_scores(p)
    assert best_path(scores) == next(p.path[e] for e in range(len(p.tag)) if "b" in p.words[e])
    assert max(s for s, _ in scores.values()) == 1.0
