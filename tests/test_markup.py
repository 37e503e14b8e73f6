"""The token machine on small pages, and as a DataFrame."""

import pytest

from veritab.sources.markup import Links, markup_links


def links(html, base="https://e.com/a/b.html", wanted=("anchor", "embed", "data_attribute", "meta_refresh", "select_option", "form_action", "input_control", "onclick", "download_manager"), documents=False):
    return [tuple(r[:3]) for r in Links(html, base, wanted, documents).rows]


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ('<A HREF = "../x?a=1&amp;b=2">A <i>b</i>\n c</A>', [("anchor", "https://e.com/x?a=1&b=2", "A b c")]),
        ("<a href=//o.org/x>out</a>", [("anchor", "https://o.org/x", "out")]),
        ('<base href="/root/"><a href="x">y</a>', [("anchor", "https://e.com/root/x", "y")]),
        ('<a title="a > b" href="x">1<a href="y">2</a>', [("anchor", "https://e.com/a/x", "1"), ("anchor", "https://e.com/a/y", "2")]),
        ("<script>'<a href=\"x\">'</script><style><a href=y></style><!-- <a href=z> --><a href=w>w", [("anchor", "https://e.com/a/w", "w")]),
        ("<!-- never closed <a href=x>y</a>", []),
        ("<a href=''>none</a><a>none</a><a href=\"unclosed", []),
        ('<a href="http://[bad">x</a>', [("anchor", "http://[bad", "x")]),
        ("<div data-url=x><div>in</div>side</div>out</div>", [("data_attribute", "https://e.com/a/x", "in side")]),
        ("<span data-src=x data-href=y>z</span>", [("data_attribute", "https://e.com/a/y", "z")]),
        ("<b></i></i></b><a href=x>t</b></a>", [("anchor", "https://e.com/a/x", "t")]),
        ("<iframe src=x></iframe><object data=y>z</object><embed>", [("embed", "https://e.com/a/x", ""), ("embed", "https://e.com/a/y", "z")]),
        ('<a href="/g?wpdmdl=1">g</a>', [("anchor", "https://e.com/g?wpdmdl=1", "g"), ("download_manager", "https://e.com/g?wpdmdl=1", "g")]),
        ('<a href="https://o.org/g?wpdmdl=1">g</a>', [("anchor", "https://o.org/g?wpdmdl=1", "g")]),
        ("<meta http-equiv=refresh content='0;url=x'><title>T &lt;1&gt;</title>", [("meta_refresh", "https://e.com/a/x", "T <1>")]),
        ("<input title=t onclick=\"f('a.pdf')\">", [("input_control", "https://e.com/a/a.pdf", "t")]),
        ("", []),
    ],
)
def test_links(html, expected):
    assert links(html) == expected


def test_documents_only():
    assert links('<a href="x">1</a><a href="x%2Epdf?v=1">2</a><button onclick="f(\'y\')">', documents=True) == [("anchor", "https://e.com/a/x%2Epdf?v=1", "2")]


def test_deep_and_long_pages_stay_linear():
    html = "<p>" * 100_000 + "</div>" * 100_000 + "<a href=x>" + "word " * 100_000 + "</a>" + "<a \"" * 50_000
    (row,) = links(html)
    assert row[:2] == ("anchor", "https://e.com/a/x") and len(row[2]) == 499_999


def test_pages(spark):
    rows = [(1, "https://e.com/", '<a href="x.pdf?1">a</a><embed src="/wp-content/y.pdf">'), (None, None, "<a href=z>b</a>"), (2, "https://e.com/", None), (1, "https://e.com/", "<a href=q>c</a>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' AS source", "'mine' AS position")
    got = sorted((r["page_id"] or 0, r["position"], r["source"], r["href"], r["text"], r["pattern"]) for r in markup_links(pages).collect())
    assert got == [
        (0, 0, "anchor", "z", "b", "direct"),
        (1, 0, "anchor", "https://e.com/q", "c", "direct"),
        (1, 0, "anchor", "https://e.com/x.pdf?1", "a", "cache_busted"),
        (1, 1, "embed", "https://e.com/wp-content/y.pdf", "", "embed_wordpress"),
    ]
    assert {r["source"] for r in markup_links(pages, ["embed"]).collect()} == {"embed"}
    assert markup_links(pages.filter("false")).count() == 0
    with pytest.raises(ValueError, match="no such extractors"):
        markup_links(pages, ["links"])
