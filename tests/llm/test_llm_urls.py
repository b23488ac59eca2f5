from kinfold.llm import url_filter

PAGES = [
    (1, "http://A.example.COM/de/x?q=1#f", "<html></html>"),  # blocked by rule
    (2, "http://alias.org/one", '<LINK rel="canonical" href="http://a.example.com/de/x?q=1">'),  # blocked as an alias
    (3, "http://alias.org/two", '<meta http-equiv=refresh content="0; url=/one">'),  # over two links
    (4, "http://b.net", "x"),  # the rule's path needs a slash
    (5, "http://b.net/", "x"),
    (6, "https://example.net/en/1", '<link href="http://free.org/z" rel=canonical>'),  # longest rule allows
    (7, "http://free.org/z", '<link rel="canonical" href="http://c.net/q">'),  # blocked and allowed aliases: allowed
    (8, None, "x"),
    (9, "no scheme", '<link rel="canonical" href="http://c.net/q">'),
    (2, "http://alias.org/one", '<LINK rel="canonical" href="http://a.example.com/de/x?q=1">'),
    (None, "http://notexample.net/en/", None),
    (11, "http://x.org/fr/", '<link rel=canonical href="http://c2.net/q">'),  # its own rule allows
    (12, "http://ends.nett/", ""),
    (13, "", ""),
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], "page_id bigint, url string, html string, host string, _address string")


def test_verdicts(spark):
    got = sorted(map(tuple, url_filter.judge(frame(spark, PAGES)).collect()), key=str)
    want = [
        (1, "a.example.com", "/de/x", "example.com/de/", "block"),
        (2, "alias.org", "/one", None, "block"),
        (2, "alias.org", "/one", None, "block"),
        (3, "alias.org", "/two", None, "block"),
        (4, "b.net", "", None, "allow"),
        (5, "b.net", "/", "net/", "block"),
        (6, "example.net", "/en/1", "example.net/en/", "allow"),
        (7, "free.org", "/z", None, "allow"),
        (8, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (None, "notexample.net", "/en/", "net/", "block"),
        (11, "x.org", "/fr/", "org/fr/", "allow"),
        (12, "ends.nett", "/", None, "allow"),
        (13, "", "", None, "allow"),
    ]
    assert got == sorted(want, key=str)


def test_redirect_table_and_empty_pages(spark):
    redirects = spark.createDataFrame([("http://alias.org/p", "http://mid.org/"), ("http://mid.org/", "http://z.net/"), (None, "x")], "a string, b string")
    pages = frame(spark, [(1, "http://alias.org/p#here", None), (2, "http://alias.org/q", None)])
    assert {row.page_id: row.verdict for row in url_filter.judge(pages, redirects=redirects).collect()} == {1: "block", 2: "allow"}
    assert url_filter.judge(pages.filter("page_id > 5")).collect() == []


def test_many_aliases_of_one_target(spark):
    rows = [(i, f"http://s{i}.org/", '<link rel=canonical href="http://hub.net/x">') for i in range(300)]
    assert {row.verdict for row in url_filter.judge(frame(spark, rows)).collect()} == {"block"}
