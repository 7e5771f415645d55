import re

import pytest

from slumptrace.llm import aliases as A


@pytest.fixture
def pages(spark):
    def build(*rows):
        return spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)],
                                     "page_id long, url string, html string, node string, component int")
    return build


def brute(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), v, h + p) for v, h, p in A.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:0:-1] if fits else (None, None))


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x#y", "http://example.org/en/1", "http://example.org/en/12/",
        "https://org/", "http://notorg.net/", "http://a.com/fr/x", "http://a.com/de/x", "http://a.com/DE/x", "x://a?b://c/d",
        "http://Äx.com/fr/", "http://com/fr", "http://a.com#/de/", "http://example.org/en/2", "a\nb://c.com/de/\nf"]


def test_rules(pages):
    df = pages(*((u, None) for u in URLS))
    rows = A.judge(df, A.page_edges(df)).orderBy("page_id").collect()
    assert len(rows) == len(URLS)
    for row, url in zip(rows, URLS, strict=True):
        host, path, rule, verdict = brute(url)
        assert (row.host, row.path, row.rule) == (host, path, rule), url
        assert row.verdict == (verdict or "allow")


def test_blocks_reach_aliases_and_allow_wins(pages):
    link = '<link href="{}" rel="canonical">'.format
    df = pages(
        ("http://a.com/de/x", None),  # 0 blocked
        ("http://mirror.net/1", '<link rel="canonical" href="http://a.com/de/x">'),  # 1 alias of it
        ("http://mirror.net/2", '<meta http-equiv="refresh" content="0; url=http://mirror.net/1">'),  # 2 alias of the alias
        ("http://b.org/en/", None),  # 3 allowed
        ("http://c.net/", '<link rel=canonical href="http://b.org/en/">'),  # 4 allowed with it
        ("http://d.net/", '<link rel="canonical" href="http://a.com/de/y">'),  # 5 alias of a blocked page that is not there
        ("http://both.net/1", '<link rel="canonical" href="http://a.com/de/z">'),  # 6 in one group with a block
        ("http://e.org/x", '<link rel="canonical" href="http://both.net/1">'),  # 7 and an allow
        ("https://www.mirror.net/1/?utm_source=x#top", None),  # 8 the same address in other words
        ("http://f.net/", '<link rel="canonical" href="/self">'), ("http://f.net/self", None),  # 9, 10
        ("http://mirror.net/1", None),  # 11 repeated
        ("http://g.net/", '<link rel="stylesheet" href="http://a.com/de/x">'),  # 12 no alias
        ("http://h.net/", link("http://a.com/de/x")),  # 13 the reference stands first
    )
    rows = A.judge(df, A.page_edges(df)).collect()
    blocked = {r.page_id for r in rows if r.verdict == "block"}
    assert blocked == {0, 1, 2, 5, 8, 11, 13}


def test_chains_and_hubs(spark, pages):
    df = pages(*((f"http://n{i}.net/", None) for i in range(60)), ("http://x.com/de/", None))
    chain = [(f"http://n{i}.net/", f"http://n{i + 1}.net/") for i in range(29)] + [("http://n29.net/", "http://x.com/de/")]
    hub = [("http://n30.net/", f"http://n{i}.net/") for i in range(31, 60)]
    edges = spark.createDataFrame(chain + hub, "from_url string, to_url string")
    rows = A.judge(df, edges).collect()
    assert {r.page_id for r in rows if r.verdict == "block"} == {*range(30), 60}
    assert len({r.component for r in rows if 30 <= r.page_id < 60}) == 1


def test_empty(pages, spark):
    df = pages(("http://a.com/", None)).limit(0)
    assert A.judge(df, A.page_edges(df)).count() == 0


def test_pages_without_url_have_no_alias(pages):
    link = '<link href="{}" rel="canonical">'.format
    df = pages(
        (None, link("http://a.com/de/x")), (None, link("http://quiet.net/")), ("http://quiet.net/", None), (None, None),
        ("", link("http://a.com/de/x")), ("no scheme", link("http://a.com/de/x")), ("quiet.net/2", link("http://a.com/de/x")),
        ("http://quiet.net/2", None), ("http://other.net/3", link("http://a.com/de/3")), ("other.net/3", None),
        ("http://a.com/de/x", link("no scheme")), ("http://more.net/", link("")))
    rows = A.judge(df, A.page_edges(df)).orderBy("page_id").collect()
    assert [r.verdict for r in rows] == ["allow"] * 8 + ["block", "allow", "block", "allow"]
    assert {r.rule for r in rows} == {None, "com/de/"}


def test_edges_given_by_hand(spark, pages):
    df = pages((None, None), ("", None), ("http://a.com/de/x", None), ("http://quiet.net/", None))
    edges = spark.createDataFrame([("http://a.com/de/x", ""), ("", "http://quiet.net/"), (None, "http://a.com/de/x")], "from_url string, to_url string")
    assert [r.verdict for r in A.judge(df, edges).orderBy("page_id").collect()][:3] == ["allow", "allow", "block"]


def test_declared_links_alone(pages):
    df = pages(("http://m.a.com/x", None), ("http://a.com/x", '<link rel=canonical href="http://a.com/y">'))
    assert [tuple(r) for r in A.page_edges(df, forms=False).collect()] == [("http://a.com/x", "http://a.com/y")]
    assert ("http://m.a.com/x", "a.com/x") in {tuple(r) for r in A.page_edges(df).collect()}
