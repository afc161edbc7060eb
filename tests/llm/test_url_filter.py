from __future__ import annotations

from stockweave.llm import url_filter
from tests.llm import tables

SCHEMA = "page_id long, url string, html string"
CANONICAL = '<html><head><link rel="canonical" href="{}"></head><body></body></html>'
REFRESH = "<html><head><META HTTP-EQUIV='Refresh' CONTENT='0; URL={}'></head></html>"


def verdicts(spark, rows, **options):
    found = url_filter.filter_urls(tables.with_clashes(spark.createDataFrame(rows, SCHEMA)), **options).collect()
    return {r.page_id: (r.rule, r.verdict) for r in found}


def test_hosts_and_paths(spark):
    urls = {
        1: ("HTTP://WWW.Example.COM/A?b#c", "www.example.com", "/A"), 2: ("x://h", "h", ""), 3: ("no scheme/en/", "", ""),
        4: (None, "", ""), 5: ("a://b://c/d", "b:", "//c/d"), 6: ("https://h?q=/en/", "h", ""), 7: ("https://h#/en/", "h", ""), 8: ("://x/y", "x", "/y"),
        9: ("", "", ""), 10: ("https://ÉX.org/é", "Éx.org", "/é"),
    }
    found = url_filter.filter_urls(spark.createDataFrame([(i, u[0], None) for i, u in urls.items()], SCHEMA)).collect()
    assert {r.page_id: (r.host, r.path) for r in found} == {i: u[1:] for i, u in urls.items()}


def test_the_longest_rule_wins(spark):
    rows = [
        (1, "http://example.com/en/1", None), (2, "http://a.example.com/en/", None), (3, "http://www.example.com/en/x", None),
        (4, "http://b.www.example.com/en/x", None), (5, "http://example.com/de/", None), (6, "http://example.com", None),
        (7, "http://notexample.com/en/", None), (8, "http://x.net/es/1", None), (9, "http://x.net/en/es/", None),
        (10, "http://com/", None), (11, "http://x.org/en/", None), (12, "http://net/fr/", None),
    ]
    assert verdicts(spark, rows) == {
        1: ("example.com/en/", "block"), 2: ("example.com/en/", "block"), 3: ("www.example.com/en/", "allow"),
        4: ("www.example.com/en/", "allow"), 5: ("com/", "allow"), 6: (None, "allow"), 7: ("com/", "allow"), 8: ("net/es/", "block"),
        9: (None, "allow"), 10: ("com/", "allow"), 11: (None, "allow"), 12: ("net/fr/", "block"),
    }


def test_blocks_spread_to_aliases_but_not_over_an_explicit_allow(spark):
    rows = [
        (1, "http://a.org/1", CANONICAL.format("http://b.org/2?x=1&amp;y=2")), (2, "https://b.org/2?x=1&y=2#top", REFRESH.format("/3")),
        (3, "http://b.org/3", CANONICAL.format("//bad.net/es/4")), (4, "http://www.example.com/en/5", CANONICAL.format("http://a.org/1")),
        (5, "http://free.org/dir/6", CANONICAL.format("7")), (6, "http://free.org/dir/7", None), (7, "http://other.org/", CANONICAL.format("http://shop.com/")),
        (8, "http://c.org/8", "<link href=http://bad.net/fr/ rel=canonical>"), (9, "http://c.org/9", "<link rel='stylesheet' href='http://bad.net/fr/'>"),
        (10, None, CANONICAL.format("http://bad.net/fr/")), (11, "http://b.org/2", None),
    ]
    found = verdicts(spark, rows)
    assert {i for i, (_, verdict) in found.items() if verdict == "block"} == {1, 2, 3, 8}
    assert found[4] == ("www.example.com/en/", "allow")


def test_redirects_are_read_with_and_without_quotes(spark):
    contents = {
        1: """content="0; url='https://a.b/c'\"""", 2: """content='0; URL="https://a.b/c"'""", 3: 'content="0; url=https://a.b/c"',
        4: "content='0;url=https://a.b/c'", 5: "content=0;url=https://a.b/c", 6: 'content="0; url = &quot;https://a.b/c&quot;"',
        7: """content="0; url=' https://a.b/c '; x\"""", 8: """data-content="1" content="0;URL='https://a.b/c\"""",
        9: 'content="0; url=https://a.b/it\'s?x=1&amp;y=2"', 10: 'content="5"', 11: "content=\"0; url=''\"",
    }
    rows = [(f"http://h/{i}", f'<html><head><meta http-equiv="refresh" {c}></head></html>') for i, c in contents.items()]
    rows.append(("http://h/12", """<meta content="0; url='https://a.b/c'" http-equiv=refresh>"""))
    found = url_filter._page_links(spark.createDataFrame(rows, "url string, html string")).collect()
    expected = {f"http://h/{i}": "https://a.b/c" for i in (*range(1, 9), 12)}
    assert {r.url: r.target for r in found} == expected | {"http://h/9": "https://a.b/it's?x=1&y=2"}
    pages = [(1, "http://h/1", rows[0][1].replace("https://a.b/c", "http://x.net/es/")), (2, "http://h/2", None)]
    assert {i: verdict for i, (_, verdict) in verdicts(spark, pages).items()} == {1: "block", 2: "allow"}


def test_given_redirects_chain(spark):
    rows = [(i, f"http://h.org/{i}", None) for i in range(30)]
    moved = [(f"http://h.org/{i}", f"/{i + 1}") for i in range(20)] + [("http://h.org/20", "http://x.net/es/"), (None, "http://h.org/25"), ("http://h.org/25", None)]
    redirects = spark.createDataFrame(moved, "url string, target string")
    found = verdicts(spark, rows, redirects=redirects)
    assert {i for i, (_, verdict) in found.items() if verdict == "block"} == set(range(21))


def test_repeated_rows_no_rules_and_empty_tables(spark):
    rows = [(1, "http://x.net/es/", None), (1, "http://x.net/es/", None), (None, "http://x.net/es/", None)]
    assert url_filter.filter_urls(spark.createDataFrame(rows, SCHEMA)).filter("verdict = 'block'").count() == 3
    assert url_filter.filter_urls(spark.createDataFrame(rows, SCHEMA), rules=()).filter("verdict = 'allow' and rule is null").count() == 3
    assert url_filter.filter_urls(spark.createDataFrame([], SCHEMA)).count() == 0
