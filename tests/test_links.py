import ipaddress
import json
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from tidegate.functions import urls as U
from tidegate.operators import links as L
from tidegate.plans.crawl import screened_frontier, write_link_payloads

BASES = ["http://h.example/a/b/c?q=1#f", "https://h.example", "http://h.example/", "http://h.example/a//b/",
         "http://h.example?x=1", "HTTP://H.example/a/b", "https://user@h.example:8080/x/y;p?z"]
REFS = ["/x", "x", "x/y/", "../up?q=1", "../../../../z", "./here", "..", ".", "a/./b/../c", "//cdn.example/z",
        "//cdn.example", "?only=query", "?", "https://other.example/p", "http://same.example/p?x#y", "ftp://f.example/x",
        "/a/../../b/.", "/a//b/../c", "x;y", "/&amp;", "http:rel", "HTTPS://UP.example/P", "x y", "g?y/./x", "g#s/../x",
        "/", "//", "a//b", "http://[bad", "x?", "data:1", "été", "/..", "/a/..", "http://same.example", "a:b", "1:2"]


def python_join(base, ref):
    try:
        return urljoin(base, ref)
    except ValueError:
        return ref


def test_resolution_equals_the_standard_library(spark):
    rows = spark.createDataFrame([(b, REFS) for b in BASES], "base string, refs array<string>")
    for r in rows.select("base", U.resolve_all(F.col("base"), F.col("refs")).alias("got")).collect():
        assert dict(zip(REFS, r.got)) == {ref: python_join(r.base, ref) for ref in REFS}
    # one reference per row, so that plain ones stay with the expressions
    single = spark.createDataFrame([(b, [ref]) for b in BASES for ref in REFS], "base string, refs array<string>")
    for r in single.select("base", "refs", U.resolve_all(F.col("base"), F.col("refs"))[0].alias("got")).collect():
        assert r.got == python_join(r.base, r.refs[0]), (r.base, r.refs[0])


def test_url_parts(column):
    urls = [u for u in BASES + [python_join(b, r) for b in BASES for r in REFS]] + [
        "http://[::1]:80/x", "https:///n", "http://:80/x", " \thttp://a\nb.example/", "//x/y", "x", "http://a@b@c.example/",
        "http://[fe80::1]/", "HTTP://User:pw@Intra.example:8080/x"]
    urls = [u for u in urls if "[bad" not in u]
    assert column(U.scheme, urls) == [urlparse(u).scheme for u in urls]
    assert column(U.netloc, urls) == [urlparse(u).netloc for u in urls]
    assert column(lambda c: U.hostname(U.netloc(c)), urls) == [urlparse(u).hostname or "" for u in urls]


def test_addresses(column):
    texts = ["10.0.0.1", "172.15.255.255", "172.16.0.0", "172.31.255.255", "172.32.0.0", "192.168.1.1", "127.0.0.1", "0.0.0.0",
             "169.254.1.1", "8.8.8.8", "256.1.1.1", "1.2.3", "01.2.3.4", "1.2.3.4.", "::1", "::", "::2", "fc00::", "fdff:ffff::1",
             "fe00::1", "FD12::7", "2001:db8::1", "::ffff:10.0.0.1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1::2::3", ":::1",
             "1:2:3:4:5:6:7::8", "1:2:3:4:5:6:7:8:", ":1:2:3:4:5:6:7:8", "g::1", "12345::", "::10.0.0.256", "host.example", "",
             "1::", "a:b:c:d:e:f:1.2.3.4", "2130706433"]
    nets = [ipaddress.ip_network(n) for n in L.BLOCKED_NETWORKS]

    def expected(text):
        try:
            a = ipaddress.ip_address(text)
        except ValueError:
            return None
        return any(a in n for n in nets)

    got = column(lambda c: U.in_networks(U.ipv4_number(c), U.ipv6_hex(c), L.BLOCKED_NETWORKS), texts)
    assert dict(zip(texts, got)) == {t: expected(t) for t in texts}
    mapped = column(lambda c: U.is_mapped_ipv4(U.ipv6_hex(c)), texts)
    assert [t for t, m in zip(texts, mapped) if m] == ["::ffff:10.0.0.1"]


HTML = ("""<a href="#f">f</a><A class=x HREF='mailto:a@b.c'>m</A><a href="../up?q=1">u</a>"""
        """<a href="//cdn.example.net/z">c</a><a href="javascript:void(0)">j</a><a href=" https://ext.example.org/p ">e</a>"""
        """<a href="/x">1</a><a title="t" href='/x'>2</a><a href="">n</a><abbr href="/no"><a href="tel:1"><a href="/y">""")


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(1, "http://h.example/a/b", HTML), (2, "http://h.example/", "no links")],
                                 "page_id long, url string, html string")


def test_page_links(pages):
    got = {r.page_id: r.links for r in L.page_links(pages).collect()}
    assert got == {1: ["http://h.example/up?q=1", "http://cdn.example.net/z", "https://ext.example.org/p",
                       "http://h.example/x", "http://h.example/y"], 2: []}
    degree = {r.host: r.n_edges for r in L.host_in_degree(L.link_edges(pages)).collect()}
    assert degree == {"h.example": 3, "cdn.example.net": 1, "ext.example.org": 1}


def test_payload_sink(pages, tmp_path):
    write_link_payloads(pages, str(tmp_path / "out"))
    rows = [json.loads(line) for f in (tmp_path / "out").glob("*.json") for line in f.read_text().splitlines()]
    assert {r["source_url"]: (r["link_count"], len(r["links"])) for r in rows} == {
        "http://h.example/a/b": (5, 5), "http://h.example/": (0, 0)}


VERDICTS = {
    "https://ok.example.org/a?b=1#c": "ok", "HTTP://User:pw@Intra.example.org:8080/x": "ssrf_blocked",
    "ftp://ok.example.org/f": "unsupported_scheme", "https:///nohost": "no_host", "http://:80/x": "no_hostname",
    "http://10.1.2.3/": "ssrf_blocked", "http://172.31.255.255/": "ssrf_blocked", "http://172.32.0.1/": "ok",
    "http://[::1]/": "ssrf_blocked", "http://[fd00::5]/": "ssrf_blocked", "http://[2001:db8::1]/": "ok",
    "http://unknown.example.org/": "ssrf_blocked", "http://0.0.0.0/": "ssrf_blocked",
    "http://169.254.169.254/latest": "ssrf_blocked", "http://[::ffff:10.0.0.1]/": "mapped_ipv4",
    "javascript:alert(1)": "unsupported_scheme", "http://a@b@ok.example.org/": "ok", "/relative/only": "unsupported_scheme",
    "http://broken.example.org/": "ssrf_blocked", "http://two.example.org/": "ssrf_blocked"}


def test_verdicts(spark, pages):
    ips = spark.createDataFrame(
        [("ok.example.org", "93.184.216.34"), ("intra.example.org", "192.168.7.7"), ("broken.example.org", "no address"),
         ("two.example.org", "93.184.216.34"), ("two.example.org", "10.0.0.1"), ("cdn.example.net", "1.1.1.1")],
        "host string, ip string")
    urls = spark.createDataFrame([(u,) for u in VERDICTS], "url string")
    assert {r.url: r.verdict for r in L.screen_urls(urls, ips).collect()} == VERDICTS
    frontier = {r.url: r.verdict for r in screened_frontier(pages, ips).collect()}
    assert len(frontier) == 5 and frontier["http://cdn.example.net/z"] == "ok"
    assert frontier["http://h.example/x"] == "ssrf_blocked"
