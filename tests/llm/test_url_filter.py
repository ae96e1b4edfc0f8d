import random
import re

import pytest

from tidemark.llm import url_filter as U
from tidemark.llm.queries import URL_RULES


def brute(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in URL_RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path) and (best is None or len(rule.name) > len(best.name)):
            best = rule
    canonical = host + re.sub(r"(?:\.html|/)$", "", path)
    verdict = best.verdict if best else "block" if canonical and canonical in listed else "allow"
    return host, path, best.name if best else None, verdict


@pytest.mark.parametrize("broadcast_blocks", [1 << 18, -1])
def test_equals_brute_force(spark, monkeypatch, broadcast_blocks):
    monkeypatch.setattr(U, "BROADCAST_BLOCKS", broadcast_blocks)
    rng = random.Random(2)
    hosts = ["a.net", "net", "Example.NET", "www.example.net", "x.example.com", "example.org", "notexample.net", "ÄB.org"]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/2.html", "/fr/2/", "/q/3", "/q/3.html?x=/en/", "?a://b", "#://x/en/"]
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + [None, "", "no scheme/en/", "://", "a://", "http://example.org/q/3\nx"]
    listed = ["example.org/q/3", "example.org/fr/2", "x.example.com/q/3", "example.org", None, "", "example.org/q/3", "nowhere/1"]
    pages = spark.createDataFrame([(i, u, "html", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, block string")
    names = spark.createDataFrame([(x,) for x in listed], "canonical string")
    rows = U.filter_urls(pages, names, URL_RULES).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(urls[r["page_id"]], set(filter(None, listed)))
        assert r["possible"] or not r["listed"]


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(3000).selectExpr("concat('h.org/', id) AS canonical")
    pages = spark.range(6000).selectExpr("id AS page_id", "concat('http://h.org/', id) AS url")
    rows = U.filter_urls(pages, listed, ()).collect()
    assert all(r["possible"] and r["listed"] for r in rows if r["page_id"] < 3000)
    assert sum(r["possible"] for r in rows if r["page_id"] >= 3000) < 90
    assert not any(r["listed"] for r in rows if r["page_id"] >= 3000)


def test_empty_list_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://x.org/q")], "page_id long, url string")
    none = spark.createDataFrame([], "canonical string")
    assert U.filter_urls(pages, none, URL_RULES).first()["verdict"] == "allow"
    assert U.filter_urls(pages.limit(0), none, URL_RULES).count() == 0
