import pytest

from facetry.llm.queries import URL_RULES
from facetry.llm.url_filter import bloom_blocks, judge_urls

URLS = [
    None, "", "no scheme", "http://", "http://net/", "http://net", "http://a.NET/x", "http://anet/x", "http://a.net?q=/",
    "ftp://b.example.net/en/x", "http://b.example.net/EN/", "http://example.net/en", "http://x.org/fr/", "http://org/fr/a#b",
    "http://example.com/de/?x", "http://example.com.au/de/", "http://example.com:80/de/", "http://u@example.net/en/",
    "http://a://net/", "http://É.net/é", "http://" + "a." * 3000 + "net/" + "p" * 9000, "http://net/", "://net/", "x://net#/",
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def frames(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return pages, spark.createDataFrame(rules, "host string, path string, verdict string")


@pytest.mark.parametrize("max_blocks", [1, 1 << 15])
def test_against_brute_force(spark, max_blocks, monkeypatch):
    # one block for many rules is a filter that passes nearly everything; the join still decides
    rules = URL_RULES + [(f"h{i}.example.org", f"/p{i}", "block") for i in range(400)]
    urls = URLS + [f"https://s.h{i}.example.org/p{i % 7}{i}" for i in range(400)] + ["http://h3.example.org/p3"] * 500
    pages, listed = frames(spark, urls, rules)
    want = {i: brute(u, rules) for i, u in enumerate(urls)}
    for fits in (True, False):
        monkeypatch.setattr("facetry.llm.url_filter.fits_broadcast", lambda *a, f=fits: f)
        got = judge_urls(pages, listed, max_blocks=max_blocks).collect()
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
        assert len(got) == len(urls)


def test_filter_is_blocked_and_bounded(spark):
    listed = spark.createDataFrame([(f"k{i}",) for i in range(200)], "key string")
    bits, blocks = bloom_blocks(listed, 1 << 15)
    assert blocks == 16 and len(bits) == 16 * 4 and 200 < sum((w & (2**64 - 1)).bit_count() for w in bits) <= 800
    assert bloom_blocks(listed, 4)[1] == 4


def test_empty_and_wrong_rules(spark):
    pages, none = frames(spark, URLS, [])
    assert {r["verdict"] for r in judge_urls(pages, none).collect()} == {"allow"}
    empty, rules = frames(spark, [], URL_RULES)
    assert judge_urls(empty, rules).count() == 0
    with pytest.raises(ValueError, match="different verdicts"):
        judge_urls(*frames(spark, URLS, [("net", "/", "block"), ("NET", "/", "allow")]))
    with pytest.raises(ValueError, match="needs a host"):
        judge_urls(*frames(spark, URLS, [(None, "/", "block")]))


def test_null_path_and_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://a/"), (1, "http://a/"), (None, "http://a")], "page_id long, url string")
    rules = spark.createDataFrame([("a", None, "block"), ("a", None, "block")], "host string, path string, verdict string")
    got = judge_urls(pages, rules).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [("a", "block")] * 3
