import pytest

from dayscout.llm import queries, urls
from dayscout.llm.urls import DigestArray, pack

URLS = [
    None, "", "no scheme", "http://", "https://COM/x", "http://a.com", "http://a.com/", "http://com/a",
    "http://Example.com/en/1?q=/de/", "http://www.example.com/en/", "http://deep.www.EXAMPLE.com/en/x#f",
    "http://notexample.com/en/", "http://x.net/es/", "http://x.net/es", "http://net/fr/1", "http://y.net?/es/",
    "a://b://c.com/d", "http://example.com/en", "http://x.com:80/y",
]


def judged(url):
    """The contract, word by word."""
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:end], rest[end:]
        path = path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, allow in queries.URL_RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), rule, "allow" if allow else "block"))
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "u") for i, u in enumerate(URLS)] + [(None, "http://a.com/", "n"), (0, None, "again")]
    return spark.createDataFrame(rows, "page_id long, url string, host string")


def rows_of(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


def test_against_the_contract(pages):
    want = sorted(((r.page_id, *judged(r.url)) for r in pages.collect()), key=str)
    assert rows_of(urls.filter_urls(pages, queries.URL_RULES)) == want


def test_sharded_agrees(spark, pages):
    rules = spark.createDataFrame(queries.URL_RULES, "rule string, allow boolean")
    one = rows_of(urls.filter_urls(pages, queries.URL_RULES))
    assert rows_of(urls.filter_urls_sharded(pages, rules, shards=3)) == one


def test_equal_digests_are_told_apart():
    index = DigestArray(pack([("a.com/x", False), ("b.com/y", True)]))
    index.keys = index.keys.copy()
    index.keys[:] = urls.keys_of([b"c.com/z"])[0]  # as if all three collided
    assert index.find([b"c.com/z"]).tolist() == [-1]


def test_list_of_many(spark, pages):
    rules = [(f"h{i}.org/{'p' * (i % 5)}", i % 2 == 0) for i in range(5000)]
    index = DigestArray(pack(rules))
    strings = [r.encode() for r, _ in rules]
    found = index.find([*strings, b"h1.org/none"])
    assert found[-1] == -1 and sorted(found[:-1].tolist()) == list(range(5000))
    assert [bool(index.allow[i]) for i in found[:-1]] == [ok for _, ok in rules]
    with pytest.raises(ValueError, match="filter_urls_sharded"):
        urls.filter_urls(pages, rules, max_bytes=1000)


def test_empty(pages):
    assert urls.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages, [], "block").collect()} == {"block"}
