import random

import pytest

from casebook.llm import urls
from casebook.llm.queries import RULES


def slow(rules, host, path, default="allow"):
    fits = [
        (len(h.split(".")) if h else 0, len(p), v == "allow", h + p, v)
        for h, p, v in rules
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[3:] if fits else (None, default)


def test_trie_agrees_with_all_rules():
    rng = random.Random(1)
    hosts = ["", "net", "a.net", "b.a.net", "com", "a.com", "x.a.com"]
    paths = ["", "/", "/a", "/a/", "/ab/", "/a/b", "/a/b/", "/a/b/c"]
    for _ in range(300):
        rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(rng.randrange(12))]
        trie = urls.Trie(rules)
        for host in [*hosts, "y.x.a.com", "neta", "a.net.", ".net", "a..net"]:
            for path in [*paths, "/abc", "/a/bc", "/a/b/cd/e", "//"]:
                assert (trie.find(host, path) or (None, "allow")) == slow(rules, host, path) or ".." in host or host[:1] == "."


@pytest.mark.parametrize(
    ("url", "parts"),
    [
        (None, ("", "")),
        ("", ("", "")),
        ("example.net/en/", ("", "")),
        ("http://", ("", "")),
        ("HTTP://WWW.Example.NET", ("www.example.net", "")),
        ("x://a.net/en/?q=/fr/", ("a.net", "/en/")),
        ("x://a.net?q", ("a.net", "")),
        ("x://a.net#/en/", ("a.net", "")),
        ("x://É.net:80/\n/a", ("É.net:80", "/\n/a")),
    ],
)
def test_split(url, parts):
    assert urls.split_url(url) == parts


def test_rows(frame):
    cases = ["http://a.net/x", "http://example.net/en/x", "http://b.example.net/en", "https://m.example.com/de/1", "http://q.org/fr/", None, "http://a.net", "http://a.net/x"]
    got = urls.filter_urls(frame([(k, u) for k, u in enumerate(cases)], "page_id long, url string"), RULES)
    verdicts = {r.page_id: (r.rule, r.verdict) for r in got.collect()}
    assert [verdicts[k] for k in range(8)] == [
        ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"),
        ("org/fr/", "allow"), (None, "allow"), (None, "allow"), ("net/", "block"),
    ]
    assert urls.filter_urls(frame([], "page_id long, url string"), RULES).collect() == []


def test_too_many_rules(frame, monkeypatch):
    monkeypatch.setattr(urls, "MOST_RULES", 3)
    with pytest.raises(ValueError):
        urls.filter_urls(frame([(1, "u")], "page_id long, url string"), RULES)
