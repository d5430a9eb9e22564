import fnmatch
import random
import re

from vaultscope.llm.queries import URL_RULES
from vaultscope.llm.urlfilter import HOST_END, Automaton, Rule, url_filter


def canonical(host, path):
    return b"." + host.encode() + bytes([HOST_END]) + path.encode()


def fits(rule, host, path):
    suffix = re.compile(r"(.*\.)?" + fnmatch.translate(rule.host)[4:-3] + r"\Z", re.S)
    start = re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in rule.path), re.S)
    return bool(suffix.match(host)) and bool(start.match(path))


def test_globs_against_regular_expressions():
    rng = random.Random(2)
    text = lambda kinds, n: "".join(rng.choice(kinds) for _ in range(rng.randrange(n)))
    rules = [Rule("block", text("ab.*", 6) + "a", text("/ab*?", 6)) for _ in range(40)]
    rules = [r for r in rules if "?" not in r.host]
    urls = [(text("ab.", 10), text("/ab", 12)) for _ in range(600)] + [("", "")]
    got = Automaton(rules).match([canonical(*u) for u in urls])
    assert Automaton(rules).words > 2
    for u, row in zip(urls, got):
        assert list(row) == [fits(r, *u) for r in rules], u


def test_wildcards_stay_on_their_side_of_the_host():
    a = Automaton([Rule("allow", "org", "/")])
    assert a.match([canonical("x.org", "/"), canonical("org", "/a"), canonical("a.com", "/x.org/"), canonical("xorg", "/")]).tolist() == [
        [True], [True], [False], [False]
    ]


def test_urls(spark):
    urls = {
        "HTTP://WWW.Example.ORG/es/1?x#y": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://example.org/en/2#/en/1": ("example.org", "/en/2", "org/", "allow"),
        "https://org": ("org", "", None, "allow"),
        "https://a.com/de/?": ("a.com", "/de/", "com/de/", "block"),
        "https://a.com?x=/de/": ("a.com", "", None, "allow"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "x://y://z/p": ("y:", "//z/p", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "h://ÉX.org/é\n": ("Éx.org", "/é\n", "org/", "allow"),
        "h://a.com/de/" + "x" * 200_000: ("a.com", "/de/" + "x" * 200_000, "com/de/", "block"),
    }
    rows = [(k, u, "clash") for k, u in enumerate(urls)] + [(0, "HTTP://WWW.Example.ORG/es/1?x#y", "clash"), (None, "h://org/", "clash")]
    out = url_filter(spark.createDataFrame(rows, "page_id long, url string, host string"), URL_RULES)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = [(k, *v) for k, v in enumerate(urls.values())] + [(0, *next(iter(urls.values()))), (None, "org", "/", "org/", "allow")]
    assert got == sorted(want, key=str)
    assert url_filter(out.limit(0).withColumnRenamed("host", "url"), URL_RULES).count() == 0
