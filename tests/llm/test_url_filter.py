import re

import pandas as pd

from lastmile.llm import url_filter as uf


def fits(glob, text):
    parts = re.split(r"(\*\*|\*)", glob)
    pattern = "".join({"**": "(?s:.*)", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts)
    return re.fullmatch(pattern, text) is not None


def test_automaton_against_regular_expressions():
    globs = ["a*b", "**", "*", "", "net/**", "*.net/**", "**casino**", "x*y*z/**", "é**", "a" * 70, "a" * 70 + "*b", "*a"]
    texts = ["", "ab", "a/b", "axxb", "net/", "foo.net/x/y", "evil.com/a.net/", "x/casino", "xayaz/", "é/1", "a" * 70, "a" * 70 + "qb", "b" * 3000 + "a", "ba", "x" * 64 + "a"]
    automaton = uf.Automaton(globs)
    assert automaton.words >= 3
    state = automaton.run([t.encode() for t in texts])
    for k, g in enumerate(globs):
        assert list(automaton.fits(state, k)) == [fits(g, t) for t in texts], g


def by_hand(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for h, p, says in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, says)
    return host, path, *(best or (None, None))


URLS = [None, "", "no mark", "http://", "http://NET/x", "https://a.example.net/en/1?x#y", "http://example.net", "http://example.net?/en/", "http://evil.com/x.example.net/en/",
        "http://xexample.com/de/", "http://m.example.com/de/1", "http://m.example.com/DE/1", "x://a://b.org/fr/", "ftp://É.org/fr/é", "http://casino.example.org/x", "http://example.org/" + "a" * 5000,
        "http://fr.org/fr/", "http://a.org/fr/", "http://a.org/fr", "http://.net/"]


def test_rules_and_verdicts(spark):
    frame = spark.createDataFrame([(i, u, "kept", "x") for i, u in enumerate(URLS)] + [(0, None, "kept", "x")], "page_id long, url string, html string, host string")
    out = uf.filter_urls(frame, uf.CONTRACT_RULES)
    assert out.count() == len(URLS) + 1
    for r in out.collect():
        host, path, rule, says = by_hand(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == (says or ("block" if "casino" in host else "allow"))
        assert r.html == "kept"
    assert uf.filter_urls(frame.limit(0), uf.CONTRACT_RULES).count() == 0


def test_longest_rule_then_block_wins():
    rules = uf.UrlRules(block=(("a.com", "/x"),), allow=(("a.com", "/y"), ("a.com", "/x")), block_globs=("**bad**",), allow_globs=("**good**",))
    got = uf.judge(["http://a.com/x1", "http://a.com/y", "http://b.com/bad", "http://b.com/badgood"], rules)
    assert list(got.verdict) == ["block", "allow", "block", "allow"]
    assert isinstance(got, pd.DataFrame)
