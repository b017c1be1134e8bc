"""URL filter against a plain Python reading of the rules and terms."""

import re

from opslens.llm import urlfilter as U

URLS = [None, "", "no scheme", "http://Example.COM/en/a?x#y", "https://www.example.com/en/b", "http://a.www.example.com/en/",
        "http://notexample.com/en/", "http://x.net/fr/1", "http://x.net/es/", "http://net/es/", "http://x.net", "http://x.com",
        "http://x.org/porn/1", "http://x.org/pornography", "http://x.org/poker-bet", "http://x.org/poker/poker",
        "http://x.org/?q=casino", "//casino", "http://a.b?c=/d", "http://a#/b", "http://u.com://net/fr/", "HTTP://X.ORG/XXX",
        "http://x.org/payday-loans", "http://x.org/payday-loan", "http://é.org/sexé-bet", "a://" + "x" * 50_000 + "/bet/loan",
        "http://x.com/porn", "http://x.org/apuestas/ruleta", "http://x.org/apuestas/", "http://x.fr/paris-sportifs?nues",
        "http://x.fr/paris-sportif", "http://x.de/Sportwetten-Gewinnspiel", "http://x.de/spielautomaten", "http://x.de/kreditkarte"]


def plain(url):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if "://" in (url or ""):
        rest = url.split("://", 1)[1]
        raw = re.split(r"[/?#]", rest, maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
        path = re.split(r"[?#]", rest[len(raw):], maxsplit=1)[0]
    fits = [r for r in U.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    alone = lambda t: re.findall(rf"(?<![a-z0-9])(?={re.escape(t)}(?![a-z0-9]))", low)
    strict, soft = sum(len(alone(t)) for t in U.STRICT), sum(bool(alone(t)) for t in U.SOFT)
    if fits:
        h, p, verdict = max(fits, key=lambda r: len(r[0] + r[1]))
        return host, path, h + p, verdict, strict, soft
    return host, path, None, "block" if strict or soft >= 2 else "allow", strict, soft


def test_matches_plain_reading(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[3], "x"), (3, URLS[3], "y")],
                               "page_id bigint, url string, host string")
    got = {(r.page_id, r.host): tuple(r)[1:] for r in U.judge_urls(df).collect()}
    for i, u in enumerate(URLS):
        assert got[i, plain(u)[0]] == plain(u), u
    assert U.judge_urls(df).count() == len(URLS) + 2
    assert U.judge_urls(df.limit(0)).count() == 0


def test_terms_need_boundaries_and_soft_terms_count_once():
    a = U.build_automaton(("bad", "very-bad"), ("meh", "mehr"))
    assert U.count_terms("bad bad abad bad2 very-bad", a) == (4, 0)
    assert U.count_terms("meh,meh mehr xmeh", a) == (0, 2)
    assert U.count_terms("anything", U.build_automaton((), ())) == (0, 0)


def test_vocabularies_of_the_languages_do_not_overlap():
    assert len(set(U.STRICT)) == len(U.STRICT) and len(set(U.SOFT)) == len(U.SOFT) and not set(U.STRICT) & set(U.SOFT)
    assert set(U.STRICT_BY_LANGUAGE) == set(U.SOFT_BY_LANGUAGE) == {"en", "es", "fr", "de"}
