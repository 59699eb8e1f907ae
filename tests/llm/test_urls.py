"""Url verdicts against a plain union of what redirects and canonical links join."""

import re
from urllib.parse import urljoin

from orewright.llm.queries import URL_RULES
from orewright.llm.url_verdicts import declared_links, plain_url, url_verdicts

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    m = re.match(r"(?s)([^/?#]*)([^?#]*)(\?[^#]*)?", url.split("://", 1)[1])
    return m[1].translate(FOLD), m[2], (m[3] or "?")[1:]


def plain(url):
    host, path, asked = parts(url)
    host = re.sub(r"^www\.", "", re.sub(r":(80|443)$", "", host))
    path = re.sub(r"/+$", "", re.sub(r"/index\.html?$", "/", path))
    kept = "&".join(p for p in asked.split("&") if p and not re.match(r"(utm_[^=]*|gclid|fbclid)(=|$)", p))
    return host + path + ("?" + kept if kept else "") if host else None


def rule(url, rules):
    host, path, _ = parts(url)
    fit = [(len(h) + len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def brute(pages, edges, rules):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    said = {}
    for a, b in edges:
        if plain(a) and plain(b):
            up[top(plain(a))] = top(plain(b))
    for url in [u for _, u in pages] + [b for a, b in edges if plain(a)]:
        if plain(url) and rule(url, rules)[1]:
            said.setdefault(top(plain(url)), set()).add(rule(url, rules)[1])
    out = []
    for page, url in pages:
        name, verdict = rule(url, rules)
        if verdict is None:
            verdict = "block" if plain(url) and said.get(top(plain(url))) == {"block"} else "allow"
        out.append((page, *parts(url)[:2], name, verdict))
    return sorted(out, key=repr)


def linked(target):
    return f'<html><head><LINK href="{target}" data-x=1 REL="alternate canonical"></head>'


PAGES = [
    (0, "https://A.example.org/x", None),
    (1, "https://spam.net/", ""),
    (2, "http://a.example.com/1", linked("https://spam.net/a?b=1&amp;c=2")),  # an edge to a blocked host that is no page
    (3, "http://b.example.com/1#top", linked("//www.a.example.com:80/1/")),  # joined to 2
    (4, "http://c.example.com/1?utm_source=x", '<meta http-equiv="Refresh" content="5; URL=\'http://b.example.com/1/index.html\'">'),
    (5, "http://d.example.com/1", linked("http://e.example.net/en/1")),  # an allowed target
    (6, "http://d.example.com/1/", linked("http://spam.net/z")),  # the same page as 5: allow goes first
    (7, "http://f.example.com/de/2", linked("http://g.example.com/2")),  # blocked itself; 8 is its alias
    (8, "http://g.example.com/2", None),
    (9, "http://h.example.com/dir/3", linked("4") + linked("?q=5") + linked("#x") + linked("mailto:a@b.net") + linked("")),
    (10, "http://h.example.com/dir/4", '<meta content="http://spam.net/q" property="og:url">'),
    (11, "http://h.example.com/dir/3?q=5", None),
    (12, "http://i.example.com/1", f"<!-- {linked('http://spam.net/1')} --><script>{linked('http://spam.net/1')}</script><p>refresh"),
    (13, None, linked("http://spam.net/1")),
    (14, "no url at all", linked("http://spam.net/1")),
    (15, "http://www.spam.net", None),  # no path: no rule fits, but its other spelling is 1
    (None, "http://g.example.com/2", None),
    (8, "http://g.example.com/2", None),
    (16, "", None),
    (17, "x://" + "y" * 50_000 + ".net/" + "z" * 50_000, "<p>" * 50_000 + linked("/w")),
    (18, "ftp://j.example.org/fr/1", linked("/2")),
    (19, "http://knet/en/", None),
    (20, "http://example.net/en/x", linked("http://l.example.com/1")),
    (21, "http://l.example.com/1", None),
]


def frame(spark, rows):
    schema = "page_id long, url string, html string, host string, verdict int, component string, id long"
    return spark.createDataFrame([(*r, None, 1, "c", 2) for r in rows], schema)


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def test_verdicts_equal_brute_force(ready):
    pages = frame(ready, PAGES)
    edges = [tuple(r) for r in declared_links(pages).select("url", "target").collect()]
    assert ("http://h.example.com/dir/3", "http://h.example.com/dir/4") in edges
    assert ("http://b.example.com/1#top", "http://www.a.example.com:80/1/") in edges
    for url, target in edges:
        assert target in {target, urljoin(url, target)} and "mailto" not in target
    got = rows(url_verdicts(pages, URL_RULES))
    assert got == brute([(p, u) for p, u, _ in PAGES], edges, URL_RULES)
    by_id = {r[0]: r[4] for r in got}
    assert [by_id[k] for k in (2, 3, 4, 8, 9, 10, 11, 15)] == ["block"] * 8
    assert [by_id[k] for k in (0, 5, 6, 12, 13, 14, 16, 19, 20, 21)] == ["allow"] * 10


def test_followed_redirects_and_long_chains(ready):
    chain = [(f"http://k{i}.example.com/", f"http://k{i + 1}.example.com/") for i in range(60)]
    pages = frame(ready, [(i, f"https://k{i}.example.com", None) for i in range(61)] + [(99, "http://z.example.com/", None)])
    links = ready.createDataFrame([*chain, ("http://k60.example.com/", "http://bad.net/x"), (None, "http://a.net/"), ("http://z.example.com/", None)], "url string, target string")
    got = rows(url_verdicts(pages, URL_RULES, links))
    assert [r[4] for r in got if r[0] != 99] == ["block"] * 61 and [r[4] for r in got if r[0] == 99] == ["allow"]


def test_plain_forms(ready):
    urls = [u for _, u, _ in PAGES] + ["http://A.b/c/?gclid=1&x=2&&utm_a", "HTTPS://www.a:443", "http://a/index.htm?", "a://b://c", "http://?q"]
    df = ready.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(plain_url(df["url"])).collect()] == [plain(u) for u in urls]


def test_no_pages(ready):
    assert rows(url_verdicts(frame(ready, []), URL_RULES)) == []
