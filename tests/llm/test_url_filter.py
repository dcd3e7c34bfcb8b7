"""URL filters against a plain matcher with regular expressions."""
import random
import re

from lectern.llm import url_filter as uf


def plain(site, globs, default, url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in site:
        rh, _, rp = rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith("/" + rp):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    out = default
    for verdict, g in globs:
        rx = "".join({("**",): r"[\s\S]*", ("*",): "[^/]*", ("?",): "[^/]"}.get(e) or re.escape(e) for e in uf.parse_glob(g))
        if re.fullmatch(rx, host + path):
            out = verdict
    return host, path, None, out


def urls():
    r = random.Random(1)
    hosts = ["Example.ORG", "a.example.org", "org", "x.com", "com", "ads.z.net", "m.b.example.net", "evil.com.au", "example.org:80"]
    paths = ["", "/", "/es/1", "/en/12", "/en/2", "/fr/", "/de/x", "/de", "/login?x", "/cart/1", "/tag1/2", "/privacy", "/é/de/", "/org/"]
    tails = ["", "?a=http://x.org/fr/", "#/de/", "?"]
    out = [f"http://{r.choice(hosts)}{r.choice(paths)}{r.choice(tails)}" for _ in range(400)]
    return out + [None, "", "no scheme/org/", "://", "http://", "x://org/" + "a" * 50_000, "http://example.com/x.org/y"]


def test_matches_plain(spark):
    rows = [(i, u, "h") for i, u in enumerate(urls())] + [(None, "http://x.com/fr/", "h"), (3, urls()[3], "h")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string").repartition(3)
    got = sorted((tuple(r)[:5] for r in uf.filter_urls(pages).collect()), key=str)
    want = sorted(((i, *plain(uf.SITE_RULES, uf.GLOBS, uf.DEFAULT, u)) for i, u, _ in rows), key=str)
    assert got == want


def test_many_rules_cross_word_limits():
    site = [("block", f"host{i}.net/p{i}") for i in range(60)]
    a = uf.Automaton(uf.compile_rules(site, uf.GLOBS))
    assert a.words > 8
    for i in (0, 17, 59):
        u = f"w.host{i}.net/p{i}/z"
        assert a.rules[a.match([u])[0]].name == plain(site, [], "", "x://" + u)[2]
    assert a.match(["host1.net.evil/p1", "xhost1.net/p1"]).tolist() == [-1, -1]


def test_wildcards():
    a = uf.Automaton([uf.Rule((g,), "block") for g in ["a*c", "a**d", "q?", r"s\*t", ""]])
    names = lambda u: [a.rules[k].globs[0] if k >= 0 else None for k in a.match(u)]
    assert names(["abbc", "a/c", "a/x/d", "qz", "q/", "s*t", "sxt", "", "ac"]) == [
        "a*c", None, "a**d", "q?", None, r"s\*t", None, "", "a*c"]


def test_empty_table(spark):
    assert uf.filter_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0
