"""URL filters against a walk over the graph in plain dictionaries."""

import random
import re

import pytest

from codestrata.llm import link_graph as L

SCHEMA = "page_id long, url string, html string, host string, kind string, trust long, verdict string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def cut(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule_of(host, path, rules):
    fits = [r for r, _ in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def brute(rows, rules, steps):
    says = dict(rules)
    told = [(i, *cut(url), html or "") for i, url, html in rows]
    seeds = {"trust": {}, "distrust": {}}
    links = set()
    for _, host, path, html in told:
        rule = rule_of(host, path, rules)
        if host and rule:
            own = seeds["trust" if says[rule] == "allow" else "distrust"]
            own[host] = own.get(host, 0) + L.UNIT
        for target in re.findall(L.LINK, html):
            if host and lower(target) != host:
                links.add((host, lower(target)))
    has = {}
    for kind, seed in seeds.items():
        out = {}
        for s, t in links:
            a, b = (s, t) if kind == "trust" else (t, s)
            out.setdefault(a, []).append(b)
        now = dict(seed)
        for _ in range(steps if links else 0):
            after = {h: x * (100 - L.FLOW) // 100 for h, x in seed.items()}
            for a, x in now.items():
                for b in out.get(a, []):
                    after[b] = after.get(b, 0) + x * L.FLOW // (100 * len(out[a]))
            now = after
        has[kind] = now
    rows = []
    for i, host, path, _ in told:
        rule, trust, distrust = rule_of(host, path, rules), has["trust"].get(host, 0), has["distrust"].get(host, 0)
        rows.append((i, host, path, rule, says[rule] if rule else "block" if distrust > trust else "allow", trust, distrust))
    return sorted(rows, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "H", "k", 5, "v") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    hosts = [f"{a}.{b}" for a in ("x", "WWW.y", "spam", "a.b.c") for b in ("example.org", "Example.com", "example.net", "com", "notexample.org", "ORG", "Én.fr")]
    paths = ["", "/", "/en/1", "/en/2.html", "/es/", "/es", "/fr/9?x=://y", "/de/3#a", "/de/4?b/fr/", "?q=1", "#t"]
    out = []
    for i in range(400):
        links = "".join(rnd.choice(["<a href='https://{0}/p'>", '<A HREF = "//{0}">', "<a href=http://{0}?x>", "<a href='/{0}'>", "{0}", "<link href='://{0}/'>"]).format(rnd.choice(hosts)) for _ in range(rnd.randrange(4)))
        out.append((i % 390, f"{rnd.choice(['http', 'https', 'x'])}://{rnd.choice(hosts)}{rnd.choice(paths)}", links))
    out += [(None, None, None), (500, "no host at all", "<a href='//x.com'>"), (501, "://", ""), (502, "http:///p", "<a href='//x.com'>"), (503, "a://b://c", None), (504, "http://org", "")]
    return out + [(600 + i, "http://hub.example.net/en/5", f"<a href='http://x{i % 9}.example.org/'>") for i in range(300)]


@pytest.mark.parametrize("steps", [0, 1, 6])
def test_against_dictionaries(spark, rows, steps):
    got = L.judged(table(spark, rows), steps=steps).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, L.RULES, steps)


def test_links_change_verdicts(spark):
    rows = [(1, "http://bad.com/de/1", ""), (2, "http://bad.com/de/2", ""), (3, "http://bad.com/en/", ""), (4, "http://farm.net/p", "<a href='http://bad.com/'>")]
    rows += [(5, "http://good.org/", "<a href='http://friend.net/'>"), (6, "http://good.org/2", ""), (7, "http://friend.net/p", "<a href='//bad.com/x'>"), (8, "http://far.net/", "")]
    got = {r.page_id: r.verdict for r in L.judged(table(spark, rows)).collect()}
    assert [got[i] for i in range(1, 9)] == ["block", "block", "block", "block", "allow", "allow", "allow", "allow"]
    alone = {r.page_id: r.verdict for r in L.judged(table(spark, [(i, u, None) for i, u, _ in rows])).collect()}
    assert alone[4] == "allow"  # only the link to a blocked host gave it away


def test_hubs_are_dealt_to_parts(spark, rows, monkeypatch):
    want = brute(rows, L.RULES, 4)
    monkeypatch.setattr(L, "ARCS", 2)
    assert sorted(map(tuple, L.judged(table(spark, rows), steps=4).collect()), key=str) == want


def test_other_rules_and_no_pages(spark, rows):
    rules = (("example.com/", "block"), ("x.example.com/fr/", "allow"))
    assert sorted(map(tuple, L.judged(table(spark, rows), rules, 3).collect()), key=str) == brute(rows, rules, 3)
    assert L.judged(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        L.judged(table(spark, []), [("a/", "allow")] * 1_001)
