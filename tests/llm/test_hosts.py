import math
from collections import Counter

from gaugeloom.llm import hosts


def split(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def domain(host, k=2):
    labels = host.split(".")
    long = ".".join(labels[-2:]) in hosts.LONG_SUFFIXES
    return ".".join(labels[-(k + long) :])


def plain(pages, outcomes):
    placed = [(p, *split(u)) for p, u in pages]
    bad = {}
    for p, b in outcomes:
        bad.setdefault(p, []).append(b)
    n, k = Counter(), Counter()
    for p, h, _ in placed:
        for b in bad.get(p, []) if p is not None else []:
            if b is not None:
                n[h] += 1
                k[h] += b
    names = {h for _, h, _ in placed}

    def level(groups, prior):
        """groups: name -> (n, k), prior: name -> mean."""
        top = sum((kk - nn * prior[g]) ** 2 - nn * prior[g] * (1 - prior[g]) for g, (nn, kk) in groups.items() if nn > 1)
        low = sum(nn * (nn - 1) * prior[g] * (1 - prior[g]) for g, (nn, kk) in groups.items() if nn > 1)
        rho = min(max(top / low if low else 0.5, 0.001), 0.5)
        m = 1 / rho - 1
        out = {}
        for g, (nn, kk) in groups.items():
            mean = (kk + m * prior[g]) / (nn + m)
            out[g] = (mean, mean - hosts.Z * math.sqrt(mean * (1 - mean) / (nn + m + 1)))
        return out

    def summed(key, of):
        out = {}
        for g, (nn, kk) in of.items():
            a, b = out.get(key(g), (0, 0))
            out[key(g)] = (a + nn, b + kk)
        return out

    by_host = {h: (n[h], k[h]) for h in names}
    by_domain = summed(domain, by_host)
    by_suffix = summed(lambda d: domain(d, 1), by_domain)
    overall = (sum(k.values()) + 0.5) / (sum(n.values()) + 1)
    s = level(by_suffix, dict.fromkeys(by_suffix, overall))
    d = level(by_domain, {x: s[domain(x, 1)][0] for x in by_domain})
    h = level(by_host, {x: d[domain(x)][0] for x in by_host})
    out = []
    for p, host, path in placed:
        fits = [r for r in hosts.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        own = "block" if h[host][1] > hosts.MOST_BAD else "allow"
        out.append((p, host, path, best and best[0] + best[1], best[2] if best else own, round(h[host][1], 9)))
    return sorted(out, key=str)


def run(spark, pages, outcomes):
    p = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' AS host", "true AS bad", "1 AS n")
    o = spark.createDataFrame(outcomes, "page_id long, bad boolean")
    got = hosts.filter_pages(p, o).collect()
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.bound, 9)) for r in got), key=str)


def test_against_plain(spark):
    pages, outcomes = [], []
    for i in range(400):
        host = f"h{i % 7}.d{i % 11 % 4}.{['com', 'org', 'co.uk', 'example.net'][i % 4]}"
        pages.append((i, f"http{'s' * (i % 2)}://{host.upper() if i % 3 else host}/{['en', 'fr', 'de'][i % 3]}/x?q=http://y#z"))
        if i % 3:
            outcomes.append((i, i % 4 == 1 or i % 5 == 0))
    pages += [
        (None, None), (900, ""), (901, "no scheme/x"), (902, "://"), (903, "a://b"), (904, "x://net/"), (905, "x://net"), (906, "x://EXAMPLE.com/de/"),
        (907, "x://notexample.com/de/"), (908, "x://example.net/en/"), (909, "x://example.net/en"), (910, "x://a.org/fr/é\n?"), (911, "x://h3.d1.com:80?/p"),
        (912, "x://" + "a." * 3000 + "com/" + "p" * 5000), (1, pages[1][1]), (1, pages[1][1]),
    ]
    outcomes += [(None, True), (900, None), (1, True), (5000, True)]
    got = run(spark, pages, outcomes)
    assert got == plain(pages, outcomes)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_empty_and_without_labels(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "a://b.c/")], []) == plain([(1, "a://b.c/")], [])


def test_a_hot_host_does_not_decide_for_all(spark):
    pages, outcomes = [], []

    def host(name, n, bad):
        for k in range(n):
            outcomes.append((len(pages), k < bad))
            pages.append((len(pages), f"x://{name}/p"))

    host("hot.com", 1000, 250)
    host("bad.com", 36, 36)
    for i in range(120):
        host(f"h{i}.com", 16, 4)
    got = {r[1]: r[4] for r in run(spark, pages, outcomes)}
    assert {name for name, verdict in got.items() if verdict == "block"} == {"bad.com"}


def test_suffix_table(spark):
    """Longest rule, one-label wildcards and exceptions, as public suffix lists have them."""
    rules = ["com", "uk", "co.uk", "*.ck", "!www.ck", "jp", "*.kobe.jp", "!city.kobe.jp", "a.b.c.d", None, " ORG "]
    want = {
        "example.com": ("example.com", "com"), "www.example.com": ("example.com", "com"), "com": ("com", "com"), "x.y.co.uk": ("y.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"), "uk": ("uk", "uk"), "a.b.ck": ("a.b.ck", "b.ck"), "x.a.b.ck": ("a.b.ck", "b.ck"), "www.ck": ("www.ck", "ck"),
        "x.www.ck": ("www.ck", "ck"), "x.city.kobe.jp": ("city.kobe.jp", "kobe.jp"), "x.y.other.kobe.jp": ("y.other.kobe.jp", "other.kobe.jp"),
        "z.a.b.c.d": ("z.a.b.c.d", "a.b.c.d"), "unknown.zz": ("unknown.zz", "zz"), "": ("", ""), "a.org": ("a.org", "org"),
    }
    table = spark.createDataFrame([(r,) for r in rules], "suffix string")
    names = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r.host: (r.domain, r.suffix) for r in hosts.with_suffix(names, table).collect()}
    assert got == want
    plainly = {r.host: (r.domain, r.suffix) for r in hosts.with_suffix(names).collect()}
    assert plainly["x.y.co.uk"] == ("y.co.uk", "co.uk") and plainly["x.a.b.ck"] == ("b.ck", "ck")
