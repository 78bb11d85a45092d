"""Mined URL rules and their verdicts against a search through all token sets, on small tables with long URLs."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest

from changeloom.llm import url_rules

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
URLS = "page_id long, url string, host string, verdict int"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def curated(host, path):
    fits = [(len(r), r, v) for r, v in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def tokens(host, path):
    labels = [x for x in host.split(".") if x]
    suffixes = {"host=" + ".".join(labels[k:]) for k in range(len(labels))}
    words = {"word=" + x for x in re.split("[.-]+", host) if x}
    return frozenset(suffixes | words | {"path=" + x for x in re.sub("[0-9]+", "0", path.lower()).split("/") if x})


def searched(urls, min_support, min_confidence, min_count):
    """Rules (set, verdict) -> (confidence, support), by counting every set of tokens."""
    baskets = []
    for u in urls:
        host, path = parts(u)
        if (verdict := curated(host, path)[1]) and (t := tokens(host, path)):
            baskets.append((t, verdict))
    least = max(-(-min_support * len(baskets) // 1), min_count)
    alone = Counter(x for t, _ in baskets for x in t)
    sets, labelled = Counter(), Counter()
    for t, verdict in baskets:
        items = sorted(x for x in t if alone[x] >= least)
        for n in range(1, len(items) + 1):
            for s in combinations(items, n):
                sets[s] += 1
                labelled[s, verdict] += 1
    rules = {k: (n / sets[k[0]], n / len(baskets)) for k, n in labelled.items() if n >= least and n / sets[k[0]] >= min_confidence}
    narrow = {(s, v) for (s, v), (c, _) in rules.items() for n in range(1, len(s)) for w in combinations(s, n) if rules.get((w, v), (0,))[0] >= c}
    return {k: x for k, x in rules.items() if k not in narrow}


def table(seed):
    draw = random.Random(seed)
    hosts = ["shop.example.net", "www.shop.example.net", "free-bets.example.com", "m.example.org", "news.io", "a.b.c.d.e.news.io", "x.example.net"]
    paths = ["en", "de", "fr", "deal12", "story7", "Sale", "tag"]
    urls = [f"http://{draw.choice(hosts)}/" + "/".join(draw.choices(paths, k=draw.randrange(1, 5))) for _ in range(400)]
    rare = lambda: "/".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(9))
    urls += [f"https://x.example.net/{'en' if k % 3 else 'fr'}/{rare()}/long{k}?q" for k in range(12)]  # 18 tokens, few of them frequent
    urls += [f"https://other.io/en/{rare()}/long{k}" for k in range(6)]
    urls += [None, "", "no scheme", "://", "http:///only/path", urls[0], urls[0]]
    ids = [None if k % 50 == 0 else k % 300 for k in range(len(urls))]  # null and repeated ids
    return list(zip(ids, urls, ["clash"] * len(urls), [9] * len(urls), strict=True))


@pytest.mark.parametrize(("seed", "support", "confidence", "count"), [(1, 0.02, 0.9, 5), (2, 0.03, 0.7, 8)])
def test_rules_and_verdicts_are_those_of_a_search(spark, seed, support, confidence, count):
    rows = table(seed)
    want = searched([r[1] for r in rows], support, confidence, count)
    pages = spark.createDataFrame(rows, URLS).repartition(5)
    host, path = url_rules.host_and_path(pages.url)
    labelled = pages.select(url_rules.tokens(host, path).alias("tokens"), url_rules.fitting_rule(host, path)["verdict"].alias("verdict"))
    mined = url_rules.mine_rules(labelled, support, confidence, count)
    members = {}
    for r in mined.members.collect():
        members.setdefault(r.item, []).append(r.token)
    found = {}
    for r in mined.rules.collect():  # one token of each item
        sets = [()]
        for item in r["items"]:
            sets = [s + (t,) for s in sets for t in members[item]]
        found |= {(tuple(sorted(s)), r.verdict): (r.confidence, r.support) for s in sets}
    assert set(found) == set(want) and len(want) > 5
    for k, x in found.items():
        assert x == pytest.approx(want[k])

    def verdict(url):
        h, p = parts(url)
        if own := curated(h, p)[1]:
            return own
        t = tokens(h, p)
        fits = [(*want[k], len(k[0]), k[1]) for k in want if t.issuperset(k[0])]
        return max(fits, key=lambda f: (round(f[0], 9), round(f[1], 9), *f[2:]))[3] if fits else "allow"

    got = url_rules.judge_urls(pages, min_support=support, min_confidence=confidence, min_count=count).collect()
    expected = Counter((i, *parts(u), curated(*parts(u))[0], verdict(u)) for i, u, *_ in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == expected
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}


def test_nothing_to_mine(spark):
    empty = spark.createDataFrame([], URLS)
    assert url_rules.judge_urls(empty).count() == 0
    few = spark.createDataFrame([(1, "http://a.net/x", "", 0), (2, "http://a.io/x", "", 0)], URLS)
    assert sorted((r.page_id, r.verdict, r.mined) for r in url_rules.judge_urls(few).collect()) == [(1, "block", None), (2, "allow", None)]


def test_given_labels_and_no_broadcast(spark):
    """Labels by id, which may be null or repeat; joins that may not broadcast give the same."""
    rows = [(k, f"http://a.io/{'good' if k % 2 else 'bad'}/{k}") for k in range(100)] + [(200, "http://a.io/bad/7"), (None, "http://b.io/good")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, "allow" if k % 2 else "block") for k in range(100)] + [(None, "block"), (3, None)], "page_id long, verdict string")
    got = {r.page_id: r for r in url_rules.judge_urls(pages, (), labels).collect()}
    assert got[200].verdict == "block" and got[200]["mined"] == ["path=bad"] and got[None].verdict == "allow" and got[3].verdict == "allow"
    host, path = url_rules.host_and_path(pages.url)
    own = pages.select(host.alias("host"), path.alias("path"), url_rules.tokens(host, path).alias("tokens"), url_rules.fitting_rule(host, path, (("block", "io/bad/"),))["verdict"].alias("verdict"))
    mined = url_rules.mine_rules(own, min_count=5, max_broadcast=0)
    assert sorted(map(str, url_rules.match_rules(own, mined, 0).collect())) == sorted(map(str, url_rules.match_rules(own, mined).collect()))
