"""URL filter against every subset of every labelled token set."""

import re
from collections import Counter
from itertools import combinations

import numpy as np

from tiermill.llm.url_rules import filter_urls

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = []
    for says, rule in RULES:
        of, rest = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, says))
    return max(fits)[1:] if fits else (None, None)


def token_set(url):
    host, path = parts(url)
    scheme = re.match(r"([A-Za-z0-9+.-]*)://", url or "")
    query = re.search(r"\?([^#]*)", url or "")
    found = [("s:", scheme[1])] if scheme else []
    found += [("h:", x) for x in host.split(".")] + [("p:", x) for x in path.split("/")]
    found += [("q:", x.split("=")[0]) for x in (query[1].split("&") if query else []) if x]
    return frozenset(kind + re.sub("[0-9]+", "0", x) for kind, x in found if x or kind == "q:")


def brute(pages, support, least, confidence):
    rows = [(i, *parts(u), *ruled(*parts(u)), token_set(u)) for i, u in pages]
    labelled = [(r[5], r[4]) for r in rows if r[4]]
    sets, with_label = Counter(), Counter()
    for tokens, verdict in labelled:
        for k in range(1, len(tokens) + 1):
            for some in combinations(sorted(tokens), k):
                sets[some] += 1
                with_label[some, verdict] += 1
    need = max(support * len(labelled), least)
    rules = {key: n / sets[key[0]] for key, n in with_label.items() if n >= need and n / sets[key[0]] >= confidence}
    kept = {
        (some, verdict): c
        for (some, verdict), c in rules.items()
        if not any(rules.get((some[:i] + some[i + 1 :], verdict), -1) >= c for i in range(len(some)))
    }
    out = []
    for i, host, path, rule, verdict, tokens in rows:
        if verdict is None:
            fits = [(c, with_label[key], len(key[0]), key[1]) for key, c in kept.items() if tokens >= set(key[0])]
            verdict = max(fits)[3] if fits else "allow"
        out.append((i, host, path, rule, verdict))
    return out


def key(row):
    return [(x is None, x if x is not None else 0) for x in row]


def test_against_all_token_subsets(spark):
    rng = np.random.default_rng(2)
    hosts = ["example.org", "WWW.Example.ORG", "site.com", "a.site.com", "other.net", "notexample.org", "blog.io"]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    pages = []
    for i in range(400):
        url = f"{pick(['http', 'https'])}://{pick(hosts)}/{pick(['es', 'en', 'fr', 'de', 'x'])}/{pick(['1', '2', 'ad', 'news'])}"
        pages.append((i, url + pick(["", "?ref=1", "?ref=2&p=3", "#top"])))
    pages += [(400, None), (401, ""), (402, "no scheme.org/x"), (403, "HTTP://EXAMPLE.org"), (404, "http://example.org?x=/es/")]
    pages += [(405, "a://b://example.org/es/"), (None, "http://site.com/de/1"), (406, "http://org"), (407, "http://example.org/" + "y" * 100_000)]
    pages += [(1, pages[1][1]), (1, pages[2][1])]
    df = spark.createDataFrame([(i, u, "n", "v") for i, u in pages], "page_id long, url string, tokens string, verdict string")
    for least, confidence in ((5, 0.8), (12, 0.6)):
        got = filter_urls(df.repartition(3), RULES, 0.005, least, confidence)
        found = sorted((tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()), key=key)
        assert found == sorted(brute(pages, 0.005, least, confidence), key=key)
        mined = [r for r in got.collect() if r.mined_rule]
        assert {r.verdict for r in mined} == {"allow", "block"}


def test_without_labels_and_without_rows(spark):
    schema = "page_id long, url string"
    assert filter_urls(spark.createDataFrame([], schema), RULES).collect() == []
    only = filter_urls(spark.createDataFrame([(1, "http://blog.io/x"), (2, None)], schema), RULES)
    assert sorted(r.verdict for r in only.collect()) == ["allow", "allow"]
