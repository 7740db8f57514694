"""The n-gram join against all pairs compared in plain Python."""

import random
import re
from itertools import combinations

import numpy as np

from tiermill.llm import ngram_join
from tiermill.llm.ngram_join import ngram_components

SCHEMA = "doc_id long, text string, n long, digest string, class int, token string, component string"


def brute(docs, k=4, percent=85):
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    label = list(range(len(docs)))
    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
            old, new = label[i], label[j]
            label = [new if x == old else x for x in label]
    lowest = {}
    for (doc, _), x, s in zip(docs, label, sets, strict=True):
        if doc is not None:
            lowest[x] = min(doc, lowest.get(x, doc))
    return sorted(((doc, len(s), lowest.get(x)) for (doc, _), s, x in zip(docs, sets, label, strict=True)), key=repr)


def run(spark, docs, **how):
    df = spark.createDataFrame([(d, t, 0, "x", 1, "y", "z") for d, t in docs], SCHEMA)
    return sorted(map(tuple, ngram_components(df, **how).collect()), key=repr)


def test_supplied_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, docs) == brute(docs)


def test_groups_chains_ties_and_edges(spark):
    rng = random.Random(5)
    docs = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE two"), (5, "one two three"), (6, "É"), (7, "é"), (None, ""), (None, "lone text")]
    base = [f"w{i}" for i in range(90)]
    docs += [(60 - i, " ".join(base[i * 3 : i * 3 + 60])) for i in range(10)]  # each like the next only
    for at in range(40):  # copies at every distance around the threshold, all sharing one passage
        words = [f"v{rng.randrange(30)}" for _ in range(rng.randrange(4, 90))]
        docs.append((100 + 10 * at, " ".join(words)))
        for j in range(3):
            other = list(words)
            for _ in range(rng.randrange(0, 5)):
                other[rng.randrange(len(other))] = f"x{rng.randrange(9)}"
            docs.append((101 + 10 * at + j, " ".join(other)))
    tie = [f"t{i}" for i in range(103)]  # 100 shingles
    docs += [(900, " ".join(tie)), (901, " ".join(tie[:88])), (902, " ".join(tie[:87]))]  # 85 and 84 of 100
    docs += [(903, " ".join(tie)), (903, " ".join(tie)), (None, " ".join(tie)), (None, "only nameless copies here now"), (None, "only nameless copies here now")]
    docs += [(1000 + i, "long " + " ".join(f"l{j % 5000}" for j in range(60_000)) + f" end{i}") for i in range(2)]
    assert run(spark, docs) == brute(docs)


def test_one_order_finds_the_same(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(80).collect()]
    assert run(spark, docs, orders=1, percent=60) == brute(docs, percent=60)


def test_templates_give_few_candidates(spark, monkeypatch):
    """1,500 pages of one template (300 common words, 60 own, similarity 0.7): no pair is verified, as rare words come first."""
    common = " ".join(f"c{i}" for i in range(300))
    docs = [(i, f"{common} " + " ".join(f"o{i}x{j}" for j in range(60))) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    seen = []
    plain = ngram_join.filtered
    monkeypatch.setattr(ngram_join, "filtered", lambda pairs, *a: (seen.append(pairs.count()), plain(pairs, *a))[1])
    assert ngram_components(df).where("component_id <> doc_id").count() == 0
    assert sum(seen) <= 2 * len(docs)


def test_prefixes_under_every_order_meet():
    rng = np.random.default_rng(3)
    common = np.zeros(ngram_join.COUNTERS, np.uint64)
    for _ in range(200):
        both = rng.integers(0, 1 << 63, rng.integers(6, 60)).astype(np.uint64)
        one = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, 1).astype(np.uint64)]))
        two = np.unique(both)
        if 100 * len(np.intersect1d(one, two)) >= 85 * len(np.union1d(one, two)):
            for p, q in zip(ngram_join.prefixes(one, common, 85, 3), ngram_join.prefixes(two, common, 85, 3), strict=True):
                assert set(p.tolist()) & set(q.tolist())


def test_empty_table(spark):
    assert run(spark, []) == []
