"""Near duplicates against all pairs compared in plain Python."""

import random
import re
from itertools import combinations

from tiermill.llm import near_dup
from tiermill.llm.near_dup import near_duplicates

SCHEMA = "doc_id long, text string, n long, digest string"


def brute(docs, k):
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    label = list(range(len(docs)))
    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
            old, new = label[i], label[j]
            label = [new if x == old else x for x in label]
    lowest = {}
    for (doc, _), x in zip(docs, label, strict=True):
        lowest[x] = min(doc, lowest.get(x, doc))
    return sorted((doc, len(s), lowest[x], doc == lowest[x]) for (doc, _), s, x in zip(docs, sets, label, strict=True))


def run(spark, docs, k=4):
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], SCHEMA)
    return sorted(map(tuple, near_duplicates(df, k).collect()))


def test_supplied_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, docs) == brute(docs, 4)


def test_chains_stars_and_edges(spark):
    base = [f"w{i}" for i in range(60)]
    docs = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE two"), (5, "one two three"), (6, "É"), (7, "é")]
    docs += [(50 - i, " ".join(base[i * 3 : i * 3 + 45])) for i in range(6)]  # each like the next only
    star = [f"s{i}" for i in range(80)]
    docs += [(100 + i, " ".join(star[: i * 8] + [f"x{i}", f"y{i}"] + star[i * 8 + 2 :])) for i in range(8)]
    docs += [(200, " ".join(star)), (201, " ".join(star)), (201, " ".join(star))]
    assert run(spark, docs) == brute(docs, 4)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_template_pages_with_copies_among_them(spark):
    """Pages of one template fill buckets together; those of them that are copies still find each other, and no others."""
    frame = [f"t{i}" for i in range(150)]
    docs = [(i, " ".join(frame + [f"o{i}x{j}" for j in range(30)])) for i in range(60)]
    docs += [(100 + i, " ".join([*docs[i][1].split(), "one", "more"])) for i in range(0, 60, 3)]
    docs += [(200 + i, " ".join([f"y{i}", *docs[i][1].split()])) for i in range(0, 60, 5)]
    assert run(spark, docs) == brute(docs, 4)


def test_pages_of_one_template_make_few_pairs(spark, monkeypatch):
    """What reaches the estimate grows with the pages, not with their square."""
    seen = []
    inner = near_dup.estimated
    monkeypatch.setattr(near_dup, "estimated", lambda pairs, *rest: seen.append(pairs.count()) or inner(pairs, *rest))
    pages = 300
    frame = [f"t{i}" for i in range(300)]
    docs = [(i, " ".join(frame + [f"o{i}x{j}" for j in range(60)])) for i in range(pages)]
    assert all(kept for *_, kept in run(spark, docs))
    assert sum(seen) <= 2 * (1 + near_dup.BANDS) * pages
    assert seen[-1] == 0 or len(seen) < 3


def test_changed_copies_of_one_text_make_few_pairs(spark, monkeypatch):
    """Copies meet the least changed one of them first, and of the others only those that may be similar: a few pairs a copy."""
    seen = []
    inner = near_dup.estimated
    monkeypatch.setattr(near_dup, "estimated", lambda pairs, *rest: seen.append(pairs.count()) or inner(pairs, *rest))
    rng = random.Random(7)
    base = [f"b{i}" for i in range(140)]
    docs = [(500, " ".join(base))]
    for i in range(300):
        words = list(base)
        for j in rng.sample(range(140), 2 + i % 8):
            words[j] = f"c{i}x{j}"
        docs.append((i, " ".join(words)))
    assert run(spark, docs) == brute(docs, 4)
    assert sum(seen) <= 8 * len(docs)
