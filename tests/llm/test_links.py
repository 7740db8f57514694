"""Connected components against plain label merging, and how many steps they take."""

import random

import pytest

from tiermill.llm import links, near_dup


def plain(edges):
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for a, b in edges:
        if a != b and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = {x: lo if c == hi else c for x, c in label.items()}
    return sorted(label.items())


@pytest.fixture
def steps(monkeypatch):
    """The shuffles of every step that ``components`` writes."""
    seen, inner = [], links.stage

    def counted(df, name, *rest):
        seen.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return inner(df, name, *rest)

    monkeypatch.setattr(links, "stage", counted)
    return seen


def run(spark, edges):
    return sorted(map(tuple, links.components(spark.createDataFrame(edges, "a long, b long")).collect()))


def test_any_graph(spark, interpreted):
    rng = random.Random(5)
    graphs = [[], [(4, 4)], [(1, 2), (2, 1), (1, 2), (3, 3)], [(i, i + 1) for i in range(20)], [(i, 99) for i in range(30)]]
    graphs += [[(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (15, 40, 90)]
    for edges in graphs:
        assert run(spark, edges) == plain(edges), edges


def test_stars_are_seen_at_once(spark, steps):
    """Links to the smallest of each group, some given twice and some the other way round, take one shuffle."""
    edges = [(100 * g + i, 100 * g) for g in range(5) for i in range(1, 40)]
    edges += [(b, a) for a, b in edges[::7]] + edges[::5]
    assert run(spark, edges) == plain(edges)
    assert steps == [1]


def test_a_hub_that_is_not_the_smallest_takes_one_round(spark, steps):
    edges = [(i, 77) for i in range(200) if i != 77]
    assert run(spark, edges) == plain(edges)
    assert len(steps) <= 4 and sum(steps) <= 8


def test_near_dup_goes_on_from_known_components(spark, monkeypatch):
    """Later links join the components found before: the graph is then small, and no earlier link is looked at again."""
    seen, inner = [], near_dup.components
    monkeypatch.setattr(near_dup, "components", lambda edges: seen.append(edges.where("a <> b").collect()) or inner(edges))
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for j in rng.sample(range(120), 2 + i % 8):
            words[j] = f"c{i}x{j}"
        docs.append((i, " ".join(words)))
    near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect()
    known = {}
    for edges in seen:
        for a, b in edges:  # a class and its component, or two components
            assert known.get(b, b) == b and known.get(a, a) in (a, b)
        known = dict(plain([tuple(e) for e in edges]))
    assert len(seen) > 1
