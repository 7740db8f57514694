"""Repeated strings against a table of all windows."""

from collections import Counter

import pytest

from tiermill.llm import repeats
from tiermill.llm.repeats import remove_repeats


def brute(docs, width):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for (doc, _), t in zip(docs, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out.append((doc, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def run(spark, docs, **settings):
    found = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), **settings).collect()
    return sorted(
        ((r.doc_id, r.n_bytes, sum(s.hi - s.lo for s in r.spans), len(r.spans), bytes(r.rest)) for r in found), key=repr
    )


@pytest.mark.parametrize("hot", [1000, 1])
def test_supplied_documents(spark, sf_dir, hot):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r.text) < 30_000]
    line = "ä shared passage that many rows hold, long enough " * 5
    docs += [(None, None), (1, ""), (7000, line), (7000, line), (7001, "a" * 777), (7002, "x" + line[30:] + "y"), (None, line[9:260])]
    assert run(spark, docs, hot=hot) == brute(docs, 200)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_texts_without_repeats_store_nothing(spark, monkeypatch):
    """What is stored between steps grows with the repeated text, not with all text."""
    rows = []
    inner = repeats.stage

    def noted(df, name):
        staged = inner(df, name)
        rows.append(staged.count())
        return staged

    monkeypatch.setattr(repeats, "stage", noted)
    docs = [(i, " ".join(f"{i}w{j}" for j in range(300))) for i in range(40)]
    assert run(spark, docs) == brute(docs, 200)
    assert rows and sum(rows) == 0


@pytest.mark.parametrize("hot", [1000, 1])
def test_texts_are_shuffled_once(spark, hot):
    """Gathering surroundings and cutting the texts use one shuffle of them."""
    docs = [(i, f"{i} first words " + "words that all of them have " * 20 + f"and the end of {i} " * 20) for i in range(20)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), hot=hot)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    made = [line for line in plan.splitlines() if "Exchange " in line or "ReusedExchange" in line]
    first = [line for line in made if "Reused" not in line]
    assert len([line for line in first if "Exchange hashpartitioning(key" in line]) == 3, made  # of texts, of places in them, of runs
    assert len([line for line in first if "REPARTITION_BY_NUM" in line]) == 1, made  # surroundings, for both ways of comparing them
    assert len(made) > len(first)


def test_copies_in_a_slice_burden_one_group_once(spark):
    """Equal surroundings of a slice reach the group of their anchor as one row; the others are known to be repeated."""
    text = " ".join(f"w{j}" for j in range(300))
    docs = spark.createDataFrame([(i, text) for i in range(50)], "key long, text string").coalesce(1)
    found = repeats._anchors(docs, 200, 50).collect()
    groups = Counter(r.anchor for r in found)
    assert len(found) == 50 * len({r.at for r in found}) and set(groups.values()) == {1}
    assert all(r.n > 1 for r in found)
