"""The pipeline's stages decide per row: null ids and shared ids take no other row with them."""

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, source string"
CLEAN = "the committee met on monday and read the plan of the town for {} new houses by the river"
TOXIC = "you filthy wretched scum go away you filthy wretched scum nobody wants filthy wretched scum here {}"


@pytest.fixture
def labelled(spark, tmp_path):
    spark.createDataFrame([(i, int(i >= 60)) for i in range(120)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return [(i, (TOXIC if i >= 60 else CLEAN).format(i), "s") for i in range(120)]


def test_toxicity_per_row(spark, tmp_path, labelled):
    more = [(None, CLEAN.format("none"), "s"), (None, TOXIC.format("none"), "s"), (None, None, "s")]
    more += [(500, CLEAN.format("same"), "s"), (500, TOXIC.format("same"), "s"), (501, CLEAN.format("twice"), "s")] * 2
    got = corpus_pipeline.toxicity(spark, spark.createDataFrame(labelled + more, SCHEMA), str(tmp_path))
    want = [r for r in labelled + more if not (r[1] or "").startswith("you")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_near_copies_per_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = [(1, a, "s"), (None, a + " end", "s"), (None, "another text of its own without any copy", "s"), (None, "", "s")]
    docs += [(7, a + " more", "s"), (7, "a unique text that shares its id with a copy", "s")]
    docs += [(None, b, "s"), (None, b + " end", "s"), (9, c, "s"), (9, c + " end", "s"), (12, "said over and over again here", "s")]
    docs += [docs[-1], (None, "", "s")]
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, spark.createDataFrame(docs, SCHEMA), "").collect()), key=repr)
    fixed = [(1, a), (None, docs[2][1]), (None, ""), (None, ""), (7, docs[5][1]), (12, docs[10][1])]
    left = [r for r in got if r not in fixed]
    assert sorted(got, key=repr) == sorted(fixed + left, key=repr)
    assert len(left) == 2 and {t.split()[0] for _, t in left} == {"b0", "c0"}  # one of each group of equal ids
