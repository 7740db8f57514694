"""Line dedup on planted templates; the pipeline's stages on the supplied tables."""

import corpus_pipeline

from tiermill.llm.line_dedup import drop_lines
from tiermill.llm.near_dup import near_duplicates

SCHEMA = "doc_id long, text string, n_chars int, n_dropped string"


def run(spark, docs):
    df = spark.createDataFrame([(d, t, len(t or ""), "x") for d, t in docs], SCHEMA)
    return sorted(((r.doc_id, r.text, r.n_dropped) for r in drop_lines(df).collect()), key=repr)


def test_recurring_templates(spark):
    names = "ann bob cat dan eve fay gus hal ida jon kim lou".split()
    docs = [(i, f"own text {n} of this document {n} alone\nPosted in blog by {n} on May {i} at noon\nOf.") for i, n in enumerate(names)]
    docs += [(50, None), (51, ""), (52, "a\n\nPosted in blog by zoe on May 77 at noon\n"), (52, "a\n\nPosted in blog by zoe on May 77 at noon\n")]
    docs += [(60 + i, "exact copies count once however many there are") for i in range(15)]
    got = dict(((d, t), n) for d, t, n in run(spark, docs))
    assert got[0, docs[0][1]] == 0  # the first occurrence stays
    for i, n in list(enumerate(names))[1:]:
        assert got[i, f"own text {n} of this document {n} alone"] == 2  # short lines go by default, too
    assert got[52, "a\n\n"] == 1 and got[50, None] == 0 and got[51, ""] == 0
    assert all(got[60 + i, docs[-1][1]] == 0 for i in range(15))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, function(spark, docs, sf_dir)
        assert docs.columns == before.columns, name
        assert 0 < docs.count() <= before.count(), name
        if name == "line dedup":
            assert docs.count() == before.count()
        if name == "near-dedup":
            assert near_duplicates(docs).where("not kept").isEmpty()
