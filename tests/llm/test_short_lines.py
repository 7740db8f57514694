"""Lines of one to three words recur and go like longer ones, in the operator, its query and the pipeline's stage."""

import hashlib

import corpus_pipeline

from tiermill.llm.queries import op9_line_dedup

SHORT = ["Les.", "And ornd.", "All rights reserved."]


def test_short_lines(spark, tmp_path):
    docs = [(i, "\n".join([f"own{chr(97 + i)}", *SHORT, "", "Page 7", f"text{chr(97 + i)} alone"])) for i in range(12)]
    docs += [(20 + i, f"rare\nonly{chr(97 + i)}") for i in range(9)]  # in fewer than ten texts
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rest = {i: f"own{chr(97 + i)}\n\nPage 7\ntext{chr(97 + i)} alone" for i in range(1, 12)}  # blank lines and half-variable ones stay
    want = {d: rest.get(d, t) for d, t in docs}  # the first occurrence stays
    got = {r.doc_id: r for r in op9_line_dedup(spark, str(tmp_path)).collect()}
    assert {d: r.left_sha256 for d, r in got.items()} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    assert {d: r.n_dropped for d, r in got.items()} == {d: 3 * (d in rest) for d, _ in docs}
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.text for r in corpus_pipeline.lines(spark, table, str(tmp_path)).collect()} == want
