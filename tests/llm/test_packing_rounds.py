"""No round of packing gathers more in a group than a task packs, also where nothing fits together."""

import pytest
from pyspark.sql import functions as F

from tiermill.llm import packing


@pytest.mark.parametrize("extra", [[], [10], [1700] * 300])
def test_groups_stay_bounded(spark, monkeypatch, extra):
    sizes, real = [], packing.stage

    def watched(df, name):
        out = real(df, name)
        if name.startswith("bins"):
            group = F.shiftright("bin", packing.BIN_BITS)
            sizes.append(out.groupBy(group).agg(F.countDistinct("item").alias("n")).agg(F.max("n")).first()[0])
        return out

    monkeypatch.setattr(packing, "stage", watched)
    lengths = [2500 + i % 1000 for i in range(2000)] + extra
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    packed = packing.pack(pieces, group_items=100).collect()
    assert max(sizes) <= 200  # groups of about 100, dealt by hash
    assert sorted((r.doc_id, r.length) for r in packed) == list(enumerate(lengths))
    held = {}
    for r in packed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 4096
    best = len(packing.best_fit(lengths)[2])
    assert len(held) <= best * 1.05 + 2
