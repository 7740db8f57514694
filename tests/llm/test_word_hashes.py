"""Words hashed without Python objects against the words themselves."""

import numpy as np
import pyarrow as pa

from tiermill.llm.common import BLOCK_BYTES, Powers, hashed_words, shingle_sets, words_of

TEXTS = ["skipped", None, "", " \t\n", "One two three", "x\x1cy one\x0bONE  two\r", "É é éÉ", "a" * (BLOCK_BYTES + 1), "A" * (BLOCK_BYTES + 1)]
TEXTS += [" ".join(f"w{i % 977}" for i in range(60_000)), "abc", "ab c", "c ab", "ba ba ab", "Z[ z[ @` @@", "left"]


def test_equal_words_only_have_equal_hashes():
    found, borders = hashed_words(pa.array(TEXTS)[1:-1], Powers())
    words = [[w.lower() for w in words_of(t)] for t in TEXTS[1:-1]]
    assert np.diff(borders).tolist() == [len(w) for w in words] and borders[0] == 0 and borders[-1] == len(found)
    pairs = set(zip([w for ws in words for w in ws], found.tolist(), strict=True))
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


def test_sets_do_not_cross_texts():
    together = shingle_sets(pa.array(TEXTS), 3, Powers())
    alone = [shingle_sets(pa.array([t], pa.string()), 3, Powers())[0] for t in TEXTS]
    assert [s.tolist() for s in together] == [s.tolist() for s in alone]
    for text, found in zip(TEXTS, together, strict=True):
        words = [w.lower() for w in words_of(text)]
        assert len(found) == len({tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else ())
