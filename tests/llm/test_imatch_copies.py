"""I-Match fingerprints where one group of copies holds a third of the rows."""

import collections
import random
import re
import statistics

import pytest
import xxhash

from harkline.llm import imatch, queries

DRAW = random.Random(4)
WORDS = [f"w{i}" for i in range(3000)]
HOT = DRAW.sample(WORDS, 150)


def table(exact):
    texts = [" ".join(DRAW.sample(WORDS, 150)) for _ in range(200)]
    for i in range(100):
        words = list(HOT)
        if not exact:
            words[DRAW.randrange(150)] = f"edit{i}"
        texts.append(" ".join(words))
    return list(enumerate(texts))


@pytest.mark.parametrize("exact", [True, False])
def test_a_group_with_a_third_of_the_rows(spark, tmp_path, exact):
    rows = table(exact)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_imatch(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    hot = [got[i] for i in range(200, 300)]
    assert not any(f.startswith("whole.") for r in hot for f in (r.fingerprint, r.edited_fingerprint))
    # the successor of all but the last is a copy
    assert statistics.mean(got[i].near_next for i in range(201, 300)) > 0.6


def test_lexicon_counts_distinct_texts(spark):
    rows = table(True) + [(i, "w1 w2 rare") for i in range(300, 320)] + [(320, "w1 other"), (321, None), (322, "")]
    found = imatch.lexicon(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), distinct=True)
    texts = {t or "" for _, t in rows}
    seen = collections.Counter(w for t in texts for w in set(re.findall(r"\w+", t)))
    want = {xxhash.xxh64_intdigest(w, 42) for w, n in seen.items() if 2 <= n <= len(texts) / 2}
    assert {r.code & (1 << 64) - 1 for r in found.collect()} == want
