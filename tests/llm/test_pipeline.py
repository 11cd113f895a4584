"""Each stage of the pipeline against a plain version, on its own input."""

import collections
import re

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from harkline.llm import bpe, pii, quality, queries
from harkline.llm.common import table
from harkline.session import written
from tests.conftest import SMALL
from tests.llm.test_tables import SPACE, plain_components, plain_targets


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SMALL, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], SMALL), f"test-{name}"))
    return seen


def test_stages(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "tokens"]
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert "pipeline" in entry.queries()


def test_quality(spark, steps):
    report = {r.doc_id: r for r in quality.quality_report(steps[0], table(spark, SMALL, "labels")).collect()}
    assert sorted(r.doc_id for r in steps[1].collect()) == sorted(i for i, r in report.items() if r.kept)
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall())
    kept = {i for i, r in report.items() if r.kept}
    good = [i in kept for i, q in labels.items() if q == 1]
    bad = [i in kept for i, q in labels.items() if q == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.2


def test_near_duplicates(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    found, _ = plain_components(rows)
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted({component for *_, component in found})


def test_personal_data(steps):
    before = {r.doc_id: r for r in steps[2].collect()}
    for r in steps[3].collect():
        text = before[r.doc_id].text
        assert r.text == pii.redact(text, pii.find(text)) and r.n_chars == len(r.text)
        assert not pii.base_spans(r.text)


def test_mixing(steps):
    texts = {r.doc_id: (r.text, r.source) for r in steps[3].collect()}
    size, taken = collections.Counter(), collections.Counter()
    for text, source in texts.values():
        size[source] += len(SPACE.findall(text))
    for r in steps[4].collect():
        words, whole = SPACE.findall(r.text), SPACE.findall(texts[r.doc_id][0])
        taken[r.source] += len(words)
        rest = iter(whole)
        assert all(w in rest for w in words)  # words of the document, in its order
        assert r.n_chars == len(r.text)
    target = plain_targets(size)
    assert all(abs(taken[s] - target[s]) <= 4 * 64 for s in size)


def test_tokens(steps):
    plain = bpe.TreeBpe(queries.RANKS, public_tokenizers.PATTERN)._leaf
    mixed = collections.Counter((r.doc_id, tuple(plain.encode_ordinary(r.text))) for r in steps[4].collect())
    got = steps[5].collect()
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == mixed
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, SMALL)
    key = lambda r: (r.doc_id, r.ids)
    assert sorted(map(key, got.collect())) == sorted(map(key, steps[5].collect()))


def test_defined_cases(spark, docs, empty, tmp_path):
    """Nulls, empty texts, repeated rows, clashing names and empty tables pass every stage."""
    spark.createDataFrame([(5, 1), (6, 1), (33, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            frame = written(stage(spark, frame, str(tmp_path)), f"test-{name}")
            if name != "tokens":
                assert frame.columns == docs.columns
        assert re.search("round_trip", str(frame.columns))
