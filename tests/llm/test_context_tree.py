"""Every context of the training text counts in a language-model score."""

import collections
import math
import random

import numpy as np
import pytest

from harkline.llm import ctw
from tests.llm.conftest import ROWS

DEPTH = 5


def edged(text):
    return b"\xff" * DEPTH + (text or "").encode().lower() + b"\xff"


def plain_scores(training, texts):
    """Context-tree weighting over all contexts, in dictionaries, by recursion from the leaves."""
    counts = [collections.defaultdict(lambda: [0, 0]) for _ in range(DEPTH + 1)]
    for data in map(edged, training):
        for i in range(DEPTH, len(data)):
            for d in range(DEPTH + 1):
                for bit in range(8):
                    prefix = (1 << bit) | (data[i] >> (8 - bit))
                    counts[d][data[i - d:i], prefix][data[i] >> (7 - bit) & 1] += 1
    below, weight = [collections.defaultdict(float) for _ in range(DEPTH + 2)], [{} for _ in range(DEPTH + 1)]
    for d in range(DEPTH, -1, -1):
        for (context, prefix), (zeros, ones) in counts[d].items():
            own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
            rest = below[d][context, prefix]
            weight[d][context, prefix] = 1.0 if d == DEPTH else 1 / (1 + np.exp(min(rest - own, 700)))
            below[d - 1][context[1:], prefix] += own if d == DEPTH else np.logaddexp(own, rest) - math.log(2)

    def chance(history, prefix):
        mixed, left = 0.0, 1.0
        for d in range(DEPTH + 1):
            key = history[DEPTH - d:], prefix
            if key not in weight[d]:
                break
            zeros, ones = counts[d][key]
            mixed += left * weight[d][key] * (ones + 0.5) / (zeros + ones + 1)
            left *= 1 - weight[d][key]
        return mixed + left / 2

    known, out = {}, []
    for data in map(edged, texts):
        total = 0.0
        for i in range(DEPTH, len(data)):
            run = data[i - DEPTH:i + 1]
            if run not in known:
                ones = [chance(run[:DEPTH], (1 << bit) | (run[DEPTH] >> (8 - bit))) for bit in range(8)]
                known[run] = sum(math.log10(p if run[DEPTH] >> (7 - bit) & 1 else 1 - p) for bit, p in enumerate(ones))
            total += known[run]
        out.append(total)
    return out


def check(frame, rows):
    got = ctw.score_documents(frame).collect()
    held = {str(r.doc_id): r.held_out for r in got}
    want = plain_scores([t for i, t in rows if not held[str(i)]], [t for _, t in rows])
    told = sorted((str(i), round(w, 5)) for (i, _), w in zip(rows, want))
    found = sorted((str(r.doc_id), round(r.score, 5)) for r in got)
    assert [i for i, _ in told] == [i for i, _ in found]
    assert np.allclose([w for _, w in told], [s for _, s in found], rtol=1e-8, atol=2e-5)


@pytest.mark.parametrize("slots", [1 << 21, 64])
def test_more_contexts_than_a_fixed_table_holds(spark, monkeypatch, slots):
    monkeypatch.setattr(ctw, "SLOTS", slots)
    draw = random.Random(8)
    rows = [(i, "".join(draw.choices("abcdefghijklmnopqrstuvwxyz é", k=900))) for i in range(24)]
    rows += [(i + 24, t[:450] + rows[i + 1][1][450:]) for i, (_, t) in enumerate(rows[:10])]
    contexts = {(d, e[i - d:i]) for e in (edged(t) for _, t in rows) for i in range(DEPTH, len(e)) for d in range(1, 6)}
    assert len(contexts) > 1 << 15
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_many_pieces(spark, monkeypatch):
    """Pieces of few runs, and one piece that holds a third of them."""
    monkeypatch.setattr(ctw, "PIECE_RUNS", 60)
    draw = random.Random(11)
    rows = [(i, "".join(draw.choices("abcdé ", k=300)) + "".join(f"the{draw.choice('abcdef')}{draw.randrange(10)}" for _ in range(40))) for i in range(20)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


@pytest.mark.parametrize("slots", [1 << 21, 64])
def test_defined_cases(docs, monkeypatch, slots):
    monkeypatch.setattr(ctw, "SLOTS", slots)
    rows = [(i, t if t is None else "".join(c.lower() if c.isascii() else c for c in t)) for i, t, _ in ROWS if i != 33]
    check(docs.where("doc_id is null or doc_id <> 33"), rows)


def test_slots():
    keys = np.arange(300, dtype=np.int64) * 977
    values, held = ctw.Slots(keys, keys / 7, 64).look_up(np.concatenate((keys, keys + 1)))
    assert not held[300:].any() and held[0] and 32 <= held.sum() <= 96
    assert (values[:300] == np.where(held[:300], keys / 7, 0)).all()
