"""Removal of repeated passages against a dictionary of all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harkline.llm import repeats
from harkline.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import ROWS


def plain_repeats(rows):
    """Rows are (doc_id, text); those of one doc_id hold one text, or the order is not known here."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        for i in range(len(data) - 99):
            window = data[i:i + 100]
            if window in seen:
                gone[i:i + 100] = True
            seen.add(window)
        gone[-1] = False
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(data) else 0
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def told(frame):
    return sorted((tuple(r) for r in repeats.repeat_report(frame).collect()), key=str)


def drawn_rows(seed, count):
    """Texts of shared passages, some only just long enough, some edited, some of one letter."""
    draw = random.Random(seed)
    letters = "abcdefghij klmnop é日\n"
    passages = ["".join(draw.choices(letters, k=k)) for k in (60, 95, 99, 100, 101, 140, 400, 1500)]
    passages += ["z" * 700, "ab" * 200, "0123456789" * 30, "\0" * 150, passages[-1][:200] + "!" + passages[-1][200:500]]
    rows = []
    for i in draw.sample(range(-50, 4 * count), count):
        parts = ["".join(draw.choices(letters, k=draw.randrange(0, 150))) for _ in range(draw.randrange(1, 5))]
        mixed = [x for p in parts for x in (p, draw.choice([*passages, ""]))]
        rows.append((i, "".join(mixed)))
    rows += [(10_000, None), (10_001, ""), (10_002, rows[0][1]), (10_003, rows[1][1] + rows[1][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_dictionary(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "_CONTEXTS", [1 << 17, 500, 90][seed - 1])
    monkeypatch.setattr(repeats, "BUCKET", [150_000, 40, 300][seed - 1])
    monkeypatch.setattr(repeats, "MOST_BITS", [29, 29, 0][seed - 1])
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", [64 << 20, 64 << 20, 0][seed - 1])
    rows = drawn_rows(seed, 90)
    frame = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, at int, d string")
    assert told(frame.repartition(6)) == plain_repeats(rows)


def test_table(spark):
    docs = table(spark, SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert told(docs) == plain_repeats(rows)


def test_a_passage_in_a_third_of_all_documents(spark, monkeypatch):
    """Its surroundings differ everywhere, so its borders are a large class of suffixes and of left parts."""
    monkeypatch.setattr(repeats, "BUCKET", 60)
    draw = random.Random(9)
    passage = "".join(draw.choices("abcdefgh ", k=250))
    other = ["".join(draw.choices("abcdefgh ", k=300)) for _ in range(300)]
    rows = [(i, t[:150] + passage + t[150:] if i % 3 == 0 else t) for i, t in enumerate(other)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert told(frame) == plain_repeats(rows)
    kept = {r.doc_id: bytes(r.kept).decode() for r in repeats.kept_bytes(frame).collect()}
    assert kept[0] == rows[0][1] and passage[1:-1] not in kept[3] and kept[1] == other[1]


def test_repeated_rows_and_null_ids(spark, docs, empty):
    """Rows of one id and text: one is first; two texts under one id have an order, whichever it is."""
    text = "".join(random.Random(4).choices("abcdefgh ", k=500))
    rows = [(7, text), (7, text), (7, text), (8, text[:120]), (None, text), (None, text), (7, "short"), (7, "short")]
    got = told(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    empty_hash = hashlib.sha256(b"").hexdigest()
    gone = [(7, 500, 500, 1, empty_hash)] * 2 + [(8, 120, 120, 1, empty_hash)] + [(None, 500, 500, 1, empty_hash)] * 2
    stays = [(7, 500, 0, 0, hashlib.sha256(text.encode()).hexdigest())] + [(7, 5, 0, 0, hashlib.sha256(b"short").hexdigest())] * 2
    assert got == sorted(gone + stays, key=str)
    two = [(5, text + "1"), (5, text + "2")]
    got = told(spark.createDataFrame(two, "doc_id long, text string"))
    assert sorted(r[2] for r in got) == [0, 500]
    assert sorted(r[:2] for r in told(docs.where("doc_id is not null"))) == sorted(
        (i, len((t or "").encode())) for i, t, _ in ROWS if i is not None
    )
    assert told(empty) == []


def test_multikey_order():
    draw = np.random.Generator(np.random.PCG64(5))
    rows = draw.integers(0, 3, (3000, 24), dtype=np.uint8) * (draw.random((3000, 1)) < 0.7)
    rows = rows.astype(np.uint8)
    order = repeats.multikey_order(rows)
    assert sorted(order) == list(range(3000))
    told_rows = [bytes(rows[i]) for i in order]
    assert told_rows == sorted(told_rows)


def test_equal_windows_have_their_anchor_at_one_offset():
    draw = np.random.Generator(np.random.PCG64(6))
    window = draw.integers(97, 101, 100, dtype=np.uint8)
    offsets = set()
    for _ in range(50):
        around = [draw.integers(97, 101, draw.integers(0, 90), dtype=np.uint8) for _ in range(2)]
        data = np.concatenate((around[0], window, around[1]))
        _, place, start, final = repeats._anchors(data, 0, len(data), np.array([[0], [len(data)]]))
        at = len(around[0])
        (k,) = np.flatnonzero((start <= at) & (final >= at))
        offsets.add(int(place[k] - at))
    assert len(offsets) == 1


def test_anchors_in_chunks(monkeypatch):
    """Every window has one anchor, wherever chunks begin; texts shorter than a window have none."""
    draw = np.random.Generator(np.random.PCG64(8))
    lengths = np.array([0, 99, 100, 2500, 7, 101, 0, 900, 50, 3000])
    data = draw.integers(97, 101, lengths.sum(), dtype=np.uint8)
    begins = np.cumsum(lengths) - lengths
    starts = [b + k for b, n in zip(begins, lengths) for k in range(n - 99)]

    def anchors_of_windows():
        out = {}
        for digest, place, start, final in repeats._chunks(data, lengths):
            for g, p, a, b in zip(digest, place, start, final):
                for s in range(a, b + 1):
                    assert s not in out and s <= p <= s + 100 - repeats.GRAM
                    out[s] = int(p), int(g)
        return out

    whole = anchors_of_windows()
    assert sorted(whole) == starts
    for chunk in (64, 100, 333, 2600):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        assert anchors_of_windows() == whole
