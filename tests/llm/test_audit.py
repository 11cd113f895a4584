"""The filter audit against documents that are filtered one by one."""

import re
from collections import Counter
from itertools import permutations

import pytest

from harkline.llm import audit
from tests.llm.conftest import ROWS


def plain_failures(rows):
    """The letters each (doc_id, text) fails."""
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        out.append(failed + "E" * (doc_id is not None and first[text] < doc_id))
    return out


def plain_audit(rows, labels):
    out = {}
    failed = plain_failures(rows)
    parts = {s or "" for _, _, s in rows}
    shapley = Counter()
    for part in parts:
        mine = [(set(f), i) for f, (i, _, s) in zip(failed, rows) if (s or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), k] = [
                    len(left), len(gone), sum(f in x[0] for x in mine) - len(gone), sum(x[0] == {f} for x in mine),
                    sum((1, 0) in labels.get(i, ()) or (1, 1) in labels.get(i, ()) for _, i in gone),
                    sum((0, 1) in labels.get(i, ()) or (1, 1) in labels.get(i, ()) for _, i in gone),
                ]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


#: doc_id: its labels as (quality, toxic).
LABELS = {0: [(1, 0)], 5: [(0, 1)], 6: [(1, 1)], 31: [(0, 0), (1, 0)], 33: [(0, 1), (0, 1)], 34: [(1, 0)], 77: [(1, 1)]}


@pytest.fixture
def labels(spark):
    rows = [(i, *x, "e") for i, some in LABELS.items() for x in some]
    return spark.createDataFrame([*rows, (None, 1, 1, "e"), (7, None, None, "e")], "doc_id long, quality int, toxic int, text string")


def test_every_order_and_step(docs, labels):
    got = audit.filter_audit(docs, labels).collect()
    assert {tuple(r) for r in got} == plain_audit(ROWS, LABELS) and len(got) == 600 * len({s for _, _, s in ROWS if s} | {""})


def test_identical_texts(spark, labels):
    """A third of the rows are one text; its ids do not stand in order, and one is repeated."""
    rows = [((i * 37) % 101, "Same words & more " * 80 if i % 3 else f"w{i} " * 300, "s") for i in range(90)]
    rows += [rows[1], (None, rows[1][1], "s"), (-4, None, None), (-5, "", None)]
    got = audit.filter_audit(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), labels)
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, LABELS)


def test_hand_made_tensor(spark):
    """One document fails all, one nothing, one B only."""
    counts = spark.createDataFrame([("p", 31, 1, 1, 0), ("p", 0, 1, 0, 0), ("p", 8, 1, 0, 1)], "part string, code int, n long, good long, bad long")
    got = {(r.filter_order, r.step): r for r in audit.interactions(counts).collect()}
    first, second = got["BACDE", 1], got["ABCDE", 2]
    assert (first.kept, first.removed, first.redundant, first.unique_fails, first.good_lost, first.toxic_lost) == (1, 2, 0, 1, 1, 1)
    assert (second.kept, second.removed, second.redundant, second.toxic_lost) == (1, 1, 1, 1)
    assert first.shapley == second.shapley == 120 + 24 and got["ABCDE", 1].shapley == 24


def test_empty_table(empty, labels):
    assert audit.filter_audit(empty, labels).count() == 0
