"""Interaction of quality filters, from a contingency tensor of their failures.

Each document fails or passes five filters, which makes a cell of a 2x2x2x2x2 tensor (0:
passes, 1: fails). A part of the corpus needs its 32 counts only: whatever order the
filters are applied in, and whatever a step keeps, removes or leaves to others, is a
contraction of that tensor with a vector for each axis that selects pass (1, 0), fail
(0, 1) or all (1, 1). All 120 orders of five filters and their steps are one `einsum`.

The texts are read once. The identical-text filter needs the smallest id of each text
only: one number for each digest, combined before its shuffle, joined back to rows of a few
bytes. Counts combine in the tasks too, so a part or a text with most of the rows is as
cheap as any other. `tensor` has 32 rows a part at most.

Defined cases: a null text is an empty text; a null source is the part ``''``; a document
without doc_id is never the copy of a smaller one; rows of one doc_id and text are each
counted and none is a copy of the other; a doc_id with several labels has each mark that
one of them has; documents without label have no marks; an empty table gives an empty
result. Other columns of the documents are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harkline.session import written

#: The filters by letter; a letter is an axis of the tensor.
FILTERS = "ABCDE"
_SPACE = " \t\n\x0b\f\r"
_WORD_END = r"[ \t-\r]+"
#: Parts whose tensors are contracted at a time.
_PARTS = 64

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

RESULT = {
    "part": "string", "filter_order": "string", "step": "int", "kept": "long", "removed": "long", "redundant": "long",
    "unique_fails": "long", "good_lost": "long", "toxic_lost": "long", "shapley": "long",
}


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions on one text alone: few words, repeated words, capitals, symbols."""
    trimmed = F.btrim(text, F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WORD_END))
    count = F.size(words)
    return {
        "A": count < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * count.cast("long"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame) -> DataFrame:
    """`doc_id`, `part` and `code`, the failures of each document as bits, the first filter's highest."""
    rows = docs.select(
        docs["doc_id"], F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    own = sum(failed.cast("int") * (1 << (4 - FILTERS.index(f))) for f, failed in text_failures(F.col("text")).items())
    rows = written(rows.select("doc_id", "part", own.alias("own"), F.unhex(F.sha2("text", 256)).alias("digest")), "audit")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).cast("int")
    joined = rows.join(first.select("digest", "first"), "digest", "left")
    return joined.select("doc_id", "part", (F.col("own") + copy).alias("code"))


def tensor(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """`part`, `code`, and how many documents, good ones and toxic ones have that code."""
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    marks = marks.where("doc_id is not null and (good = 1 or bad = 1)")
    marked = failed.join(marks, "doc_id", "left")
    return marked.groupBy("part", "code").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"),
    )


def _selection(choices: list[dict[str, tuple[int, int]]]) -> np.ndarray:
    """A tensor of weights for each choice of a vector by axis; axes that are not chosen take all."""
    axes = [np.array([c.get(f, ALL) for c in choices], dtype=np.int64) for f in FILTERS]
    return np.einsum("sa,sb,sc,sd,se->sabcde", *axes)


def contractions() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """Every (order, step), and what each measure selects of the tensor there."""
    steps = [("".join(order), k) for order in permutations(FILTERS) for k in range(1, len(FILTERS) + 1)]

    def before(order, k):
        return dict.fromkeys(order[:k - 1], PASS)

    return steps, {
        "kept": _selection([before(o, k) | {o[k - 1]: PASS} for o, k in steps]),
        "removed": _selection([before(o, k) | {o[k - 1]: FAIL} for o, k in steps]),
        "failed": _selection([{o[k - 1]: FAIL} for o, k in steps]),
        "unique_fails": _selection([dict.fromkeys(FILTERS, PASS) | {o[k - 1]: FAIL} for o, k in steps]),
    }


def interactions(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from the rows of `tensor`."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("code", "n", "good", "bad")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, select = contractions()
        letter = np.array([FILTERS.index(order[k - 1]) for order, k in steps])
        for batch in batches:
            for begin in range(0, batch.num_rows, _PARTS):
                some = batch.slice(begin, _PARTS)
                block = np.zeros((3, some.num_rows, 32), dtype=np.int64)
                for at, row in enumerate(some["cells"].to_pylist()):
                    for cell in row:
                        block[:, at, cell["code"]] = cell["n"], cell["good"], cell["bad"]
                block = block.reshape(3, some.num_rows, 2, 2, 2, 2, 2)
                got = {name: np.einsum("pabcde,sabcde->ps", block[0], w) for name, w in select.items()}
                lost = np.einsum("mpabcde,sabcde->mps", block[1:], select["removed"])
                each = np.stack([got["removed"][:, letter == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)
                columns = [
                    got["kept"], got["removed"], got["failed"] - got["removed"], got["unique_fails"],
                    lost[0], lost[1], each[:, letter],
                ]
                count = some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [some["part"].take(pa.array(np.repeat(np.arange(count), len(steps)))),
                     pa.array([order for order, _ in steps] * count),
                     pa.array(np.tile(np.array([k for _, k in steps], dtype=np.int32), count)),
                     *[pa.array(c.reshape(-1)) for c in columns]],
                    list(RESULT),
                )

    return cells.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in RESULT.items()))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`interactions` of the five filters over all documents."""
    return interactions(tensor(failures(docs), labels))
