"""SimHash near-duplicates by pigeonring filtering.

A fingerprint is cut into `SEGMENTS` consecutive segments on a ring. If two fingerprints
differ in at most `MAX_BITS` bits, some segment starts a chain around the ring whose first
l segments differ in at most l * MAX_BITS / SEGMENTS bits, for every l (the pigeonring
principle). The first CHAIN segments of such a chain are indexed: their budgets leave only
a few sets of segments that may differ, and each (start, set) gives a key of the segments
that must be equal. Fingerprints meet under equal keys, the chain budgets prune the pairs,
and only the pairs that are left get the full Hamming check.

Exact copies of a fingerprint are joined before, so a key's rows are different
fingerprints. Pairs are never listed: under each key a spanning forest of the links is
found in the task (breadth first, only against fingerprints not yet reached), at most one
row per fingerprint and key.

Defined cases: a null or empty text has fingerprint zero and links like any other; a text
with fewer than `SHINGLE` words is one shingle; repeated rows are members of one component;
rows without doc_id have a fingerprint and a component, but give no component its id, so a
component of such rows only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harkline.llm.common import bytes_of, map_arrow, pieces
from harkline.llm.components import connected_components
from harkline.session import written

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = 9
CHAIN = 6

#: Shingles of one text whose bits are counted at a time.
_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased words of a text, as an unsigned number."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space bytes only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width] + 1)).tolist()
    stops = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = np.array(
            [digest(line[a:b], SEED) for a, b in zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])], dtype=">u8"
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def add_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if None) and the fingerprint as a signed 64-bit number."""
    kept = docs.columns if keep is None else keep
    source = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(kept)], docs[text].cast("string").alias("t"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("f", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "t"):
            prints = np.array([fingerprint(t) for t in bytes_of(piece["t"])], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(prints)], schema.names)

    return map_arrow(source, run, schema).toDF(*kept, name)


def hex_print(column: Column) -> Column:
    """16 lower-case hex digits of a signed 64-bit number."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def _budget(length: int) -> int:
    """Bits in which the first `length` segments of a chain may differ."""
    return length * MAX_BITS // SEGMENTS


def _segment_masks() -> list[int]:
    edges = [64 * i // SEGMENTS for i in range(SEGMENTS + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def _may_differ() -> list[tuple[int, ...]]:
    """Largest sets of places in a chain's first CHAIN segments that may hold a difference."""
    most = _budget(CHAIN)
    allowed = [
        places
        for places in combinations(range(CHAIN), most)
        if all(sum(p < length for p in places) <= _budget(length) for length in range(1, CHAIN + 1))
    ]
    return allowed


def chain_keys() -> list[tuple[int, int]]:
    """(start, mask of the bits that must be equal) of every index key."""
    masks = _segment_masks()
    keys = []
    for start in range(SEGMENTS):
        for places in _may_differ():
            keys.append((start, sum(masks[(start + p) % SEGMENTS] for p in range(CHAIN) if p not in places)))
    return keys


def _chain_checks(start: int) -> list[tuple[np.uint64, int]]:
    """Masks of the growing chain and their budgets, where the next length has a larger budget."""
    masks = _segment_masks()
    checks = []
    for length in range(1, SEGMENTS + 1):
        if length == SEGMENTS or _budget(length + 1) > _budget(length):
            checks.append((np.uint64(sum(masks[(start + p) % SEGMENTS] for p in range(length))), _budget(length)))
    return checks


def _within(one: np.uint64, others: np.ndarray, checks: list[tuple[np.uint64, int]]) -> np.ndarray:
    """Places of `others` that keep every chain budget to `one`; the last check is the whole Hamming distance."""
    places = np.arange(len(others))
    for mask, budget in checks:
        places = places[np.bitwise_count((others[places] ^ one) & mask) <= budget]
        if not len(places):
            break
    return places


def _forest(prints: np.ndarray, checks: list[tuple[np.uint64, int]]) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected under one key: each fingerprint is reached once."""
    waiting = prints
    while len(waiting) > 1:
        frontier, waiting = [waiting[0]], waiting[1:]
        while frontier and len(waiting):
            one = frontier.pop()
            near = _within(one, waiting, checks)
            if len(near):
                reached = waiting[near]
                yield from ((int(one), int(other)) for other in reached)
                frontier.extend(reached)
                waiting = np.delete(waiting, near)


def similar_links(prints: DataFrame, name: str = "fingerprint") -> DataFrame:
    """Links `a`, `b` that connect all different fingerprints within MAX_BITS bits."""
    keys = chain_keys()
    starts = [start for start, _ in keys]
    checks = [_chain_checks(start) for start in range(SEGMENTS)]
    signed = [mask - (1 << 64) if mask >> 63 else mask for _, mask in keys]
    indexed = prints.select(
        F.col(name).alias("f"),
        F.explode(
            F.array(*[
                F.struct(F.lit(j).alias("j"), F.xxhash64(F.lit(j), F.col(name).bitwiseAND(F.lit(mask))).alias("k"))
                for j, mask in enumerate(signed)
            ])
        ).alias("x"),
    ).select("x.k", "x.j", "f")
    placed = indexed.repartition("k").sortWithinPartitions("k", "j", "f")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, dtype=np.int64)
        k, j, f = empty, empty, empty

        def links(k: np.ndarray, j: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            change = np.flatnonzero((np.diff(k) != 0) | (np.diff(j) != 0)) + 1
            begins, ends = np.concatenate(([0], change)), np.concatenate((change, [len(k)]))
            found: list[tuple[int, int]] = []
            for at in np.flatnonzero(ends - begins > 1):
                begin, end = begins[at], ends[at]
                for pair in _forest(f[begin:end].view(np.uint64), checks[starts[j[begin]]]):
                    found.append(pair)
                    if len(found) >= 1 << 16:
                        yield batch_of(found)
                        found = []
            if found:
                yield batch_of(found)

        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            pairs = np.array(found, dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["a", "b"]
            )

        for batch in batches:
            k, j, f = (
                np.concatenate((old, np.asarray(batch[n], dtype=np.int64))) for old, n in ((k, "k"), (j, "j"), (f, "f"))
            )
            if not len(k):
                continue
            # the last key may go on in the next batch
            last = int(np.searchsorted(k, k[-1]))
            if last:
                yield from links(k[:last], j[:last], f[:last])
                k, j, f = k[last:], j[last:], f[last:]
        if len(k):
            yield from links(k, j, f)

    return placed.mapInArrow(run, "a long, b long").distinct()


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """`fingerprint`, `root` (a fingerprint of the component) and `component_id` (its smallest doc_id).

    `prints`: `doc_id` and `fingerprint` of every document.
    """
    classes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = connected_components(similar_links(classes), "simhash-links")
    rooted = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(ids, "root").select("fingerprint", "root", "component_id")


def near_duplicate_components(docs: DataFrame) -> DataFrame:
    """`doc_id`, `fingerprint` (hex) and `component_id` per document."""
    prints = written(add_fingerprints(docs, keep=["doc_id"]), "simhash-prints")
    found = fingerprint_components(prints).select("fingerprint", "component_id")
    return prints.join(found, "fingerprint").select(
        "doc_id", hex_print(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One row of each component, all columns: the one of the smallest doc_id.

    Rows that repeat a doc_id within a component count as one; a component without any
    doc_id keeps one of its rows.
    """
    prints = written(add_fingerprints(docs, keep=["doc_id"]), "simhash-prints")
    roots = fingerprint_components(prints).select("fingerprint", "root")
    # smallest doc_id of each component, null last, then the smallest fingerprint
    best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("fingerprint").alias("f")))
    chosen = (
        prints.groupBy("fingerprint").agg(best.alias("x")).join(roots, "fingerprint")
        .groupBy("root").agg(F.min("x").alias("x"))
        .select(F.col("x.d").alias("_d"), F.col("x.f").alias("_f"))
    )
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = names[docs.columns.index("doc_id")]
    text = names[docs.columns.index("text")]
    marked = add_fingerprints(docs.toDF(*names), text=text, name="_p")
    kept = marked.join(chosen, marked["_p"].eqNullSafe(chosen["_f"]) & marked[at].eqNullSafe(chosen["_d"]))
    return kept.dropDuplicates(["_p", at]).select(*names).toDF(*docs.columns)
