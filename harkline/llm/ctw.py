"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision (a prefix of the byte's bits) has its own
context tree over the bytes before. A node's Krichevsky-Trofimov estimate comes from its
counts of zeros and ones, and its weighted probability is half that estimate and half the
product over its children. A trained tree predicts by mixing the estimates of all depths on
the path of a context with the weights the training data gave them. The score of a text is
the log10 probability of its bytes and an end mark; `bits_per_byte` is its code length.

Training counts runs of `DEPTH` + 1 bytes over all training text, each in the task that
reads it, then summed; runs of held-out text join them with a count of zero. All their
contexts are nodes; the tree grows with the corpus and no node is dropped. It is worked out
in pieces: the runs of a piece share the `CUT` nearest bytes of context, so the levels from
the leaves to the cut are one task's arrays, made of one piece (2^24 runs at most, however
large the corpus). The nodes at the cut then meet by their nearest byte, and the top of the tree,
two levels, is a table of fixed size. On the way back down each piece makes its levels again,
which costs less than to keep them, and ends with a log probability for each run. What
training has not seen has counts of zero and probability 1/2 a bit.

Log probabilities of the most frequent runs, up to `SLOTS` of them, travel to the tasks as
a fast path. All other runs of a document meet theirs in a join, once per text.

The base score is a unigram model with add-one smoothing over the same training documents.
Counts of the `FREQUENT` most frequent words travel to the tasks; all other words of a
document meet their counts in a join, so no vocabulary has to fit in a task.

Defined cases: a null text is an empty text and consists of the end only; rows without
doc_id are training rows; repeated rows count as often as they stand and have equal
scores; without training rows every word is unknown and every bit has probability 1/2; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harkline.llm.common import each_group, joined_bytes, lower_ascii, map_arrow, pack, pieces, unpack, word_bounds, word_hashes
from harkline.session import written

#: Bytes of context, and words whose counts travel to the tasks.
DEPTH = 5
FREQUENT = 1 << 17
#: Runs whose log probabilities travel to the tasks at most; a power of two.
SLOTS = 1 << 21
#: Remainder of crc32(doc_id) by FOLDS that is held out.
FOLDS = 7
HELD_OUT = 2

#: Nearest bytes of context that the runs of a piece share, and runs of the pieces that are worked on together.
CUT = 3
PIECE_RUNS = 1 << 19

#: Marks begin and end of a text; no byte of UTF-8.
EDGE = 0xFF
#: Distinct keys a task gathers before it sends them on.
_GATHERED = 1 << 21

_WORD, _RUN, _HELD_OUT_RUN = 0, 1, 2


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


# --- bytes


def _edged(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with DEPTH edge bytes before each and after the last; places to predict; first place of each text.

    A text's places are its bytes and the edge byte after it.
    """
    begins = np.cumsum(lengths) - lengths
    shift = (np.arange(len(lengths)) + 1) * DEPTH
    out = np.full(len(data) + (len(lengths) + 1) * DEPTH, EDGE, dtype=np.uint8)
    out[np.arange(len(data)) + np.repeat(shift, lengths)] = data
    predicted = np.ones(lengths.sum() + len(lengths), dtype=np.int64)
    first = begins + np.arange(len(lengths))
    # within a text places follow each other; between texts they jump over the other edge bytes
    predicted[first[1:]] = DEPTH
    predicted[:1] = DEPTH
    return out, np.cumsum(predicted), first


def _runs(edged: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The DEPTH bytes before each place and its own byte as one number."""
    key = np.zeros(len(places), dtype=np.uint64)
    for back in range(DEPTH, -1, -1):
        key = (key << np.uint64(8)) | edged[places - back].astype(np.uint64)
    return key


class _Tally:
    """Counts by key, gathered from many pieces."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.size += len(found)
        if self.size > _GATHERED:
            self.keys, self.counts = (list(x) for x in zip(self.total()))
            self.size = len(self.keys[0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        found, inverse = np.unique(np.concatenate(self.keys), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate(self.counts), minlength=len(found))
        return found, sums.astype(np.int64)

    def full(self) -> bool:
        return self.size > _GATHERED


def corpus_counts(texts: DataFrame) -> DataFrame:
    """`kind` (word or run), `key`, `n` over the training rows and `total` over all rows of `text` and `held_out`.

    Words are those of training rows only; a run of held-out rows only has an `n` of zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {_WORD: _Tally(), _RUN: _Tally(), _HELD_OUT_RUN: _Tally()}

        def sent(kind: int) -> pa.RecordBatch:
            keys, counts = tallies[kind].total()
            tallies[kind] = _Tally()
            seen = np.zeros_like(counts) if kind == _HELD_OUT_RUN else counts
            kinds = np.full(len(keys), _WORD if kind == _WORD else _RUN, dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(keys.view(np.int64)), pa.array(seen), pa.array(counts)],
                ["kind", "key", "n", "total"],
            )

        for piece in pieces(batches, "text"):
            for held in (False, True):
                part = piece.filter(pc.equal(piece["held_out"], held))
                if part.num_rows == 0:
                    continue
                data, lengths = joined_bytes(part["text"])
                data = lower_ascii(data)
                edged, places, _ = _edged(data, lengths)
                tallies[_HELD_OUT_RUN if held else _RUN].add(_runs(edged, places))
                if not held:
                    starts, ends, _ = word_bounds(data, lengths)
                    tallies[_WORD].add(word_hashes(data, starts, ends))
            for kind in tallies:
                if tallies[kind].full():
                    yield sent(kind)
        for kind in tallies:
            yield sent(kind)

    source = texts.select(texts["text"].cast("string").alias("text"), "held_out")
    return (
        map_arrow(source, run, "kind int, key long, n long, total long")
        .groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


# --- tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x > 0: recurrence to x + 8, then Stirling's series."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def _kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


class Level(NamedTuple):
    """Nodes of one depth: `code` is the context, nearest byte lowest, and then the bit prefix led by a one."""

    code: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray  # log of the weighted probability
    weight: np.ndarray  # of the node's own estimate, after training
    member: np.ndarray  # its node, for each thing it was made of

    def own(self) -> np.ndarray:
        """Probability of a one by the node's own counts."""
        return (self.ones + 0.5) / (self.zeros + self.ones + 1)


def _leaves(keys: np.ndarray, counts: np.ndarray) -> tuple[Level, np.ndarray]:
    """The deepest level and, for each of the eight decisions of each run, whether it is a one."""
    bits = np.arange(8)
    byte = keys & 255
    code = (keys - byte)[:, None] + ((byte | 256)[:, None] >> (8 - bits))
    one = ((keys[:, None] >> (7 - bits)) & 1).astype(bool)
    found, member = np.unique(code.reshape(-1), return_inverse=True)
    member = member.reshape(-1)
    times = np.repeat(counts, 8).astype(float)
    ones = np.bincount(member, times * one.reshape(-1), minlength=len(found))
    zeros = np.bincount(member, times, minlength=len(found)) - ones
    return Level(found, zeros, ones, _kt_log(zeros, ones), np.ones(len(found)), member), one


def _above(below: Level, depth: int) -> Level:
    """The level of `depth` over the one below it: the farthest byte of the context goes."""
    found, member = np.unique(below.code & ((1 << (8 * depth + 8)) - 1), return_inverse=True)
    member = member.reshape(-1)
    zeros, ones, product = (np.bincount(member, x, minlength=len(found)) for x in (below.zeros, below.ones, below.weighted))
    estimate = _kt_log(zeros, ones)
    weight = 1 / (1 + np.exp(np.clip(product - estimate, -700, 700)))
    return Level(found, zeros, ones, np.logaddexp(estimate, product) - np.log(2), weight, member)


def _mixed_down(level: Level, mixed: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed probability of a one so far, and weight not yet given, from those above each node."""
    return mixed + left * level.weight * level.own(), left * (1 - level.weight)


def _levels(level: Level, first: int, last: int) -> list[Level]:
    """`level` and those above it, of depths `first` down to `last`."""
    out = [level]
    for depth in range(first, last - 1, -1):
        out.append(_above(out[-1], depth))
    return out


def _packed_nodes(level: Level) -> bytes:
    return pack(level.code, *(x.view(np.int64) for x in level[1:5]))


def _nodes(parts: list[bytes]) -> Level:
    """Nodes of several packed parts, which have none in common, by code."""
    code, *values = (np.concatenate(x) for x in zip(*(unpack(p, "nnnnn") for p in parts)))
    by = np.argsort(code)
    return Level(code[by], *(v.view(np.float64)[by] for v in values), np.zeros(0, dtype=np.int64))


def _part_of(cut: np.ndarray, parts: int) -> np.ndarray:
    """The task of a piece, by its nearest bytes."""
    mixed = cut.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def run_log_probabilities(runs: DataFrame) -> DataFrame:
    """`key`, `total` and `log`, the log10 probability of each run's byte after its context, from `key`, `n`, `total`."""
    cut_mask = (1 << (8 * CUT)) - 1
    partitions = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(partitions, -(-runs.count() // PIECE_RUNS))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n, total = (np.asarray(batch[k], dtype=np.int64) for k in ("key", "n", "total"))
            part = _part_of((keys >> 8) & cut_mask, parts)
            order = np.argsort(part, kind="stable")
            for p, at in each_group(part[order]):
                some = order[at]
                packed = pack(keys[some], n[some], total[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([packed], pa.binary()), pa.nulls(1, pa.binary())], ["part", "runs", "known"]
                )

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Runs of whole pieces, about `PIECE_RUNS` at a time, and what is known of their nodes at the cut."""
        gathered, known = [], []
        for batch in batches:
            gathered += [unpack(x, "nnn") for x in batch["runs"].to_pylist() if x is not None]
            known += [unpack(x, "nnn") for x in batch["known"].to_pylist() if x is not None]
        if not gathered:
            return
        keys, n, total = (np.concatenate(x) for x in zip(*gathered))
        known = [np.concatenate(x) for x in zip(*known)] if known else None
        piece = (keys >> 8) & cut_mask
        order = np.argsort(piece, kind="stable")
        ends = np.flatnonzero(np.append(piece[order][1:] != piece[order][:-1], True)) + 1
        begin = 0
        while begin < len(order):
            # the last end within the bound, or the next one
            end = int(ends[max(np.searchsorted(ends, begin + PIECE_RUNS, side="right") - 1, np.searchsorted(ends, begin, side="right"))])
            some = order[begin:end]
            yield keys[some], n[some], total[some], known
            begin = end

    def rising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, _, _ in pieces_of(batches):
            top = _levels(_leaves(keys, n)[0], DEPTH - 1, CUT)[-1]
            nearest = (top.code >> 8) & 255
            order = np.argsort(nearest, kind="stable")
            for near, at in each_group(nearest[order]):
                some = top._replace(**{f: getattr(top, f)[order[at]] for f in top._fields[:5]})
                yield pa.RecordBatch.from_arrays([pa.array([near], pa.int32()), pa.array([_packed_nodes(some)], pa.binary())], ["near", "nodes"])

    def by_nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Level]]:
        groups: dict[int, list[bytes]] = {}
        for batch in batches:
            for near, nodes in zip(batch["near"].to_pylist(), batch["nodes"].to_pylist()):
                groups.setdefault(near, []).append(nodes)
        for near, nodes in groups.items():
            yield near, _nodes(nodes)

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for near, nodes in by_nearest(batches):
            top = _levels(nodes, CUT - 1, 1)[-1]
            yield pa.RecordBatch.from_arrays([pa.array([near], pa.int32()), pa.array([_packed_nodes(top)], pa.binary())], ["near", "nodes"])

    packed = "part int, runs binary, known binary"
    sent = written(runs.select("key", "n", "total").mapInArrow(dealt, packed), "lm-dealt")
    rows = "near int, nodes binary"
    nodes = written(sent.repartitionById(parts, "part").mapInArrow(rising, rows), "lm-nodes")
    # 256 contexts of one byte with 255 bit prefixes each, at most
    upper = nodes.repartition("near").mapInArrow(narrowed, rows).toArrow()["nodes"].to_pylist()
    if not upper:
        return runs.select("key", "total", F.lit(0.0).alias("log")).where("false")
    first = _nodes(upper)
    root = _above(first, 0)
    mixed, left = _mixed_down(root, np.zeros(len(root.code)), np.ones(len(root.code)))
    mixed, left = _mixed_down(first, mixed[root.member], left[root.member])
    top = runs.sparkSession.sparkContext.broadcast((first.code, mixed, left))

    def to_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, mixed, left = top.value
        for _, nodes in by_nearest(batches):
            _, two, one = _levels(nodes, CUT - 1, 1)
            at = np.searchsorted(code, one.code)
            both = _mixed_down(two, mixed[at][one.member], left[at][one.member])
            part = _part_of(nodes.code >> 8, parts)
            order = np.argsort(part, kind="stable")
            for p, of in each_group(part[order]):
                some = order[of]
                packed = pack(nodes.code[some], *(x[two.member[some]].view(np.int64) for x in both))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.nulls(1, pa.binary()), pa.array([packed], pa.binary())], ["part", "runs", "known"]
                )

    def falling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n, total, (code, mixed, left) in pieces_of(batches):
            by = np.argsort(code)
            leaves, one = _leaves(keys, n)
            *_, cut = levels = _levels(leaves, DEPTH - 1, CUT)
            at = by[np.searchsorted(code[by], cut.code)]
            both = _mixed_down(cut, mixed[at].view(np.float64), left[at].view(np.float64))
            for above, level in zip(levels[:0:-1], levels[-2::-1]):
                both = _mixed_down(level, both[0][above.member], both[1][above.member])
            chance = both[0][leaves.member].reshape(-1, 8)
            log = np.log10(np.where(one, chance, 1 - chance)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total), pa.array(log)], ["key", "total", "log"])

    known = nodes.repartition("near").mapInArrow(to_cut, packed)
    return sent.unionAll(known).repartitionById(parts, "part").mapInArrow(falling, "key long, total long, log double")


class Slots:
    """Values of some keys below 2^63 in two tables of hash slots; of keys that share a slot the first stays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, size: int):
        self.tables = []
        for bits in (max(size.bit_length() - 1, 1), max(size.bit_length() - 2, 1)):
            slots, first = np.unique(self._slots(keys, bits), return_index=True)
            at, found = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits)
            at[slots], found[slots] = keys[first], values[first]
            self.tables.append((bits, at, found))
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]

    @staticmethod
    def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
        # another part of the product for each size of table
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 if bits & 1 else 0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(64 - bits)).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, and whether it is held; 0 for one that is not."""
        bits, at, found = self.tables[0]
        slot = self._slots(keys, bits)
        held = at[slot] == keys
        values = np.where(held, found[slot], 0.0)
        missed = np.flatnonzero(~held)
        bits, at, found = self.tables[1]
        slot = self._slots(keys[missed], bits)
        second = at[slot] == keys[missed]
        values[missed[second]] = found[slot[second]]
        held[missed[second]] = True
        return values, held


def frequent_runs(logs: DataFrame) -> Slots:
    """The most frequent of the rows (`key`, `log`, `total`), at most `SLOTS` of them.

    Whole classes of frequency are taken, so that no task orders all runs.
    """
    ranked = logs.withColumn("class", F.floor(F.log2("total") * 8).cast("int"))
    classes = sorted(ranked.groupBy("class").count().collect(), reverse=True)
    least, room = None, SLOTS
    for c, count in classes:
        room -= count
        if room < 0:
            break
        least = c
    taken = ranked.where(F.col("class") >= least if least is not None else F.lit(False)).select("key", "log", "total").toArrow()
    order = np.lexsort((taken["key"].to_numpy(), -taken["total"].to_numpy()))
    return Slots(taken["key"].to_numpy()[order], taken["log"].to_numpy()[order], SLOTS)


# --- scores


def score_documents(docs: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`, `bits_per_byte`.

    `n_tokens` are words and one end; the end is a token of the training text like others.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", docs["text"].cast("string").alias("text"),
        held_out(docs["doc_id"]).alias("held_out"),
    )
    training = rows.where(~F.col("held_out"))
    counts = written(corpus_counts(rows), "lm-counts")
    words = counts.where(F.col("kind") == _WORD).select("key", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    ends = training.count()
    total, distinct = total + ends, distinct + (ends > 0)
    space = float(total + distinct + 1)
    runs = counts.where(F.col("kind") == _RUN)
    logs = written(run_log_probabilities(runs), "lm-logs")
    frequent = words.orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    order = np.argsort(frequent["key"].to_numpy())
    keys, seen = frequent["key"].to_numpy()[order], frequent["n"].to_numpy()[order]
    # fixed sizes: SLOTS and FREQUENT
    model = docs.sparkSession.sparkContext.broadcast((frequent_runs(logs), keys, seen))

    schema = T.StructType(
        [
            T.StructField("row", T.LongType()), T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("held_out", T.BooleanType()), T.StructField("kind", T.IntegerType()),
            T.StructField("key", T.LongType()), T.StructField("times", T.LongType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()),
            T.StructField("score", T.DoubleType()), T.StructField("n_bytes", T.LongType()),
        ]
    )

    def once(row: np.ndarray, owner: np.ndarray, found: np.ndarray, kind: int, of: pa.DataType) -> pa.RecordBatch:
        """Keys that are not at hand, once per text."""
        by = np.lexsort((found, owner))
        found, owner = found[by], owner[by]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(found) != 0) | (np.diff(owner) != 0)))[: len(found)])
        times = np.diff(np.concatenate((new, [len(found)])))
        some = len(new)
        return pa.RecordBatch.from_arrays(
            [pa.array(row[owner[new]]), pa.nulls(some, of), pa.nulls(some, pa.bool_()),
             pa.array(np.full(some, kind, dtype=np.int32)), pa.array(found[new]), pa.array(times),
             *[pa.nulls(some, pa.int64())] * 2, *[pa.nulls(some, pa.float64())] * 2, pa.nulls(some, pa.int64())],
            schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, keys, seen = model.value
        for piece in pieces(batches, "text"):
            data, lengths = joined_bytes(piece["text"])
            data = lower_ascii(data)
            count = piece.num_rows
            row = np.asarray(piece["row"], dtype=np.int64)
            # runs whose log probabilities are at hand
            edged, places, first = _edged(data, lengths)
            runs = _runs(edged, places).view(np.int64)
            value, held = slots.look_up(runs)
            score = np.add.reduceat(value, first, dtype=np.float64)
            missed = np.flatnonzero(~held)
            yield once(row, np.searchsorted(first, missed, side="right") - 1, runs[missed], _RUN, piece["doc_id"].type)
            # words whose counts are at hand
            starts, ends_, words_of = word_bounds(data, lengths)
            hashes = word_hashes(data, starts, ends_).view(np.int64)
            owner = np.repeat(np.arange(count), words_of)
            at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
            hit = keys[at] == hashes if len(keys) else np.zeros(len(hashes), dtype=bool)
            known = np.bincount(owner[hit], minlength=count)
            base = np.bincount(owner[hit], np.log10((seen[at[hit]] + 1) / space), minlength=count)
            base += np.log10((ends + 1) / space)  # the end
            yield pa.RecordBatch.from_arrays(
                [piece["row"], piece["doc_id"], piece["held_out"], pa.nulls(count, pa.int32()), pa.array(~row),
                 pa.nulls(count, pa.int64()), pa.array(words_of + 1),
                 pa.array(known + (ends > 0)), pa.array(base), pa.array(score), pa.array(lengths)],
                schema.names,
            )
            yield once(row, owner[~hit], hashes[~hit], _WORD, piece["doc_id"].type)

    parts = map_arrow(rows, run, schema)
    met = parts.join(
        words.select(F.lit(_WORD).alias("kind"), "key", "n", F.lit(None).cast("double").alias("log"))
        .unionAll(logs.select(F.lit(_RUN), "key", F.lit(None).cast("long"), "log")),
        ["kind", "key"], "left",
    )
    n = F.coalesce("n", F.lit(0))
    word = F.col("kind") == _WORD
    scored = met.groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.first("held_out", ignorenulls=True).alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.coalesce(F.sum(F.when(word & (n > 0), F.col("times"))), F.lit(0))).alias("n_known"),
        (F.sum("base") + F.coalesce(F.sum(F.when(word, F.col("times") * F.log10((n + 1) / space))), F.lit(0.0))).alias("base_score"),
        (F.sum("score") + F.coalesce(F.sum(F.when(F.col("kind") == _RUN, F.col("times") * F.col("log"))), F.lit(0.0))).alias("score"),
        F.sum("n_bytes").alias("n_bytes"),
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
        (-F.col("score") / np.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
