"""Removal of repeated passages: every byte of a 100-byte string that starts earlier as well.

The order is that of (doc_id, place in the document); strings do not cross documents.

1. *Which suffixes.* Each window of 100 bytes has one anchor, the place of its least hash of
   32 bytes: equal windows have their anchors at the same offset, so it is enough to sort
   the suffixes at anchors (about one place in 35). The windows of an anchor follow each
   other; the bytes they cover are the anchor's context, a part to the left and the suffix.
2. *Which anchors.* Digests of the 32 bytes are counted, each task's own first. An anchor
   whose digest occurs once is in no repeat. The repeated digests travel to the tasks as
   a bit map of at most 2^`MOST_BITS` bits; where there are too many for that, all anchors
   go on. A task keeps the first of equal contexts and sends only that one.
3. *Sorting.* Sampled splitters range-partition the suffixes by their leading bytes (and
   equal suffixes by what stands to the left), packed and compressed for each bucket. A
   bucket sorts its suffixes by multikey quicksort, a token being eight bytes, and likewise
   the parts to the left, from the anchor on. With the common prefix lengths of neighbours,
   windows at offset o are equal exactly if they are in one class of suffixes by 100 - o
   bytes and in one class of left parts by o bytes.
4. *Across boundaries.* Classes that a splitter belongs to may stand in two buckets or more:
   the first window that a bucket has of each is compared with those of the others by digest.

No document, passage or bucket needs a task of its own: a passage in a third of all
documents is one context a task where its surroundings are equal, and otherwise its suffixes
or left parts differ and are ranges of their own.

Defined cases: a null text is an empty text; texts under 100 bytes stay as they are; rows
without doc_id come last; rows of one doc_id and different texts are ordered by a hash of
the text; of rows of one doc_id and text one is the first and the others are later ones; an
empty table gives an empty result. doc_id is a whole number. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harkline.llm.common import each_group, joined_bytes, map_arrow, pack, pieces, unpack
from harkline.session import written

WINDOW = 100
#: Bytes of the string whose least hash is a window's anchor; a power of two.
GRAM = 32
_OFFSETS = WINDOW - GRAM + 1
#: Bytes of a row of suffixes and of left parts, whole tokens of eight bytes.
_RIGHT, _LEFT = 104, 72

#: Window starts that are looked at together; fewer than 2^20.
CHUNK = 1 << 18
#: Digests and contexts that a task gathers before it sends them.
_DIGESTS = 1 << 21
_CONTEXTS = 1 << 18
#: Suffixes in a bucket, on average, and in the sample for each splitter.
BUCKET = 150_000
_SAMPLED = 64

#: Bits of the map of repeated digests for each of them, and of the map at most.
BITS_EACH = 16
MOST_BITS = 29
#: The table of spans of documents is broadcast up to this size, and joined by document beyond it.
BROADCAST_BYTES = 64 << 20

_LAST = (1 << 63) - 1
_BYTE_CODE = np.random.Generator(np.random.PCG64(20240917)).integers(1, 1 << 63, 256, dtype=np.uint64)
_WEIGHTS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, (2, 64), dtype=np.uint64) | np.uint64(1)
_DOC = ["d", "t", "u"]


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(32))
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(29))


def _row_digests(rows: np.ndarray, *lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row of bytes (whole words) and its lengths."""
    words = rows.view(np.uint64)
    out = []
    for lane in _WEIGHTS:
        total = np.zeros(len(rows), dtype=np.uint64)
        for k in range(words.shape[1]):
            total += _mixed(words[:, k] + lane[k]) * lane[k]
        for k, length in enumerate(lengths):
            total += _mixed(length.astype(np.uint64) + lane[-1 - k]) * lane[-1 - k]
        out.append(_mixed(total))
    return out[0], out[1]


# --- anchors


def _anchors(data: np.ndarray, first: int, last: int, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the windows that start in [first, last): digest, place, first and last start of each.

    `bounds`: begin and end of each text in `data`; no window crosses an end.
    """
    block = data[first:last + WINDOW - 1]
    places = len(block) - GRAM + 1
    nothing = np.zeros(0, dtype=np.int64)
    if len(block) < WINDOW:
        return np.zeros(0, dtype=np.uint64), nothing, nothing, nothing
    digest, width = _BYTE_CODE[block], 1
    while width < GRAM:
        factor = np.uint64(pow(0x9E3779B97F4A7C15, width, 1 << 64))
        digest = digest[:-width] * factor + digest[width:]
        width *= 2
    digest = _mixed(digest)
    # the place in the low bits: of equal hashes the first is the least
    least = (digest & ~np.uint64((1 << 20) - 1)) | np.arange(places, dtype=np.uint64)
    width = 1
    while 2 * width <= _OFFSETS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = _OFFSETS - width
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    change = np.zeros(len(least) + 1, dtype=np.int64)
    begins, ends = bounds[0] - first, bounds[1] - first - WINDOW + 1
    held = (ends > begins) & (ends > 0) & (begins < len(least))
    np.add.at(change, np.maximum(begins[held], 0), 1)
    np.add.at(change, np.minimum(ends[held], len(least)), -1)
    starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64), nothing, nothing, nothing
    place = (least[starts] & np.uint64((1 << 20) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    place = place[new]
    final = np.concatenate((starts[new[1:] - 1], starts[-1:]))
    return digest[place], place + first, starts[new] + first, final + first


def _chunks(data: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    ends = np.cumsum(lengths)
    bounds = np.stack((ends - lengths, ends))
    for first in range(0, len(data), CHUNK):
        some = bounds[:, (bounds[1] > first) & (bounds[0] < first + CHUNK)]
        yield _anchors(data, first, min(first + CHUNK, len(data)), some)


# --- repeated digests


def _bucket_bits(frame: DataFrame) -> int:
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max((16 * partitions).bit_length(), 8), 16)


def _repeated_digests(texts: DataFrame) -> tuple[DataFrame, int]:
    """(`bucket`, `n`, `sent`, `digests`): the anchors' digests that occur more than once, by their leading bits.

    `sent`: how often tasks sent them.
    """
    bits = _bucket_bits(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0

        def sent() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(gathered), return_counts=True)
            # a digest that is repeated here is sent twice, however often it occurs
            found = np.repeat(found, np.minimum(counts, 2))
            bucket = (found >> np.uint64(64 - bits)).astype(np.int32)
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            parts = [x.tobytes() for x in np.split(found, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array(parts, pa.binary())], ["bucket", "digests"])

        for piece in pieces(batches, "text"):
            for digest, *_ in _chunks(*joined_bytes(piece["text"])):
                if len(digest):
                    gathered.append(digest)
                    size += len(digest)
                if size > _DIGESTS:
                    yield sent()
                    gathered, size = [], 0
        if size:
            yield sent()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, digests in zip(batch["bucket"].to_pylist(), batch["digests"].to_pylist()):
                by_bucket.setdefault(bucket, []).append(np.frombuffer(digests, dtype=np.uint64))
        for bucket, parts in by_bucket.items():
            found, counts = np.unique(np.concatenate(parts), return_counts=True)
            found, times = found[counts > 1], int(counts[counts > 1].sum())
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([len(found)], pa.int64()), pa.array([times], pa.int64()),
                     pa.array([found.tobytes()], pa.binary())],
                    ["bucket", "n", "sent", "digests"],
                )

    sent = map_arrow(texts.select("text"), run, "bucket int, digests binary")
    found = sent.repartition("bucket").mapInArrow(counted, "bucket int, n long, sent long, digests binary")
    return written(found, "repeats-digests"), bits


def _repeated_map(texts: DataFrame) -> tuple[int, int, np.ndarray | None]:
    """How many repeats were sent; leading bits of a digest and the map that has a bit for those of repeated ones.

    None in place of a map that would be too full.
    """
    found, bucket_bits = _repeated_digests(texts)
    count, sent = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("sent"), F.lit(0))).first()
    if count > 1 << MOST_BITS:
        return sent, 0, None
    bits = min(max((BITS_EACH * count).bit_length(), bucket_bits + 3), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for digests in batch["digests"].to_pylist():
                cells = np.frombuffer(digests, dtype=np.uint64) >> np.uint64(64 - bits)
                flags = np.zeros(1 << (bits - bucket_bits), dtype=bool)
                flags[(cells & np.uint64(len(flags) - 1)).astype(np.int64)] = True
                maps.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch["bucket"], pa.array(maps, pa.binary())], ["bucket", "map"])

    whole = np.zeros((1 << bucket_bits, 1 << (bits - bucket_bits - 3)), dtype=np.uint8)
    maps = found.select("bucket", "digests").mapInArrow(run, "bucket int, map binary").toArrow()
    for bucket, part in zip(maps["bucket"].to_pylist(), maps["map"].to_pylist()):
        whole[bucket] = np.frombuffer(part, dtype=np.uint8)
    return sent, bits, whole.reshape(-1)


# --- contexts


def _flat(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first bytes of each row, joined."""
    return rows[np.arange(rows.shape[1]) < lengths[:, None]]


def _rows_of(data: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The other way: rows of bytes, filled with zeros."""
    out = np.zeros((len(lengths), width), dtype=np.uint8)
    out[np.arange(width) < lengths[:, None]] = data
    return out


def _merged(owner: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each owner with those that touch joined."""
    if len(owner) == 0:
        return owner, begins, ends
    by = np.lexsort((begins, owner))
    owner, begins, ends = owner[by], begins[by], ends[by]
    far = int(ends.max()) + 2
    reach = np.maximum.accumulate(ends + owner * far)
    new = np.flatnonzero(np.concatenate(([True], begins[1:] + owner[1:] * far > reach[:-1])))
    until = np.concatenate((new[1:] - 1, [len(owner) - 1]))
    return owner[new], begins[new], reach[until] - owner[new] * far


class _Contexts:
    """Contexts of a task: the first of equal ones, and the spans of windows of the others."""

    def __init__(self) -> None:
        self.parts, self.size, self.spans = [], 0, []

    def add(self, *fields: np.ndarray) -> None:
        """`right`, `left`, their lengths, document key and start."""
        self.parts.append(fields)
        self.size += len(fields[0])

    def collapse(self) -> None:
        """Order by context, then document and place; what is not first of its context becomes a span."""
        if self.size == 0:
            return
        fields = [np.concatenate(x) for x in zip(*self.parts)]
        right, left, n_right, n_left, d, t, u, at = fields
        one, two = _row_digests(right, n_right, n_left)
        more = _row_digests(left)
        one, two = one + more[0], two ^ more[1]
        by = np.lexsort((at, u, t, d, two, one))
        new = np.concatenate(([True], (one[by[1:]] != one[by[:-1]]) | (two[by[1:]] != two[by[:-1]])))
        first = by[np.flatnonzero(new)]
        whose = first[np.cumsum(new) - 1]
        # a repeated row has the same document and place, and is no later one
        later = np.zeros(len(by), dtype=bool)
        for column in (d, t, u, at):
            later |= column[by] != column[whose]
        gone = by[later]
        self.spans.append((d[gone], t[gone], u[gone], at[gone], at[gone] + n_left[gone] + n_right[gone]))
        self.parts, self.size = [tuple(x[first] for x in fields)], len(first)

    def taken(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """All contexts and all spans, which go."""
        contexts = [np.concatenate(x) for x in zip(*self.parts)]
        spans = [np.concatenate(x) for x in zip(*self.spans)]
        self.parts, self.size, self.spans = [], 0, []
        return contexts, spans


def _keys(right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffix and then the part to the left, as texts that numpy orders by bytes."""
    rows = np.concatenate((right, left), axis=1)
    return rows.view(f"S{rows.shape[1]}").reshape(-1)


def _gathered_contexts(texts: DataFrame, bits: int, repeated: np.ndarray | None) -> Callable:
    """A function over Arrow batches that yields contexts and spans of their texts, as `_Contexts.taken` does."""
    known = texts.sparkSession.sparkContext.broadcast(repeated)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list[np.ndarray]]]:
        gathered = _Contexts()
        for piece in pieces(batches, "text"):
            data, lengths = joined_bytes(piece["text"])
            ends = np.cumsum(lengths)
            padded = np.concatenate((np.zeros(_LEFT, dtype=np.uint8), data, np.zeros(_RIGHT, dtype=np.uint8)))
            keys = [np.asarray(piece[k], dtype=np.int64) for k in _DOC]
            right_of = np.lib.stride_tricks.sliding_window_view(padded, _RIGHT)
            left_of = np.lib.stride_tricks.sliding_window_view(padded, _LEFT)
            for digest, place, start, final in _chunks(data, lengths):
                if known.value is not None and len(digest):
                    cell = (digest >> np.uint64(64 - bits)).astype(np.int64)
                    held = (known.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
                    place, start, final = place[held], start[held], final[held]
                if len(place) == 0:
                    continue
                n_right, n_left = final + WINDOW - place, place - start
                right = np.where(np.arange(_RIGHT) < n_right[:, None], right_of[place + _LEFT], 0).astype(np.uint8)
                # from the anchor on to the left
                left = np.where(np.arange(_LEFT) < n_left[:, None], left_of[place][:, ::-1], 0).astype(np.uint8)
                doc = np.searchsorted(ends, place, side="right")
                gathered.add(right, left, n_right, n_left, *(k[doc] for k in keys), start - (ends - lengths)[doc])
                if gathered.size > _CONTEXTS:
                    gathered.collapse()
                    if gathered.size > _CONTEXTS // 2:
                        yield gathered.taken()
        gathered.collapse()
        if gathered.spans:
            yield gathered.taken()

    return gather


def _splitters(texts: DataFrame, gather: Callable, expected: int, buckets: int) -> np.ndarray:
    """Where buckets begin, from a sample of the contexts of a sample of the documents.

    `_SAMPLED` contexts for each bucket, by expectation; the sample decides on the balance only.
    """
    share = min(1.0, _SAMPLED * buckets / max(expected, 1))
    of_documents = min(1.0, 10 * share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.Generator(np.random.PCG64(1))
        for (right, left, *_), _ in gather(batches):
            some = draw.random(len(right)) < share / of_documents
            rows = np.concatenate((right[some], left[some]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in rows], pa.binary())], ["key"])

    sampled = texts if of_documents == 1 else texts.sample(of_documents, seed=12)
    keys = map_arrow(sampled.select("text", *_DOC), run, "key binary").toArrow()["key"].to_pylist()
    if not keys:
        return np.zeros(0, dtype=f"S{_RIGHT + _LEFT}")
    keys = np.sort(np.frombuffer(b"".join(keys), dtype=f"S{_RIGHT + _LEFT}"))
    return np.unique(keys[np.arange(1, buckets) * len(keys) // buckets])


# contexts: bytes to the right, to the left, their lengths; spans: document, begin and end
_CONTEXT, _SPAN = "bbnnnnnn", "nnnnn"


def _packed_spans(spans: list[np.ndarray], groups: int) -> Iterator[tuple[int, bytes]]:
    """Spans of each group of documents, those that touch joined."""
    d, t, u, begins, ends = spans
    if len(d) == 0:
        return
    by = np.lexsort((u, t, d))
    new = np.zeros(len(by), dtype=np.int64)
    for key in (d, t, u):
        new[1:] |= key[by[1:]] != key[by[:-1]]
    owner = np.cumsum(new)
    docs = by[np.flatnonzero(np.concatenate(([1], new[1:])))]
    owner, begins, ends = _merged(owner, begins[by], ends[by])
    docs = docs[owner]
    group = (_mixed((d[docs] ^ t[docs]).view(np.uint64)) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    for g, at in each_group(group[order]):
        some = order[at]
        yield g, pack(*(k[docs[some]] for k in (d, t, u)), begins[some], ends[some])


def _bucketed(texts: DataFrame, gather: Callable, splitters: np.ndarray, buckets: int) -> DataFrame:
    """(`bucket`, `contexts`, `spans`): packed contexts of each bucket, and packed spans for any."""
    known = texts.sparkSession.sparkContext.broadcast(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for contexts, spans in gather(batches):
            right, left, n_right, n_left, *doc = contexts
            keys = _keys(right, left)
            bucket = np.searchsorted(known.value, keys, side="right")
            order = np.lexsort((right.view(">u8")[:, 1], right.view(">u8")[:, 0], bucket))  # alike next to each other
            for b, at in each_group(bucket[order]):
                some = order[at]
                lengths = n_right[some], n_left[some]
                packed = pack(_flat(right[some], lengths[0]), _flat(left[some], lengths[1]), *lengths, *(k[some] for k in doc))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([packed], pa.binary()), pa.nulls(1, pa.binary())],
                    ["bucket", "contexts", "spans"],
                )
            for b, packed in _packed_spans(spans, buckets):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.nulls(1, pa.binary()), pa.array([packed], pa.binary())],
                    ["bucket", "contexts", "spans"],
                )

    return map_arrow(texts.select("text", *_DOC), run, "bucket int, contexts binary, spans binary")


# --- sorting


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of rows of bytes by multikey quicksort; a token is eight bytes.

    Rows that are alone with their tokens so far are in place. The others are parted by
    the next token within their equals, all such groups of a level at once.
    """
    tokens = rows.view(">u8")
    order, active = np.arange(len(rows)), np.arange(len(rows))
    group = np.zeros(len(rows), dtype=np.int64)
    for level in range(tokens.shape[1]):
        if len(active) == 0:
            break
        at = order[active]
        token = tokens[at, level].astype(np.uint64)
        by = np.lexsort((token, group))
        at, token, group = at[by], token[by], group[by]
        order[active] = at
        new = np.concatenate(([True], (token[1:] != token[:-1]) | (group[1:] != group[:-1])))
        group = np.cumsum(new) - 1
        tied = np.bincount(group)[group] > 1
        active, group = active[tied], group[tied]
    return order


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Leading bytes that each row in order shares with the one before; the first: -1."""
    out = np.full(len(order), -1, dtype=np.int64)
    for a in range(1, len(order), 1 << 16):
        b = min(a + (1 << 16), len(order))
        differs = rows[order[a:b]] != rows[order[a - 1:b - 1]]
        out[a:b] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return out


def _classes(common: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each row a number that rows with the same leading `length` bytes share."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(common < length) - 1
    return out


def _dense_rank(*keys: np.ndarray) -> np.ndarray:
    """Rank by the keys, the first leading; equal ones have one rank."""
    by = np.lexsort(keys[::-1])
    new = np.zeros(len(by), dtype=np.int64)
    for key in keys:
        new[1:] |= key[by[1:]] != key[by[:-1]]
    out = np.empty(len(by), dtype=np.int64)
    out[by] = np.cumsum(new)
    return out


def _shared(row: np.ndarray, splitter: np.ndarray | None) -> int:
    """Leading bytes that a suffix shares with the one of a splitter."""
    if splitter is None:
        return -1
    differs = np.flatnonzero(row != splitter[:_RIGHT])
    return int(differs[0]) if len(differs) else _RIGHT


def bucket_repeats(right, left, n_right, n_left, rank, lower, upper) -> tuple[np.ndarray, np.ndarray, list]:
    """Least and greatest offset of each anchor's windows that repeat an earlier one of the bucket.

    Also, for each offset, the anchors whose window is first here in a class that a bounding
    splitter (`lower`, `upper`; None at the ends) belongs to. Without repeat the least offset
    is above the greatest.
    """
    low, high = np.full(len(rank), _OFFSETS, dtype=np.int64), np.full(len(rank), -1, dtype=np.int64)
    by_right, by_left = multikey_order(right), multikey_order(left)
    common_right, common_left = _common(right, by_right), _common(left, by_left)
    with_lower, with_upper = _shared(right[by_right[0]], lower), _shared(right[by_right[-1]], upper)
    boundary = []
    for offset in range(_OFFSETS):
        suffix = _classes(common_right, by_right, WINDOW - offset)
        members = np.flatnonzero((n_left >= offset) & (n_right >= WINDOW - offset))
        if len(members) == 0:
            continue
        at_end = np.zeros(len(members), dtype=bool)
        if with_lower >= WINDOW - offset:
            at_end |= suffix[members] == 0
        if with_upper >= WINDOW - offset:
            at_end |= suffix[members] == suffix[by_right[-1]]
        several = np.bincount(suffix[members], minlength=int(suffix.max()) + 1)[suffix[members]] > 1
        some = members[several]
        window = suffix[some] * len(rank) + _classes(common_left, by_left, offset)[some]
        by = np.lexsort((rank[some], window))
        new = np.concatenate(([True], window[by[1:]] != window[by[:-1]]))[: len(by)]
        first = by[np.flatnonzero(new)][np.cumsum(new) - 1] if len(by) else by
        repeated = some[by[rank[some[by]] > rank[some[first]]]]
        low[repeated] = np.minimum(low[repeated], offset)
        high[repeated] = offset
        if at_end.any():
            gone = np.zeros(len(rank), dtype=bool)
            gone[repeated] = True
            ends = members[at_end]
            boundary.append((offset, ends[~gone[ends]]))
    return low, high, boundary


def _least_by(keys: tuple[np.ndarray, ...], rank: tuple[np.ndarray, ...]) -> np.ndarray:
    """Rows that are behind the least of those with their keys."""
    by = np.lexsort((*rank[::-1], *keys))
    new = np.zeros(len(by), dtype=np.int64)
    for key in keys:
        new[1:] |= key[by[1:]] != key[by[:-1]]
    first = by[np.flatnonzero(np.concatenate(([1], new[1:])))][np.cumsum(new)]
    behind = np.zeros(len(by), dtype=bool)
    for column in rank:
        behind |= column[by] != column[first]
    return by[behind]


def _sorted_repeats(bucketed: DataFrame, splitters: np.ndarray, buckets: int, groups: int) -> DataFrame:
    """Packed spans of groups of documents (`across` false), and first windows of classes at a boundary by groups of digests."""
    known = bucketed.sparkSession.sparkContext.broadcast(splitters)

    def splitter(at: int) -> np.ndarray | None:
        if not 0 <= at < len(known.value):
            return None
        return np.frombuffer(known.value[at:at + 1].tobytes(), dtype=np.uint8)

    def told(across: bool, group: int, packed: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([across]), pa.array([group], pa.int32()), pa.array([packed], pa.binary())], ["across", "group", "packed"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, spans, bucket = [], [], 0
        for batch in batches:
            for b, packed in zip(batch["bucket"].to_pylist(), batch["contexts"].to_pylist()):
                if packed is not None:
                    contexts.append(unpack(packed, _CONTEXT))
                    bucket = b
            spans += [unpack(x, _SPAN) for x in batch["spans"].to_pylist() if x is not None]
        boundary = []
        if contexts:
            flat_right, flat_left, n_right, n_left, d, t, u, at = (np.concatenate(x) for x in zip(*contexts))
            del contexts
            right, left = _rows_of(flat_right, n_right, _RIGHT), _rows_of(flat_left, n_left, _LEFT)
            place = at + n_left
            rank = _dense_rank(d, t, u, place)
            low, high, boundary = bucket_repeats(right, left, n_right, n_left, rank, splitter(bucket - 1), splitter(bucket))
            found = np.flatnonzero(high >= low)
            spans.append([d[found], t[found], u[found], place[found] - high[found], place[found] - low[found] + WINDOW])
        if spans:
            for group, packed in _packed_spans([np.concatenate(x) for x in zip(*spans)], groups):
                yield told(False, group, packed)
        edges = []
        for offset, some in boundary:
            window = np.zeros((len(some), _RIGHT), dtype=np.uint8)
            window[:, :offset] = left[some, :offset][:, ::-1]
            window[:, offset:WINDOW] = right[some, :WINDOW - offset]
            one, two = _row_digests(window)
            edges.append((one.view(np.int64), two.view(np.int64), d[some], t[some], u[some], place[some] - offset))
        if edges:
            edges = [np.concatenate(x) for x in zip(*edges)]
            group = (edges[0].view(np.uint64) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            for g, at in each_group(group[order]):
                yield told(True, g, pack(*(x[order[at]] for x in edges)))

    found = bucketed.repartitionById(buckets, "bucket").mapInArrow(run, "across boolean, group int, packed binary")
    return written(found, "repeats-sorted")


def repeat_spans(texts: DataFrame) -> DataFrame:
    """`d`, `t`, `u` and the `spans` of bytes (`at`, `to`) to remove, for documents that have any; see `_keyed`."""
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    expected, bits, repeated = _repeated_map(texts)
    buckets, groups = (max(partitions, -(-expected // size)) for size in (BUCKET, 8 * BUCKET))
    gather = _gathered_contexts(texts, bits, repeated)
    splitters = _splitters(texts, gather, expected, buckets)
    found = _sorted_repeats(_bucketed(texts, gather, splitters, buckets), splitters, buckets, groups)

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A window at a boundary that is behind the first of its kind is a span."""
        edges = [unpack(x, "nnnnnn") for batch in batches for x in batch["packed"].to_pylist()]
        if not edges:
            return
        one, two, d, t, u, at = (np.concatenate(x) for x in zip(*edges))
        later = _least_by((one, two), (d, t, u, at))
        for g, packed in _packed_spans([d[later], t[later], u[later], at[later], at[later] + WINDOW], groups):
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([packed], pa.binary())], ["group", "packed"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = [unpack(x, _SPAN) for batch in batches for x in batch["packed"].to_pylist()]
        if not spans:
            return
        d, t, u, begins, ends = (np.concatenate(x) for x in zip(*spans))
        by = np.lexsort((u, t, d))
        new = np.zeros(len(by), dtype=np.int64)
        for key in (d, t, u):
            new[1:] |= key[by[1:]] != key[by[:-1]]
        docs = by[np.flatnonzero(np.concatenate(([1], new[1:])))]
        owner, begins, ends = _merged(np.cumsum(new), begins[by], ends[by])
        offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(docs))))).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            pa.array(offsets), pa.StructArray.from_arrays([pa.array(begins), pa.array(ends)], ["at", "to"])
        )
        whole = pa.RecordBatch.from_arrays([*(pa.array(k[docs]) for k in (d, t, u)), lists], [*_DOC, "spans"])
        for a in range(0, whole.num_rows, 1000):
            yield whole.slice(a, 1000)

    edges = found.where("across").repartitionById(groups, "group").select("packed")
    parts = found.where("not across").select("group", "packed").unionAll(edges.mapInArrow(resolved, "group int, packed binary"))
    together = parts.repartitionById(groups, "group").select("packed")
    return together.mapInArrow(merged, "d long, t long, u long, spans array<struct<at: long, to: long>>")


def _keyed(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and the key of a document: its id (null: the last) and two hashes of its text.

    The hashes are zero where all ids differ.
    """
    ids = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(_LAST)).alias("d"), docs["doc_id"], docs["text"])
    alone = ids.groupBy("d").count().where("count > 1").isEmpty()
    text = F.coalesce(ids["text"].cast("string"), F.lit(""))
    none = F.lit(0).cast("long")
    return ids.select(
        "doc_id", text.alias("text"), "d", (none if alone else F.xxhash64(text)).alias("t"),
        (none if alone else F.xxhash64(F.lit(1), text)).alias("u"),
    )


def kept_bytes(docs: DataFrame) -> DataFrame:
    """For each row `doc_id`, `d`, `t`, `u`, `n_bytes`, the merged `spans` to remove and the bytes `kept`.

    Rows of one doc_id and text are all told as the first of them.
    """
    texts = _keyed(docs)
    by_doc = written(repeat_spans(texts), "repeats-spans")
    rows, spans = by_doc.agg(F.count("*"), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
    side = F.broadcast(by_doc) if 64 * rows + 32 * spans <= BROADCAST_BYTES else by_doc
    joined = texts.join(side, _DOC, "left").select("doc_id", *_DOC, "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, lengths = joined_bytes(piece["text"])
            begins = np.cumsum(lengths) - lengths
            lists = piece["spans"]
            counts = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
            flat = lists.flatten()
            owner, at, to = _merged(
                np.repeat(np.arange(piece.num_rows), counts),
                np.asarray(flat.field("at"), dtype=np.int64), np.asarray(flat.field("to"), dtype=np.int64),
            )
            change = np.zeros(len(data) + 1, dtype=np.int8)
            np.add.at(change, begins[owner] + at, 1)
            np.add.at(change, begins[owner] + to, -1)
            stays = np.cumsum(change[:-1], dtype=np.int8) == 0
            kept_lengths = np.add.reduceat(np.append(stays, False), begins, dtype=np.int64) * (lengths > 0) if len(begins) else lengths
            cuts = np.concatenate(([0], np.cumsum(kept_lengths)))
            kept = data[stays].tobytes()
            found = pa.StructArray.from_arrays([pa.array(at), pa.array(to)], ["at", "to"])
            offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=piece.num_rows)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], *(piece[k] for k in _DOC), pa.array(lengths), pa.ListArray.from_arrays(pa.array(offsets), found),
                 pa.array([kept[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())],
                ["doc_id", *_DOC, "n_bytes", "spans", "kept"],
            )

    kind = joined.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, d long, t long, u long, n_bytes long, spans array<struct<at: long, to: long>>, kept binary"
    return map_arrow(joined, run, schema)


def repeat_report(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans` and `kept_sha256` of each document."""
    told = kept_bytes(docs).select(
        "doc_id", "t", "u", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
    counted = told.groupBy(*told.columns).agg(F.count("*").alias("copies"))
    # all but one of the rows with this id and text are later ones
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(copies - 1) div 4096"))))
    rows = blocks.withColumn(
        "row", F.explode(F.sequence(F.col("block") * 4096, F.least(F.col("block") * 4096 + 4095, F.col("copies") - 1)))
    )
    later = (F.col("row") > 0) & (F.col("n_bytes") >= WINDOW)
    return rows.select(
        "doc_id", "n_bytes", F.when(later, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(later, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(later, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
