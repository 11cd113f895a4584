"""Prefix trie of rebuilt conversations: which first turns conversations share.

A conversation is rebuilt from the first turns of its base conversation (the largest
multiple of `GROUP` that is not above its id) and its own later turns. A node of the trie is
a distinct sequence of first turns.

1. Turns are range partitioned in order, with a 128-bit digest each in place of their text.
   A prefix has a digest too: the sum of its turns' digests times powers of an odd number,
   modulo 2^64, twice. Such sums can be continued from one partition to the next and moved
   to another place in a conversation, so a conversation of any length is many tasks' work
   and no text is shuffled.
2. Prefix digests are counted in a count-min sketch of two rows, of which the tasks get one
   bit a cell: counted once, or more often. A digest that one row counts once belongs to one
   conversation; so do all longer prefixes of that conversation. The nodes of such tails
   are emitted where they are. A sketch has at most 2^`MOST_BITS` cells a row; where
   that is little for the data more prefixes than need be go on, and the result is the same.
3. Only prefixes that may be shared are grouped by digest, exactly. Sums over subtrees need
   no levels: each node belongs to its smallest member, each conversation sums what belongs
   to it from the end to each depth, and a node adds up these sums of its members.

Ids of conversations that end at one node are joined in sorted stretches in many tasks; the
hash over a node's stretches runs over them as a stream.

Defined cases: rows without conv_id belong to no conversation; a null role or text is
empty; equal turns of a conversation are ordered by role and then by a hash of the text,
so repeated rows are turns of their own; ids divide as in SQL (towards zero); without
conversations there is no root and the result is empty. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harkline.session import written

#: Conversations of a group start with turns of its first one; HEADS - 1 of them at most.
GROUP = 5
HEADS = 9

#: Cells of a row of the sketch: this many for each prefix, up to 2^MOST_BITS (a bit each).
CELLS_EACH = 8
MOST_BITS = 28
#: Depths of one conversation that are summed in one group.
BLOCK = 1 << 12
#: Ids in one stretch of a node's ends.
STRETCH = 1 << 14

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_LOCAL, _EDGE, _SHARED = 0, 1, 2
_KEY = ["ka", "kb", "depth"]

COLUMNS = {
    "conv_id": "long", "depth": "long", "parent_conv_id": "long", "n_convs": "long", "n_children": "long",
    "n_leaves": "long", "saved_tokens": "long", "ends_sha256": "string",
}


def head_length(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first one of its group, at most."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2^64, for exponents of either sign."""
    out = np.ones(len(exponents), dtype=np.uint64)
    if len(exponents) == 0:
        return out
    for sign, square in ((1, base), (-1, pow(base, -1, 1 << 64))):
        left = np.maximum(exponents * sign, 0)
        for bit in range(int(left.max()).bit_length()):
            out *= np.where(left >> bit & 1, np.uint64(square), np.uint64(1))
            square = square * square % (1 << 64)
    return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return np.asarray(column, dtype=np.int64).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


# --- positions and prefix digests


def _placed_turns(turns: DataFrame) -> DataFrame:
    """Turns in order: `part`, `conv_id`, `n_bytes`, `pos` and prefix sums with (`sa`, `sb`) and without the turn.

    `pos` and the sums of a conversation start again in each partition.
    """
    text, role = F.coalesce(turns["text"].cast("string"), F.lit("")), F.coalesce(turns["role"].cast("string"), F.lit(""))
    rows = turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("ta"), F.xxhash64(F.lit(2), role, text).alias("tb"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        # tells repeated rows apart, so that they can be in several partitions
        F.monotonically_increasing_id().alias("_tie"),
    )
    order = ["conv_id", "turn", "role", "ta", "tb", "_tie"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, count, sums = None, 0, [np.uint64(0), np.uint64(0)]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = np.asarray(batch["conv_id"], dtype=np.int64)
            first = np.concatenate(([ids[0] != conv], ids[1:] != ids[:-1]))
            starts = np.flatnonzero(first)
            begun = np.zeros(len(ids), dtype=np.int64)
            begun[starts] = starts
            begun = np.maximum.accumulate(begun)
            goes_on = np.cumsum(first) == 0  # still the conversation of the batch before
            pos = np.arange(len(ids)) - begun + np.where(goes_on, count, 0)
            out = []
            for lane, name in enumerate(("ta", "tb")):
                own = _unsigned(batch[name]) * _power(_BASES[lane], pos)
                total = np.cumsum(own)
                before = np.where(begun > 0, total[np.maximum(begun - 1, 0)], np.uint64(0))
                total = total - before + np.where(goes_on, sums[lane], np.uint64(0))
                out += [total, total - own]
            conv, count, sums = ids[-1], int(pos[-1]) + 1, [out[0][-1], out[2][-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), part, dtype=np.int64)), batch["conv_id"], batch["n_bytes"], pa.array(pos),
                 *map(_signed, out)],
                ["part", "conv_id", "n_bytes", "pos", "sa", "la", "sb", "lb"],
            )

    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "ta", "tb", "n_bytes")
    schema = "part long, conv_id long, n_bytes long, pos long, sa long, la long, sb long, lb long"
    return written(placed.mapInArrow(run, schema), "trie-turns")


def _carried(placed: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """For each partition whose first conversation began before it: that id, turns and sums so far.

    One row for each partition on the driver.
    """
    bounds = placed.groupBy("part").agg(F.min("conv_id"), F.max("conv_id")).collect()
    bounds = sorted(map(tuple, bounds))
    crossing = sorted({last for (_, _, last), (_, first, _) in zip(bounds, bounds[1:]) if last == first})
    if not crossing:
        return {}
    ids = F.broadcast(placed.sparkSession.createDataFrame(pa.table({"conv_id": pa.array(crossing, pa.int64())})))
    runs = placed.join(ids, "conv_id").groupBy("conv_id", "part").agg(
        F.max("pos").alias("last"), F.max_by(F.struct("sa", "sb"), "pos").alias("sums")
    )
    carried, so_far = {}, {}
    for conv, part, last, sums in sorted(map(tuple, runs.collect())):
        n, *before = so_far.get(conv, (0, 0, 0))
        if n:
            carried[part] = (conv, n, *before)
        now = (b + pow(base, n, 1 << 64) * (s % (1 << 64)) for b, base, s in zip(before, _BASES, sums))
        so_far[conv] = (n + last + 1, *(x % (1 << 64) for x in now))
    return carried


def _prefix_digests(placed: DataFrame) -> DataFrame:
    """`conv_id`, `n_bytes`, `pos`, the digest `qa`, `qb` of the turns up to this one, and `pa`, `pb` without it."""
    carried = _carried(placed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = np.asarray(batch["conv_id"], dtype=np.int64), np.asarray(batch["part"], dtype=np.int64)
            pos = np.asarray(batch["pos"], dtype=np.int64).copy()
            sums = [_unsigned(batch[name]).copy() for name in ("sa", "sb", "la", "lb")]
            for p in np.unique(parts):
                if p in carried:
                    whose, n, *so_far = carried[p]
                    at = (parts == p) & (ids == whose)
                    pos[at] += n
                    for k, values in enumerate(sums):
                        values[at] = values[at] * np.uint64(pow(_BASES[k % 2], n, 1 << 64)) + np.uint64(so_far[k % 2])
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["n_bytes"], pa.array(pos), *map(_signed, sums)],
                ["conv_id", "n_bytes", "pos", "qa", "qb", "pa", "pb"],
            )

    return placed.mapInArrow(run, "conv_id long, n_bytes long, pos long, qa long, qb long, pa long, pb long")


def rebuilt_prefixes(turns: DataFrame) -> DataFrame:
    """One row for each conversation and depth of its rebuilt turns, from depth 0.

    `ka`, `kb`: digest of the prefix; `ja`, `jb`: of the one above; `n_bytes`: UTF-8 bytes of its
    last text; `last`: whether the conversation ends here.
    """
    own = _prefix_digests(_placed_turns(turns))
    entry = F.struct("pos", F.col("qa").alias("a"), F.col("qb").alias("b"), F.col("n_bytes").alias("n_bytes"))
    convs = own.groupBy("conv_id").agg(
        (F.max("pos") + 1).alias("n"), F.array_sort(F.collect_list(F.when(F.col("pos") < HEADS - 1, entry))).alias("head")
    )
    convs = written(convs, "trie-convs")
    first = convs.where(f"conv_id % {GROUP} = 0").select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("head").alias("base_head")
    )
    nothing = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))

    def digest(head: str, length: Column) -> Column:
        """Of the first `length` turns."""
        entry = F.get(F.col(head), length - 1)
        return F.when(length > 0, F.struct(entry["a"].alias("a"), entry["b"].alias("b"))).otherwise(nothing)

    known = (
        convs.withColumn("base", F.expr(f"conv_id - conv_id % {GROUP}")).join(first, "base", "left")
        .withColumn("h", head_length(F.col("conv_id")).cast("int"))
        .withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))
        .withColumn("end", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    plan = written(known.select(
        "conv_id", "h", "taken", "end", digest("base_head", F.col("taken")).alias("up"),
        digest("head", F.least("h", "n").cast("int")).alias("cut"), F.slice("base_head", 1, F.col("taken")).alias("base_head"),
    ), "trie-plan")
    head = F.explode(F.sequence(F.lit(0), F.col("taken"))).alias("depth")
    heads = plan.select("conv_id", "end", "base_head", head)
    own_digest, above = digest("base_head", F.col("depth")), digest("base_head", F.col("depth") - 1)
    heads = heads.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), own_digest["a"].alias("ka"), own_digest["b"].alias("kb"),
        above["a"].alias("ja"), above["b"].alias("jb"),
        F.coalesce(F.get(F.col("base_head"), F.col("depth") - 1)["n_bytes"], F.lit(0)).alias("n_bytes"),
        (F.col("depth") == F.col("end")).alias("last"),
    )
    tails = own.join(plan.select("conv_id", "h", "taken", "end", "up", "cut"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "qa", "qb", "pa", "pb",
        F.col("up.a").alias("ua"), F.col("up.b").alias("ub"), F.col("cut.a").alias("ca"), F.col("cut.b").alias("cb"),
        (F.col("taken") - F.col("h")).cast("long").alias("shift"), "n_bytes", "end",
    )

    names = heads.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shift, out = np.asarray(batch["shift"], dtype=np.int64), []
            for digests in (("qa", "qb"), ("pa", "pb")):
                for lane, (name, up, cut) in enumerate(zip(digests, ("ua", "ub"), ("ca", "cb"))):
                    moved = (_unsigned(batch[name]) - _unsigned(batch[cut])) * _power(_BASES[lane], shift)
                    out.append(_signed(moved + _unsigned(batch[up])))
            depth = np.asarray(batch["depth"], dtype=np.int64)
            last = pa.array(depth == np.asarray(batch["end"], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["depth"], *out, batch["n_bytes"], last], names)

    schema = "conv_id long, depth long, ka long, kb long, ja long, jb long, n_bytes long, last boolean"
    return heads.unionAll(tails.mapInArrow(run, schema))


# --- screening


def _seen_twice(rows: DataFrame, bits: int) -> np.ndarray:
    """The cells of both rows of the sketch that count two prefixes or more, as bits."""
    cell = [F.shiftrightunsigned(F.col(k), 64 - bits) + (at << bits) for at, k in enumerate(("ka", "kb"))]
    counted = rows.where("depth > 0").select(F.explode(F.array(*cell)).alias("cell")).groupBy("cell").count().where("count > 1")
    place = F.col("cell") + 1
    chunks = counted.groupBy(F.bitmap_bucket_number(place).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    ).toArrow()
    size = 4096  # bytes of a chunk, as the function has it
    seen = np.zeros((max((2 << bits) // 8 // size, 1), size), dtype=np.uint8)
    for chunk, found in zip(chunks["chunk"].to_pylist(), chunks["bits"].to_pylist()):
        seen[chunk - 1] = np.frombuffer(found, dtype=np.uint8)
    return seen.reshape(-1)


def screened(rows: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Prefix rows with `kind`: surely in one conversation and the one above too, surely in one, perhaps shared."""
    bits = min(max((CELLS_EACH * rows.count()).bit_length(), 15), most_bits)
    seen = rows.sparkSession.sparkContext.broadcast(_seen_twice(rows, bits))

    def shared(a: pa.Array, b: pa.Array, depth: np.ndarray) -> np.ndarray:
        found = depth <= 0
        both = np.ones(len(depth), dtype=bool)
        for at, lane in enumerate((a, b)):
            cell = (_unsigned(lane) >> np.uint64(64 - bits)).astype(np.int64) + (at << bits)
            both &= (seen.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return found | both

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = np.asarray(batch["depth"], dtype=np.int64)
            own, above = shared(batch["ka"], batch["kb"], depth), shared(batch["ja"], batch["jb"], depth - 1)
            kind = np.where(above, np.where(own, _SHARED, _EDGE), _LOCAL).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind)], [*batch.schema.names, "kind"])

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", kind int"
    return written(rows.mapInArrow(run, schema), "trie-screened")


# --- exact nodes


def _joined_hash(ends: DataFrame) -> DataFrame:
    """`ends_sha256` of the ids that end at each node, ascending; rows are (`ka`, `kb`, `depth`, `conv_id`)."""
    keyed = ", ".join(f"{k} long" for k in _KEY)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = np.stack([np.asarray(batch[k], dtype=np.int64) for k in _KEY])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            cuts = np.unique(np.concatenate(([0], cuts, np.arange(0, batch.num_rows, STRETCH))))
            ids = batch["conv_id"].to_pylist()
            spans = list(zip(cuts, [*cuts[1:], batch.num_rows]))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k[cuts]) for k in keys], batch["conv_id"].take(pa.array(cuts)),
                 pa.array([",".join(map(str, ids[a:b])) for a, b in spans])],
                [*_KEY, "first", "ids"],
            )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def told(done: list) -> pa.RecordBatch:
            columns = zip(*[(*key, found) for key, found in done])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*_KEY, "ends_sha256"])

        for batch in batches:
            done = []
            for *key, ids in zip(*(batch[n].to_pylist() for n in (*_KEY, "ids"))):
                if key != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                    digest.update(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield told(done)
        if now is not None:
            yield told([(now, digest.hexdigest())])

    order = [*_KEY, "conv_id"]
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written(ordered.mapInArrow(stretches, f"{keyed}, first long, ids string"), "trie-ends")
    together = parts.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").drop("first")
    return together.mapInArrow(hashes, f"{keyed}, ends_sha256 string")


def _sums_to_the_end(rows: DataFrame, names: list[str]) -> DataFrame:
    """`names` summed over the rows of a conversation from each depth on, in blocks of depths."""
    rows = rows.withColumn("block", F.floor(F.col("depth") / BLOCK).cast("long"))
    from_end = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(n).alias(n) for n in names])
    after = blocks.select("conv_id", "block", *[F.sum(n).over(later).alias(f"_{n}") for n in names])
    inside = rows.select(*[F.sum(n).over(from_end).alias(n) if n in names else n for n in rows.columns])
    # a conversation of one block has nothing after it
    joined = inside.join(after.where(f"_{names[0]} is not null"), ["conv_id", "block"], "left")
    return joined.select(*_KEY, *[(F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in names])


def prefix_trie(turns: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations; see `COLUMNS`."""
    rows = screened(written(rebuilt_prefixes(turns), "trie-prefixes"), most_bits)
    no_ends, own_end = F.sha2(F.lit(""), 256), F.sha2(F.col("conv_id").cast("string"), 256)
    ends_here = F.when(F.col("last"), own_end).otherwise(no_ends)
    goes_on = (~F.col("last")).cast("long")
    shared, edge = rows.where(F.col("kind") == _SHARED), rows.where(F.col("kind") == _EDGE)

    def alone(some: DataFrame, parent: Column) -> DataFrame:
        """Nodes of one conversation, which is also the only one of all nodes below."""
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        values = ["conv_id", "depth", parent, one, goes_on, one, none, ends_here]
        return some.select(*[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in zip(COLUMNS, values)])

    nodes = shared.groupBy(*_KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("n_bytes").alias("node_bytes"),
        F.min("ja").alias("ja"), F.min("jb").alias("jb"), F.count_if("last").alias("n_ends"),
        F.min(F.when(F.col("last"), F.col("conv_id"))).alias("end_id"),
    )
    nodes = written(nodes, "trie-nodes")
    above = [F.col("ja").alias("ka"), F.col("jb").alias("kb"), (F.col("depth") - 1).alias("depth")]
    children = nodes.select(*above).unionAll(edge.select(*above)).groupBy(*_KEY).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "trie-nodes")

    parents = nodes.select(*[F.col(k).alias(f"_{k}") for k in _KEY], F.col("owner").alias("parent"))
    meets = (F.col("ja") == F.col("_ka")) & (F.col("jb") == F.col("_kb")) & (F.col("depth") - 1 == F.col("_depth"))

    def with_parent(some: DataFrame, conv: str) -> DataFrame:
        """A node whose parent is no shared one has the parent's only conversation."""
        known = F.when(F.col("depth") > 0, F.coalesce(F.col("parent"), F.col(conv)))
        return some.join(parents, meets, "left").withColumn("parent", known)

    # what belongs to a conversation, as the smallest of a node's; it has a leaf of its own unless it ends inside or at another's
    mine = F.col("owner") == F.col("conv_id")
    told = shared.join(nodes.select(*_KEY, "owner", "n_convs", "node_bytes", "n_children"), _KEY).select(
        "conv_id", *_KEY, F.when(mine, (F.col("n_convs") - 1) * F.col("node_bytes")).otherwise(0).alias("saved"),
        F.when(F.col("last") & ~(mine & (F.col("n_children") == 0)), -1).otherwise(0).cast("long").alias("lacks"),
    )
    sums = _sums_to_the_end(told, ["saved", "lacks"]).groupBy(*_KEY).agg(
        F.sum("saved").alias("saved_tokens"), F.sum(F.col("lacks") + 1).alias("n_leaves")
    )
    several = shared.where("last").join(nodes.where("n_ends > 1").select(*_KEY), _KEY, "left_semi")
    one_end = F.when(F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string"), 256)).otherwise(no_ends)
    whole = with_parent(nodes, "owner").join(sums, _KEY).join(_joined_hash(several), _KEY, "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", one_end).alias("ends_sha256"),
    )
    tails = alone(rows.where(F.col("kind") == _LOCAL), F.col("conv_id"))
    out = whole.unionByName(alone(with_parent(edge, "conv_id"), F.col("parent"))).unionByName(tails)
    return out.select(*[F.col(n).cast(t).alias(n) for n, t in COLUMNS.items()])
