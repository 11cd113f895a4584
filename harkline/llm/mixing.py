"""Mixing sources to target weights, with DataFrame operations only.

Each source's words are packed, document after document, into blocks of `BLOCK_WORDS`
words; those of a source with a small target into shorter ones, down to a word, so that no
source vanishes and all meet their targets within a hundredth or a word. A source takes as
many blocks as its target asks for. All taken blocks together are
the slots of the mix: a pseudorandom permutation deals them to output shards of
`SHARD_SLOTS` slots, so that each shard's source counts are a multinomial draw given the
totals. Slot i of a source maps to a block by a pseudorandom permutation of the source's
block numbers, a new one for each pass over the source. Blocks are joined by number.

Permutations are swap-or-not shuffles: ROUNDS rounds, each of which pairs x with
(K - x) mod n and swaps the pair or not by a hash of the larger one. That is a bijection
on 0..n-1 for every n and needs no sort and no state.

Nothing is ordered in one task: documents are placed by a hash into groups of bounded size,
and prefix sums run over groups, groups of groups, and the few rows above.

Defined cases: a null text has size 0; a null source is a source of its own, ordered last;
a document without words is taken 0 words; repeated rows are different documents (each
gets the words its own place in the stream gets); a source without words has target 0; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harkline.session import written

#: Weights of the sources by code point order, repeating, and the share of all words to take.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
#: Most times a source is taken.
MOST = 2.0

BLOCK_WORDS = 64
#: Blocks that a source takes at least, if it has the words.
LEAST_BLOCKS = 64
SHARD_SLOTS = 1 << 14
ROUNDS = 24
SEED = 11

#: Documents of a group, and groups of a group of groups, on average.
GROUP = 1 << 12
#: Slots made from one row at a time, and such rows made from one row.
CHUNK = 1 << 12
CHUNKS = 1 << 12
CHUNKS_A_TASK = 16

_SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), _SPACE)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words: white space outside words dropped, the single spaces between counted."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # every white-space byte as a space, then words are the runs between spaces
    flat = F.translate(text, "\t\n\x0b\x0c\r", " " * 5)
    runs = F.split(F.trim(flat), " +")
    return F.when(F.trim(flat) == "", F.lit(0)).otherwise(F.size(runs)).cast("long")


def _div(a: Column, b: Column | int) -> Column:
    """Whole-number quotient of non-negative numbers."""
    b = b if isinstance(b, Column) else F.lit(b).cast("long")
    return F.call_function("div", a.cast("long"), b)


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Where the pseudorandom permutation of 0..n-1 named by `key` puts x."""

    def round_(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *key), n) - at, n)
        larger = F.greatest(at, partner)
        swap = F.xxhash64(F.lit(SEED + 1), r, larger, *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), round_)


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source: `no` (0-based order), `source_size`, `weight` and `target`.

    `sizes`: `source` and `size` per document. The targets share SHARE of all words by
    weight; a source that would get more than MOST times its size stops there and the rest
    goes to the others by weight. Sources by rising size / weight stop first, so the common
    factor is that of the first source that does not stop. One row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = totals.withColumn("no", (F.row_number().over(everything) - 1).cast("long"))
    weighed = numbered.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("no") % len(WEIGHTS) + 1).cast("int"))
    ).withColumn("most", F.col("source_size") * MOST)
    rising = Window.orderBy(F.col("most") / F.col("weight"), "no")
    whole = Window.partitionBy(F.lit(0))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    factor = (F.lit(SHARE) * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = weighed.withColumn("factor", factor).withColumn("stops", F.col("most") / F.col("weight") <= F.col("factor"))
    # the factor rises up to the first source that does not stop and falls after it
    common = F.max(F.when(~F.col("stops"), F.col("factor"))).over(whole)
    target = F.when(F.col("stops"), F.col("most")).otherwise(F.col("weight") * common)
    return ranked.select("source", "no", "source_size", "weight", target.alias("target"))


def _starts(groups: DataFrame) -> DataFrame:
    """Words of a source before each of its groups: sums over groups of groups, then inside them."""
    keyed = groups.withColumn("_over", _div(F.col("_group"), GROUP))
    before = (Window.unboundedPreceding, -1)

    def prefix(value: str, window) -> Column:
        return F.coalesce(F.sum(value).over(window.rowsBetween(*before)), F.lit(0))

    over = keyed.groupBy("no", "_over").agg(F.sum("_size").alias("_size"))
    over = over.select("no", "_over", prefix("_size", Window.partitionBy("no").orderBy("_over")).alias("_base"))
    inside = keyed.select(
        "no", "_group", "_over", prefix("_size", Window.partitionBy("no", "_over").orderBy("_group")).alias("_in")
    )
    return inside.join(over, ["no", "_over"]).select("no", "_group", (F.col("_base") + F.col("_in")).alias("_start"))


def place(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Add `start`, the word of the source's stream at which each document starts.

    `docs`: `row` (unique), `source` and `size`. The stream's order is that of a hash.
    """
    count = max(1, docs.count())
    groups = max(1, -(-count // GROUP))
    # a non-negative hash whose range the groups share evenly
    hashed = F.shiftrightunsigned(F.xxhash64("row", F.lit(SEED)), 2)
    width = (1 << 62) // groups + 1
    known = docs.join(
        targets.select(F.col("source").alias("_source"), "no", "source_size", "target"),
        docs["source"].eqNullSafe(F.col("_source")),
    ).drop("_source")
    grouped = known.withColumn("_hash", hashed).withColumn("_group", _div(F.col("_hash"), width))
    starts = _starts(grouped.groupBy("no", "_group").agg(F.sum("size").alias("_size")))
    window = (
        Window.partitionBy("no", "_group").orderBy("_hash", "row").rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = grouped.withColumn("_in", F.coalesce(F.sum("size").over(window), F.lit(0)))
    return inside.join(starts, ["no", "_group"]).withColumn("start", F.col("_start") + F.col("_in")).drop(
        "_hash", "_group", "_in", "_start"
    )


def block_words(target: Column) -> Column:
    """Words in a block of a source."""
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(target / LEAST_BLOCKS))).cast("long")


def slots(targets: DataFrame) -> DataFrame:
    """Every slot of the mix: `shard`, `slot`, and the `no`, `block` and `turn` it takes."""
    length = block_words(F.col("target"))
    blocks = F.ceil(F.col("source_size") / length).cast("long")
    taken = F.least(F.round(F.col("target") / length).cast("long"), blocks * int(MOST))
    counted = targets.select("no", blocks.alias("blocks"), taken.alias("slots")).where("slots > 0")
    counted = counted.select(
        "*",
        (F.sum("slots").over(Window.orderBy("no")) - F.col("slots")).alias("first"),
        F.sum("slots").over(Window.partitionBy(F.lit(0))).alias("all"),
    )
    # chunks of equal size spread by number, so no source is one task and no row holds more
    # than CHUNKS of them; a few rows stand for many slots, so adaptive execution must not
    # join the partitions
    total = counted.agg(F.sum("slots")).head()[0] or 0
    tasks = max(1, math.ceil(total / CHUNK / CHUNKS_A_TASK))
    wide = CHUNK * CHUNKS

    def numbers(first: Column, last: Column, step: int) -> Column:
        return F.explode(F.sequence(first, last, F.lit(step).cast("long")))

    groups = counted.withColumn("group", numbers(F.lit(0).cast("long"), F.col("slots") - 1, wide))
    in_group = F.least(F.col("group") + wide, F.col("slots")) - 1
    chunks = groups.withColumn("from", numbers(F.col("group"), in_group, CHUNK))
    single = (
        chunks.repartition(tasks, "no", "from")
        .withColumn("i", numbers(F.col("from"), F.least(F.col("from") + CHUNK, F.col("slots")) - 1, 1))
    )
    dealt = permuted(F.col("first") + F.col("i"), F.col("all"), F.lit("shard"))
    turn = _div(F.col("i"), F.col("blocks"))
    return single.select(
        "no", "blocks", dealt.alias("_at"), turn.alias("turn"), F.pmod("i", "blocks").alias("_in")
    ).select(
        _div(F.col("_at"), SHARD_SLOTS).alias("shard"),
        F.pmod(F.col("_at"), F.lit(SHARD_SLOTS)).alias("slot"),
        "no",
        permuted(F.col("_in"), F.col("blocks"), F.col("no"), F.col("turn")).alias("block"),
        "turn",
    )


def pieces_of(placed: DataFrame) -> DataFrame:
    """Each document's part in each block: `row`, `size`, `no`, `block`, `from` (0-based word), `n` words."""
    length = F.col("length")
    first = _div(F.col("start"), length)
    last = _div(F.col("start") + F.col("size") - 1, length)
    sized_blocks = placed.where("size > 0").withColumn("length", block_words(F.col("target")))
    spread = sized_blocks.select("row", "no", "start", "size", "length", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * length - F.col("start"), F.lit(0).cast("long"))
    end = F.least((F.col("block") + 1) * length - F.col("start"), F.col("size"))
    return spread.select("row", "size", "no", "block", begin.alias("from"), (end - begin).alias("n"))


def sized(docs: DataFrame) -> DataFrame:
    """`row` (unique while the plan's input stays), doc_id, source and size of every document."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", docs["source"].cast("string").alias("source"),
        word_count(docs["text"]).alias("size"),
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target` and `taken` of every document."""
    known = written(sized(docs), "mix-sizes")
    targets = written(source_targets(known), "mix-targets")
    placed = written(place(known, targets), "mix-places")
    # made from a row per source, the slots look small to the planner: no broadcast
    takes = slots(targets).groupBy("no", "block").agg(F.count("*").alias("times"))
    taken = (
        pieces_of(placed).join(takes.hint("merge"), ["no", "block"]).groupBy("row")
        .agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
    )
    return placed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )


def mixed_documents(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The mix as documents, all columns: one row per document and turn that takes words of it.

    A turn that takes all words of a document keeps its text as it is; otherwise the words
    of the taken blocks stand in their order with single spaces. `length` follows the text.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at, source, doc_id = (names[docs.columns.index(c)] for c in (text, "source", "doc_id"))
    numbered = written(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "mix-documents")
    known = written(
        numbered.select(
            "row", F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
            word_count(F.col(at)).alias("size"),
        ),
        "mix-sizes",
    )
    targets = written(source_targets(known), "mix-targets")
    placed = written(place(known, targets), "mix-places")
    parts = (
        pieces_of(placed).join(slots(targets).select("no", "block", "turn").hint("merge"), ["no", "block"])
        .groupBy("row", "turn")
        .agg(F.first("size").alias("all"), F.sum("n").alias("taken"), F.sort_array(F.collect_list(F.struct("from", "n"))).alias("parts"))
    )
    joined = numbered.join(parts, "row")
    # the words as the only element of an array: split once, not once for each part
    some = F.transform(
        F.array(words(F.col(at))),
        lambda every: F.array_join(
            F.flatten(
                F.transform("parts", lambda p: F.slice(every, (p["from"] + 1).cast("int"), p["n"].cast("int")))
            ),
            " ",
        ),
    )[0]
    new = joined.withColumn(at, F.when(F.col("taken") == F.col("all"), F.col(at)).otherwise(some))
    if length in docs.columns:
        size = names[docs.columns.index(length)]
        new = new.withColumn(size, F.length(at).cast(docs.schema[length].dataType))
    return new.select(*names).toDF(*docs.columns)
