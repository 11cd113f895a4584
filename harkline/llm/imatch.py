"""I-Match document fingerprints, with DataFrame operations only.

A term is a longest run of letters and digits of the lower-cased text, known by its 64-bit
hash. The lexicon holds the terms whose document frequency lies in a band (inverse document
frequency between log 4 and log 1024). A fingerprint keeps a text's distinct lexicon terms,
sorts them, and hashes those that fall into each of 16 randomised subsets of the lexicon:
two of each rate from 1/2 to 1/256, so that long and short texts both have subsets of few
terms. Two fingerprints are as alike as the share of their filled subsets that agree.

With `distinct`, as the query has it, document frequency counts distinct texts, and the band
ends at 1/2 (inverse document frequency log 2): a term's place does not depend on how often
one text is copied, and the terms of a group of near copies stay in the lexicon as long as
the group holds up to half of the distinct texts.

The lexicon is broadcast. Its size has a bound that does not grow with the corpus: each of
its terms is in at least N / 1024 documents, and N documents hold N * d distinct terms, so
there are at most 1024 * d of them (d: mean number of distinct terms of a document).

Documents meet their successor in blocks of 1,024 consecutive ids, each of which also gets
a copy of the first row of the block below. Terms are counted and looked up without a
second shuffle of the texts.

Defined cases: a null text is an empty text; a text without lexicon terms has the hash of
the whole text as its fingerprint, and is like another such text only if both are equal;
the successor follows by falling doc_id, then by falling text; rows without doc_id come
last; a single document is its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harkline.session import written

#: Share of all documents a lexicon term is in, at least and at most.
LEAST_SHARE = 1 / 1024
MOST_SHARE = 1 / 4
#: The same at most over distinct texts: more than one group of near copies may hold.
MOST_SHARE_OF_TEXTS = 1 / 2
#: A term of one document only tells nothing, however small the corpus.
LEAST_DOCUMENTS = 2
#: Rates of the subsets are 2^-1 to 2^-DEPTH, two subsets of each.
DEPTH = 8
#: Consecutive ids of a block; blocks of a group of blocks.
BLOCK = 1 << 10
GROUP = 1 << 12

#: Stands for a text in the lexicon, so that texts without terms stay.
_MARK = 0


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    found = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(found, lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, text: str = "text", distinct: bool = False) -> DataFrame:
    """`code` of each term in the band, over all documents or over all distinct texts."""
    texts = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = texts.select(terms(F.col("text")).alias("codes"))
    most = MOST_SHARE
    if distinct:
        # a text is known by two hashes, so that its terms move and not the text
        known = texts.select(
            F.xxhash64("text").alias("hash"), F.xxhash64(F.lit(1), "text").alias("other"), terms(F.col("text")).alias("codes")
        )
        found = written(known.groupBy("hash", "other").agg(F.first("codes").alias("codes")).select("codes"), "distinct-texts")
        most = MOST_SHARE_OF_TEXTS
    count = found.count()
    return (
        found.select(F.explode("codes").alias("code"))
        .groupBy("code").agg(F.count("*").alias("n"))
        .where(F.col("n").between(max(LEAST_DOCUMENTS, count * LEAST_SHARE), max(LEAST_DOCUMENTS, count * most)))
        .select("code")
    )


def _subset_masks() -> list[int]:
    """Bits of a term's hash that are zero for the members of each subset."""
    masks, low, high = [], 0, 64
    for depth in range(1, DEPTH + 1):
        ones = (1 << depth) - 1
        high -= depth
        for mask in (ones << low, ones << high):
            masks.append(mask - (1 << 64) if mask >> 63 else mask)
        low += depth
    return masks


def prints(codes: Column) -> Column:
    """Hash of the sorted terms of each subset; null for a subset without terms."""
    codes = F.sort_array(codes)

    def of(mask: int) -> Column:
        members = F.filter(codes, lambda c: c.bitwiseAND(F.lit(mask)) == 0)
        return F.when(F.size(members) > 0, F.xxhash64(members))

    return F.array(*[of(mask) for mask in _subset_masks()])


def _hex(number: Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def fingerprint_text(found: Column, whole: Column) -> Column:
    """Subset hashes as text; the whole text's hash if no subset has terms."""
    filled = F.exists(found, lambda x: x.isNotNull())
    listed = F.array_join(F.transform(found, lambda x: F.coalesce(_hex(x), F.lit("-"))), ".")
    return F.when(filled, listed).otherwise(F.concat(F.lit("whole."), _hex(whole)))


def likeness(one: Column, other: Column, one_whole: Column, other_whole: Column) -> Column:
    """Share of the subsets filled in either fingerprint that agree, 0 to 1."""
    both = F.arrays_zip(one.alias("a"), other.alias("b"))
    filled = F.size(F.filter(both, lambda x: x["a"].isNotNull() | x["b"].isNotNull()))
    agree = F.size(F.filter(both, lambda x: F.coalesce(x["a"] == x["b"], F.lit(False))))
    return F.when(filled > 0, agree / filled).otherwise((one_whole == other_whole).cast("double"))


def _block_above(blocks: DataFrame) -> DataFrame:
    """`block` and `above`, the next higher block that has rows; the lowest one for the highest.

    Blocks are ordered inside groups of blocks, and only the groups in one task.
    """
    grouped = blocks.select("block", F.floor(F.col("block") / GROUP).alias("group"))
    groups = grouped.groupBy("group").agg(F.min("block").alias("low"))
    groups = groups.select(
        "group",
        F.coalesce(
            F.lag("low").over(Window.orderBy(F.desc("group"))), F.min("low").over(Window.partitionBy(F.lit(0)))
        ).alias("next_low"),
    )
    inside = F.lag("block").over(Window.partitionBy("group").orderBy(F.desc("block")))
    return (
        grouped.withColumn("inside", inside).join(groups, "group")
        .select("block", F.coalesce("inside", "next_low").alias("above"))
    )


def with_successors(docs: DataFrame) -> DataFrame:
    """`block`, `place`, `copy`, `doc_id`, `text` and `next_text` in order of falling doc_id.

    A row with `copy` is the first row of the block below, at the end of this block.
    """
    # ids below every other stand for rows without one
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(
        F.coalesce(F.floor(F.col("doc_id") / BLOCK), lowest).alias("block"), "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    firsts = rows.groupBy("block").agg(F.max(F.struct("doc_id", "text")).alias("first"))
    firsts = written(firsts.select("block", "first.doc_id", "first.text"), "successor-copies")
    copies = firsts.join(_block_above(firsts), "block").select(
        F.col("above").alias("block"), "doc_id", "text", F.lit(True).alias("copy")
    )
    order = Window.partitionBy("block").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.desc("text"))
    both = rows.withColumn("copy", F.lit(False)).unionByName(copies)
    return both.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"))


def fingerprint_report(docs: DataFrame, distinct: bool = False) -> DataFrame:
    """Fingerprints of every text and of its edit, and their likeness; see the module text.

    `distinct`: the lexicon counts distinct texts, not rows.

    The edit replaces the last half of a text (rounded down) by as many first characters of
    its successor, or all of them.
    """
    known = written(lexicon(docs, distinct=distinct).unionAll(docs.sparkSession.range(1).select(F.lit(_MARK).cast("long"))), "lexicon")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half),
        F.when(F.col("copy"), F.lit("")).otherwise(F.substring(F.col("next_text"), F.lit(1), half)),
    )
    told = with_successors(docs).withColumn("edited", edited).select(
        "block", "place",
        F.struct(
            "copy", "doc_id", F.length("text").cast("long").alias("n_chars"),
            F.unhex(F.sha2(F.col("edited"), 256)).alias("sha"),
            F.xxhash64("text").alias("whole"), F.xxhash64("edited").alias("edited_whole"),
        ).alias("told"),
        terms(F.col("text")).alias("own"), terms(F.col("edited")).alias("other"),
    )
    sides = F.concat(
        F.array(F.struct(F.lit(_MARK).cast("long").alias("code"), F.lit(2).alias("side"))),
        F.transform("own", lambda c: F.struct(c.alias("code"), F.lit(0).alias("side"))),
        F.transform("other", lambda c: F.struct(c.alias("code"), F.lit(1).alias("side"))),
    )
    single = told.select("block", "place", "told", F.explode(sides).alias("x")).select("block", "place", "told", "x.code", "x.side")
    gathered = (
        single.join(F.broadcast(known), "code", "left_semi")
        .groupBy("block", "place")
        .agg(
            F.first("told").alias("told"),
            prints(F.collect_list(F.when(F.col("side") == 0, F.col("code")))).alias("own"),
            prints(F.collect_list(F.when(F.col("side") == 1, F.col("code")))).alias("other"),
        )
    )
    order = Window.partitionBy("block").orderBy("place")
    paired = gathered.select(
        "told.*", "own", "other", F.lead("own").over(order).alias("next"), F.lead("told").over(order)["whole"].alias("next_whole")
    ).where(~F.col("copy"))
    return paired.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
        fingerprint_text(F.col("own"), F.col("whole")).alias("fingerprint"),
        fingerprint_text(F.col("other"), F.col("edited_whole")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), F.col("whole"), F.col("edited_whole")).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), F.col("whole"), F.col("next_whole")).alias("near_next"),
    )
