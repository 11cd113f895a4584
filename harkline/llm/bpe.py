"""Byte-level BPE as a tree reduction over the text.

`encode` splits a text in halves down to leaves, encodes the leaves, and joins neighbours
by encoding a window around the cut again. Two facts say when the tokens outside a window
are final, whatever stands further away:

* **Text level.** A place with a non-space on its left and a space on its right is a
  boundary of the split pattern in every context: white space only starts a match or fills
  it. A window from the last such place in the left half to the first one in the right half
  therefore holds all that the join can change. The window grows by doubling from the cut
  until it holds such a place on each side, or reaches the end of the half.
* **Match level.** A match longer than a leaf is itself split in halves. A token sequence
  is the encoding of its bytes if and only if each pair of neighbours is the encoding of
  the pair's bytes (merges act on neighbours and lower ranks come first). So a window of
  tokens around the cut, encoded again, is final when its first and its last token stay
  as they were: all pairs outside and across its ends have been valid before.

`decode` concatenates the byte strings of the ids up a tree of halves.

Defined cases: a null text is an empty text and has no tokens; texts of any length are
encoded whole; special tokens are ordinary text; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harkline.llm.common import map_arrow, pieces, texts_of

#: Code points of a text leaf, bytes of a match leaf, and ids of a decoding leaf.
TEXT_LEAF = 1024
MATCH_LEAF = 512
DECODE_LEAF = 4096
#: First window of a join: code points of the text, tokens of a match.
TEXT_WINDOW = 24
TOKEN_WINDOW = 2

_SPACE_AFTER = regex.compile(r"(?<=\S)\s")


class TreeBpe:
    """Encoder and decoder for a rank file and a split pattern."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        # merges of one leaf; the split, the halving and the joins are done here
        self._leaf = tiktoken.Encoding("leaf", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def _whole(self) -> tiktoken.Encoding:
        """The same merges over a whole leaf as one match; long matches only need it."""
        return tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks=self.ranks, special_tokens={})

    # --- text level

    def encode(self, text: str) -> list[int]:
        size = len(text)
        if size <= TEXT_LEAF:
            return self._leaf.encode_ordinary(text)
        if not _SPACE_AFTER.search(text, 1):
            # no stable place: each join would hold the whole text, so go to the matches
            return self._encode_window(text)
        half = size // 2
        left, right = text[:half], text[half:]
        return self._join(left, self.encode(left), right, self.encode(right))

    def _join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        cut, end = self._window(left, right)
        if cut is None and end is None:
            # no stable place on either side: the whole text is in the window
            return self._encode_window(left + right)
        head = left[cut:] if cut is not None else left
        tail = right[:end] if end is not None else right
        kept_left = self._before(left_ids, head) if cut is not None else 0
        kept_right = self._after(right_ids, tail) if end is not None else len(right_ids)
        return left_ids[:kept_left] + self._encode_window(head + tail) + right_ids[kept_right:]

    def _window(self, left: str, right: str) -> tuple[int | None, int | None]:
        """Last stable place of the left half and first one of the right half, by growing windows."""
        cut = end = None
        width = TEXT_WINDOW
        while cut is None:
            for found in _SPACE_AFTER.finditer(left, max(1, len(left) - width)):
                cut = found.start()
            if width >= len(left):
                break
            width *= 2
        width = TEXT_WINDOW
        while end is None:
            found = _SPACE_AFTER.search(right, 1, width)
            if found:
                end = found.start()
            if width >= len(right):
                break
            width *= 2
        return cut, end

    def _encode_window(self, window: str) -> list[int]:
        """Encode each match of the pattern; a long one by halves of its own."""
        if len(window) <= MATCH_LEAF:
            return self._leaf.encode_ordinary(window)
        ids: list[int] = []
        for match in self.pattern.finditer(window):
            ids += self.encode_match(match[0].encode())
        return ids

    def _before(self, ids: list[int], dropped: str) -> int:
        """Number of leading ids that stay when the last `dropped` characters go."""
        size, at = len(dropped.encode()), len(ids)
        while size > 0:
            at -= 1
            size -= len(self.bytes_of[ids[at]])
        return at

    def _after(self, ids: list[int], dropped: str) -> int:
        """Number of leading ids that hold the first `dropped` characters."""
        size, at = len(dropped.encode()), 0
        while size > 0:
            size -= len(self.bytes_of[ids[at]])
            at += 1
        return at

    # --- match level

    def encode_match(self, data: bytes) -> list[int]:
        """Encode the bytes of one match of the pattern."""
        if len(data) <= MATCH_LEAF:
            return self.merge(data)
        half = len(data) // 2
        while half < len(data) and data[half] & 0xC0 == 0x80:  # not inside a character
            half += 1
        if half == len(data):
            return self.merge(data)
        return self._join_tokens(self.encode_match(data[:half]), self.encode_match(data[half:]))

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        width = TOKEN_WINDOW
        while True:
            head, tail = left[-width:], right[:width]
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, head + tail)))
            whole_left, whole_right = width >= len(left), width >= len(right)
            if (whole_left or window[0] == head[0]) and (whole_right or window[-1] == tail[-1]):
                return left[: len(left) - len(head)] + window + right[len(tail):]
            width *= 2

    def merge(self, data: bytes) -> list[int]:
        """Merge neighbours of lowest rank until no pair is in the ranks."""
        try:
            return self._whole.encode_ordinary(data.decode())
        except UnicodeDecodeError:
            return self._merge_bytes(data)

    def _merge_bytes(self, data: bytes) -> list[int]:
        """The same for bytes that are cut inside a character."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    # --- decoding

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_CODERS: dict[tuple[str, str], TreeBpe] = {}


def coder(rank_file: str, pattern: str) -> TreeBpe:
    """One coder per worker process."""
    if (rank_file, pattern) not in _CODERS:
        _CODERS[rank_file, pattern] = TreeBpe(rank_file, pattern)
    return _CODERS[rank_file, pattern]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and `ids` (array of int) per document."""
    source = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    schema = T.StructType(
        [T.StructField("key", source.schema["key"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(rank_file, pattern)
        for piece in pieces(batches, "text"):
            ids = [bpe.encode(t) for t in texts_of(piece["text"])]
            yield pa.RecordBatch.from_arrays([piece["key"], pa.array(ids, pa.list_(pa.int32()))], ["key", "ids"])

    return map_arrow(source, run, schema).withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key and `text` per row of ids; bytes that are no UTF-8 become the replacement character."""
    source = encoded.select(encoded[key].alias("key"), encoded[ids].alias("ids"))
    schema = T.StructType([T.StructField("key", source.schema["key"].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(rank_file, pattern)
        for batch in batches:
            texts = [bpe.decode(i or []).decode("utf-8", "replace") for i in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(texts, pa.string())], ["key", "text"])

    return map_arrow(source, run, schema).withColumnRenamed("key", key)


def round_trip_report(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Encode and decode each text; number of tokens, digests of ids and of decoded bytes."""
    source = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", source.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(rank_file, pattern)
        for piece in pieces(batches, "text"):
            counts, digests, decoded = [], [], []
            for text in texts_of(piece["text"]):
                ids = bpe.encode(text)
                counts.append(len(ids))
                digests.append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())],
                schema.names,
            )

    return map_arrow(source, run, schema)


def token_documents(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """`doc_id`, `source`, `n_tokens`, `ids` and whether decoding gives the text again (`round_trip`)."""
    source = docs.select("doc_id", docs["source"].alias("source"), docs["text"].cast("string").alias("text"))
    schema = T.StructType(
        [
            *source.schema.fields[:2],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(rank_file, pattern)
        for piece in pieces(batches, "text"):
            texts = texts_of(piece["text"])
            ids = [bpe.encode(t) for t in texts]
            same = [bpe.decode(i) == t.encode() for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], piece["source"], pa.array([len(i) for i in ids], pa.int64()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                schema.names,
            )

    return map_arrow(source, run, schema)
