"""Token ids as binary files: frequency-ranked ids, byte-aligned codes, separate control bytes.

Documents are range partitioned and sorted by id, encoded, and written as files of whole
documents. In a file each id is replaced by its rank by frequency in the file, so that
common ids take one byte. A rank takes 1 to 4 bytes; the lengths stand apart, four of them
in a control byte. Reading looks the control bytes up in a table of lengths, sums them to
offsets and gathers the data bytes, all in numpy.

File layout (little-endian): magic, then five counts (documents, ids, distinct ids, control
bytes, data bytes) as u64; ids by rank as u32; ids per document as u32; control bytes; data
bytes. A file ends with the first batch of documents that reaches FILE_IDS ids, so memory is
bounded by a file and a batch (a few MB of text, or one document).

A task attempt writes under names of its own; the manifest lists the files of the attempts
that succeeded only, so repeated or lost tasks leave no ids twice.

Text is cut where the split pattern cuts in every context (between a non-space and a
space), and pieces that a worker has seen lately are not given to the library again.

Defined cases: a null text is an empty text, its ids are the end id only; rows without
doc_id come last; rows of equal doc_id follow each other by their text; an empty table
gives no file and an empty result.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harkline.llm.common import joined_bytes, map_arrow, pieces, SPACE, word_hashes
from harkline.session import local_path, scratch_path, written

MAGIC = b"HKTOK001"
FILE_IDS = 1 << 22
#: Files a task reads.
FILES_A_TASK = 4
#: Pieces of text, and letter runs at their start, that a worker keeps the ids of.
KEPT_PIECES = 2_000_000
KEPT_HEADS = 300_000
#: Bytes of the longest piece that is kept.
LONGEST_PIECE = 64

_SPACES = np.frombuffer(SPACE, dtype=np.uint8)

#: Ids below this are counted in a table, larger ones by sorting.
COUNTED_IDS = 1 << 22
#: Ids that are counted, and numbers that are coded, at once: numpy's steps take several times
#: their size, and a worker keeps what it took. A multiple of four, as a control byte has four.
COUNTED_AT_ONCE = 1 << 20
CODED_AT_ONCE = 1 << 16

_COUNTS = struct.Struct("<5Q")

#: Lengths of the four codes a control byte describes.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


# --- codes


def encode_ranks(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    if len(ranks) > CODED_AT_ONCE:
        parts = [encode_ranks(ranks[at:at + CODED_AT_ONCE]) for at in range(0, len(ranks), CODED_AT_ONCE)]
        return np.concatenate([c for c, _ in parts]), np.concatenate([d for _, d in parts])
    ranks = ranks.astype("<u4")
    lengths = 1 + (ranks > 0xFF) + (ranks > 0xFFFF).astype(np.int64) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    return control, data


def decode_ranks(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """Numbers from control and data bytes, by table lookup."""
    values = np.empty(count, dtype=np.uint32)
    padded = np.concatenate((data, np.zeros(3, dtype=np.uint8)))
    done = 0
    for begin in range(0, count, CODED_AT_ONCE):
        some = values[begin:begin + CODED_AT_ONCE]
        lengths = _LENGTHS[control[begin // 4:(begin + CODED_AT_ONCE) // 4]].reshape(-1)[: len(some)]
        ends = done + np.cumsum(lengths, dtype=np.int64)
        starts = ends - lengths
        some[:] = padded[starts]
        for place in (1, 2, 3):
            longer = np.flatnonzero(lengths > place)
            if not len(longer):
                break
            some[longer] |= padded[starts[longer] + place].astype(np.uint32) << np.uint32(8 * place)
        done = int(ends[-1])
    return values


def file_bytes(ids: np.ndarray, per_document: np.ndarray) -> bytes:
    """A file's content."""
    if len(ids) and ids.max() >= COUNTED_IDS:
        known, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
    else:
        all_counts = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=np.int64)
        for at in range(0, len(ids), COUNTED_AT_ONCE):
            all_counts += np.bincount(ids[at:at + COUNTED_AT_ONCE], minlength=len(all_counts))
        known, places = np.flatnonzero(all_counts), None
        counts = all_counts[known]
    order = np.argsort(-counts, kind="stable")  # ties by id
    rank = np.empty(len(known), dtype=np.uint32)
    rank[order] = np.arange(len(known), dtype=np.uint32)
    if places is None:
        by_id = np.zeros(len(all_counts), dtype=np.uint32)
        by_id[known] = rank
        control, data = encode_ranks(by_id[ids])
    else:
        control, data = encode_ranks(rank[places])
    head = _COUNTS.pack(len(per_document), len(ids), len(known), len(control), len(data))
    return b"".join(
        (MAGIC, head, known[order].astype("<u4").tobytes(), per_document.astype("<u4").tobytes(),
         control.tobytes(), data.tobytes())
    )


def read_bytes(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ids per document of a file's content."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    documents, count, distinct, n_control, n_data = _COUNTS.unpack_from(content, len(MAGIC))
    at = len(MAGIC) + _COUNTS.size
    known = np.frombuffer(content, "<u4", distinct, at)
    at += 4 * distinct
    per_document = np.frombuffer(content, "<u4", documents, at)
    at += 4 * documents
    control = np.frombuffer(content, np.uint8, n_control, at)
    data = np.frombuffer(content, np.uint8, n_data, at + n_control)
    return known[decode_ranks(control, data, count)], per_document


# --- text to ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceEncoder:
    """Ids of texts by the tokenizers library, piece by piece.

    Pieces are found and told apart (by a 64-bit hash) for all texts of a batch at once; only
    pieces not seen lately are encoded. Long pieces and texts with white space beyond ASCII
    are not taken apart. The library finds its added tokens in a whole text before all
    else: a text that holds the string of one goes to it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values() if t.content]
        self._model = self._tokenizer.model
        self._byte_letters = byte_letters()
        self._head = regex.compile(r" ?\p{L}+")
        self._forget()

    def _forget(self) -> None:
        self._heads: dict[str, bytes] = {"": b""}
        self._keys = np.zeros(0, dtype=np.uint64)  # sorted
        self._slots = np.zeros(0, dtype=np.int64)  # place of each key in begins
        self._begins = np.zeros(1, dtype=np.int64)  # of each slot in ids, and the end
        self._ids = np.zeros(0, dtype=np.uint32)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, texts: list[str]) -> list[bytes]:
        """Ids of pieces: letters at the start are one match, the rest goes to the whole tokenizer.

        A letter before a character that is no letter ends a match in every context.
        """
        cut = [m.end() if (m := self._head.match(t)) else 0 for t in texts]
        rests = list({t[c:] for t, c in zip(texts, cut) if c < len(t)})
        known = {"": b""}
        for at in range(0, len(rests), 4096):
            known.update(zip(rests[at:at + 4096], self._whole(rests[at:at + 4096])))
        if len(self._heads) > KEPT_HEADS:
            self._heads = {"": b""}
        out = []
        for text, c in zip(texts, cut):
            head = text[:c]
            if head not in self._heads:
                letters = head.encode().decode("latin-1").translate(self._byte_letters)
                self._heads[head] = _packed([t.id for t in self._model.tokenize(letters)])
            out.append(self._heads[head] + known[text[c:]])
        return out

    def _slots_of(self, keys: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of each of the sorted, different keys; new ones get one. Their bytes are data[start:end]."""
        at = np.searchsorted(self._keys, keys)
        there = np.zeros(len(keys), dtype=bool)
        inside = at < len(self._keys)
        there[inside] = self._keys[at[inside]] == keys[inside]
        slots = np.empty(len(keys), dtype=np.int64)
        slots[there] = self._slots[at[there]]
        new = np.flatnonzero(~there)
        if len(new):
            found = self._new([data[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
            slots[new] = len(self._begins) - 1 + np.arange(len(new))
            self._begins = np.concatenate((self._begins, self._begins[-1] + np.cumsum(sizes)))
            self._ids = np.concatenate((self._ids, np.frombuffer(b"".join(found), dtype="<u4")))
            self._keys = np.insert(self._keys, at[new], keys[new])
            self._slots = np.insert(self._slots, at[new], slots[new])
        return slots

    def _places_of_added(self, data: bytes) -> list[int]:
        """Where strings of added tokens begin."""
        places = []
        for content in self._added:
            at = data.find(content)
            while at >= 0:
                places.append(at)
                at = data.find(content, at + 1)
        return places

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text (null: none)."""
        data, lengths = joined_bytes(column)
        ends_at = np.cumsum(lengths)
        starts_at = ends_at - lengths
        space = np.isin(data, _SPACES)
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        cut[starts_at[lengths > 0]] = True
        # a wide space before a space would be cut wrongly: such a text is one piece
        wide = np.unique(np.searchsorted(ends_at, _wide_spaces(data), side="right"))
        for row in wide:
            cut[starts_at[row] + 1:ends_at[row]] = False
        raw = data.tobytes()
        whole = np.zeros(len(data) + 1, dtype=bool)
        for row in np.unique(np.searchsorted(ends_at, self._places_of_added(raw), side="right")):
            cut[starts_at[row] + 1:ends_at[row]] = False
            whole[starts_at[row]] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
        apart = (ends - starts > LONGEST_PIECE) | whole[starts]
        long, short = np.flatnonzero(apart), np.flatnonzero(~apart)
        keys, first, inverse = np.unique(
            word_hashes(data, starts[short], ends[short]), return_index=True, return_inverse=True
        )
        if len(self._keys) > KEPT_PIECES:
            self._forget()
        slots = self._slots_of(keys, raw, starts[short][first], ends[short][first])
        begins = np.zeros(len(starts), dtype=np.int64)
        sizes = np.zeros(len(starts), dtype=np.int64)
        begins[short] = self._begins[slots][inverse]
        sizes[short] = (self._begins[slots + 1] - self._begins[slots])[inverse]
        pool = self._ids
        if len(long):
            found = [np.frombuffer(x, dtype="<u4") for x in self._whole([raw[a:b].decode() for a, b in zip(starts[long].tolist(), ends[long].tolist())])]
            sizes[long] = [len(x) for x in found]
            begins[long] = len(pool) + np.cumsum(sizes[long]) - sizes[long]
            pool = np.concatenate((pool, *found))
        done = np.cumsum(sizes)
        ids = pool[np.repeat(begins - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)]
        before = np.concatenate(([0], done))
        counts = before[np.searchsorted(starts, ends_at)] - before[np.searchsorted(starts, starts_at)]
        return ids, counts


def _wide_spaces(data: np.ndarray) -> np.ndarray:
    """Places of bytes that may belong to a white-space character beyond ASCII."""
    two = np.flatnonzero(data == 0xC2)
    two = two[np.isin(data[np.minimum(two + 1, len(data) - 1)], (0x85, 0xA0))]
    three = np.flatnonzero((data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    middle = data[np.minimum(three + 1, len(data) - 1)]
    lead = data[three]
    three = three[
        ((lead == 0xE1) & (middle == 0x9A)) | ((lead == 0xE2) & ((middle == 0x80) | (middle == 0x81)))
        | ((lead == 0xE3) & (middle == 0x80))
    ]
    return np.concatenate((two, three))


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Bytes that print as they are stand for themselves, the others for the code points from 256 on.
    """
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("\u00a1"), ord("\u00ac") + 1), *range(ord("\u00ae"), 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + place) for place, b in enumerate(others)}


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# --- files


def _target(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith(("/", "file:")):
        return pafs.LocalFileSystem(), local_path(path)
    return pafs.FileSystem.from_uri(path)




def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; the manifest, one row per file.

    Columns: `part`, `seq` (together the order of the files), `path`, `documents`, `ids`,
    `start` (ids in files before) and `doc_ids`, the ids of the file's documents in order.
    """
    source = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    # many rows without id or of one id are no single task; the sample of a range partitioning
    # goes to the driver, so of a text only its beginning, which has the same order
    beginning = F.substring("text", 1, 64).asc_nulls_first()
    placed = source.repartitionByRange(order[0], beginning).sortWithinPartitions(*order)
    key = source.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.IntegerType()),
            T.StructField("path", T.StringType()),
            T.StructField("documents", T.LongType()),
            T.StructField("ids", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(key)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        files, root = _target(folder)
        ids, keys, lengths, total = [], [], [], 0

        def close(kind: pa.DataType) -> pa.RecordBatch:
            name = f"{root}/part-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.tok"
            files.create_dir(root, recursive=True)
            with files.open_output_stream(name) as out:
                out.write(file_bytes(np.concatenate(ids), np.concatenate(lengths)))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([name]),
                 pa.array([len(keys)]), pa.array([total]), pa.array([keys], pa.list_(kind))],
                schema.names,
            )

        kind = None
        for piece in pieces(batches, "text"):
            kind = piece["doc_id"].type
            got, counts = coder.encode(piece["text"])
            ids.append(np.insert(got, np.cumsum(counts), end_id))
            keys += piece["doc_id"].to_pylist()
            lengths.append(counts + 1)
            total += len(ids[-1])
            if total >= FILE_IDS:
                yield close(kind)
                seq += 1
                ids, keys, lengths, total = [], [], [], 0
        if keys:
            yield close(kind)
        pa.default_memory_pool().release_unused()  # the worker waits for its next task

    manifest = written(map_arrow(placed, run, schema), "token-files")
    # one row per file
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("part", "seq", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")).alias("start"))
    return manifest.join(starts, ["part", "seq"])


def read_token_files(manifest: DataFrame, digest_only: bool = False) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids_crc32` and, if asked for, `ids` of every document."""
    key = manifest.schema["doc_ids"].dataType.elementType
    fields = [
        T.StructField("doc_id", key), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ]
    if not digest_only:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                files, path = _target(batch["path"][row].as_py())
                with files.open_input_stream(path) as content:
                    ids, lengths = read_bytes(content.read())
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                digests = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begins, ends)]
                columns = [
                    batch["doc_ids"][row].values, pa.array(batch["start"][row].as_py() + begins),
                    pa.array(lengths.astype(np.int64)), pa.array(digests, pa.int64()),
                ]
                if not digest_only:
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    wanted = manifest.select("path", "start", "doc_ids")
    # a row stands for a file: a few files a task
    return wanted.repartition(max(1, -(-manifest.count() // FILES_A_TASK))).mapInArrow(run, schema)


def token_file_report(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents as token files in the shared folder and read them back."""
    folder = scratch_path(spark, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), digest_only=True)
