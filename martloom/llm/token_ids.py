"""Token ids in binary files: frequency-ranked, byte-aligned, with the control bytes apart from the data bytes.

Documents are put into ascending order of doc_id by one range shuffle and encoded behind it, so each partition is a shard
and the shards follow one another. A shard is a file of blocks. In a block, ids are replaced by their rank in the block's
own frequency table, so the commonest 256 take one byte and the next 65,280 two. Lengths stand two bits each in control
bytes; the data bytes follow. A block carries its table and can be read alone. Files are committed by Spark's writer: a
lost task leaves nothing half written.

Layout of a block, little-endian: magic, version, flags (u4 each); numbers of documents, ids and ranks (u8 each); per
document its id (i8), whether it has one (u1) and how many ids it has (u8); the ids by rank (u4); control bytes; data.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import arrow_map, slices
from martloom.llm.pieces import MOST_REMEMBERED, Remembered, gathered
from martloom.session import work_folder

BLOCK_IDS = 4 << 20
MAGIC, VERSION = 0x314D4C54, 1
# Lengths of the four values that a control byte stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGITS = "0-9²³¹¼-¾"
# Kinds of characters up to U+024F; a text with any other goes to the library whole.
OTHER = re.compile("[^\t\n\r -~¡-ɏ]")
SPACE, LETTER, DIGIT, SYMBOL = range(4)
KINDS = np.array([
    SPACE if c in "\t\n\r " else LETTER if re.match(f"[{LETTERS}]", c) else DIGIT if re.match(f"[{DIGITS}]", c) else SYMBOL
    for c in map(chr, range(0x250))
], dtype=np.uint8)
# The contractions that the split pattern knows.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
PLAIN_BYTES = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))
# The letter that stands for a byte: its own if it is printable, else one from U+0100 on.
OTHER_BYTES = [b for b in range(256) if b not in PLAIN_BYTES]
BYTE_LETTERS = {b: 0x100 + k for k, b in enumerate(OTHER_BYTES)}
ENCODED_BYTES = 6 << 20  # text whose words are looked up together


def encode_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = values.astype(np.uint32)
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(values)] = extra
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    ends = np.cumsum(extra.astype(np.int64) + 1)
    begins = ends - extra - 1
    data = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    data[begins] = values & 0xFF
    for k in range(1, 4):
        longer = np.flatnonzero(extra >= k)
        data[begins[longer] + k] = (values[longer] >> (8 * k)) & 0xFF
    return control.astype(np.uint8), data


def decode_values(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The numbers behind control and data bytes: lengths by table lookup, then one gather for each byte of a number."""
    lengths = LENGTHS[control].reshape(-1)[:count]
    ends = np.cumsum(lengths, dtype=np.int64)
    begins = ends - lengths
    values = data[begins].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= data[begins[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """One block. ids: those of all its documents, one after the other."""
    often = np.bincount(ids)
    order = np.argsort(-often, kind="stable")[: np.count_nonzero(often)]
    rank = np.empty(len(often), dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    control, data = encode_values(rank[ids])
    head = np.array([MAGIC, VERSION, 0], "<u4").tobytes() + np.array([len(counts), len(ids), len(order)], "<u8").tobytes()
    docs = np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is not None for x in doc_ids], "<u1").tobytes()
    table = order.astype("<u4").tobytes()
    return b"".join([head, docs, np.array(counts, "<u8").tobytes(), table, control.tobytes(), data.tobytes()])


def unpack(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Ids of the documents of a block, how many token ids each has, and all token ids."""
    magic, version, _ = np.frombuffer(block, "<u4", 3)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of token ids")
    docs, count, ranks = (int(x) for x in np.frombuffer(block, "<u8", 3, 12))
    at = 36

    def take(kind: str, many: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(block, kind, many, at)
        at += found.nbytes
        return found

    doc_ids, known, counts = take("<i8", docs), take("<u1", docs), take("<u8", docs)
    table, control = take("<u4", ranks), take("u1", -(-count // 4))
    ids = table[decode_values(control, take("u1", len(block) - at), count)] if count else np.empty(0, "<u4")
    return [x if k else None for x, k in zip(doc_ids.tolist(), known.tolist(), strict=True)], counts.astype(np.int64), ids


def cuts_of(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the pieces of byte-level vocabularies begin: runs of letters, of digits and of symbols, each with a single space
    before it, short endings after an apostrophe, and white space; edges: where texts begin and end.

    Of white space before other characters the last one is not part of its run: a space goes with what follows, any other
    stands alone.
    """
    size = len(points)
    kinds = KINDS[points]
    edge = np.zeros(size + 1, dtype=bool)
    edge[edges] = True
    new = np.ones(size + 1, dtype=bool)
    new[1:-1] = kinds[1:] != kinds[:-1]
    new |= edge
    # The last of some white space, with something else of the same text behind it.
    last = np.flatnonzero((kinds == SPACE) & new[1:] & ~edge[1:])
    new[last] = True
    new[last[points[last] == ord(" ")] + 1] = False
    # An apostrophe that begins a piece takes a short ending with it.
    spots = np.flatnonzero((points == ord("'")) & new[:-1] & ~edge[1:])
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    goes_on = np.concatenate([~new[1:], np.zeros(2, bool)])  # the next character belongs to the same piece
    one, two = padded[spots + 1], padded[spots + 2]
    short = np.isin(one, [ord(c) for c in CONTRACTIONS if len(c) == 1])
    long = np.zeros(len(spots), dtype=bool)
    for c in CONTRACTIONS:
        if len(c) == 2:
            long |= goes_on[spots + 1] & (one == ord(c[0])) & (two == ord(c[1]))
    new[spots[short | long] + 1] = False
    new[spots[short] + 2] = True
    new[spots[long] + 3] = True
    return np.flatnonzero(new)


class LibraryEncoder:
    """Ids of texts by the tokenizers library, each distinct piece encoded once. One for each task."""

    def __init__(self, path: str):
        self.library = loaded(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known = Remembered(MOST_REMEMBERED)

    def batch(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Pieces are split already: the library's model gets them in the letters that stand for their bytes."""
        tokens_of, letters = self.library.model.tokenize, BYTE_LETTERS
        spelled = [
            p.replace(" ", "Ġ") if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters)
            for p in pieces
        ]
        return [array("I", [t.id for t in tokens_of(x)]).tobytes() for x in spelled]

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts of known characters only: cut by numpy, numbered by Arrow."""
        joined = "".join(texts)
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        if not joined:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        raw = joined.encode()
        if len(raw) == len(joined):
            cuts = cuts_of(np.frombuffer(raw, np.uint8), edges)
            spans = cuts
        else:
            points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            cuts = cuts_of(points, edges)
            at_byte = np.zeros(len(points) + 1, dtype=np.int64)
            np.cumsum(1 + (points >= 0x80), out=at_byte[1:])
            spans = at_byte[cuts]
        strings = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(spans.astype(np.int64)), pa.py_buffer(raw))
        coded = strings.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        found, missing = self.known.find(pieces)
        if missing:
            made = self.encode_pieces(missing)
            self.known.add(missing, made)
            rest = iter(made)
            found = [next(rest) if x is None else x for x in found]
        ids, counts = gathered(found, np.asarray(coded.indices).astype(np.int64))
        before = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(cuts, edges)]
        return ids, np.diff(before)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and the number of ids of each text."""
        whole = np.array([OTHER.search(t) is not None or any(s in t for s in self.special) for t in texts], dtype=bool)
        if not whole.any():
            return self.plain(texts)
        rest, counts = self.plain([t for t, x in zip(texts, whole.tolist(), strict=True) if not x])
        coded = [np.frombuffer(x, "<u4") for x in self.batch([t for t, x in zip(texts, whole.tolist(), strict=True) if x])]
        sizes = np.zeros(len(texts), dtype=np.int64)
        sizes[~whole], sizes[whole] = counts, [len(x) for x in coded]
        ids = np.empty(int(sizes.sum()), dtype=np.uint32)
        own = np.repeat(whole, sizes)
        ids[~own] = rest
        ids[own] = np.concatenate(coded)
        return ids, sizes


@cache
def loaded(path: str):
    """The library's tokenizer, kept by a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already has a task on each core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def closed(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of all texts with the end id after each."""
    out = np.empty(len(ids) + len(counts), dtype=np.uint32)
    ends = np.cumsum(counts) + np.arange(len(counts))
    out[ends] = end_id
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = ids
    return out


BLOCKS = "shard int, block int, n_ids long, payload binary"


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text and write the ids to files in ascending order of doc_id, each document closed by end_id.

    path names a byte-level vocabulary of the tokenizers library that every executor has. NULL texts are empty, and an
    empty text is the end id alone. Rows without an id come first; rows with equal ids follow in the order of their texts'
    hashes. An empty table gives files without a block. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shard, block = LibraryEncoder(path), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        coded: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            ids = np.concatenate(coded)
            payload = pack(names, np.concatenate(sizes).tolist(), ids)
            columns = [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([payload], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "block", "n_ids", "payload"])

        for batch in batches:
            for part in slices(batch, "text", ENCODED_BYTES):
                names += part.column("doc_id").to_pylist()
                ids, counts = known.encode(part.column("text").fill_null("").to_pylist())
                coded.append(closed(ids, counts, end_id))
                sizes.append(counts + 1)
                held += len(coded[-1])
                if held >= block_ids:
                    yield out()
                    names, coded, sizes, held, block = [], [], [], 0, block + 1
        if coded:
            yield out()

    arrow_map(ordered, run, BLOCKS).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, decoded from the files of a folder."""
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    # Two steps: the blocks of a shard, then one row for each shard.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    shards = shards.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    begins = blocks.select("shard", "block", inside.alias("inside")).join(shards, "shard").select(
        "shard", "block", (F.col("before") + F.col("inside")).alias("before")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "payload")), strict=True):
                names, counts, ids = unpack(payload)
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
                here = [pa.array(np.full(len(names), x, np.int32)) for x in (shard, block)]
                yield pa.RecordBatch.from_arrays(
                    [*here, pa.array(names, pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    found = arrow_map(blocks, run, "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(begins, ["shard", "block"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What read_token_files finds after write_token_files, in a new folder among the shared ones."""
    folder = work_folder(docs.sparkSession, "llm-token-files")
    write_token_files(docs, folder, path, end_id, doc_id, text)
    return read_token_files(docs.sparkSession, folder)
