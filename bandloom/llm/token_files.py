"""Token ids of documents in seekable zstandard files.

A shard is a row of independent zstandard frames of about ``FRAME_BYTES`` each, holding whole
documents; then a skippable frame with an index of the frames' documents; then the seek table of the
public seekable format (a skippable frame with the compressed size, the full size and a checksum of
every frame, closed by a magic number). Any zstandard tool reads a shard from end to end; a reader
that wants some documents reads the two tables and decompresses the frames that hold them.

A frame's content: count n (int64), n ids of documents (int64), n flags (uint8: 1 where the id is not
null), n token counts (int64), then the token ids of all n documents (uint16, or uint32 for large
vocabularies).

Spark's text writer makes the files, one row to a file: a task that fails leaves nothing behind, and a
speculative copy is never seen. Its line separator is the magic number that closes the seek table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .encode import Encoder
from .shared import batches_of, by_id, ship

FRAME_BYTES = 256 << 10
SHARD_BYTES = 16 << 20
LEVEL = 3
#: Fixed values of the public formats.
INDEX_MAGIC, SEEK_MAGIC, CLOSING_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80
CLOSING = struct.pack("<I", CLOSING_MAGIC)
#: The numbers of the task and of its file in the names that Spark's writers give; as text, -c1000 is before -c101.
PART, FILE = r"part-(\d+)-[^/]*$", r"-c(\d+)[^/]*$"


def _sum(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class ShardWriter:
    """Collects documents in order and gives the bytes of a shard, without the closing magic."""

    def __init__(self, width: int):
        self.width, self.frames, self.index, self.size = width, [], [], 0
        self._reset()

    def _reset(self) -> None:
        self.ids: list[int | None] = []
        self.tokens: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        if self.held and self.held + len(tokens) > FRAME_BYTES:
            self._close_frame()
        self.ids.append(doc_id)
        self.tokens.append(tokens)
        self.held += len(tokens) + 17

    def _close_frame(self) -> None:
        counts = np.array([len(x) // self.width for x in self.tokens], dtype="<i8")
        ids = np.array([0 if x is None else x for x in self.ids], dtype="<i8")
        there = np.array([x is not None for x in self.ids], dtype=np.uint8)
        content = b"".join(
            [struct.pack("<q", len(ids)), ids.tobytes(), there.tobytes(), counts.tobytes(), *self.tokens]
        )
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(content)
        self.frames.append((packed, len(content), _sum(content)))
        known = ids[there == 1]
        first, last = (int(known.min()), int(known.max())) if len(known) else (0, -1)
        self.index.append(struct.pack("<qqq?", len(ids), first, last, not there.all()))
        self.size += len(packed)
        self._reset()

    def finish(self) -> bytes:
        if self.ids:
            self._close_frame()
        table = struct.pack("<BI", self.width, len(self.index)) + b"".join(self.index)
        index = struct.pack("<II", INDEX_MAGIC, len(table)) + table
        entries = [*((len(p), n, s) for p, n, s in self.frames), (len(index), 0, _sum(b""))]
        seek = b"".join(struct.pack("<III", *entry) for entry in entries)
        seek += struct.pack("<IB", len(entries), WITH_CHECKSUMS)
        seek = struct.pack("<II", SEEK_MAGIC, len(seek) + 4) + seek
        return b"".join([*(packed for packed, _, _ in self.frames), index, seek])


@dataclass(frozen=True)
class Document:
    doc_id: int | None
    start: int  # tokens of the shard before it, or -1 if frames before it were not read
    tokens: np.ndarray


def read_shard(
    read: Callable[[int, int], bytes], length: int, wanted: Collection[int] | None = None
) -> Iterator[Document]:
    """The documents of a shard in order; ``read(offset, size)`` gives bytes of the file.

    With ``wanted`` only the frames whose range of ids holds a wanted one are read and decompressed.
    Raises ValueError if the tables or a frame's checksum do not fit.
    """
    count, flags, closing = struct.unpack("<IBI", read(length - 9, 9))
    if closing != CLOSING_MAGIC or flags != WITH_CHECKSUMS:
        raise ValueError("not a shard: the seek table is missing")
    size = count * 12 + 9
    head = struct.unpack("<II", read(length - size - 8, 8))
    if head != (SEEK_MAGIC, size):
        raise ValueError("the seek table does not fit its length")
    entries = [*struct.iter_unpack("<III", read(length - size, count * 12))]
    offsets = np.concatenate([[0], np.cumsum([e[0] for e in entries])]).tolist()
    table = read(offsets[-2] + 8, entries[-1][0] - 8)
    width, _ = struct.unpack_from("<BI", table)
    index = [*struct.iter_unpack("<qqq?", table[5:])]
    start, sought = 0, None if wanted is None else np.array(sorted(wanted), dtype=np.int64)
    for (packed, full, check), offset, (_, first, last, _) in zip(entries, offsets, index):
        if sought is not None and np.searchsorted(sought, first) == np.searchsorted(sought, last, "right"):
            start = -1
            continue
        try:
            content = zstandard.ZstdDecompressor().decompress(read(offset, packed), max_output_size=full)
        except zstandard.ZstdError as error:
            raise ValueError(f"the frame at {offset} is damaged, so its checksum cannot fit") from error
        if len(content) != full or _sum(content) != check:
            raise ValueError(f"the frame at {offset} does not fit its checksum")
        (n,) = struct.unpack_from("<q", content)
        ids = np.frombuffer(content, "<i8", n, 8)
        there = np.frombuffer(content, np.uint8, n, 8 + 8 * n)
        counts = np.frombuffer(content, "<i8", n, 8 + 9 * n)
        at = 8 + 17 * n
        for doc_id, known, tokens in zip(ids.tolist(), there.tolist(), counts.tolist()):
            if sought is None or (known and doc_id in wanted):
                values = np.frombuffer(content, f"<u{width}", tokens, at)
                yield Document(doc_id if known else None, start, values)
            at += tokens * width
            start = start + tokens if start >= 0 else -1


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, shard_bytes: int = SHARD_BYTES
) -> None:
    """Write ``folder`` with the ids of every ``text`` and ``end_id`` after each, by ascending ``doc_id``.

    Files sort by the two numbers in their names (task, file of the task) as documents do by id (null
    first; equal ids by a hash of the text, so that they may be dealt to several tasks). A null or empty
    text is the end id alone, a text of any length is one document of one frame. Every row is written,
    repeated rows too; other columns are left out. An empty table makes a folder without shards.
    """
    ship(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(tokenizer)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        shard = ShardWriter(encoder.dtype.itemsize)
        for batch in batches_of(batches, "text", 8 << 20, 4096, keep_encoders=True):
            found = encoder.encode(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), found):
                shard.add(doc_id, ids + end)
                if shard.size + shard.held >= shard_bytes:
                    yield pa.record_batch([[shard.finish()]], names=["value"])
                    shard = ShardWriter(encoder.dtype.itemsize)
        if shard.size or shard.ids:
            yield pa.record_batch([[shard.finish()]], names=["value"])

    ordered = by_id(docs)
    made = ordered.mapInArrow(shards, "value binary").select(F.col("value").cast("string"))
    made.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option(
        "lineSep", CLOSING.decode("latin-1")
    ).text(folder)


def read_tokens(
    spark: SparkSession, folder: str, wanted: Collection[int] | None = None, with_ids: bool = True
) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before it; null with ``wanted``), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) and, on request, ``ids``."""
    ship(spark)
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    schema = "shard string, doc_id long, start long, n_tokens long, ids_crc32 long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                view = memoryview(content.as_buffer())
                held: list[tuple] = []
                size = 0
                for doc in read_shard(lambda a, n: view[a : a + n], len(view), wanted):
                    wide = doc.tokens.astype("<u4")
                    row = (path, doc.doc_id, doc.start, len(wide), zlib.crc32(wide.tobytes()))
                    held.append(row + (wide.astype(np.int32),) * with_ids)
                    size += len(wide) if with_ids else 1
                    if size >= 1 << 20:
                        yield _rows(held, with_ids)
                        held, size = [], 0
                if held:
                    yield _rows(held, with_ids)

    found = files.mapInArrow(rows, schema + ", ids array<int>" * with_ids)
    if wanted is not None:
        return found.withColumn("start", F.lit(None).cast("long")).drop("shard")
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # a row for each shard
    number = lambda pattern: F.regexp_extract("shard", pattern, 1).cast("long")
    before = Window.orderBy(number(PART), number(FILE)).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return found.join(starts, "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids,
    )


def _rows(held: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["shard", "doc_id", "start", "n_tokens", "ids_crc32"]
    if with_ids:
        kinds, names = [*kinds, pa.list_(pa.int32())], [*names, "ids"]
    return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)
