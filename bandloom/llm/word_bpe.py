"""Byte-level BPE by a shuffle of distinct words, and decoding by the token table.

Documents are read in blocks. A block's words (the matches of the pattern) are numbered; the block's
documents become sequences of word numbers, the positions of the words. The distinct words of a block
leave it in ``BUCKETS`` packets by hash. All packets of a bucket meet in one task, which encodes each
word of the bucket once; the ids return to the block in the same packets, and are put in place of the
word numbers. What is shuffled is the packed sequences and each block's distinct words, not a row for
each word of the text.

A frequent word ("the") is one entry in one packet of every block, so it is no hot key. A block's key
is a digest of its documents: if a lost task were to cut the documents into other blocks than before,
their parts would not meet and the query would fail rather than give wrong ids.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .encode import pieces
from .shared import batches_of, ship

BLOCK_BYTES = 8 << 20
BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS
PACKETS = "block long, bucket int, content binary"
ROWS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file with their ids."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def stands_alone(part: str) -> bool:
    return part != "" and part.strip() == part


LOOSE = -1


class Block:
    """Documents as sequences of words. Words are ordered by a hash, whose first bits are their bucket."""

    def __init__(self, batch: pa.RecordBatch, pattern: regex.Pattern):
        self.ids = batch.column(0)
        whole: defaultdict[str, int] = defaultdict(count().__next__)
        column = pc.fill_null(batch.column(1), "")
        texts = column.to_numpy(zero_copy_only=False).tolist()
        digest = xxhash.xxh64(pc.binary_length(column).to_numpy().tobytes())
        for text in texts:
            digest.update(text.encode())
        digest.update(str(self.ids.to_pylist()).encode())
        self.key = digest.intdigest() - (1 << 63)
        split = pc.split_pattern(column, " ")
        n_parts = pc.list_value_length(split).to_numpy().astype(np.int64)
        split, begin = split.flatten(), np.cumsum(n_parts) - n_parts
        firsts = split.take(pa.array(begin)).to_pylist()
        follows = np.ones(len(split), dtype=bool)
        follows[begin] = False
        # parts that follow a single space, without it
        behind = split.filter(pa.array(follows)).dictionary_encode()
        # a part splits the same way wherever it stands: a single space between other characters always begins a word
        parts = behind.dictionary.to_numpy(zero_copy_only=False).tolist()
        usual = np.fromiter(map(stands_alone, parts), bool, len(parts))
        place = np.where(usual, np.cumsum(usual) - 1, LOOSE)
        words = pattern.findall("".join(f" {part}" for part in compress(parts, usual)))
        begins = np.flatnonzero(pc.starts_with(pa.array(words, pa.large_string()), " ").to_numpy(zero_copy_only=False))
        if len(begins) != usual.sum():
            raise RuntimeError("parts do not begin with a word of their own")
        after = place[behind.indices.to_numpy(zero_copy_only=False)]
        tails = np.split(after, np.cumsum(n_parts - 1)[:-1]) if texts else []
        heads = [
            [first] if first != "" and not first[-1].isspace() and bool((own != LOOSE).all()) else None
            for first, own in zip(firsts, tails)
        ]
        own_heads = [
            np.fromiter(map(whole.__getitem__, pieces(text) if head is None else head), np.int64)
            for text, head in zip(texts, heads)
        ]
        at_start = [pattern.findall(part) for part in whole]
        # heads are numbered behind the parts that follow a space
        self.parts: list[np.ndarray] = [
            own + len(begins) if head is None else np.concatenate([own + len(begins), tail])
            for own, head, tail in zip(own_heads, heads, tails)
        ]
        self.sizes = np.concatenate([np.diff(np.append(begins, len(words))), [len(x) for x in at_start]]).astype(np.int64)
        words.extend(chain.from_iterable(at_start))
        numbers = pa.array(words, pa.large_string()).dictionary_encode()
        self.flat = numbers.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = numbers.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        hashed = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
        self.order = np.argsort(hashed, kind="stable")
        if (np.diff(hashed[self.order]) == 0).any():  # numbers follow no order that another task repeats
            self.order = np.array(sorted(range(len(words)), key=lambda i: (hashed[i], words[i])))
        self.words = [words[i] for i in self.order.tolist()]
        bucket = (hashed[self.order] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        self.bounds = np.searchsorted(bucket, np.arange(BUCKETS + 1))

    def packets(self) -> Iterator[tuple[int, bytes]]:
        for bucket, (a, b) in enumerate(zip(self.bounds.tolist(), self.bounds[1:].tolist())):
            if a < b:
                yield bucket, packed_words(self.words[a:b])

    def packed(self) -> bytes:
        """The ids of the documents, their lengths and the sequences, in planes of bytes."""
        ids = np.array([0 if x is None else x for x in self.ids.to_pylist()], dtype="<i8")
        there = np.array(self.ids.is_valid(), dtype=np.uint8)
        bounds = np.cumsum([0, *map(len, self.parts)])
        parts = np.concatenate([np.zeros(0, np.int64), *self.parts])
        words = np.concatenate([[0], np.cumsum(self.sizes[parts])])[bounds]  # words before each document
        sequence = self.flat[ragged((np.cumsum(self.sizes) - self.sizes)[parts], self.sizes[parts])]
        # frequent words get small numbers in the packed form
        by_use = np.argsort(-np.bincount(sequence, minlength=len(self.words)), kind="stable")
        rank, place = np.empty(len(by_use), "<u4"), np.empty(len(by_use), "<u4")
        rank[by_use] = np.arange(len(by_use))
        place[self.order] = np.arange(len(by_use))
        planes = rank[sequence].view(np.uint8).reshape(-1, 4).T
        lengths = np.diff(words).astype("<u4")
        press = zstandard.ZstdCompressor(level=3).compress
        packed = [press(x.tobytes()) for x in (ids, there, lengths, place[by_use], *planes)]
        sizes = np.array([len(x) for x in packed], dtype="<u4").tobytes()
        return sizes + b"".join(packed)


def unpacked(content: bytes) -> list[bytes]:
    sizes = np.frombuffer(content, "<u4", 8)
    ends = (32 + np.cumsum(sizes)).tolist()
    return [zstandard.decompress(content[end - n : end]) for n, end in zip(sizes.tolist(), ends)]


def packed_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], dtype="<u4")
    narrow = bool(lengths.max() < 256)
    return b"".join([bytes([narrow]), np.uint32(len(words)).tobytes(),
                     lengths.astype(np.uint8 if narrow else "<u4").tobytes(), *words])


def words_in(content: bytes) -> list[bytes]:
    n = int(np.frombuffer(content, "<u4", 1, 1)[0])
    kind = np.dtype(np.uint8 if content[0] else "<u4")
    ends = (5 + n * kind.itemsize + np.cumsum(np.frombuffer(content, kind, n, 5), dtype=np.int64)).tolist()
    return [content[a:b] for a, b in zip([5 + n * kind.itemsize, *ends], ends)]


def _packet_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = zip(*rows)
    kinds = (pa.int64(), pa.int32(), pa.binary())
    return pa.record_batch(
        [pa.array(x, k) for x, k in zip(columns, kinds)], names=["block", "bucket", "content"]
    )


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """For every row ``doc_id``, ``n_tokens``, and the SHA-256 of its ids (as little-endian unsigned
    32-bit integers) and of the bytes that the ids decode to.

    A null or empty text has no tokens. Repeated rows each give a row; a null ``doc_id`` stays null;
    other columns are left out; an empty table gives no rows.
    """
    return encoded(docs, ranks, pattern, _digests(ranks), ROWS)


def encode_ids(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every row; an empty list for a null or empty text."""

    def lists(doc_ids: list[int | None], ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        values = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
        return pa.record_batch([pa.array(doc_ids, pa.int64()), values], names=["doc_id", "ids"])

    return encoded(docs, ranks, pattern, lambda: lists, "doc_id long, ids array<int>")


def encoded(docs: DataFrame, ranks: str, pattern: str, prepare, schema: str) -> DataFrame:
    """Encode; ``prepare()`` gives, in the task, the function that makes rows of a block's ids."""
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        compiled = regex.compile(pattern)
        for batch in batches_of(batches, "text", BLOCK_BYTES):
            yield Block(batch, compiled)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            if rows := [(block.key, bucket, content) for bucket, content in block.packets()]:
                yield _packet_rows(rows)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield _packet_rows([(block.key, -1, block.packed())])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = read_ranks(ranks)
        coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        now, known = None, {}
        for batch in batches:
            rows = []
            for key, bucket, content in zip(*(column.to_pylist() for column in batch.columns)):
                if bucket != now:
                    now, known = bucket, {}
                found = []
                for word in words_in(content):
                    ids = known.get(word)
                    if ids is None:
                        found_ids = coder.encode_ordinary(word.decode())
                        ids = known[word] = struct.pack(f"<{len(found_ids)}I", *found_ids)
                    found.append(ids)
                rows.append((key, bucket, packed_words(found)))
            if rows:
                yield _packet_rows(rows)

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = prepare()
        key, packed, found = None, None, []
        for batch in batches:
            for block, bucket, content in zip(*(column.to_pylist() for column in batch.columns)):
                if bucket == -1:
                    if packed is not None:
                        yield from restored(packed, found, make)
                    key, packed, found = block, content, []
                elif block != key:
                    raise RuntimeError("words of a block without its documents")
                else:
                    found.extend(words_in(content))
        if packed is not None:
            yield from restored(packed, found, make)

    by_bucket = source.mapInArrow(words, PACKETS).repartition("bucket").sortWithinPartitions("bucket")
    returned = by_bucket.mapInArrow(encode_words, PACKETS)
    everything = returned.union(source.mapInArrow(sequences, PACKETS)).repartition("block")
    return everything.sortWithinPartitions("block", "bucket").mapInArrow(reassemble, schema)


def restored(packed: bytes, found: list[bytes], make) -> Iterator[pa.RecordBatch]:
    """Put ids in place of word numbers, some documents at a time."""
    ids, there, lengths, places, *planes = (np.frombuffer(x, np.uint8) for x in unpacked(packed))
    doc_ids = [x if known else None for x, known in zip(ids.view("<i8").tolist(), there.tolist())]
    places = places.view("<u4")
    if len(found) != len(places):
        raise RuntimeError(f"a block has {len(places)} words, {len(found)} came back")
    sequence = np.stack(planes, axis=1).copy().view("<u4").ravel() if len(planes[0]) else np.zeros(0, "<u4")
    sizes = np.array([len(x) for x in found], dtype=np.int64) // 4
    flat, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
    sizes, starts = sizes[places], starts[places]  # by rank
    bounds = np.concatenate([[0], np.cumsum(lengths.view("<u4"), dtype=np.int64)])
    step = 0
    while step < len(doc_ids):
        end = max(step + 1, int(np.searchsorted(bounds, bounds[step] + (1 << 18), "right")) - 1)
        some = sequence[bounds[step] : bounds[end]]
        tokens = flat[ragged(starts[some], sizes[some])]
        ends = np.concatenate([[0], np.cumsum(sizes[some])])
        yield make(doc_ids[step:end], tokens, ends[bounds[step : end + 1] - bounds[step]])
        step = end


def _digests(ranks: str):
    def prepare():
        table = read_ranks(ranks)
        size = max(table.values()) + 1
        token: list[bytes] = [b""] * size
        for content, i in table.items():
            token[i] = content
        lengths = np.array([len(x) for x in token], dtype=np.int64)
        content, starts = np.frombuffer(b"".join(token), np.uint8), np.cumsum(lengths) - lengths

        def rows(doc_ids: list[int | None], ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
            """Decoding joins the ids with the token table, which the vocabulary bounds, by position."""
            decoded = content[ragged(starts[ids], lengths[ids])].tobytes()
            ends = np.concatenate([[0], np.cumsum(lengths[ids])])[bounds].tolist()
            raw, cuts = ids.astype("<u4").tobytes(), (bounds * 4).tolist()
            sha = lambda x: hashlib.sha256(x).hexdigest()
            return pa.record_batch(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([sha(raw[a:b]) for a, b in zip(cuts, cuts[1:])], pa.string()),
                    pa.array([sha(decoded[a:b]) for a, b in zip(ends, ends[1:])], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return rows

    return prepare
