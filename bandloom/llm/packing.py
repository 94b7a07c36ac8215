"""Pack documents into sequences of tokens, in order, by dynamic programming.

The documents of a partition, by ascending id, are one stream of tokens. Windows of at most ``LONGEST``
tokens cover it without gaps. A window may end after a document (free), after a sentence (``SENTENCE``)
or, in a long sentence, after every ``STEP`` tokens (``INSIDE``). The windows chosen have the least sum
of padding and of these penalties. Padding is what a window lacks to ``LONGEST``; a window whose length
is a power of two from ``SHORTEST`` on has none.

The least cost up to a cut j is its penalty plus the least, over earlier cuts i no further than LONGEST,
of cost(i) + LONGEST - (j - i): the minimum of cost(i) + i over a sliding range, which a monotone queue
gives in constant time; the powers of two are a few looked-up cuts more. The stream is worked off in
stretches of ``STRETCH`` tokens. The last windows of a stretch are not fixed but begin the next one, so
a partition has one end only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .encode import Encoder
from .shared import batches_of, by_id, ship

LONGEST = 2048
SHORTEST = 256  # the shortest power of two that a window without padding may have
SENTENCE, INSIDE, STEP = 8, 64, 128
STRETCH = 1 << 20
KEPT = 4 * LONGEST  # tokens before the end of a stretch whose windows are not yet fixed
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def cut_points(length: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending cuts with 0 and ``length``, and their penalties."""
    rank = np.zeros(length + 1, dtype=np.uint8)  # of a cut: 1 inside, 2 after a sentence, 3 after a document
    rank[sentence_ends] = 2
    rank[doc_ends] = 3
    rank[[0, length]] = 3
    cuts = np.flatnonzero(rank)
    gaps = np.diff(cuts)
    long = np.flatnonzero(gaps > STEP)
    if len(long):
        more = (gaps[long] - 1) // STEP
        base = np.repeat(cuts[long], more)
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
        rank[base + (step + 1) * STEP] = 1
        cuts = np.flatnonzero(rank)
    return cuts, np.array([0, INSIDE, SENTENCE, 0])[rank[cuts]]


def best_cuts(cuts: np.ndarray, penalty: np.ndarray, longest: int = LONGEST) -> list[int]:
    """Ends of the cheapest windows that cover from the first cut to the last."""
    exact: dict[int, list[int]] = {}
    size = SHORTEST
    while size < longest:
        at = np.searchsorted(cuts, cuts - size)
        hit = np.flatnonzero((cuts - size >= cuts[0]) & (cuts[at] == cuts - size))
        for j, i in zip(hit.tolist(), at[hit].tolist()):
            exact.setdefault(j, []).append(i)
        size *= 2
    where, fine = cuts.tolist(), penalty.tolist()
    cost, back = [0] * len(where), [0] * len(where)
    keys, at, head = [where[0]], [0], 0  # the queue: cost(i) + i ascending, i ascending
    for j in range(1, len(where)):
        here = where[j]
        while here - where[at[head]] > longest:
            head += 1
        i = at[head]
        least = keys[head] + longest - here
        if j in exact:
            for k in exact[j]:
                if cost[k] < least:
                    least, i = cost[k], k
        least += fine[j]
        cost[j], back[j] = least, i
        key = least + here
        while len(keys) > head and keys[-1] > key:
            keys.pop()
            at.pop()
        keys.append(key)
        at.append(j)
    ends, j = [], len(where) - 1
    while j:
        ends.append(where[j])
        j = back[j]
    return ends[::-1]


def sentence_end_ids(encoder: Encoder) -> np.ndarray:
    """For each token id, whether a sentence may end after it."""
    size = encoder.tokenizer.get_vocab_size()
    texts = [encoder.tokenizer.decode([i], skip_special_tokens=False) for i in range(size)]
    return np.array([text.rstrip(" \"')")[-1:] in (".", "!", "?", "\n", "。", "！", "？") and bool(text)
                     for text in texts])


class Packer:
    """Takes documents in order; gives rows of PIECES, and the ids of each piece."""

    def __init__(self, ends_sentence: np.ndarray, first_sequence: int):
        self.ends_sentence, self.sequence = ends_sentence, first_sequence
        self.docs: list[tuple[int | None, np.ndarray, int]] = []  # id, ids not yet packed, how many were
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids)

    def pack(self, last: bool) -> Iterator[tuple[tuple, np.ndarray]]:
        if not self.docs:
            return
        stream = np.concatenate([ids for _, ids, _ in self.docs])
        doc_ends = np.cumsum([len(ids) for _, ids, _ in self.docs])
        cuts, penalty = cut_points(
            len(stream), doc_ends, np.flatnonzero(self.ends_sentence[stream]) + 1
        )
        windows = best_cuts(cuts, penalty)
        if not last:
            windows = [end for end in windows if end <= len(stream) - KEPT]
        if not windows:
            return
        doc, begin, left = 0, 0, []
        doc_starts = np.concatenate([[0], doc_ends]).tolist()
        for end in windows:
            offset = 0
            while begin < end:
                doc_id, ids, gone = self.docs[doc]
                stop = min(end, doc_starts[doc + 1])
                part = stream[begin:stop]
                total = gone + len(ids)
                yield (
                    (doc_id, gone + begin - doc_starts[doc], len(part), zlib.crc32(part.astype("<u4").tobytes()),
                     total, self.sequence, offset), part,
                )
                offset += len(part)
                begin = stop
                if stop == doc_starts[doc + 1]:
                    doc += 1
            self.sequence += 1
        if doc < len(self.docs):
            doc_id, ids, gone = self.docs[doc]
            cut = begin - doc_starts[doc]
            left = [(doc_id, ids[cut:], gone + cut), *self.docs[doc + 1 :]]
        self.docs, self.held = left, len(stream) - begin


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """A row for each piece of a document in a sequence; with ``with_ids`` also its token ``ids``.

    A document is its text's ids and ``end_id``; a null or empty text is the end id alone. Order is by
    ``doc_id`` (null first), equal ids by a hash of the text, so that rows of one id may be dealt to several
    tasks; sequences of a later partition have larger numbers. A text of any length is cut like others. Repeated rows are packed each. Other columns are left out. An empty table gives no rows.
    """
    ship(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(tokenizer)
        ends = getattr(encoder, "ends_sentence", None)
        if ends is None:
            ends = encoder.ends_sentence = sentence_end_ids(encoder)
        packer = Packer(ends, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        for batch in batches_of(batches, "text", 8 << 20, 4096, keep_encoders=True):
            found = encoder.encode(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), found):
                packer.add(doc_id, np.frombuffer(ids + end, encoder.dtype))
                if packer.held >= STRETCH:
                    yield _table(packer.pack(last=False), with_ids)
        yield _table(packer.pack(last=True), with_ids)

    return by_id(docs).mapInArrow(pieces, PIECES + ", ids array<int>" * with_ids)


def _table(found: Iterator[tuple[tuple, np.ndarray]], with_ids: bool) -> pa.RecordBatch:
    rows, ids = [], []
    for row, part in found:
        rows.append(row)
        if with_ids:
            ids.append(part.astype(np.int32))
    names = [field.split()[0] for field in PIECES.split(", ")]
    columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * len(names))]
    if with_ids:
        names, columns = [*names, "ids"], [*columns, pa.array(ids, pa.list_(pa.int32()))]
    return pa.record_batch(columns, names=names)
