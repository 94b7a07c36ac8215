"""Pack documents into as few sequences of tokens as the search finds, by bin completion.

Documents longer than a sequence are cut into whole sequences and a first, shorter piece; no other is cut. The
documents never move: they are encoded where they are read, and each piece gets a running number among the
pieces of its length in its task. How many pieces of each length there are is all that the packing needs, a
number for each of ``LONGEST`` lengths however many documents there are; ``bin_completion`` turns these
counts into fillings and their numbers of bins. Pieces of a length are dealt to the places for this length in
the order of their numbers, so a piece finds its sequence and its place there in a table of a few entries for
each length. A shuffle carries counts by task and length, and at most the narrow rows of the pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .bin_completion import Plan, pack_counts
from .encode import Encoder
from .shared import batches_of, ship, written

LONGEST = 2048
EFFORT = 200_000
CUT = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def with_end(values: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of documents in a row with the end id behind each, and where each document begins."""
    bounds_ = bounds + np.arange(len(bounds))
    out = np.full(bounds_[-1], end_id, dtype=values.dtype)
    inside = np.ones(len(out), dtype=bool)
    inside[bounds_[1:] - 1] = False
    out[inside] = values
    return out, bounds_


def cut(bounds: np.ndarray, longest: int) -> tuple[np.ndarray, ...]:
    """Of each piece its document, its number there, and where it begins and ends; the first may be shorter."""
    sizes = np.diff(bounds)
    count = -(-sizes // longest)
    of = np.repeat(np.arange(len(sizes)), count)
    piece = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    last = bounds[1:][of] - (count[of] - 1 - piece) * longest
    return of, piece, np.maximum(last - longest, bounds[:-1][of]), last


def numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The running number of each among those of its length, after ``seen``, which goes on."""
    order = np.argsort(lengths, kind="stable")
    sorted_ = lengths[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else order
    sizes = np.diff(np.concatenate([first, [len(sorted_)]]))
    nth = np.empty(len(lengths), dtype=np.int64)
    nth[order] = np.arange(len(sorted_)) - np.repeat(first, sizes) + seen[sorted_]
    seen[sorted_[first]] += sizes
    return nth


def places(plan: Plan) -> np.ndarray:
    """Rows of length, number of the first piece of the length that goes there, pieces in each sequence, first
    sequence, offset of the first; by length, then number."""
    rows: list[tuple[int, ...]] = []
    dealt: dict[int, int] = {}
    sequence = 0
    for filling, bins in plan:
        offset = 0
        for length, times in filling:
            first = dealt.get(length, 0)
            rows.append((length, first, times, sequence, offset))
            dealt[length] = first + times * bins
            offset += length * times
        sequence += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack_best_fit(
    docs: DataFrame, tokenizer: str, end_id: int = 0, longest: int = LONGEST, with_ids: bool = True,
    effort: int = EFFORT,
) -> DataFrame:
    """A row for each piece of a document in a sequence; with ``with_ids`` also its token ``ids``.

    A document is its text's ids and ``end_id``; a null or empty text is the end id alone, a text of any
    length is cut like others. Repeated rows, rows of one id and null ids are documents of their own. Pieces
    of one length are alike to the packing: which of them goes where follows the order in which they are
    read. ``sequence_id`` counts from 0 without gaps. Other columns are left out. An empty table gives no rows.

    ``effort`` bounds the search for a better packing than best fit, never the documents that are packed.
    """
    spark = docs.sparkSession
    ship(spark)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder.at(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, dtype=np.int64)
        for batch in batches_of(batches, "text", 8 << 20, 4096, keep_encoders=True):
            values, bounds = with_end(*encoder.encode_flat(batch.column(1)), end_id)
            of, piece, begin, end = cut(bounds, longest)
            wide = memoryview(values.astype("<u4")).cast("B")
            sums = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist())]
            columns = [
                batch.column(0).take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(begin - bounds[of]),
                pa.array(end - begin), pa.array(sums, pa.int64()), pa.array(np.full(len(of), task, np.int32)),
                pa.array(numbered(end - begin, seen)),
            ]
            names = [field.split()[0] for field in CUT.split(", ")]
            if with_ids:
                offsets = np.concatenate([begin, end[-1:]]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32))))
                names.append("ids")
            yield pa.record_batch(columns, names=names)

    ids = ", ids array<int>" * with_ids
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    made = written(source.mapInArrow(pieces, CUT + ids))
    by_task = written(made.groupBy("task", "length").agg(F.count("*").alias("n")))
    totals = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row for each length at most
    table = places(pack_counts({row.length: row.n for row in totals}, longest, effort))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    shared = spark.sparkContext.broadcast(table)  # its size depends on the lengths, not on the documents
    placed_names = [field.split()[0] for field in PLACED.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, each, sequence, offset = shared.value.T
        keys = (length << 48) | first
        for batch in batches:
            own = batch.column("length").to_numpy()
            rank = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            at = np.searchsorted(keys, (own << 48) | rank, side="right") - 1
            within, times = rank - first[at], each[at]
            columns = [batch.column(name) for name in placed_names[:5]]
            columns += [pa.array(sequence[at] + within // times), pa.array(offset[at] + within % times * own)]
            columns += [batch.column(name) for name in ["ids"] * with_ids]
            yield pa.record_batch(columns, names=[*placed_names, *["ids"] * with_ids])

    return made.join(before, ["task", "length"]).mapInArrow(place, PLACED + ids)
