"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in at most ``MOST_BITS`` of 64 bits are linked. Two such fingerprints agree
in at least ``AGREE`` of ``BLOCKS`` blocks of bits, so each fingerprint is sent to one place for every
choice of ``AGREE`` blocks, under the bits it has there. A place is sorted by Gray rank, where
neighbours differ in few bits, and cut into runs of at most ``RUN`` fingerprints. Each run becomes a
tree: a node keeps the bits on which all fingerprints below it agree, without those its parent has
already; a search adds up the differences on the way down and leaves a node, with all below it, as
soon as they pass the limit. Runs of one place meet each other only if their roots do not already
differ too much.

A place that holds a third of all fingerprints is many runs in many partitions (range partitioning on
place *and* rank), so no task gathers a group. Links within a run leave it as stars, so a group of m
copies sends m rows, not m squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from .components import LINKS, components, roots
from .shared import ship, written

MOST_BITS = 4
BLOCKS, AGREE = 6, 2  # 4 differing bits spoil 4 blocks at most, so 2 of 6 agree
RUN, FANOUT = 1024, 8
SHINGLE, SEED = 4, 42
TOP = np.uint64(1 << 63)
ALL_BITS = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = (ends - [len(word) + 1 for word in words]).tolist()
    stops = (ends - 1).tolist()[SHINGLE - 1 :] or [len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8"
    ).view(np.uint8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8 << 16):
        bits = np.unpackbits(hashes[at : at + (8 << 16)].reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes) // 8, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column) -> Column:
    """The fingerprint as a signed long."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x) for x in texts], dtype=np.uint64).view(np.int64))

    return of(text)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in the Gray sequence of 64-bit words."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def block_masks() -> list[np.uint64]:
    """The bits of every choice of AGREE of the BLOCKS blocks."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    block = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [np.uint64(sum(block[i] for i in chosen)) for chosen in combinations(range(BLOCKS), AGREE)]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = block_masks()
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        rank = (gray_rank(prints) ^ TOP).view(np.int64)  # ordered as a signed long
        for number, mask in enumerate(masks):
            yield pa.record_batch(
                [
                    np.full(len(prints), number, dtype=np.int32),
                    (prints & mask).view(np.int64),
                    rank,
                    prints.view(np.int64),
                ],
                names=["choice", "bits", "rank", "print"],
            )


RUNS = "choice int, bits long, run long, low long, high long, prints array<long>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut sorted rows into runs of one place. A place with a single fingerprint has no links and is
    left out, unless it may go on in a neighbouring partition."""
    part, number, first = TaskContext.get().partitionId(), 0, True
    held: tuple[np.ndarray, ...] | None = None
    goes_on = False  # whether the held rows continue a place that has been cut

    def cut(choice, bits, prints, last):
        nonlocal number, first
        if not len(prints):
            return
        new = np.flatnonzero((np.diff(choice) != 0) | (np.diff(bits) != 0)) + 1
        starts = np.concatenate([[0], new])
        stops = np.concatenate([new, [len(prints)]])
        out = []
        for k, (a, b) in enumerate(zip(starts.tolist(), stops.tolist())):
            edge = ((first or goes_on) and k == 0) or (last and k == len(starts) - 1)
            if b - a > 1 or edge:
                for at in range(a, b, RUN):
                    some = prints[at : min(b, at + RUN)]
                    low, high = np.bitwise_and.reduce(some), np.bitwise_or.reduce(some)
                    out.append((choice[a], bits[a], part << 40 | number, low, high, some.view(np.int64)))
                    number += 1
        first = False
        if out:
            columns = list(zip(*out))
            signed = lambda x: np.array(x, dtype=np.uint64).view(np.int64)
            yield pa.record_batch(
                [
                    pa.array(columns[0], pa.int32()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(signed(columns[3])),
                    pa.array(signed(columns[4])),
                    pa.array(columns[5], pa.list_(pa.int64())),
                ],
                names=["choice", "bits", "run", "low", "high", "prints"],
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        choice, bits, prints = (
            batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3)
        )
        prints = prints.view(np.uint64)
        if held is not None:
            choice, bits, prints = (np.concatenate(x) for x in zip(held, (choice, bits, prints)))
        # whole runs only: what may go on in the next batch waits
        same = (choice == choice[-1]) & (bits == bits[-1])
        start = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        stop = start + (len(prints) - start - 1) // RUN * RUN
        yield from cut(choice[:stop], bits[:stop], prints[:stop], last=False)
        goes_on = stop > start or (goes_on and stop == 0)
        held = choice[stop:], bits[stop:], prints[stop:]
    if held is not None:
        yield from cut(*held, last=True)


def near(prints: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, fingerprint) at MOST_BITS or fewer, by position. ``prints`` is in Gray order."""
    low, high = [prints], [prints]
    while len(low[-1]) > FANOUT:
        starts = np.arange(0, len(low[-1]), FANOUT)
        low.append(np.bitwise_and.reduceat(low[-1], starts))
        high.append(np.bitwise_or.reduceat(high[-1], starts))
    agreed = [~(a ^ b) for a, b in zip(low, high)]
    for at in range(0, len(queries), 256):
        some = queries[at : at + 256]
        tops = np.arange(len(low[-1]))
        q, node = (x.ravel() for x in np.meshgrid(np.arange(len(some)), tops, indexing="ij"))
        parent = np.zeros(len(node), dtype=np.uint64)
        seen = np.zeros(len(node), dtype=np.uint8)
        for level in range(len(low) - 1, -1, -1):
            own = agreed[level][node] & ~parent  # bits that no node above has compared
            seen = seen + np.bitwise_count((some[q] ^ low[level][node]) & own)
            keep = seen <= MOST_BITS
            q, node, seen = q[keep], node[keep], seen[keep]
            if level:
                size = len(low[level - 1])
                parent = np.repeat(agreed[level][node], FANOUT)
                q, seen = np.repeat(q, FANOUT), np.repeat(seen, FANOUT)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                there = node < size
                q, node, seen, parent = q[there], node[there], seen[there], parent[there]
        yield q + at, node


def _stars(src: np.ndarray, dst: np.ndarray) -> pa.RecordBatch:
    vertex, root = roots(src, dst)
    far = vertex != root
    return pa.record_batch([vertex[far], root[far]], names=["src", "dst"])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.column("prints"):
            prints = row.values.to_numpy().view(np.uint64)
            found = [_stars(prints[q[q < n]].view(np.int64), prints[n[q < n]].view(np.int64))
                     for q, n in near(prints, prints)]
            yield _joined(found)


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for left, right in zip(batch.column("prints"), batch.column("others")):
            prints, others = (x.values.to_numpy().view(np.uint64) for x in (left, right))
            yield _joined([_stars(others[q].view(np.int64), prints[n].view(np.int64))
                           for q, n in near(prints, others)])


def _joined(found: list[pa.RecordBatch]) -> pa.RecordBatch:
    src, dst = (np.concatenate([x.column(i).to_numpy() for x in found]) for i in (0, 1))
    return _stars(src.astype(np.int64), dst.astype(np.int64))


def print_components(prints: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` of all fingerprints that have a link; ``prints`` is one long column,
    without repeats."""
    places = prints.mapInArrow(_places, "choice int, bits long, rank long, print long")
    ordered = places.repartitionByRange("choice", "bits", "rank").sortWithinPartitions(
        "choice", "bits", "rank"
    )
    runs = written(ordered.mapInArrow(_runs, RUNS))
    inner = runs.where("size(prints) > 1").select("prints").mapInArrow(_within, LINKS)
    shared = runs.groupBy("choice", "bits").count().where("count > 1").drop("count")
    several = runs.join(shared, ["choice", "bits"])
    other = several.select("choice", "bits", *(F.col(x).alias(f"{x}_2") for x in ("run", "low", "high")),
                           F.col("prints").alias("others"))
    roots_differ = F.expr("bit_count((low ^ low_2) & ~(low ^ high) & ~(low_2 ^ high_2))")
    pairs = several.join(other, ["choice", "bits"]).where(
        (F.col("run") < F.col("run_2")) & (roots_differ <= MOST_BITS)
    )
    return components(inner.union(pairs.select("prints", "others").mapInArrow(_between, LINKS)))


def simhash_components(docs: DataFrame, order: Column, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents with ``order`` and ``print``, and ``print`` with the least ``order`` of its component."""
    ship(docs.sparkSession)
    marked = written(docs.select(order.alias("order"), fingerprint_of(F.col(text)).alias("print")))
    prints = marked.groupBy("print").agg(F.min("order").alias("least"))
    found = print_components(prints.select("print"))
    rooted = prints.join(found, F.col("print") == F.col("vertex"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    group = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return marked, rooted.join(group, "root").select("print", "component")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    A null or empty text has fingerprint zero and is linked like any other. Repeated rows each give a
    row. A null ``doc_id`` stays null and names no component, unless all ids of the component are null.
    An empty table gives an empty table; other columns are left out. Texts of any length are read whole.
    """
    marked, groups = simhash_components(docs, F.col("doc_id"))
    return marked.join(groups, "print").select(
        F.col("order").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every component, whole: that with the least id (null last), then the least content.

    The choice is an aggregate that combines before the shuffle, so a group of copies sends one row
    per task. Columns of any name stay as they are.
    """
    ship(docs.sparkSession)
    tie = F.xxhash64(*(F.col(f"`{name}`") for name in docs.columns))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), tie.alias("tie"))
    _, groups = simhash_components(docs, order)
    best = groups.select(F.col("component").alias("__order")).distinct()
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns))
    chosen = docs.select(row.alias("__row"), order.alias("__order")).join(best, "__order")
    one = chosen.groupBy("__order").agg(F.first("__row").alias("__row"))
    return one.select("__row.*")
