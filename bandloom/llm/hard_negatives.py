"""Hard negatives of anchor vectors by length buckets and coordinate pruning (LEMP).

Components become whole numbers, so every score is exact. The vectors are dealt into groups by descending
length and cut into buckets of neighbouring lengths. A bucket holds its vectors, their directions' coordinates
as sorted lists, and its greatest length. Anchors, in blocks, are sent once to every group, where they
pass all its buckets, the longest first:

* An anchor leaves a bucket out if its own length times the bucket's greatest is below the score it still needs.
* The score needed gives the least cosine that a vector must have, and that a range for each coordinate of its
  direction. On the anchor's few largest coordinates, its focus, the ranges are looked up in the sorted
  lists; where the shortest of them holds few vectors, those in all ranges are the candidates, else all are.
* Candidates are verified by their exact scores.

First each anchor's best vectors of its own label are found, then, with their scores, the best vectors of other
labels in the range of scores that each of these positives allows. The best of all groups are ranked at last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import ship, written

POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST, WHOLE = 50, 95, 100  # hundredths of the positive's score
SCALE = 256
BUCKET, GROUP = 2048, 1 << 17  # vectors of a bucket and of a group
BLOCK = 256  # anchors of a block
FOCUS = 3
FEW = 8  # candidates are listed where one of FEW vectors or fewer are in the shortest range
LAST = (1 << 63) - 1  # in place of a null id: it comes after all others
EXACT = 1 << 53

BUCKETS = "g int, kind int, n int, rows int, labels binary, ids binary, vectors binary, low binary, high binary"
FOUND = "anchor long, anchor_id long, nth int, id long, score long"


def usable(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """Whole vectors with a label: id (null: the last), label, x (whole numbers), length and whether an anchor."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE).cast("double"))
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    kept = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & good)
    return kept.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("id"), F.col("label").cast("long").alias("label"),
        x.alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).withColumn("length", length)


def matrix(rows: list[np.ndarray]) -> np.ndarray:
    """The vectors as rows; a shorter vector is filled with zeros, which add nothing to a score."""
    width = max((len(row) for row in rows), default=0)
    if all(len(row) == width for row in rows):
        return np.array(rows, dtype=np.float64).reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact scores of rows of whole numbers; beyond 53 bits by Python's integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width or not len(a) or not len(b):
        return np.zeros((len(a), len(b)))
    if np.abs(a).max() * np.abs(b).max() * width < EXACT:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(a) @ whole(b).T


class Bucket:
    """Vectors of neighbouring lengths, by descending length."""

    def __init__(self, labels: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.labels, self.ids, self.vectors = labels, ids, vectors
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        self.longest = float(lengths.max(initial=0.0))
        unit = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")  # the sorted list of each coordinate
        self.sorted = np.take_along_axis(unit, self.order, axis=0)
        self.unit = unit

    def candidates(self, unit: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows whose direction may have this cosine with ``unit``, or None for all of the bucket.

        With coordinate q of the anchor, one of the vector is within q c -+ sqrt((1 - q^2)(1 - c^2))."""
        if cosine <= 0.0 or not len(unit):
            return None
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        focus = focus[focus < self.sorted.shape[1]]
        half = np.sqrt(max(0.0, 1 - cosine * cosine) * np.maximum(0.0, 1 - unit[focus] ** 2)) + 1e-9
        # a cosine above c lies on a smaller circle about q, which may be further out: up to 1 where q > c
        low = np.where(-unit[focus] > cosine, -1.0, unit[focus] * cosine - half) - 1e-9
        high = np.where(unit[focus] > cosine, 1.0, unit[focus] * cosine + half) + 1e-9
        bounds = [(np.searchsorted(self.sorted[:, f], a), np.searchsorted(self.sorted[:, f], b, "right"))
                  for f, a, b in zip(focus.tolist(), low.tolist(), high.tolist())]
        if not bounds:
            return None
        shortest = min(range(len(bounds)), key=lambda i: bounds[i][1] - bounds[i][0])
        begin, end = bounds[shortest]
        if (end - begin) * FEW > len(self.ids):
            return None
        rows = self.order[begin:end, focus[shortest]]
        inside = self.unit[rows][:, focus]
        return rows[((inside >= low) & (inside <= high)).all(axis=1)]


class Best:
    """The best ``most`` of (score, id) seen: higher scores first, then smaller ids."""

    def __init__(self, most: int):
        self.most = most
        self.kept: list[tuple[int, int]] = []  # (-score, id), ascending

    def needed(self) -> int:
        return -self.kept[-1][0] if len(self.kept) == self.most else -LAST - 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.most:  # all that may be among the best, with every tie
            least = np.partition(scores, len(scores) - self.most)[len(scores) - self.most]
            near = scores >= least
            scores, ids = scores[near], ids[near]
        new = [(-int(s), int(i)) for s, i in zip(scores.tolist(), ids.tolist())]
        self.kept = sorted(self.kept + new)[: self.most]


class Wanted:
    """One search of an anchor: which labels count, between which scores, and the best so far."""

    def __init__(self, nth: int, same: bool, low: int, high: int, most: int):
        self.nth, self.same, self.low, self.high = nth, same, low, high
        self.best = Best(most)

    def needed(self) -> int:
        return max(self.low, self.best.needed())

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.needed()) & (scores <= self.high)
        if inside.any():
            self.best.add(scores[inside], ids[inside])


def bounds_of(positive: int) -> tuple[int, int]:
    """Least and greatest whole score of a negative."""
    return max(-LAST - 1, -(-LOWEST * positive // WHOLE)), min(LAST, HIGHEST * positive // WHOLE)


def search(bucket: Bucket, label: np.ndarray, own: np.ndarray, vectors: np.ndarray,
           wanted: list[list[Wanted]]) -> None:
    """Let the anchors of a block pass a bucket."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    whole: list[int] = []
    for i, searches in enumerate(wanted):
        if not searches:
            continue
        needed = min(one.needed() for one in searches)
        reach = float(lengths[i]) * bucket.longest * (1 + 1e-12)
        if reach < needed:
            continue
        rows = None
        if needed > 0 and reach > 0:
            rows = bucket.candidates(vectors[i] / lengths[i], min(1.0, needed / reach))
        if rows is None:
            whole.append(i)
        elif len(rows):
            _offer(searches, products(vectors[i : i + 1], bucket.vectors[rows])[0], bucket, rows, label[i], own[i])
    if whole:
        _offer_all(bucket, whole, label, own, products(vectors[whole], bucket.vectors), wanted)


def _offer_all(bucket: Bucket, whole: list[int], label: np.ndarray, own: np.ndarray, scores: np.ndarray,
               wanted: list[list[Wanted]]) -> None:
    """Offer whole lines of scores: those that matter to a search are found for all anchors at once."""
    alike = label[whole][:, None] == bucket.labels[None, :]
    fit = {True: alike & (own[whole][:, None] != bucket.ids[None, :]), False: ~alike}
    for slot in range(max(len(wanted[i]) for i in whole)):
        lines = [at for at, i in enumerate(whole) if slot < len(wanted[i])]
        searches = [wanted[whole[at]][slot] for at in lines]
        some = scores[lines]
        low = np.array([one.needed() for one in searches], dtype=some.dtype)[:, None]
        high = np.array([one.high for one in searches], dtype=some.dtype)[:, None]
        hits = fit[searches[0].same][lines] & (some >= low) & (some <= high)
        for at in np.flatnonzero(hits.any(axis=1)).tolist():
            searches[at].take(some[at][hits[at]], bucket.ids[hits[at]])


def _offer(searches: list[Wanted], scores: np.ndarray, bucket: Bucket, rows: np.ndarray, label: int, own: int) -> None:
    labels, ids = bucket.labels[rows], bucket.ids[rows]
    fit = {True: (labels == label) & (ids != own), False: labels != label}
    for one in searches:
        mask = fit[one.same]
        one.take(scores[mask], ids[mask])


def _packed(g: int, kind: int, n: int, labels, ids, vectors: np.ndarray, low=None, high=None) -> tuple:
    binary = lambda x, kind: None if x is None else np.asarray(x, dtype=kind).tobytes()
    return (g, kind, n, len(ids), binary(labels, "<i8"), binary(ids, "<i8"), binary(vectors, "<f8"),
            binary(low, "<i8"), binary(high, "<i8"))


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    labels, ids = (np.frombuffer(row[x], "<i8") for x in ("labels", "ids"))
    return labels, ids, np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1 if len(row["vectors"]) else 0)


def _vectors(batch: pa.RecordBatch) -> list[np.ndarray]:
    column = batch.column(batch.schema.get_field_index("x"))
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]


def _in_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list, list[np.ndarray]]]:
    labels, ids, rows = [], [], []
    for batch in batches:
        labels += batch.column("label").to_pylist()
        ids += batch.column("id").to_pylist()
        rows += _vectors(batch)
        while len(ids) >= size:
            yield labels[:size], ids[:size], rows[:size]
            labels, ids, rows = labels[size:], ids[size:], rows[size:]
    if ids:
        yield labels, ids, rows


def _rows(found: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*found)) if found else [[] for _ in fields]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    g = TaskContext.get().partitionId()
    for n, (labels, ids, rows) in enumerate(_in_blocks(batches, BUCKET)):
        yield _rows([_packed(g, 0, n, labels, ids, matrix(rows))], BUCKETS)


def _anchor_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() << 16
    for n, (labels, ids, rows) in enumerate(_in_blocks(batches, BLOCK)):
        yield _rows([_packed(0, 1, task + n, labels, ids, matrix(rows))], BUCKETS)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, kind and number: a group's buckets, then the blocks of anchors that pass them."""
    buckets: list[Bucket] = []
    group = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["g"] != group:
                group, buckets = row["g"], []
            labels, ids, vectors = _unpacked(row)
            if row["kind"] == 0:
                buckets.append(Bucket(labels, ids, vectors))
                continue
            if row["low"] is None:
                wanted = [[Wanted(0, True, -LAST - 1, LAST, POSITIVES)] for _ in ids]
            else:
                low, high = (np.frombuffer(row[x], "<i8").reshape(-1, POSITIVES).tolist() for x in ("low", "high"))
                wanted = [
                    [Wanted(k, False, a, b, NEGATIVES) for k, (a, b) in enumerate(zip(*ranges)) if a <= b]
                    for ranges in zip(low, high)
                ]
            for bucket in buckets:
                search(bucket, labels, ids, vectors, wanted)
            found = [
                (row["n"] * BLOCK + i, int(ids[i]), one.nth, best_id, max(-LAST - 1, min(LAST, -minus)))
                for i, searches in enumerate(wanted) for one in searches for minus, best_id in one.best.kept
            ]
            if found:
                yield _rows(found, FOUND)


def _with_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of anchors with the scores that a negative of each positive may have; no positive, no range."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            low, high = (np.full((row["rows"], POSITIVES), x, dtype="<i8") for x in (1, 0))
            for at, nth, score in zip(row.pop("at"), row.pop("nths"), row.pop("scores")):
                low[at, nth], high[at, nth] = bounds_of(score)
            out.append((0, 1, row["n"], row["rows"], row["labels"], row["ids"], row["vectors"], low.tobytes(),
                        high.tobytes()))
        yield _rows(out, BUCKETS)


def best_of(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each search of an anchor, with their ``rank``."""
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``. Rows with a null label, a null vector or a component
    that is null or not finite take no part. A component x becomes floor(256 x); a score is the integer inner
    product, of the components that both vectors have. An anchor's positives are its first 5 other rows of the
    same label, by descending score, then ascending id; for each, the first 3 rows of other labels whose
    score is between 50 and 95 hundredths of the positive's are its negatives, ranked from 1.

    Other rows are those of another id: repeated rows of an anchor are no positives of each other, and each is an
    anchor of its own with the same rows. A null id is the greatest in ties and comes back as null; it is no
    other row to an anchor of a null id. Scores beyond 64 bits are ranked as such and shown as the nearest long.
    Vectors without components have the score 0 with all others. Other columns are left out. An empty table,
    or one without anchors, gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    base = written(usable(vectors, is_anchor))
    n = base.count()
    groups = max(1, min(n // BUCKET + 1, max(-(-n // GROUP), spark.sparkContext.defaultParallelism)))
    by_length = base.repartitionByRange(groups, F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
    buckets = written(by_length.select("id", "label", "x").mapInArrow(_buckets, BUCKETS))
    anchors = written(base.where("anchor").select("id", "label", "x").mapInArrow(_anchor_blocks, BUCKETS))

    def passed(blocks: DataFrame) -> DataFrame:
        names = [field.split()[0] for field in BUCKETS.split(", ")[1:]]
        everywhere = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), *names)
        met = buckets.union(everywhere).repartitionById(groups, F.col("g")).sortWithinPartitions("g", "kind", "n")
        return met.mapInArrow(_scored, FOUND)

    positives = written(best_of(passed(anchors), POSITIVES).withColumn("nth", F.col("rank") - 1))
    ranges = positives.groupBy(F.expr(f"cast(anchor div {BLOCK} as int)").alias("n")).agg(
        F.collect_list(F.struct((F.col("anchor") % BLOCK).cast("int").alias("at"), "nth", "score")).alias("all")
    )  # of the anchors of a block: BLOCK * POSITIVES at most
    bounded = anchors.select("n", "rows", "labels", "ids", "vectors").join(ranges, "n").select(
        "n", "rows", "labels", "ids", "vectors", F.col("all.at").alias("at"), F.col("all.nth").alias("nths"),
        F.col("all.score").alias("scores"),
    )
    blocks = written(bounded.mapInArrow(_with_bounds, BUCKETS))
    negatives = best_of(passed(blocks), NEGATIVES)
    of = positives.select("anchor", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    back = lambda name: F.when(F.col(name) != LAST, F.col(name))
    return negatives.join(of, ["anchor", "nth"]).select(
        back("anchor_id").alias("anchor_id"), back("positive_id").alias("positive_id"), F.col("rank").cast("int"),
        back("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
