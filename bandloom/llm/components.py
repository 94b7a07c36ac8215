"""Connected components of a link table, by alternating large and small stars.

Each round points every vertex at the least vertex it knows of and relinks the neighbours to that one,
so the distance to a component's least vertex shrinks geometrically. A round is one aggregate and one
join on the vertex; the aggregate combines before the shuffle and the join is an ordinary sort-merge
join, whose hot keys (the centre of a large star) Spark splits. No vertex list, link list or component
is ever held by one task or by the driver: the driver sees one count and one checksum per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import ship, written

LINKS = "src long, dst long"
AT_ONCE = 1 << 18  # links that a task contracts at once


def roots(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of the given links and the least vertex of each one's component among them."""
    vertices, flat = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = flat[: len(src)], flat[len(src) :]
    label = np.arange(len(vertices))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return vertices, vertices[label]
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of some batches at a time by stars: as many rows at most, the same components."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(one.num_rows for one in held) >= AT_ONCE:
            yield _stars(held)
            held = []
    if held:
        yield _stars(held)


def _stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    src, dst = (np.concatenate([one.column(i).to_numpy() for one in held]) for i in range(2))
    vertex, root = roots(src, dst)
    far = vertex != root
    return pa.record_batch([vertex[far], root[far]], names=["src", "dst"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least"))
    joined = both.join(least, "src").withColumn("least", F.least("src", "least"))
    return joined.where("dst > src and dst != least").select(
        F.col("dst").alias("src"), F.col("least").alias("dst")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the larger to the smaller vertex."""
    least = links.groupBy("src").agg(F.min("dst").alias("least"))
    moved = links.join(least, "src").where("dst != least").select(
        F.col("dst").alias("src"), F.col("least").alias("dst")
    )
    return moved.union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` (the least vertex of its component) of every vertex with a link.

    ``links`` has two long columns, ``src`` and ``dst``. Links to oneself, repeated and reversed links
    count once; null ends are no links. An empty table gives an empty table.
    """
    spark = links.sparkSession
    ship(spark)
    clean = links.toDF("src", "dst").where("src is not null and dst is not null and src != dst")
    stars = written(clean.mapInArrow(_contract, LINKS))
    before = None
    while True:
        now = stars.agg(
            F.count("*"),
            F.coalesce(F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")), F.lit(0)),
        ).head()
        if now == before or now[0] == 0:
            return stars.select(F.col("src").alias("vertex"), F.col("dst").alias("root")).union(
                stars.select("dst", "dst").distinct()
            )
        before = now
        stars = written(_small_star(_large_star(stars)))
