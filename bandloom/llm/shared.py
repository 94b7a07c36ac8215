"""What the operators share: tables in the shared folder, code on the executors, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from bandloom.sources.files import delete_folder, join_path, scratch_folder

PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_bandloom_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="bandloom-code-")) / "bandloom_code.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(PACKAGE.rglob("*.py")):
            packed.write(file, file.relative_to(PACKAGE.parent).as_posix())
    context.addPyFile(str(archive))
    context._bandloom_shipped = True


#: Folders of the tables that the innermost open ``scratch_tables`` removes.
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``written`` inside are removed at the end, but those that last."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for folder in _SCOPES.pop():
            delete_folder(spark, folder)


#: Spark's own setting (4.1; others do not know it): a query that has ended leaves no shuffle files.
REMOVES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside remove their shuffle files then, not when the driver happens to collect its garbage."""
    before = spark.conf.get(REMOVES_SHUFFLES, None)
    spark.conf.set(REMOVES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVES_SHUFFLES)
        else:
            spark.conf.set(REMOVES_SHUFFLES, before)


def written(df: DataFrame, folder: str | None = None, lasting: bool = False) -> DataFrame:
    """The rows as a Parquet table in the shared folder: a later job never computes them again, and
    loses nothing with an executor. Inside ``scratch_tables`` the table is removed at its end; one that is
    ``lasting`` goes to the scope around it, if there is one."""
    spark = df.sparkSession
    path = join_path(scratch_folder(spark), "table") if folder is None else folder
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    scopes = _SCOPES[:-1] if lasting else _SCOPES
    if folder is None and scopes:
        scopes[-1].append(path.rsplit("/", 1)[0])
    return spark.read.schema(df.schema).parquet(path)


def by_id(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` dealt into ranges and sorted: by id (null first), rows of one id by a hash of
    their text, so that an id (or null) with very many rows is split like any other range."""
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = ("doc_id", F.xxhash64("text"), "text")
    return keyed.repartitionByRange(*order[:2]).sortWithinPartitions(*order)


MOST_BITS = 28  # the logarithm of the bits of a field of marks; this many are 32 MB
SPARSE = 4  # and of the bits for each key as long as there are fewer


class Marks:
    """A field of bits in which keys, 64-bit hashes, are marked: who is not marked is certainly not among them."""

    def __init__(self, width: int, words: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - width)
        self.bits = np.zeros((1 << width) // 8, dtype=np.uint8)
        self.bits.view("<u4")[words] = values

    def hit(self, a: np.ndarray) -> np.ndarray:
        at = a >> self.shift
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def marks_of(keys: DataFrame, a: str = "a") -> Marks:
    """The marks of a written table's keys. At most 2**MOST_BITS / 32 rows come to the driver, whatever the table holds."""
    frequent = keys.select(F.col(a).alias("a"))
    width = min(MOST_BITS, max(16, (frequent.count() << SPARSE).bit_length()))
    at = F.shiftrightunsigned("a", 64 - width)
    word = F.shiftright(at, 5).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(a, {64 - width}) & 31 as int))")
    table = frequent.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    return Marks(width, table["word"].to_numpy(), table["bits"].to_numpy().astype("<u4"))


def release_memory(keep_encoders: bool) -> None:
    """Give back what earlier tasks of this worker have left: Spark uses a worker for many stages."""
    encoding = sys.modules.get(f"{__package__}.encode")
    if encoding is not None and not keep_encoders:
        encoding.Encoder._open.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


def batches_of(
    batches: Iterator[pa.RecordBatch],
    weight: str,
    most_bytes: int,
    most_rows: int = 100_000,
    keep_encoders: bool = False,
) -> Iterator[pa.RecordBatch]:
    """Cut or join batches so that column ``weight`` holds about ``most_bytes`` in each; a longer
    value comes alone."""
    release_memory(keep_encoders)
    yield from _resized(batches, weight, most_bytes, most_rows)
    release_memory(keep_encoders)


def _resized(
    batches: Iterator[pa.RecordBatch], weight: str, most_bytes: int, most_rows: int
) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = count = 0
    for batch in batches:
        at = batch.schema.get_field_index(weight)
        start, here = 0, 0
        lengths = [0 if n is None else n for n in binary_lengths(batch.column(at))]
        for row, length in enumerate(lengths):
            if row > start and (size + here + length > most_bytes or count + row - start >= most_rows):
                held.append(batch.slice(start, row - start))
                yield one_batch(held)
                held, size, count, start, here = [], 0, 0, row, 0
            elif row == start and held and (size + length > most_bytes or count >= most_rows):
                yield one_batch(held)
                held, size, count = [], 0, 0
            here += length
        if start < batch.num_rows:
            held.append(batch.slice(start))
            size, count = size + here, count + batch.num_rows - start
    if held:
        yield one_batch(held)


def binary_lengths(column: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()


def one_batch(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

