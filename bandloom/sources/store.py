"""The store of benchmark results: a catalog table with soft deletes, views and snapshots.

The table is partitioned by model, state and upload. The active rows of a model are one partition, which an
upload overwrites; the rows that it makes inactive are a new partition of their own. Both are one write job
with dynamic partition overwrite: Spark stages the files and moves them when all tasks are through, so a job
that fails, or whose driver dies, leaves the table as it was. History is neither read nor written. Uploads of
one model are to follow each other; where several writers meet, use a catalog whose tables have transactions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import require_columns
from ..functions.sql import quoted, text
from ..operators.result import RESULT_SCHEMA, STORE_KEY
from ..operators.upsert import require_unique, upsert, verify_counts, with_active_flag
from .files import is_folder, join_path, replace_table

PARTITIONS = ["model", "state", "upload"]
ACTIVE, RETIRED, CURRENT = "active", "retired", "current"
MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def overwriting_partitions(spark: SparkSession) -> Iterator[None]:
    """Inside, an overwriting insert replaces the partitions that get rows, and no others."""
    before = spark.conf.get(MODE)
    spark.conf.set(MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(MODE, before)


VIEW_FILTERS = [
    "benchmark_name",
    "platform",
    "user_type",
    "metric_name",
    "model_name",
    "value_name",
    "benchmark_created_at",
]


def view(
    rows: DataFrame,
    *,
    limit: int | None = None,
    active_only: bool = False,
    order_by: Sequence[str] = ("benchmark_created_at", *STORE_KEY, "benchmark_id"),
    **filters: str | None,
) -> DataFrame:
    """Rows that equal every given filter; a limit takes the first rows in key order."""
    filters = {
        "benchmark_created_at" if name == "created_at" else name: value
        for name, value in filters.items()
    }
    unknown = sorted(set(filters) - set(VIEW_FILTERS))
    if unknown:
        raise ValueError(f"unknown filters {unknown}; known: {VIEW_FILTERS}")
    for name, value in filters.items():
        if value is not None:
            wanted = value.upper() if name == "model_name" else value
            rows = rows.filter(F.col(name) == F.lit(wanted))
    if active_only:
        rows = rows.filter("is_active")
    if limit is not None:
        order = [F.col(name).asc_nulls_first() for name in order_by if name in rows.columns]
        rows = rows.orderBy(*order).limit(limit)
    return rows


def snapshot_path(spark: SparkSession, path: str) -> str:
    """Where a snapshot goes: a folder gets a file name, a name without suffix the suffix."""
    if path.endswith("/") or (not path.endswith(".parquet") and is_folder(spark, path)):
        return join_path(path, "benchmark_table.parquet")
    return path if path.endswith(".parquet") else f"{path}.parquet"


def fetch(
    rows: DataFrame, path: str | None = None, model_name: str | None = None
) -> tuple[DataFrame, str | None]:
    """The rows (of one model, if named) and, when a path is given, the path of their snapshot.

    The snapshot may be the very table that the rows are read from."""
    rows = view(rows, model_name=model_name)
    if path is None:
        return rows, None
    return rows, replace_table(rows, snapshot_path(rows.sparkSession, path))


class BenchmarkStore:
    """A result store in a table of the session's catalog; with ``path`` its files are kept there.

    A catalog that does not know a table whose files are at ``path`` finds its partitions again."""

    def __init__(
        self, spark: SparkSession, table: str, keys: Sequence[str] = tuple(STORE_KEY), path: str | None = None
    ):
        self.spark = spark
        self.table = table
        self.keys = list(keys)
        self.path = path

    def _open(self) -> None:
        if self.spark.catalog.tableExists(self.table):
            return
        columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in RESULT_SCHEMA]
        columns += [f"{name} STRING" for name in PARTITIONS]
        place = "" if self.path is None else f" LOCATION {text(self.path)}"
        self.spark.sql(
            f"CREATE TABLE {self.table} ({', '.join(columns)}) USING parquet "
            f"PARTITIONED BY ({', '.join(PARTITIONS)}){place}"
        )
        if self._has_files():
            self.spark.catalog.recoverPartitions(self.table)

    def _has_files(self) -> bool:
        return self.path is not None and is_folder(self.spark, self.path)

    def exists(self) -> bool:
        """Whether there is a table, or files of one."""
        return self.spark.catalog.tableExists(self.table) or self._has_files()

    def _stored(self, model_name: str | None = None, active_only: bool = False) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], RESULT_SCHEMA)
        self._open()
        rows = self.spark.read.table(self.table)
        if model_name is not None:
            rows = rows.filter(F.col("model") == model_name.upper())
        if active_only:
            rows = rows.filter(F.col("state") == ACTIVE)
        return rows.select(*RESULT_SCHEMA.names)

    def active(self) -> DataFrame:
        """The active rows; history is not read."""
        return self._stored(active_only=True)

    def rows(self) -> DataFrame:
        """All rows: the active ones and everything that was replaced."""
        return self._stored()

    def upload(self, incoming: DataFrame, verify: bool = False) -> DataFrame | None:
        """Make active rows with the same key inactive and add the incoming rows, in one write job.

        Only the active rows of the models that come in are read and written again. Several active rows with one
        key are an error.
        """
        require_columns(incoming, self.keys)
        incoming = with_active_flag(incoming)
        absent = {f.name: F.lit(None) for f in RESULT_SCHEMA if f.name not in incoming.columns}
        incoming = incoming.withColumns(absent) if absent else incoming
        incoming = incoming.select(*[F.col(f.name).cast(f.dataType) for f in RESULT_SCHEMA])
        require_unique(incoming, self.keys)
        self._open()
        model = F.upper("model_name").alias("model")
        models = [row[0] for row in incoming.select(model).distinct().collect()]
        named = F.col("model").isin([name for name in models if name is not None])
        before = self.spark.read.table(self.table).filter(F.col("state") == ACTIVE)
        before = before.filter(named | F.col("model").isNull() if None in models else named)
        after = upsert(before.select(*RESULT_SCHEMA.names), incoming, self.keys)
        state = F.when(F.col("is_active"), ACTIVE).otherwise(RETIRED).alias("state")
        upload = F.when(F.col("is_active"), CURRENT).otherwise(uuid.uuid4().hex).alias("upload")
        placed = after.select("*", model, state, upload)
        emptied = placed.groupBy("model").agg(F.max("is_active").alias("left")).filter("NOT left").collect()
        # Rebalanced so that a partition is a few well-sized files, however the join was run.
        with overwriting_partitions(self.spark):
            placed.hint("rebalance", *PARTITIONS).write.insertInto(self.table, overwrite=True)
        for row in emptied:
            self._empty(row.model)
        return self.verify() if verify else None

    def _empty(self, model: str | None) -> None:
        """Overwrite the active rows of a model with none, as a write of partitions without rows changes nothing."""
        none = self.spark.createDataFrame([], RESULT_SCHEMA).createOrReplaceTempView
        none("bandloom_no_rows")
        own = "NULL" if model is None else text(model)
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.table} PARTITION (model = {own}, state = {text(ACTIVE)}, "
            f"upload = {text(CURRENT)}) SELECT * FROM bandloom_no_rows"
        )

    def verify(self) -> DataFrame:
        """Rows per key, id and active flag."""
        return verify_counts(self.rows(), [*self.keys, "benchmark_id"])

    def view(self, **filters) -> DataFrame:
        """See ``view``; a model and ``active_only`` read the partitions that hold such rows."""
        return view(self._stored(filters.get("model_name"), bool(filters.get("active_only"))), **filters)

    def fetch(
        self, path: str | None = None, model_name: str | None = None
    ) -> tuple[DataFrame, str | None]:
        """See ``fetch``; the partitions of other models are not read."""
        return fetch(self._stored(model_name), path, model_name)
