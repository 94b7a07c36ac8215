"""Reading and writing tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan Parquet files: a file, a folder, a glob, or several of them."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df if columns is None else df.select(*columns)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write snappy Parquet, a file per task."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def read_rows(
    spark: SparkSession,
    *,
    path: str | None = None,
    table: str | None = None,
    source: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stored rows from Parquet files, a catalog table, or any reader Spark has (such as ``jdbc``)."""
    if sum(given is not None for given in (path, table, source)) != 1:
        raise ValueError("give exactly one of path, table and source")
    if table is not None:
        return spark.read.table(table)
    if path is not None:
        return read_table(spark, path)
    return spark.read.format(source).options(**(options or {})).load()


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system a path lives on, and the path for it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_folder(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = file_system(spark, path)
    return system.exists(hadoop_path) and system.getFileStatus(hadoop_path).isDirectory()


def delete_folder(spark: SparkSession, path: str) -> None:
    system, hadoop_path = file_system(spark, path)
    system.delete(hadoop_path, True)


def replace_table(df: DataFrame, path: str) -> str:
    """Write rows in place of the table at ``path``, which they may be read from.

    The rows are written beside it first; only when they are there is the old table moved aside, the new one
    put in its place and the old one deleted. A job that fails leaves the old table as it was.
    """
    spark = df.sparkSession
    folder, name = path.rstrip("/").rsplit("/", 1)
    mark = uuid.uuid4().hex
    staged, old = (join_path(folder, f"_{name}.{kind}-{mark}") for kind in ("new", "old"))
    try:
        write_table(df, staged)
        system, target = file_system(spark, path)
        aside = file_system(spark, old)[1]
        had_one = system.exists(target)
        if had_one and not system.rename(target, aside):
            raise OSError(f"cannot move {path} aside")
        if not system.rename(file_system(spark, staged)[1], target):
            if had_one:
                system.rename(aside, target)
            raise OSError(f"cannot put the new table at {path}")
    except BaseException:
        delete_folder(spark, staged)
        raise
    delete_folder(spark, old)
    return path


def join_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder, which every executor can reach.

    Only a session that runs in a single process may go without the setting ``spark.checkpoint.dir``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="bandloom-")
    return join_path(shared, f"bandloom-{uuid.uuid4().hex}")
