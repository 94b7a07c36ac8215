"""Run a query and keep its result as Parquet part files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .files import join_path, write_table


def export_query(
    spark: SparkSession, query: str, folder: str, source: str, prefix: str = ""
) -> str:
    """Write the result of a query to ``<folder>/<source>_base_<prefix>`` and return that path.

    Tasks write their part files straight to the target; nothing passes through the driver.
    """
    target = join_path(folder, f"{source}_base_{prefix}")
    return write_table(spark.sql(query.strip().rstrip(";")), target)
