"""The scored population that all metrics are computed on."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.columns import require_columns
from ..operators.prepare import (
    JSON_COLUMN,
    JSON_KEYS,
    REFERENCE_KEY,
    RENAMES,
    merge_sources,
    platform_from_channel,
    prepare_source,
)
from ..operators.rows import as_list, latest_per_key
from ..sources.files import delete_folder, read_table, scratch_folder, write_table

_SOURCE = "__source"
#: Paths or a glob of Parquet files, or rows from anywhere else (see ``read_rows``).
Table = str | Sequence[str] | DataFrame


def _rows(spark: SparkSession, table: Table) -> DataFrame:
    return table if isinstance(table, DataFrame) else read_table(spark, table)


@dataclass
class SourceTables:
    """The tables of one source, by path or as DataFrames, and what to keep of them.

    The platform is one name, or comes from the production log's channel.
    """

    features: Table
    outputs: Table
    production: Table
    platform: str
    channels: Mapping[str, str] = field(default_factory=dict)
    channel_column: str = "channel"
    drop_from_production: Sequence[str] = ()
    drop: Sequence[str] = ()
    drop_prefixes: Sequence[str] = ()
    reference_key: str = REFERENCE_KEY
    #: Columns by which one of several rows of an id is chosen, highest first; see ``prepare_source``.
    features_order: str | Sequence[str] | None = None
    outputs_order: str | Sequence[str] | None = None

    def platform_column(self) -> Column:
        if not self.channels:
            return F.lit(self.platform)
        return platform_from_channel(F.col(self.channel_column), self.channels, self.platform)


def build_population(
    spark: SparkSession,
    sources: Sequence[SourceTables],
    *,
    id_column: str = "id",
    latest_by: str = "created_at",
    tie_break: str | Sequence[str] | None = None,
    json_column: str | None = JSON_COLUMN,
    json_keys: Sequence[str] = JSON_KEYS,
    renames: Mapping[str, str] = RENAMES,
    columns: Sequence[str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Join every source, stack them, and keep the latest row of each id.

    Since one row per id is kept in the end, each table is brought to one row per id *before* it is
    joined, so that joins are one-to-one and no repeated id can blow up. All tables are shuffled on the
    id once; joins, union and the last choice run on that partitioning. Of rows with the same time in
    several sources, the one from the source listed first is kept (after ``tie_break``, if given). With
    ``columns`` the population has these only (and the id), and no others are read, hashed or shuffled. An
    ``observation`` gets the number of ``rows`` of all sources together when the population is written.
    """
    wanted = None if columns is None else {name.lower() for name in [id_column, *columns]}
    only = None
    if wanted is not None:
        if json_column is not None and wanted.isdisjoint([json_column.lower(), *map(str.lower, json_keys)]):
            json_column = None
        only = [*wanted, *[old for old, new in renames.items() if new.lower() in wanted]]
        only += [] if json_column is None else [json_column]
    prepared = []
    for position, source in enumerate(sources):
        frame = prepare_source(
            _rows(spark, source.features),
            _rows(spark, source.outputs),
            _rows(spark, source.production),
            source.platform_column(),
            id_column=id_column,
            reference_key=source.reference_key,
            latest_by=latest_by,
            tie_break=tie_break,
            drop_from_production=source.drop_from_production,
            drop=source.drop,
            drop_prefixes=source.drop_prefixes,
            one_row_per_id=True,
            only=only,
            features_order=source.features_order,
            outputs_order=source.outputs_order,
        )
        # The join made the reference key equal to the id. Spark keeps the partitioning of a union
        # only if it is on a single column, so the second name of the key is put back at the end.
        prepared.append(frame.drop(source.reference_key).withColumn(_SOURCE, F.lit(-position)))
    merged = merge_sources(prepared, json_column=json_column, keys=json_keys, renames=renames)
    if observation is not None:
        merged = merged.observe(observation, F.count(F.lit(1)).alias("rows"))
    named = {old.lower(): new for old, new in (renames or {}).items()}
    ties = [named.get(name.lower(), name.lower()) for name in as_list(tie_break) or []]
    require_columns(merged, ties)
    population = latest_per_key(merged, id_column, latest_by, [*ties, _SOURCE]).drop(_SOURCE)
    names = {source.reference_key.lower() for source in sources}
    population = population.withColumns({name: F.col(id_column) for name in names})
    if wanted is not None:
        population = population.select([name for name in population.columns if name.lower() in wanted])
    return population


@contextmanager
def materialise(df: DataFrame, path: str | None = None) -> Iterator[DataFrame]:
    """Write the population once and give back the written table.

    Metrics then scan their own columns of a Parquet table, and lost executors cost a re-read and not
    the joins. Without a path the table goes to the shared checkpoint folder and is removed at the end.
    """
    spark = df.sparkSession
    target = path or scratch_folder(spark)
    write_table(df, target)
    try:
        yield spark.read.schema(df.schema).parquet(target)
    finally:
        if path is None:
            delete_folder(spark, target)
