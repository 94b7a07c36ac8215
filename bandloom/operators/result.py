"""From the long form to rows of the result table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import require_columns, row_digest
from .rows import as_list, first_per_key

TEXT, DOUBLES = T.StringType(), T.ArrayType(T.DoubleType())
# Names and order of the result columns.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("benchmark_created_at", TEXT),
        T.StructField("benchmark_name", TEXT),
        T.StructField("benchmark_id", TEXT),
        T.StructField("benchmark_start_time", TEXT),
        T.StructField("benchmark_end_time", TEXT),
        T.StructField("tracking_type", TEXT),
        T.StructField("model_name", TEXT),
        T.StructField("platform", TEXT),
        T.StructField("user_type", TEXT),
        T.StructField("metric_name", TEXT),
        T.StructField("value_name", TEXT),
        T.StructField("cutpoints", DOUBLES),
        T.StructField("bin_counts", DOUBLES),
        T.StructField("categories", T.ArrayType(TEXT)),
        T.StructField("category_count", DOUBLES),
        T.StructField("total_count", T.DoubleType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("start_date", TEXT),
        T.StructField("end_date", TEXT),
        T.StructField("meta_data", TEXT),
    ]
)
# What names a result, and what names it in the store.
RESULT_KEY = ["model_name", "platform", "user_type", "metric_name", "value_name"]
STORE_KEY = [*RESULT_KEY, "benchmark_name"]


def created_now() -> str:
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def benchmark_id(*key: str) -> Column:
    """A row id made from the row's key, so that a rerun (or a retried task) gives the same id.

    The key is hashed as a JSON array, so nulls and separators inside a text keep different keys apart.
    """
    parts = F.array(*[F.col(name).cast("string") for name in key])
    return F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}), 256)


def stamp(
    df: DataFrame,
    model_name: str,
    *,
    benchmark_name: str | None = None,
    created_at: str | None = None,
    start_time: str | None = None,
    end_time: str | None = None,
    tracking_type: str = "DAILY",
    is_active: bool = True,
    start_date: str | None = None,
    end_date: str | None = None,
    meta_data: str | None = None,
) -> DataFrame:
    """Put the attributes of a run on every result row."""
    attributes = {
        "benchmark_created_at": created_at or created_now(),
        "benchmark_name": benchmark_name,
        "benchmark_start_time": start_time,
        "benchmark_end_time": end_time,
        "tracking_type": tracking_type,
        "model_name": model_name.upper(),
        "start_date": start_date,
        "end_date": end_date,
        "meta_data": meta_data,
    }
    columns = {name: F.lit(value).cast("string") for name, value in attributes.items()}
    return df.withColumns({**columns, "is_active": F.lit(is_active)})


# The range of each number of ``numbers``, from all edges: the outermost are dropped if there are three.
RANGES = """transform(numbers, no -> CASE WHEN no > 0 THEN concat(
    '(', coalesce(string(get(CASE WHEN size(edges) > 2 THEN slice(edges, 2, size(edges) - 2)
                               WHEN size(edges) > 0 THEN slice(edges, -1, 1) END, no - 2)), '-inf'),
    ', ', coalesce(string(get(CASE WHEN size(edges) > 2 THEN slice(edges, 2, size(edges) - 2)
                               WHEN size(edges) > 0 THEN slice(edges, -1, 1) END, no - 1)), 'inf'),
    IF(no = n_bands, ')', ']')) END)"""


def to_table(long: DataFrame) -> DataFrame:
    """One row per population, metric and value, with its bands as arrays in band order.

    Arrays of banded values start with the rows that fall in no band, then hold one entry for each
    band, 0 for an empty one; position i is band i. Categories stand beside the counts they describe: band
    numbers, or ranges of values for FEATURE_RANGE_DRIFT, and null for no band. Other arrays are in label
    order. A row is as long as the value has bands, or labels in the case of a segment of free text.
    """
    entry = F.struct(
        F.coalesce("band_no", F.lit(0)).alias("no"),
        F.col("band_label").alias("label"),
        F.col("metric_value").alias("value"),
    )
    rows = long.groupBy("platform", "user_type", "metric_name", "value_name").agg(
        F.sort_array(F.collect_list(entry)).alias("bands"),
        F.max("total").alias("total_count"),
        F.max("n_bands").alias("n_bands"),
        F.max("edges").alias("edges"),
    )
    rows = rows.withColumn("by_number", F.map_from_arrays(F.col("bands.no"), F.col("bands.value")))
    numbers = F.sequence(F.lit(0), F.col("n_bands"))
    banded = F.col("n_bands").isNotNull()
    rows = rows.withColumns(
        {
            "numbers": F.when(banded, numbers),
            "counts": F.when(
                banded,
                F.transform(
                    numbers, lambda no: F.coalesce(F.try_element_at(F.col("by_number"), no), F.lit(0.0))
                ),
            ).otherwise(F.col("bands.value")),
        }
    )
    metric, value = F.col("metric_name"), F.lower("value_name")
    as_share = metric.isin("CSI") | (metric.isin("PSI", "DRIFT_IN_MB") & (value == "score"))
    as_bins = as_share | metric.isin("NULL_RATE", "DISTINCT_RATE")
    ranged = metric == "FEATURE_RANGE_DRIFT"
    labels = (
        F.when(ranged, F.expr(RANGES))
        .when(
            banded,
            F.transform("numbers", lambda no: F.when(no > 0, no.cast("string"))),
        )
        .otherwise(F.col("bands.label"))
    )
    return rows.select(
        "platform",
        "user_type",
        "metric_name",
        "value_name",
        F.when(as_share | ranged, F.col("edges")).alias("cutpoints"),
        F.when(as_bins, F.col("counts")).alias("bin_counts"),
        F.when(~as_bins, labels).alias("categories"),
        F.when(~as_bins, F.col("counts")).alias("category_count"),
        "total_count",
    )


def result_rows(table: DataFrame) -> DataFrame:
    """Stamped table rows as the typed result columns, in their fixed order."""
    table = table.withColumn("benchmark_id", benchmark_id(*STORE_KEY))
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA.fields])


def keep_fullest(
    df: DataFrame,
    keys: str | Sequence[str] = tuple(RESULT_KEY),
    *,
    measured: Sequence[str] | None = None,
    tie_break: str | Sequence[str] | None = None,
) -> DataFrame:
    """Of the rows of one key keep the one with the fewest nulls (in ``measured``, default: all columns)."""
    keys = as_list(keys)
    require_columns(df, keys)
    nulls = F.lit(0)
    for name in measured or df.columns:
        nulls = nulls + F.col(f"`{name}`").isNull().cast("int")
    ties = [F.col(name).asc_nulls_last() for name in as_list(tie_break) or []]
    return first_per_key(df, keys, [nulls.asc(), *(ties or [row_digest(df).asc()])])


def arrays_to_text(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for sinks that hold plain columns only."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`"), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
