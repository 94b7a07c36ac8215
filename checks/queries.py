"""One query per operator. Each reads whole test tables and ends in plain columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from bandloom import Benchmark, ModelConfig, SourceTables, benchmark_long, build_population, operators as op
from bandloom.operators.result import arrays_to_text
from bandloom.operators.rows import POPULATION
from bandloom.sources.extract import export_query
from bandloom.sources.files import read_table, scratch_folder
from bandloom.sources.store import fetch, view

from .oracles import SHORT_SEGMENTS
from .standin import ALL_METRICS, METADATA, SEGMENT_NAMES, scored, table

Query = Callable[[SparkSession, str], DataFrame]
CUT_FEATURES = list(METADATA.feature_cuts)
FILL_FEATURES = list(METADATA.fills)


def everything(spark: SparkSession, folder: str) -> DataFrame:
    """All metrics of all populations."""
    population = op.json_keys(
        scored(spark, folder), "bureau_json", ["active_cc_count", "active_pl_count"]
    )
    return benchmark_long(population, ALL_METRICS, METADATA)


def long_result(spark: SparkSession, folder: str) -> DataFrame:
    return everything(spark, folder).select(
        *POPULATION,
        "metric_name",
        "value_name",
        "band_label",
        F.round("metric_value", 6).alias("metric_value"),
        F.round("total", 6).alias("total"),
    )


def score_values(spark: SparkSession, folder: str, metric: str, values: list[str]) -> DataFrame:
    population = scored(spark, folder, items=False)
    return op.score_metrics(population, METADATA.score_cuts, {metric: values})


def band_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return score_values(spark, folder, "PSI", ["score"]).select(
        *POPULATION,
        F.col("band_no").alias("model_band"),
        "cnt",
        F.col("total").cast("long").alias("total_count"),
        F.col("metric_value").alias("pct"),
    )


def band_population(spark: SparkSession, folder: str) -> DataFrame:
    return score_values(spark, folder, "PSI", ["total_population"]).select(
        *POPULATION,
        F.col("band_no").alias("model_band"),
        "cnt",
        F.col("total").cast("long").alias("total_count"),
    )


def status_trend(spark: SparkSession, folder: str) -> DataFrame:
    return score_values(spark, folder, "DRIFT_IN_MB", ["fa", "ca", "d1", "d2"]).select(
        *POPULATION,
        "value_name",
        F.col("band_no").alias("model_band"),
        "cnt",
        F.col("total").cast("long").alias("total_count"),
    )


def status_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return score_values(spark, folder, "DRIFT_IN_MB", ["ca/fa", "d1/fa"]).select(
        *POPULATION,
        "value_name",
        F.col("band_no").alias("model_band"),
        F.round("metric_value", 6).alias("ratio"),
        F.round("total", 6).alias("ratio_total"),
    )


def invalid_score(spark: SparkSession, folder: str) -> DataFrame:
    return op.invalid_scores(scored(spark, folder, items=False)).select(
        *POPULATION, F.col("band_label").alias("band_name"), "cnt"
    )


def shares(spark: SparkSession, folder: str, metric: str) -> DataFrame:
    return op.feature_shares(scored(spark, folder), {metric: CUT_FEATURES}, METADATA.feature_cuts, METADATA.fills)


def csi(spark: SparkSession, folder: str) -> DataFrame:
    return shares(spark, folder, "CSI").select(
        *POPULATION,
        F.col("value_name").alias("feature"),
        F.col("band_no").alias("feature_band"),
        F.col("metric_value").alias("pct"),
    )


def feature_range_drift(spark: SparkSession, folder: str) -> DataFrame:
    return shares(spark, folder, "FEATURE_RANGE_DRIFT").select(
        *POPULATION,
        F.col("value_name").alias("feature"),
        F.col("band_no").alias("feature_band"),
        "cnt",
    )


def null_rate(spark: SparkSession, folder: str) -> DataFrame:
    return op.null_rates(scored(spark, folder), FILL_FEATURES, METADATA.fills).select(
        *POPULATION,
        F.col("value_name").alias("feature"),
        F.col("cnt").alias("null_count"),
        F.col("total").cast("long").alias("total_count"),
    )


def distinct_rate(spark: SparkSession, folder: str) -> DataFrame:
    return op.distinct_rates(scored(spark, folder), FILL_FEATURES).select(
        *POPULATION,
        F.col("value_name").alias("feature"),
        F.col("cnt").alias("distinct_count"),
        F.col("total").cast("long").alias("total_count"),
    )


def segment_population(spark: SparkSession, folder: str) -> DataFrame:
    return op.json_keys(
        scored(spark, folder, items=False), "bureau_json", ["active_cc_count", "active_pl_count"]
    )


def segment_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return op.segment_counts(segment_population(spark, folder), SEGMENT_NAMES).select(
        *POPULATION, "value_name", F.col("band_label").alias("segment_band"), "cnt"
    )


def one_segment(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return op.segment_counts(segment_population(spark, folder), [name]).select(
        *POPULATION, F.col("band_label").alias("segment_band"), "cnt"
    )


def population_filter(spark: SparkSession, folder: str) -> DataFrame:
    population = scored(spark, folder, items=False)
    return op.filter_population(population, "APP_A", "NEW").select("id", *POPULATION)


def platform_from_channel(spark: SparkSession, folder: str) -> DataFrame:
    platform = op.platform_from_channel(F.col("platform"), {"APP_A": "A"}, "OTHER")
    return scored(spark, folder, items=False).select("id", platform.alias("p"))


def feature_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    return op.unpivot_features(scored(spark, folder), ["sum_qty", "max_discount", "acctbal"], ["id"])


def computed_key_join(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    customer = customer.select(
        F.concat(F.lit("#"), F.col("c_custkey").cast("string")).alias("reference_no"), "c_name"
    )
    population = scored(spark, folder, items=False).select("id", "ref_no")
    joined = op.join_on_prefixed_key(population, customer, "ref_no", "reference_no", "#")
    return joined.select("id", "c_name")


def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type")
    return op.latest_per_key(events, "user_id", "ts", "event_id")


def dedup_population(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["id", "ref_no", "created_at", *POPULATION, "output_value", "status"]
    population = scored(spark, folder, items=False).select(*columns)
    return op.latest_per_key(population, "ref_no", "created_at", "id")


def duplicate_count(spark: SparkSession, folder: str) -> DataFrame:
    return op.duplicate_count(scored(spark, folder, items=False), "ref_no")


def json_map_extract(spark: SparkSession, folder: str) -> DataFrame:
    return segment_population(spark, folder).select("id", "active_cc_count", "active_pl_count")


def two_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers as features, their orders as scores, the event log as production log of two platforms."""
    features = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"))
    outputs = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("v30_pred_prob")
    )
    log = table(spark, folder, "events").select(
        F.col("user_id").alias("BUREAU_REFERENCE_NUMBER"),
        F.col("ts").alias("created_at"),
        "event_id",
        F.col("event_type").alias("channel"),
        F.col("value").alias("OUTPUT_VALUE"),
        F.col("props").alias("NEW_BUREAU_VARIABLES"),
    )
    in_app = F.col("channel").isin("view", "click")
    source = partial(
        op.prepare_source,
        features,
        outputs,
        tie_break="event_id",
        drop_from_production=["output_value"],
        drop=["channel", "event_id"],
        drop_prefixes=["model"],
    )
    channel = op.platform_from_channel(F.col("channel"), {"purchase": "APP_B"}, "WEB_AGG")
    return source(log.filter(in_app), F.lit("APP_A")), source(log.filter(~in_app), channel), source(log, channel)


def prepare_source(spark: SparkSession, folder: str) -> DataFrame:
    """One source that takes the whole log."""
    return two_sources(spark, folder)[2]


def merge_sources(spark: SparkSession, folder: str) -> DataFrame:
    merged = op.merge_sources(two_sources(spark, folder)[:2], keys=["k"])
    return merged.select("id", "created_at", "platform", "acctbal", "n_orders", "output_value", "k")


def source_tables(spark: SparkSession, folder: str) -> list[SourceTables]:
    """The two sources as a user names them; every customer stands twice in the features, with another balance
    in the row that is not to be kept."""
    customer = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_acctbal AS acctbal", "c_mktsegment AS user_type_final", "1 AS revision"
    )
    earlier = customer.withColumns({"acctbal": -F.col("acctbal"), "revision": F.lit(0)})
    outputs = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.expr("count(*) AS n_orders"),
        F.expr("max(o_totalprice) / 500000D AS v30_pred_prob"),
        F.expr("if(max(o_orderstatus) = 'P', 'FINAL_APPROVED', 'COND_APPROVED') AS status"),
    )
    log = table(spark, folder, "events").selectExpr(
        "user_id AS BUREAU_REFERENCE_NUMBER", "ts AS created_at", "event_id", "event_type AS channel",
        "props AS NEW_BUREAU_VARIABLES",
    )
    in_app = F.col("channel").isin("view", "click")
    source = partial(
        SourceTables, earlier.union(customer), outputs, drop=["channel"], features_order="revision",
        outputs_order="id",
    )
    return [
        source(production=log.filter(in_app), platform="APP_A"),
        source(production=log.filter(~in_app), platform="WEB_AGG", channels={"purchase": "APP_B"}),
    ]


def whole_population(spark: SparkSession, folder: str) -> DataFrame:
    rows = build_population(spark, source_tables(spark, folder), tie_break="EVENT_ID", json_keys=["k"])
    return rows.select(
        "id", "event_id", "created_at", *POPULATION, "acctbal", "n_orders", "output_value", "status", "k"
    )


def created(spark: SparkSession, folder: str) -> tuple[Benchmark, DataFrame]:
    model = ModelConfig(source_tables(spark, folder), METADATA, tie_break="event_id")
    place = scratch_folder(spark)
    table = f"bandloom_store_{place.rsplit('-', 1)[1]}"
    bench = Benchmark(spark, {"MODEL_X": model}, table, f"{place}/bench", store_path=f"{place}/store")
    request = {"PSI": ["score", "total_population"], "NULL_RATE": "acctbal", "INVALID_SCORE": None}
    return bench, bench.create_benchmark(
        model_name="MODEL_X", benchmark_name="b", metric_dict=request, save_intermediate=False
    )


def flat(rows: DataFrame) -> DataFrame:
    """Result rows with their arrays as text; numbers are in thousandths."""
    whole = lambda name: f"concat_ws(',', transform({name}, x -> string(bigint(round(x * 1000)))))"
    return rows.selectExpr(
        "benchmark_id", "model_name", *POPULATION, "metric_name", "value_name",
        "concat_ws(',', categories) AS categories", f"{whole('cutpoints')} AS cutpoints",
        f"{whole('coalesce(bin_counts, category_count)')} AS counts", "total_count", "is_active",
    )


def create_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return flat(created(spark, folder)[1])


def stored_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """A result in the store, and that of one platform uploaded once more."""
    bench, result = created(spark, folder)
    bench.store.upload(result)
    bench.store.upload(result.filter("platform = 'APP_A'"))
    return flat(bench.view_benchmark(model_name="model_x"))


def row_null_count_dedup(spark: SparkSession, folder: str) -> DataFrame:
    measured = ["output_value", "employment_type", "sum_qty"]
    kept = op.keep_fullest(
        scored(spark, folder), POPULATION, measured=measured, tie_break="id"
    )
    return kept.select(*POPULATION, "id")


def two_metrics(spark: SparkSession, folder: str) -> DataFrame:
    request = {"PSI": "total_population", "SEGMENT_DISTRIBUTION": SEGMENT_NAMES}
    return benchmark_long(segment_population(spark, folder), request, METADATA)


def result_table(spark: SparkSession, folder: str) -> DataFrame:
    key = ["model_name", *POPULATION, "metric_name", "value_name"]
    stamped = op.stamp(two_metrics(spark, folder), "model_x")
    return stamped.select(
        op.benchmark_id(*key).alias("benchmark_id"),
        *key,
        "band_label",
        "cnt",
        F.col("total").cast("long").alias("total_count"),
        "is_active",
    )


def result_arrays(spark: SparkSession, folder: str) -> DataFrame:
    counts = op.segment_counts(segment_population(spark, folder), SEGMENT_NAMES)
    arrays = op.to_table(counts)
    return arrays.select(
        *POPULATION,
        "value_name",
        F.concat_ws(",", "categories").alias("categories"),
        F.concat_ws(",", F.col("category_count").cast("array<bigint>").cast("array<string>")).alias(
            "category_count"
        ),
        "total_count",
    )


def result_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The arrays of result rows as JSON text."""
    arrays = op.to_table(op.segment_counts(segment_population(spark, folder), SEGMENT_NAMES))
    return arrays_to_text(arrays.select(*POPULATION, "value_name", "categories", "category_count"))


def glob_read(spark: SparkSession, folder: str) -> DataFrame:
    """Files found by a pattern."""
    return read_table(spark, f"{folder}/reg*.parquet", ["r_regionkey", "r_name"])


def exported_query(spark: SparkSession, folder: str) -> DataFrame:
    """A query's result, written as part files and read again."""
    table(spark, folder, "orders").createOrReplaceTempView("bandloom_orders")
    query = "SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS last_key FROM bandloom_orders GROUP BY 1;"
    return spark.read.parquet(export_query(spark, query, scratch_folder(spark), "orders", "daily"))


def created_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """The creation stamp on every row of a result, a given one in place of the clock's."""
    stamped = op.stamp(two_metrics(spark, folder), "model_x", created_at="2024-01-31 08:00:00")
    return stamped.groupBy("benchmark_created_at", "tracking_type", "model_name").agg(F.count(F.lit(1)).alias("n"))


def store_upsert(spark: SparkSession, folder: str) -> DataFrame:
    key = ["platform", "employment_type"]
    stored = scored(spark, folder, items=False).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    incoming = stored.filter(F.col("platform") == "APP_A").withColumn("n", F.col("n") + 1000)
    return op.upsert(stored.withColumn("is_active", F.lit(True)), incoming, key)


def store_verify_counts(spark: SparkSession, folder: str) -> DataFrame:
    active = F.col("status") == "FINAL_APPROVED"
    rows = scored(spark, folder, items=False).withColumn("is_active", active)
    return op.verify_counts(rows, POPULATION)


def store_view(spark: SparkSession, folder: str) -> DataFrame:
    rows = result_table(spark, folder)
    return view(
        rows,
        platform="APP_B",
        metric_name="PSI",
        limit=20,
        order_by=["benchmark_id", "band_label"],
    )


def store_fetch(spark: SparkSession, folder: str) -> DataFrame:
    return fetch(result_table(spark, folder), model_name="model_x")[0]


def store_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Two models in the store; a snapshot of one is written, and written over itself."""
    bench, result = created(spark, folder)
    bench.store.upload(result)
    bench.store.upload(result.withColumn("model_name", F.lit("OTHER")))
    place = scratch_folder(spark)
    path = bench.get_benchmark("model_x", f"{place}/")[1]
    return flat(spark.read.parquet(fetch(spark.read.parquet(path), path)[1]))


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "benchmark_long": long_result,
        "model_band_distribution": band_distribution,
        "model_band_population": band_population,
        "status_trend": status_trend,
        "status_ratio": status_ratio,
        "invalid_score": invalid_score,
        "csi": csi,
        "feature_range_drift": feature_range_drift,
        "null_rate": null_rate,
        "distinct_rate": distinct_rate,
        "segment_distribution": segment_distribution,
        "population_filter": population_filter,
        "platform_from_channel": platform_from_channel,
        "feature_unpivot": feature_unpivot,
        "computed_key_join": computed_key_join,
        "latest_per_key": latest_per_key,
        "dedup_population": dedup_population,
        "duplicate_count": duplicate_count,
        "json_map_extract": json_map_extract,
        "prepare_source": prepare_source,
        "merge_sources": merge_sources,
        "build_population": whole_population,
        "create_benchmark": create_benchmark,
        "stored_benchmark": stored_benchmark,
        "row_null_count_dedup": row_null_count_dedup,
        "result_table": result_table,
        "result_arrays": result_arrays,
        "result_texts": result_texts,
        "glob_read": glob_read,
        "exported_query": exported_query,
        "created_stamp": created_stamp,
        "store_upsert": store_upsert,
        "store_view": store_view,
        "store_fetch": store_fetch,
        "store_snapshot": store_snapshot,
        "store_verify_counts": store_verify_counts,
    }
    for short, name in SHORT_SEGMENTS.items():
        named[f"segment_{short}"] = partial(one_segment, name=name)
    return named
