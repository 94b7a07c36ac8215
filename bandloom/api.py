"""The entry point for users: create, upload, view and get benchmarks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .operators.rows import as_list
from .plans.benchmark import benchmark_table
from .plans.population import SourceTables, build_population, materialise
from .plans.request import Request, normalise_metrics, required_columns
from .sources.files import join_path, write_table
from .sources.metadata import Metadata
from .sources.store import BenchmarkStore

POPULATION_FILE = "bench_input.parquet"
RESULT_FILE = "bench_output.parquet"


@dataclass
class ModelConfig:
    """What one model is benchmarked from."""

    sources: Sequence[SourceTables]
    metadata: Metadata
    platforms: list[str] = field(default_factory=list)
    user_types: list[str] = field(default_factory=list)
    tie_break: str | Sequence[str] | None = None


class Benchmark:
    """Benchmarks of a set of models, kept in one store."""

    def __init__(
        self,
        spark: SparkSession,
        models: Mapping[str, ModelConfig],
        store: str,
        bench_path: str | None = None,
        store_path: str | None = None,
    ):
        """``store`` names the catalog table of the results; ``store_path`` is where its files are to be kept."""
        self.spark = spark
        self.models = dict(models)
        self.store = BenchmarkStore(spark, store, path=store_path)
        self.bench_path = bench_path
        self.row_counts: dict[str, int] = {}

    def create_benchmark(
        self,
        platform: str | Sequence[str] | None = None,
        user_type: str | Sequence[str] | None = None,
        metric_name: str | None = None,
        value_name: str | Sequence[str] | None = None,
        model_name: str | None = None,
        benchmark_name: str | None = None,
        benchmark_start_date: str | None = None,
        benchmark_end_date: str | None = None,
        save_intermediate: bool = True,
        bench_path: str | None = None,
        metric_dict: Request | None = None,
        on_missing: str = "raise",
        **attributes,
    ) -> DataFrame:
        """Compute the requested metrics and write the result table below ``bench_path``.

        Two writes happen: the prepared population, once, and the result of all metrics and
        populations. ``save_intermediate`` keeps the population next to the result; otherwise it only
        lives in the shared checkpoint folder during the call, in the columns that the metrics read.
        Returns the written result. ``row_counts`` then has the rows of all sources, of the population, and how many
        duplicates were left out, counted while the population was written.
        """
        if model_name not in self.models:
            raise KeyError(f"model {model_name!r} is not configured; available: {list(self.models)}")
        folder = bench_path or self.bench_path
        if folder is None:
            raise ValueError("give a bench_path for the result")
        model = self.models[model_name]
        request = normalise_metrics(metric_name, value_name, metric_dict)
        columns = None if save_intermediate else required_columns(request, model.metadata, on_missing)
        merged, chosen = Observation(), Observation()
        population = build_population(
            self.spark, model.sources, tie_break=model.tie_break, columns=columns, observation=merged
        ).observe(chosen, F.count(F.lit(1)).alias("rows"))
        kept = join_path(folder, POPULATION_FILE) if save_intermediate else None
        with materialise(population, kept) as rows:
            before, after = merged.get["rows"], chosen.get["rows"]
            self.row_counts = {"rows": before, "population": after, "duplicates": before - after}
            result = benchmark_table(
                rows,
                request,
                model.metadata,
                model_name,
                platforms=as_list(platform) or model.platforms or None,
                user_types=as_list(user_type) or model.user_types or None,
                on_missing=on_missing,
                benchmark_name=benchmark_name,
                start_time=benchmark_start_date,
                end_time=benchmark_end_date,
                **attributes,
            )
            path = write_table(result, join_path(folder, RESULT_FILE))
        return self.spark.read.schema(result.schema).parquet(path)

    def upload_benchmark(self, parquet_path: str, verify_upload: bool = False) -> DataFrame | None:
        """Upsert a written result into the store; with ``verify_upload`` return the counts per key."""
        return self.store.upload(self.spark.read.parquet(parquet_path), verify_upload)

    def view_benchmark(
        self,
        benchmark_name: str | None = None,
        platform: str | None = None,
        user_type: str | None = None,
        metric_name: str | None = None,
        model_name: str | None = None,
        value_name: str | None = None,
        created_at: str | None = None,
        limit: int | None = None,
        active_only: bool = False,
    ) -> DataFrame:
        """Stored rows that equal every given filter."""
        return self.store.view(
            benchmark_name=benchmark_name,
            platform=platform,
            user_type=user_type,
            metric_name=metric_name,
            model_name=model_name,
            value_name=value_name,
            created_at=created_at,
            limit=limit,
            active_only=active_only,
        )

    def get_benchmark(
        self, model_name: str | None = None, output_path: str | None = None
    ) -> tuple[DataFrame, str | None]:
        """The stored rows, of one model if named, and the path they were written to, if any."""
        return self.store.fetch(output_path, model_name)
