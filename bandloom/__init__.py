"""Benchmarks (baselines) for model monitoring, computed as Spark DataFrame plans."""

from .api import Benchmark, ModelConfig
from .plans.benchmark import benchmark_long, benchmark_table
from .plans.population import SourceTables, build_population
from .sources.metadata import Metadata, load_metadata
from .sources.store import BenchmarkStore

__all__ = [
    "Benchmark",
    "BenchmarkStore",
    "Metadata",
    "ModelConfig",
    "SourceTables",
    "benchmark_long",
    "benchmark_table",
    "build_population",
    "load_metadata",
]
