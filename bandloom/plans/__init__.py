from .benchmark import benchmark_long, benchmark_table
from .population import SourceTables, build_population, materialise
from .request import expand_metrics, normalise_metrics

__all__ = [
    "SourceTables",
    "benchmark_long",
    "benchmark_table",
    "build_population",
    "expand_metrics",
    "materialise",
    "normalise_metrics",
]
