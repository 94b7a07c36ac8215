from .counting import feature_shares, invalid_scores, null_rates, score_metrics, segment_counts
from .features import distinct_rates, unpivot_features
from .joins import join_on_prefixed_key
from .prepare import json_keys, merge_sources, platform_from_channel, prepare_source
from .result import benchmark_id, keep_fullest, stamp, to_table
from .rows import duplicate_count, filter_population, latest_per_key
from .upsert import upsert, verify_counts

__all__ = [
    "benchmark_id",
    "distinct_rates",
    "duplicate_count",
    "feature_shares",
    "filter_population",
    "invalid_scores",
    "join_on_prefixed_key",
    "json_keys",
    "keep_fullest",
    "latest_per_key",
    "merge_sources",
    "null_rates",
    "platform_from_channel",
    "prepare_source",
    "score_metrics",
    "segment_counts",
    "stamp",
    "to_table",
    "unpivot_features",
    "upsert",
    "verify_counts",
]
