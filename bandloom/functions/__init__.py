from .bands import feature_band, feature_band_count, feature_edges, invalid_score_label, score_band
from .columns import lower_columns, row_digest
from .segments import SEGMENTS, segment_label

__all__ = [
    "SEGMENTS",
    "feature_band",
    "feature_band_count",
    "feature_edges",
    "invalid_score_label",
    "lower_columns",
    "row_digest",
    "score_band",
    "segment_label",
]
