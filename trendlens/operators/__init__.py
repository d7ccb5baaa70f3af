from trendlens.operators.joins import overlap_with
from trendlens.operators.series import moving_average, one_per_period, period_delta
from trendlens.operators.tags import (
    explode_tags,
    frequent_tags,
    keep_pairable_tags,
    sorted_pairs,
    tag_array,
    tag_pairs,
)
from trendlens.operators.topk import kth_best, top_k, top_k_with_ties
from trendlens.operators.windows import windowed_agg

__all__ = [
    "overlap_with", "windowed_agg", "moving_average", "one_per_period", "period_delta",
    "explode_tags", "frequent_tags", "keep_pairable_tags", "sorted_pairs", "tag_array", "tag_pairs", "kth_best", "top_k",
    "top_k_with_ties",
]
