from trendlens.plans.analytics import (
    avg_comments_per_category,
    duration_vs_popularity,
    engagement_by_region,
    fastest_growth_videos,
    popularity_over_time,
    regional_engagement,
    top_categories,
    top_engagement,
    top_tag_combinations,
    top_tags,
    trending_by_day_of_week,
    view_count_change_per_day,
)
from trendlens.plans.history import hist_channel_ids, hist_region_stats, views_baseline
from trendlens.plans.prepare import (
    MAX_REALISTIC_VIEWS,
    OBSERVATION_COLUMNS,
    add_derived,
    drop_outliers,
    prepare,
    select_typed,
)

__all__ = [
    "avg_comments_per_category", "duration_vs_popularity", "engagement_by_region",
    "fastest_growth_videos", "popularity_over_time", "regional_engagement", "top_categories",
    "top_engagement", "top_tag_combinations", "top_tags", "trending_by_day_of_week",
    "view_count_change_per_day", "hist_channel_ids", "hist_region_stats", "views_baseline",
    "MAX_REALISTIC_VIEWS", "OBSERVATION_COLUMNS", "prepare", "add_derived", "drop_outliers",
    "select_typed",
]
